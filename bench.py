"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "parse_log_lines",
    "parse_json_lines",
    "partition_overwrite",
    "latest_snapshot",
    "latest_snapshot_single",
    "dedup_exact_line",
    "flag_same_instant",
    "nest_child_replay",
    "silver_leads",
    "silver_events",
    "silver_orders_flags",
    "silver_items_flags",
    "silver_reviews_flags",
    "fact_order",
    "fact_order_item",
    "fact_session",
    "kpi_sales_month",
    "kpi_sales_state_month",
    "kpi_delivery_month",
    "kpi_lead_month",
    "kpi_funnel_day",
    "topk_sellers",
    "fk_orphans",
    "kpi_compare",
)


def main() -> None:
    from tidemark.catalog.queries import QUERIES
    from tidemark.catalog.tables import FINISHED, Tables

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start the engine before timing

    # tables that several queries read are written first, as in a batch run, and timed apart
    inputs, seconds = {}, {}
    tables = Tables(spark, sf_dir)
    for name in FINISHED:
        started = time.perf_counter()
        tables[name]
        inputs[name] = round(time.perf_counter() - started, 3)
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    seconds["write_finished_tables"] = round(sum(inputs.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "finished_tables": inputs,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
