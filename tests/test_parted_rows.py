"""Rows that need no other row of their key are not shuffled for it."""

from __future__ import annotations

from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.catalog import inputs
from tidemark.operators import latest
from tidemark.operators.batches import Batch, BatchPlan, replay_children
from tidemark.plans import anomalies, second_route, silver

PLAN = BatchPlan((Batch("one", "2020-06-30 23:59:59"), Batch("two", "2020-12-31 23:59:59")))


def tuples(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanged(frame) -> list[str]:
    """What the shuffles of a plan are dealt by."""
    return [line.split("hashpartitioning(")[1] for line in plan_of(frame).splitlines() if "Exchange hashpartitioning(" in line]


@pytest.fixture(params=[64, 1 << 26])
def marks(request, monkeypatch):
    """With 64 bits nearly every key shares its bit with others."""
    monkeypatch.setattr(latest, "MARK_BITS", request.param)


def versions(spark):
    rows = [("a", 0, 1), ("a", 1, 2), ("b", 1, 3), ("b", 1, 4), ("b", 0, 5), ("c", 0, 6), ("c", 0, 7), (None, 0, 8), (None, 1, 9), (None, 1, 10)]
    rows += [(f"k{n}", n % 2, n) for n in range(100, 400)] + [("none", None, 11)]
    return spark.createDataFrame(rows, "k string, seq int, v int")


def test_latest_rows_above_a_lowest_sequence(spark, marks):
    rows = versions(spark)
    found = latest.latest_rows(rows, ["k"], "seq", lowest=0)
    assert tuples(found) == tuples(latest.latest_rows(rows, ["k"], "seq"))
    assert {r.v for r in found.collect() if r.v < 100} == {2, 3, 4, 6, 7, 9, 10}


def test_repeated_keys_are_parted_from_the_rest(spark, marks):
    rows = versions(spark)
    once, rest = latest.parted_by_repeat(rows, ["k"])
    assert tuples(once.unionByName(rest)) == tuples(rows)
    assert once.count() == once.select("k").distinct().count()
    assert not {r.k for r in once.collect()} & {r.k for r in rest.collect()}
    assert {"a", "b", "c", None} <= {r.k for r in rest.collect()}


def test_only_marks_and_hashes_are_shuffled(spark):
    once, _ = latest.parted_by_repeat(versions(spark), ["k"])
    assert exchanged(once) and all("__word" in by or "__hash" in by or "_groupingexpression" in by for by in exchanged(once))
    orders = spark.createDataFrame([], ", ".join(f"{c} string" for c in ("order_id", "customer_id", "order_status", *silver.ORDER_TIMES, "source_file", "batch_id")))
    assert "Union" in plan_of(silver.orders(orders, PLAN)) and "LeftAnti" in plan_of(silver.orders(orders, PLAN))


def test_equal_lines_and_shared_reviews(spark, marks):
    reviews = spark.createDataFrame([("r", "1"), ("r", "2"), ("r", "2"), ("s", "1"), ("s", "1"), ("t", "3"), (None, "1"), (None, "2")], "review_id string, order_id string")
    shared = anomalies.shared_reviews(reviews)
    assert tuples(shared) == [("r", 2)]
    assert "hash" in plan_of(shared) and "BroadcastHashJoin" in plan_of(shared)
    event = {"user_id": "u", "session_id": "s", "order_id": None, "product_id": None, "outcome": None, "event_type": "home", "amount": None}
    shape = "user_id string, session_id string, order_id string, product_id string, outcome string, event_type string, amount double, event_ts timestamp_ntz, raw_line string, is_parsed boolean, batch_id string, source_file string, ingested_at timestamp_ntz"
    lines = [("x", "two"), ("x", "one"), ("x", None), ("y", "two"), ("z", "odd")]
    rows = [(*event.values(), datetime(2020, 1, 1), line, True, batch, "f", datetime(2020, 1, 2)) for line, batch in lines]
    unique = silver.distinct_events(silver.evaluate_events(spark.createDataFrame(rows, shape)), PLAN)
    assert sorted(str(r.batch_id) for r in unique.collect()) == ["odd", "one", "two"]
    assert "BroadcastHashJoin" in plan_of(unique)


def test_newest_of_the_second_route(spark, marks):
    rows = spark.createDataFrame([("a", "x", "one"), ("a", "y", "two"), ("b", "z", "odd"), (None, "n", "one"), (None, "m", "one")], "id string, v string, batch_id string")
    newest = second_route._newest(rows, {"key": F.trim("id")}, ["v"], PLAN)
    assert tuples(newest) == sorted([("a", "y"), ("b", "z"), (None, "n")], key=repr)
    assert "BroadcastHashJoin" in plan_of(newest)


def test_sums_of_the_second_route_are_read_not_made_again(spark):
    sums = {c: F.lit(1).cast("long") for c in (*second_route.DELIVERY_SUMS, "n_orders_total", "n_canceled_orders", "n_valid_orders")}
    leads = ("n_leads", "n_leads_with_deal", "n_close_time_valid_deals", "sum_days_to_close", "n_leads_not_excluded", "n_won_30d")
    funnel = {c for pair in second_route.FUNNEL_RATES.values() for c in pair}
    day = spark.createDataFrame([(date(2020, 11, 3),)], "day date")
    month = F.lit("2020-11")
    orders = day.select("day", month.alias("year_month"), F.lit("x").alias("customer_state"), *[v.alias(c) for c, v in sums.items()], F.lit(5).cast(second_route.MONEY).alias("sum_revenue"))
    lead = day.select("day", month.alias("year_month"), F.lit("o").alias("origin"), *[F.lit(1).cast("long").alias(c) for c in leads])
    sessions = day.select(F.col("day").alias("session_date"), month.alias("year_month"), *[F.lit(1).cast("long").alias(c) for c in sorted(funnel)])
    found = second_route.kpi_tables(orders, lead, sessions, PLAN)
    assert [r.year_month for r in found["kpi_sales_month"].orderBy("year_month").collect()] == ["2020-11", "2020-12"]
    assert not [name for name, rows in found.items() if "Expand" in plan_of(rows) or second_route.FIRST in rows.columns]


def test_deals_are_spelled_after_their_choice(spark, tmp_path):
    at = pa.timestamp("us")
    days = [datetime(2000, 1, 2), datetime(2001, 6, 5), None, datetime(2005, 1, 1)]
    lines = [(k, 7 + n, 10 * k, n + 1, float(n) if n else None, 2.5, ["N", "A", None][n], "O", days[(k + n) % 4]) for k in range(1, 9) for n in range(3)]
    names = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.string(), at)
    pq.write_table(pa.table({n: pa.array([r[i] for r in lines], t) for i, (n, t) in enumerate(zip(names, types))}), tmp_path / "lineitem.parquet")
    orders = {
        "o_orderkey": pa.array(range(1, 10), pa.int64()), "o_custkey": pa.array(range(1, 10), pa.int64()),
        "o_orderdate": pa.array([datetime(1999, 1, 1)] * 9, at), "o_orderpriority": ["1-URGENT"] * 9,
    }
    pq.write_table(pa.table(orders), tmp_path / "orders.parquet")
    found = inputs.replayed_leads(spark, str(tmp_path))
    spelled = replay_children(
        inputs.lead_parents(spark, str(tmp_path)), inputs.deal_children(spark, str(tmp_path)), "mql_id", "first_contact_date", "won_date", "deal",
        [F.asc(c) for c in inputs.FIRST_DEAL], inputs.BATCHES,
    )
    assert found.dtypes == spelled.dtypes and tuples(found) == tuples(spelled) and found.where("deal.has_company IS NOT NULL").count()
    below = found._jdf.queryExecution().optimizedPlan().toString().split("Window [")[1]
    assert "declared_monthly_revenue" not in below and "reseller" not in below
