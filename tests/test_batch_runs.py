"""Batch runs: counts that were published, states instead of older raw rows, and what readers see meanwhile."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_plans import D, first_batch, second_batch, write_csv, write_raw
from tidemark.operators import checks
from tidemark.operators.batches import MARKETPLACE_BATCHES as PLAN
from tidemark.plans import pipeline
from tidemark.plans.contract import GOLD_COLUMNS
from tidemark.sources import routed
from tidemark.sources.tables import overwrite_batches

BULK = PLAN.ids[0]


def shown(spark, layout, layer, names):
    return {n: sorted(map(str, layout.read(spark, layer, n).drop("ingested_at").collect())) for n in names}


def published(root, **rows):
    lines = ["table_name,bulk,2018-06,2018-07,2018-08,total_rows,distinct_keys,excluded"]
    lines += [f"{name},{bulk},0,0,0,{bulk},{bulk},0" for name, bulk in rows.items()]
    (root / "raw").mkdir(parents=True, exist_ok=True)
    (root / "raw" / pipeline.COUNTS_FILE).write_text("\n".join(lines) + "\n")


def test_raw_is_counted_while_it_is_written(spark, tmp_path, monkeypatch):
    first_batch(tmp_path)
    layout = pipeline.Layout(str(tmp_path))
    with monkeypatch.context() as patched:
        frame = type(spark.range(1))

        def no_second_scan(self):
            raise AssertionError("raw was read a second time")

        patched.setattr(frame, "count", no_second_scan)
        assert pipeline.load_bronze(spark, layout, BULK) == 16
    reviews = layout.read(spark, "bronze", "order_reviews").first()
    assert reviews.is_parsed and reviews.review_comment_message == "two\nlines"


def test_a_batch_unlike_the_published_counts_is_refused(spark, tmp_path):
    first_batch(tmp_path)
    layout = pipeline.Layout(str(tmp_path))
    published(tmp_path, orders=2, clickstream=3, order_items=3)
    with pytest.raises(pipeline.RowCountError, match="order_items .*: 2 rows in bronze, 3 published"):
        pipeline.load_bronze(spark, layout, BULK)
    published(tmp_path, orders=2, clickstream=4, order_items=2)
    with pytest.raises(pipeline.RowCountError, match="clickstream_events"):
        pipeline.load_bronze(spark, layout, BULK)
    published(tmp_path, orders=2, clickstream=3, order_items=2)
    assert pipeline.load_bronze(spark, layout, BULK) == 16


def test_bad_csv_rows_stay_in_bronze(spark, tmp_path):
    first_batch(tmp_path)
    write_csv(tmp_path, BULK, "order_payments", [("o1", "1", "card", "1", "11.00"), ("o2", "1", "card", "1", "3.00", "more"), ("o2", "2")])
    layout = pipeline.Layout(str(tmp_path))
    pipeline.load_bronze(spark, layout, BULK)
    bronze = layout.read(spark, "bronze", "order_payments")
    assert {r.raw_record for r in bronze.where("NOT is_parsed").collect()} == {"o2,1,card,1,3.00,more", "o2,2"}
    pipeline.build_silver(spark, layout, PLAN, BULK)
    assert [r.order_id for r in layout.read(spark, "silver", "order_payments").collect()] == ["o1"]


def test_a_batch_reads_no_older_rows(spark, tmp_path):
    """The first batch's rows are spoiled before the second one is loaded, and the result is the rebuild's."""
    first_batch(tmp_path)
    layout = pipeline.Layout(str(tmp_path))
    for number, batch in enumerate((BULK, "2018-06")):
        if number:
            second_batch(tmp_path)
        pipeline.load_bronze(spark, layout, batch)
    whole = pipeline.Layout(str(tmp_path))
    pipeline.build_silver(spark, whole, PLAN)
    names = ("leads", "orders", "order_items", "order_reviews", "clickstream_events")
    wanted = shown(spark, whole, "silver", names)
    steps = pipeline.Layout(str(tmp_path / "steps"))
    first_batch(tmp_path / "steps")
    pipeline.load_bronze(spark, steps, BULK)
    pipeline.build_silver(spark, steps, PLAN, BULK)
    steps.publish("state", "silver")
    second_batch(tmp_path / "steps")
    pipeline.load_bronze(spark, steps, "2018-06")
    # whoever reads the first batch's rows again would take these for its rows
    wrong = {"orders": "order_id", "marketing_leads": "mql_id", "clickstream_events": "session_id"}
    for name, key in wrong.items():
        first = steps.read(spark, "bronze", name).where(F.col("batch_id") == BULK)
        rows = spark.createDataFrame(first.collect(), first.schema).withColumn(key, F.lit("wrong"))
        overwrite_batches(rows, steps.table("bronze", name))
    pipeline.build_silver(spark, steps, PLAN, "2018-06")
    assert shown(spark, steps, "silver", names) == wanted


def test_any_batch_again_equals_the_rebuild(spark, tmp_path):
    first_batch(tmp_path)
    root = str(tmp_path)
    for batch, bring in ((BULK, None), ("2018-06", second_batch)):
        if bring:
            bring(tmp_path)
        layout = pipeline.Layout(root)
        pipeline.load_bronze(spark, layout, batch)
        pipeline.build_silver(spark, layout, PLAN, batch)
        layout.publish("state", "silver")
    # the first batch comes again with another order, another event, and without its lead
    write_csv(tmp_path, BULK, "orders", [
        ("o1", "c1", "shipped", D("02"), D("02"), D("03"), "", D("20")), ("o3", "c2", "created", D("04"), "", "", "", D("20")),
    ])
    write_raw(tmp_path, BULK, "marketing_funnel", "marketing_leads.jsonl",
              '{"mql_id":"m2","first_contact_date":"2018-01-06","landing_page_id":"p"}\n')
    layout = pipeline.Layout(root)
    pipeline.load_bronze(spark, layout, BULK)
    pipeline.build_silver(spark, layout, PLAN, BULK)
    whole = pipeline.Layout(root)
    pipeline.build_silver(spark, whole, PLAN)
    names = ["leads", "orders", "order_reviews", "clickstream_events", "leads_rejects", "clickstream_rejects"]
    assert shown(spark, layout, "silver", names) == shown(spark, whole, "silver", names)
    assert {r.order_id for r in layout.read(spark, "silver", "orders").collect()} == {"o1", "o3"}
    assert {r.mql_id for r in layout.read(spark, "silver", "leads").collect()} == {"m1", "m2"}


def test_readers_see_checked_tables_only(spark, tmp_path, monkeypatch):
    first_batch(tmp_path)
    root, layout = str(tmp_path), pipeline.Layout(str(tmp_path))
    pipeline.run_batch(spark, root, BULK)
    old = shown(spark, layout, "gold", GOLD_COLUMNS)
    second_batch(tmp_path)
    with monkeypatch.context() as patched:
        failing = checks.Check("made to fail", spark.range(1))
        patched.setattr(pipeline, "silver_checks", lambda *_: [checks.Check("nothing", spark.range(0))])
        patched.setattr(pipeline, "gold_checks", lambda *_: [failing])
        with pytest.raises(checks.ChecksFailed, match="made to fail"):
            pipeline.run_batch(spark, root, "2018-06")
    assert shown(spark, layout, "gold", GOLD_COLUMNS) == old
    assert layout.read(spark, "silver", "leads").where(F.col("has_deal")).count() == 1
    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "silver_checks", lambda *_: [checks.Check("nothing", spark.range(0))])
        patched.setattr(pipeline.Draft, "commit", lambda self: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            pipeline.run_batch(spark, root, "2018-06")
    assert shown(spark, layout, "gold", GOLD_COLUMNS) == old


def test_gold_agrees_with_the_second_route(spark, tmp_path):
    first_batch(tmp_path)
    second_batch(tmp_path)
    layout = pipeline.Layout(str(tmp_path))
    for batch in (BULK, "2018-06"):
        pipeline.load_bronze(spark, layout, batch)
    pipeline.build_silver(spark, layout, PLAN)
    pipeline.build_gold(spark, layout, PLAN)
    found = pipeline.second_route_check(spark, layout, PLAN).violations.collect()
    assert found == []
    draft = layout.draft(spark, "gold")
    months = layout.read(spark, "gold", "kpi_sales_month")
    off = F.when(F.col("n_valid_orders") > 0, F.col("avg_order_value") + 0.001).otherwise(F.col("avg_order_value"))
    draft.name += "-off"
    draft.write("kpi_sales_month", spark.createDataFrame(months.withColumn("avg_order_value", off).collect(), months.schema))
    found = pipeline.second_route_check(spark, layout, PLAN).violations.collect()
    assert {(r.table_name, r.kpi_name, r.problem) for r in found} == {("kpi_sales_month", "avg_order_value", "different")}


def test_routed_leads_are_loaded(spark, tmp_path):
    """What the routed writer leaves is what a batch reads; what it set apart is not read."""
    rows = [(BULK, '{"mql_id":"m1"}'), (BULK, '{"mql_id":"m2"}'), ("2018-06", '{"mql_id":"m1","deal":{"sr_id":"s"}}'), ("_excluded", '{"mql_id":"m2"}')]
    routed.write_routed(spark.createDataFrame(rows, "route string, value string"), str(tmp_path / "raw" / "marketing_funnel"), pipeline.LEADS_FILE)
    layout = pipeline.Layout(str(tmp_path))
    assert [pipeline.load_bronze(spark, layout, batch) for batch in (BULK, "2018-06")] == [2, 1]
    loaded = layout.read(spark, "bronze", "marketing_leads").where("is_parsed")
    assert sorted((r.mql_id, r.deal is not None) for r in loaded.collect()) == [("m1", False), ("m1", True), ("m2", False)]
