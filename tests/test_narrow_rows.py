"""What is shuffled and written is no wider than it must be."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq

from tidemark.catalog import inputs
from tidemark.operators.batches import Batch, BatchPlan
from tidemark.plans import silver
from tidemark.sources import scratch

PLAN = BatchPlan((Batch("one", "2020-12-31 23:59:59"),))
ORDER = "order_id string, order_purchase_timestamp timestamp_ntz"
ITEM = (
    "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string, "
    "price string, freight_value string, source_file string, batch_id string"
)
REVIEW = (
    "review_id string, order_id string, review_score string, review_comment_title string, "
    "review_comment_message string, review_creation_date string, review_answer_timestamp string, "
    "source_file string, batch_id string"
)


def joined_columns(frame) -> list[str]:
    """Names below the join with the orders, as the plan has them."""
    plan = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(n for n, line in enumerate(plan) if "Join LeftOuter" in line)
    return plan[at + 1].split("Project [", 1)[1].split(", ")


def test_joins_carry_no_raw_text(spark):
    orders = spark.createDataFrame([("o", datetime(2020, 1, 5))], ORDER)
    items = spark.createDataFrame([("o", "x", "p", "s", "2020-09-01 00:00:00", "1.5", "abc", "f", "one"), ("q", "1", "p", "s", None, "2", "3", "f", "one")], ITEM)
    done = silver.order_items(items, orders)
    assert sorted((r.order_id, r.dq_flag) for r in done.collect()) == [("o", "I1,T1:order_item_id,T1:freight_value"), ("q", None)]
    assert not [c for c in joined_columns(done) if c.startswith("__raw_") or " AS __raw_" in c]
    reviews = spark.createDataFrame([("r", "o", "five", None, None, "2020-01-01 00:00:00", "soon", "f", "one")], REVIEW)
    done = silver.order_reviews(reviews, orders, PLAN)
    assert [r.dq_flag for r in done.collect()] == ["R2,T1:review_score,T1:review_answer_timestamp"]
    top = done._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[1].splitlines()[1]
    assert "__raw_" not in top.split("CASE", 1)[0]


def test_item_totals_are_exact_and_narrow(spark, tmp_path):
    prices = [0.1, 0.2, 12345678.99, 12345678.99, None]
    rows = pa.table({
        "l_orderkey": [1] * 4 + [2], "l_linenumber": pa.array([1] * 4 + [1], pa.int32()), "l_partkey": [5] * 5, "l_suppkey": [6] * 5,
        "l_shipdate": pa.array([datetime(2000, 1, 1)] * 5, pa.timestamp("us")), "l_extendedprice": pa.array(prices, pa.float64()),
        "l_quantity": pa.array([1.0, 2.25, 3.0, 4.0, 5.0]),
    })
    pq.write_table(rows, tmp_path / "lineitem.parquet")
    found = inputs.item_totals(spark, str(tmp_path))
    assert sorted((r.l_orderkey, r.price, r.freight) for r in found.collect()) == [
        (1, Decimal("24691358.28"), Decimal("10.25")), (2, None, Decimal("5.00")),
    ]
    assert dict(found.dtypes)["price"] == dict(found.dtypes)["freight"] == "decimal(12,2)"
    assert found._jdf.queryExecution().executedPlan().toString().count("as bigint)") >= 2


def test_written_tables_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_path", lambda spark, name: str(tmp_path / name))
    assert scratch.written_table(spark.range(10), "ids").count() == 10
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "ids").glob("part-*")]
    assert {f.row_group(0).column(0).compression for f in files if f.num_row_groups} == {"ZSTD"}
