"""Lookup tables that ship with the models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.batches import MARKETPLACE_BATCHES, BatchPlan
from tidemark.sources.scratch import small_table

# Quality flags, their table, what they mean, and what they exclude.
FLAGS = (
    ("D1", "orders", "delivered without customer date", "AN-03", "delivery"),
    ("D2", "orders", "not delivered but has customer date", "AN-03", "delivery"),
    ("D3", "orders", "carrier date before purchase", "AN-02", "none"),
    ("D4", "orders", "customer date before carrier date", "AN-01", "delivery"),
    ("D5", "orders", "delivered without approval", "AN-03", "none"),
    ("D6", "orders", "carrier date before approval", "AN-02", "none"),
    ("D7", "orders", "delivered without carrier date", "AN-03", "none"),
    ("I1", "order_items", "shipping limit over 148 days after purchase", "AN-05", "none"),
    ("P1", "order_payments", "payment type not defined", "AN-06", "none"),
    ("P2", "order_payments", "payment value is zero", "AN-06", "none"),
    ("P3", "order_payments", "no instalments", "AN-06", "none"),
    ("R2", "order_reviews", "created before the purchase date", "AN-09", "review score"),
    ("PR1", "products", "no category", "AN-10", "none"),
    ("PR2", "products", "weight is zero, read as missing", "AN-10", "none"),
    ("PR3", "products", "a dimension is missing", "AN-10", "none"),
    ("C1", "leads", "deal won before first contact", "AN-13", "close time"),
    ("E1", "clickstream_events", "event after the session's purchase", "AN-15", "none"),
    ("E2", "clickstream_events", "same instant as another event", "AN-15", "none"),
    ("T1", "every table", "value that does not fit the type", "none", "none"),
)
FLAG_SCHEMA = "flag_id string, table_name string, condition string, an_id string, excluded_from string"

# Anomalies the published data is known to hold.
ANOMALIES = (
    ("AN-01", "D4", "orders", 23),
    ("AN-02", "D3", "orders", 166),
    ("AN-02", "D6", "orders", 1359),
    ("AN-03", "D1", "orders", 8),
    ("AN-03", "D2", "orders", 6),
    ("AN-03", "D5", "orders", 14),
    ("AN-03", "D7", "orders", 2),
    ("AN-04", None, "orders", 756),
    ("AN-05", "I1", "order_items", 4),
    ("AN-06", "P1_P2_P3", "order_payments", 10),
    ("AN-07", None, "order_payments", 303),
    ("AN-08", None, "order_reviews", 779),
    ("AN-09", "R2", "order_reviews", 45),
    ("AN-10", "PR1", "products", 610),
    ("AN-10", "missing_translation_categories", "product_category_translation", 2),
    ("AN-10", "missing_translation_products", "products", 13),
    ("AN-10", "PR2", "products", 4),
    ("AN-10", "PR3", "products", 2),
    ("AN-11", None, "sellers", 38),
    ("AN-12", None, "geolocation", 261831),
    ("AN-13", "C1", "leads", 1),
    ("AN-14", "orders_source_excluded", "orders", 59),
    ("AN-14", "reviews_source_excluded", "order_reviews", 666),
    ("AN-14", "silver_post_cutoff_expected", "orders", 0),
    ("AN-14", "reviews_silver_post_cutoff_expected", "order_reviews", 0),
    ("AN-15", "E1", "clickstream_events", 453),
    ("AN-15", "E2", "clickstream_events", 6),
    ("AN-16", "shipped_overdue_undelivered", "orders", 1103),
    ("AN-16", "post_cutoff_delivered_carrier", "orders", 57),
    ("AN-16", "total_overdue_undelivered", "orders", 1160),
)
ANOMALY_SCHEMA = "an_id string, sub_code string, table_name string, expected_count bigint"

# Child rows whose parent may still be missing after each batch, in batch order.
ORPHANS = (
    ("order_reviews_to_orders", "orders", "order_reviews", (2, 1, 9, 0)),
    ("clickstream_to_orders", "orders", "clickstream_events", (3, 8, 20, 0)),
)
ORPHAN_SCHEMA = (
    "relation string, parent_table string, child_table string, batch_id string, "
    "expected_orphans bigint"
)

# Raw rows per batch, in batch order, then distinct keys and rows left out.
RAW_ROW_COUNTS = (
    ("orders", (80450, 8590, 7979, 8522), 99421, 20),
    ("order_items", (91231, 7078, 7092, 7248), 112649, 1),
    ("order_payments", (84242, 6419, 6507, 6698), 103866, 20),
    ("order_reviews", (77888, 7002, 6261, 9430), 99205, 19),
    ("customers", (99441, 0, 0, 0), 99441, 0),
    ("products", (32951, 0, 0, 0), 32951, 0),
    ("sellers", (3095, 0, 0, 0), 3095, 0),
    ("product_category_translation", (71, 0, 0, 0), 71, 0),
    ("geolocation", (1000163, 0, 0, 0), 1000163, 0),
    ("marketing_leads", (8000, 57, 37, 33), 8000, 50),
    ("clickstream", (802300, 61961, 63017, 64753), 992031, 0),
)
ROW_COUNT_SCHEMA = "table_name string, batch_id string, expected_rows bigint"

# Where leads come from.
LEAD_ORIGINS = (
    "organic_search",
    "paid_search",
    "social",
    "unknown",
    "direct_traffic",
    "email",
    "referral",
    "other",
    "display",
    "other_publicities",
)

# Leads and deals once the final batch is loaded.
FINAL_LEADS = 8000
FINAL_DEALS = 792


def flag_catalog(spark: SparkSession) -> DataFrame:
    return small_table(spark, FLAGS, FLAG_SCHEMA)


def expected_anomalies(spark: SparkSession) -> DataFrame:
    return small_table(spark, ANOMALIES, ANOMALY_SCHEMA)


def expected_orphans(spark: SparkSession, plan: BatchPlan = MARKETPLACE_BATCHES) -> DataFrame:
    rows = [
        (relation, parent, child, batch_id, count)
        for relation, parent, child, counts in ORPHANS
        for batch_id, count in zip(plan.ids, counts)
    ]
    return small_table(spark, rows, ORPHAN_SCHEMA)


def orphans_allowed(relation: str, batch_id: str, plan: BatchPlan = MARKETPLACE_BATCHES) -> int:
    counts = {name: counts for name, _, _, counts in ORPHANS}[relation]
    return dict(zip(plan.ids, counts)).get(batch_id, 0)


def anomaly_count(table_name: str, sub_code: str) -> int:
    return {(table, code): n for _, code, table, n in ANOMALIES}[table_name, sub_code]


def expected_row_counts(spark: SparkSession, plan: BatchPlan = MARKETPLACE_BATCHES) -> DataFrame:
    rows = [
        (table, batch_id, count)
        for table, counts, _, _ in RAW_ROW_COUNTS
        for batch_id, count in zip(plan.ids, counts)
    ]
    return small_table(spark, rows, ROW_COUNT_SCHEMA)


PUBLISHED_SCHEMA = "table_name string, expected_rows bigint, expected_distinct bigint, expected_excluded bigint"
# Of the published leads so many have a deal in scope, all with their own key.
PUBLISHED_DEALS = ("marketing_deals", 792, 792, 50)


def published_totals(spark: SparkSession) -> DataFrame:
    """Rows, distinct keys and rows left out of each raw table; excluded deals stand with the leads, too."""
    rows = [(table, sum(counts), keys, excluded) for table, counts, keys, excluded in RAW_ROW_COUNTS]
    return small_table(spark, [*rows, PUBLISHED_DEALS], PUBLISHED_SCHEMA)
