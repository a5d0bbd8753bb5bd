"""The driver tables in the shapes the models read.

Where a raw shape is text (log lines, numbers with typing mistakes), the text
is spelled by one expression that Spark and DuckDB both read, so both sides of
a comparison start from the same characters. Everything is derived from whole
tables; mistakes are put into a share of the rows, none is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.batches import Batch, BatchPlan, in_scope, replay_children
from tidemark.sources.raw_leads import DEAL_FIELDS, parse_json_lines, to_json_lines
from tidemark.sources.raw_logs import parse_log_lines

BATCHES = BatchPlan(
    (
        Batch("bulk_1995-01_2001-04", "2001-04-30 23:59:59.999999"),
        Batch("2001-05", "2001-05-31 23:59:59.999999"),
        Batch("2001-06", "2001-06-30 23:59:59.999999"),
        Batch("2001-07", "2001-07-31 23:59:59.999999"),
    )
)
FIRST_INSTANT = "1995-01-01 00:00:00"
# The events table covers January 2024; this moves it next to the orders.
EVENT_SHIFT_DAYS = 8230

EVENT_KIND = (
    "CASE event_type WHEN 'signup' THEN 'home' WHEN 'view' THEN 'product_view' "
    "WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'purchase' END"
)
PRODUCT_NUMBER = "replace(replace(props, '{\"k\": ', ''), '}', '')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- web events ----------------------------------------------------------------------------


def shifted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events near the orders in time; some are put at midnight, so that instants repeat."""
    shifted = F.col("ts") - F.expr(f"interval {EVENT_SHIFT_DAYS} days")
    midnight = shifted.cast("date").cast("timestamp_ntz")
    moved = F.when(F.col("event_id") % 11 == 0, midnight).otherwise(shifted)
    return table(spark, sf_dir, "events").withColumn("ts", moved)


def web_line(stamp: str, day: str) -> str:
    """A log line per event; ``stamp`` and ``day`` format the time in the engine's dialect."""
    return f"""
    CASE WHEN event_type = 'error' THEN {stamp} || ' [ERROR] - ' || props
    ELSE {stamp} || CASE WHEN event_id % 89 = 0 THEN '7' ELSE '' END || ' [INFO] - USER_ID: '
      || CASE WHEN event_id % 97 = 0 THEN ' ' ELSE CAST(user_id AS STRING) END
      || ', SESSION_ID: ' || CAST(user_id AS STRING) || '-' || {day}
      || ', ORDER_ID: ' || CASE WHEN event_type = 'purchase'
           THEN CAST(event_id * 2 AS STRING) ELSE 'N/A' END
      || ', EVENT_TYPE: ' || {EVENT_KIND}
      || ', PRODUCT_ID: ' || CASE WHEN event_type IN ('view', 'click')
           THEN {PRODUCT_NUMBER} ELSE 'N/A' END
      || ', AMOUNT: ' || CASE WHEN event_type <> 'purchase' THEN 'N/A'
           WHEN event_id % 50 = 0 THEN 'abc' WHEN event_id % 53 = 0 THEN '123456789012'
           ELSE CAST(CAST(value AS DECIMAL(10,2)) AS STRING) END
      || ', OUTCOME: ' || CASE WHEN event_type <> 'purchase' THEN 'N/A'
           WHEN event_id % 7 = 0 THEN 'failed' ELSE 'paid' END
    END"""


def web_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_line, batch_id, source_file; every twentieth line was sent a second time."""
    line = F.expr(
        web_line("date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')", "date_format(ts, 'yyyyMMdd')")
    )
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("event_id") % 20 == 3, 1).otherwise(0)))
    again = F.col("copy") == 1
    sent = shifted_events(spark, sf_dir).select(
        line.alias("raw_line"), BATCHES.batch_of(F.col("ts")).alias("batch_id"), copies.alias("copy")
    )
    return sent.select(
        "raw_line",
        F.when(again, F.lit(BATCHES.final_batch)).otherwise(F.col("batch_id")).alias("batch_id"),
        F.when(again, F.lit("resent_log.txt")).otherwise(F.lit("access_log.txt")).alias(
            "source_file"
        ),
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_log_lines(web_lines(spark, sf_dir))
    return parsed.withColumn("ingested_at", F.current_timestamp())


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed events as they stand in the table: no text in between."""
    events = shifted_events(spark, sf_dir)
    session = F.concat(
        F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")
    )
    bought = F.col("event_type") == "purchase"
    return events.filter(F.col("event_type") != "error").select(
        "event_id",
        session.alias("session_id"),
        F.col("ts").alias("event_ts"),
        F.expr(EVENT_KIND).alias("event_type"),
        F.when(bought, (F.col("event_id") * 2).cast("string")).alias("order_id"),
        F.when(bought, F.col("value").cast("decimal(10,2)")).alias("amount"),
    )


# --- leads ---------------------------------------------------------------------------------

ORIGIN = "CASE WHEN o_custkey % 19 = 0 THEN '' ELSE o_orderpriority END"
LANDING_PAGE = (
    "CASE WHEN o_custkey % 113 = 0 THEN ' ' "
    "ELSE 'page-' || CAST(o_custkey % 50 AS STRING) END"
)
# The deal of a lead is the first line of its order.
DEAL_TEXT = {
    "seller_id": "CAST(l_suppkey AS STRING)",
    "sdr_id": "CAST(l_partkey AS STRING)",
    "sr_id": "CAST(l_linenumber AS STRING)",
    "won_date": "CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 10:30:00'",
    "business_segment": "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END",
    "lead_type": "l_linestatus",
    "lead_behaviour_profile": "CASE WHEN l_linenumber % 2 = 0 THEN ' ' ELSE 'cat' END",
    "has_company": (
        "CASE l_partkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN '1.0' WHEN 2 THEN 'False' "
        "WHEN 3 THEN '0' ELSE 'maybe' END"
    ),
    "has_gtin": "CASE l_partkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '0.0' ELSE 'true' END",
    "average_stock": (
        "CASE WHEN l_quantity <= 25 THEN CAST(CAST(l_quantity AS INT) AS STRING) END"
    ),
    "business_type": "'reseller'",
    "declared_product_catalog_size": (
        "CAST(CAST(l_quantity AS INT) AS STRING) "
        "|| CASE WHEN l_partkey % 7 = 0 THEN '.5' ELSE '.0' END"
    ),
    "declared_monthly_revenue": (
        "CASE WHEN l_suppkey % 13 = 0 THEN '1e3' WHEN l_suppkey % 17 = 0 THEN 'n/a' "
        "ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING) END"
    ),
}
# Mistakes put into the leads after they are routed to batches.
SPOILED_MQL_ID = "CASE WHEN lead_key % 307 = 0 THEN ' ' ELSE mql_id END"
SPOILED_CONTACT = (
    "CASE WHEN lead_key % 211 = 0 THEN substring(first_contact_date, 1, 4) || '-02-30' "
    "WHEN lead_key % 223 = 0 THEN CAST(NULL AS STRING) ELSE first_contact_date END"
)
SPOILED_JSON = (
    "CASE WHEN lead_key % 401 = 0 THEN substring(raw_json, 1, length(raw_json) - 1) "
    "ELSE raw_json END"
)


def lead_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.expr("CAST(o_orderkey AS STRING)").alias("mql_id"),
        F.expr("CAST(CAST(o_orderdate AS DATE) AS STRING)").alias("first_contact_date"),
        F.expr(LANDING_PAGE).alias("landing_page_id"),
        F.expr(ORIGIN).alias("origin"),
    )


def deal_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.expr("CAST(l_orderkey AS STRING)").alias("mql_id"),
        *[F.expr(DEAL_TEXT[name]).alias(name) for name in DEAL_FIELDS],
    )


# Leads that are there; the deals of the others are orphans.
HAS_LEAD = "CAST(mql_id AS BIGINT) % 101 <> 0"
FIRST_DEAL = ("won_date", "sr_id", "sdr_id", "seller_id")
# What the other fields of a deal are spelled from, beside the numbers in FIRST_DEAL.
DEAL_CELLS = ("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
DEAL_NUMBERS = {"l_linenumber": "CAST(sr_id AS INT)", "l_partkey": "CAST(sdr_id AS BIGINT)", "l_suppkey": "CAST(seller_id AS BIGINT)"}


def replayed_leads(spark: SparkSession, sf_dir: str, deal_fields: Sequence[str] = DEAL_FIELDS) -> DataFrame:
    """Lead columns, deal, batch_id: each lead in its batch and again in that of its deal.

    The deal may be given fewer fields, of which ``FIRST_DEAL`` choose it. The others are spelled
    for the chosen deals alone: the lines are sorted and shuffled with the cells they are spelled from.
    """
    parents = lead_parents(spark, sf_dir)
    cells = DEAL_CELLS if set(deal_fields) - set(FIRST_DEAL) else ()
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr("CAST(l_orderkey AS STRING)").alias("mql_id"),
        *[F.expr(DEAL_TEXT[name]).alias(name) for name in FIRST_DEAL],
        *cells,
    )
    replayed = replay_children(
        parents=parents,
        children=lines,
        key="mql_id",
        parent_time="first_contact_date",
        child_time="won_date",
        child_name="deal",
        child_order=[F.asc(c) for c in FIRST_DEAL],
        plan=BATCHES,
    )
    chosen = replayed.select(*parents.columns, F.col("deal").isNotNull().alias("has_deal"), "deal.*", "batch_id")
    numbered = chosen.withColumns({name: F.expr(number) for name, number in DEAL_NUMBERS.items()})
    deal = F.struct(*[(F.col(name) if name in FIRST_DEAL else F.expr(DEAL_TEXT[name])).alias(name) for name in deal_fields])
    return numbered.select(*parents.columns, F.when(F.col("has_deal"), deal).alias("deal"), "batch_id")


def lead_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_json, batch_id, source_file with mistakes in a share of the lines."""
    keyed = replayed_leads(spark, sf_dir).withColumn("lead_key", F.col("mql_id").cast("bigint"))
    spoiled = keyed.withColumns(
        {"mql_id": F.expr(SPOILED_MQL_ID), "first_contact_date": F.expr(SPOILED_CONTACT)}
    )
    return to_json_lines(spoiled).select(
        F.expr(SPOILED_JSON).alias("raw_json"),
        "batch_id",
        F.lit("marketing_leads.jsonl").alias("source_file"),
    )


def bronze_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_json_lines(lead_lines(spark, sf_dir))
    return parsed.withColumn("ingested_at", F.current_timestamp())


# --- orders --------------------------------------------------------------------------------

ORDER_STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END"
)
ORDER_ID = (
    "CASE WHEN o_orderkey % 2 = 0 THEN ' ' || CAST(o_orderkey AS STRING) || ' ' "
    "ELSE CAST(o_orderkey AS STRING) END"
)
MIDNIGHT = "CAST(CAST({} AS DATE) AS STRING) || ' 00:00:00'"
APPROVED = (
    f"CASE WHEN o_orderkey % 503 = 0 THEN 'not-a-date' ELSE {MIDNIGHT.format('approved')} END"
)
ESTIMATE_DAYS = 45


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text. One delivered in a later batch appears before that as shipped."""
    by_flag = {"N": ("approved", F.min), "A": ("carrier", F.min), "R": ("customer", F.max)}
    times = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            *[
                best(F.when(F.col("l_returnflag") == flag, F.col("l_shipdate"))).alias(name)
                for flag, (name, best) in by_flag.items()
            ]
        )
    )
    dated = (
        table(spark, sf_dir, "orders")
        .join(times, "o_orderkey", "left")
        .withColumns(
            {
                "estimate": F.col("o_orderdate") + F.expr(f"interval {ESTIMATE_DAYS} days"),
                "bought_in": BATCHES.batch_of(F.col("o_orderdate")),
                "arrived_in": BATCHES.batch_of(F.col("customer")),
            }
        )
    )
    later = (F.col("customer") > F.col("o_orderdate")) & (F.col("arrived_in") != F.col("bought_in"))
    bought = F.col("bought_in").alias("batch_id")
    versions = F.when(
        later,
        F.array(
            F.struct(bought, F.lit(False).alias("is_final")),
            F.struct(F.col("arrived_in").alias("batch_id"), F.lit(True).alias("is_final")),
        ),
    ).otherwise(F.array(F.struct(bought, F.lit(True).alias("is_final"))))
    shown = dated.filter(F.col("bought_in").isNotNull())
    final = F.col("version.is_final")
    return shown.withColumn("version", F.explode(versions)).select(
        F.expr(ORDER_ID).alias("order_id"),
        F.expr("CAST(o_custkey AS STRING)").alias("customer_id"),
        F.when(final, F.expr(ORDER_STATUS)).otherwise("shipped").alias("order_status"),
        F.expr(MIDNIGHT.format("o_orderdate")).alias("order_purchase_timestamp"),
        F.expr(APPROVED).alias("order_approved_at"),
        F.expr(MIDNIGHT.format("carrier")).alias("order_delivered_carrier_date"),
        F.when(final, F.expr(MIDNIGHT.format("customer"))).alias("order_delivered_customer_date"),
        F.expr(MIDNIGHT.format("estimate")).alias("order_estimated_delivery_date"),
        F.lit("orders.csv").alias("source_file"),
        F.col("version.batch_id").alias("batch_id"),
    )


ITEM_PRICE = "CASE WHEN product % 40 = 0 THEN '0' ELSE CAST(price AS STRING) END"


def item_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per order and line number; line numbers repeat in the table.

    Hundredths are added up as whole numbers: the sum of a decimal takes three times the room until it is final.
    """

    def total(column: str) -> Column:
        hundredths = (F.col(column).cast("decimal(10,2)") * 100).cast("bigint")
        return (F.sum(hundredths).cast("decimal(20,0)") / 100).cast("decimal(12,2)")

    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_partkey").alias("product"),
            F.min("l_suppkey").alias("seller"),
            F.max("l_shipdate").alias("limit"),
            total("l_extendedprice").alias("price"),
            total("l_quantity").alias("freight"),
        )
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_scope(item_totals(spark, sf_dir), "limit", BATCHES).select(
        F.expr("CAST(l_orderkey AS STRING)").alias("order_id"),
        F.expr("CAST(l_linenumber AS STRING)").alias("order_item_id"),
        F.expr("CAST(product AS STRING)").alias("product_id"),
        F.expr("CAST(seller AS STRING)").alias("seller_id"),
        F.expr(MIDNIGHT.format("limit")).alias("shipping_limit_date"),
        F.expr(ITEM_PRICE).alias("price"),
        F.expr("CAST(freight AS STRING)").alias("freight_value"),
        F.lit("order_items.csv").alias("source_file"),
        "batch_id",
    )


PAYMENT_TYPE = (
    "CASE l_returnflag WHEN 'N' THEN 'not_defined' WHEN 'A' THEN 'credit_card' ELSE 'voucher' END"
)
PAYMENT_VALUE = (
    "CAST(CAST(CASE WHEN l_tax = 0 THEN 0 ELSE l_extendedprice END AS DECIMAL(10,2)) AS STRING)"
)


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return in_scope(lines, "l_shipdate", BATCHES).select(
        F.expr("CAST(l_orderkey AS STRING)").alias("order_id"),
        F.expr("CAST(l_linenumber AS STRING)").alias("payment_sequential"),
        F.expr(PAYMENT_TYPE).alias("payment_type"),
        F.expr("CAST(l_linenumber - 1 AS STRING)").alias("payment_installments"),
        F.expr(PAYMENT_VALUE).alias("payment_value"),
        F.lit("order_payments.csv").alias("source_file"),
        "batch_id",
    )


REVIEW_DELAY_DAYS = 200
REVIEW_ID = (
    "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' "
    "|| CAST(l_linenumber AS STRING) || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING)"
)
REVIEW_SCORE = (
    "CASE WHEN l_partkey % 331 = 0 THEN 'five' "
    "ELSE CAST(1 + CAST(l_quantity AS INT) % 5 AS STRING) "
    "|| CASE WHEN l_partkey % 13 = 0 THEN '.0' ELSE '' END END"
)
REVIEW_ANSWER = (
    "CASE WHEN l_returnflag = 'N' AND l_linenumber % 2 = 0 THEN CAST(NULL AS STRING) "
    "ELSE CAST(CAST(created AS DATE) AS STRING) || ' 0' || CAST(l_linenumber AS STRING) "
    "|| ':15:00' END"
)


def reviewed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.col("l_shipdate") + F.expr(f"interval {REVIEW_DELAY_DAYS} days")
    return table(spark, sf_dir, "lineitem").withColumn("created", created)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per order line. Some were first exported, unanswered, with the bulk batch."""
    bulk = BATCHES.ids[0]
    routed = in_scope(reviewed_lines(spark, sf_dir), "created", BATCHES)
    early = (F.col("l_suppkey") % 10 == 0) & (F.col("batch_id") != bulk)
    version = F.explode(F.sequence(F.when(early, 0).otherwise(1), F.lit(1)))
    final = F.col("version") == 1
    return routed.withColumn("version", version).select(
        F.expr(REVIEW_ID).alias("review_id"),
        F.expr("CAST(l_orderkey AS STRING)").alias("order_id"),
        F.expr(REVIEW_SCORE).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.expr("'flag ' || l_returnflag").alias("review_comment_message"),
        F.expr(MIDNIGHT.format("created")).alias("review_creation_date"),
        F.when(final, F.expr(REVIEW_ANSWER)).alias("review_answer_timestamp"),
        F.lit("order_reviews.csv").alias("source_file"),
        F.when(final, F.col("batch_id")).otherwise(F.lit(bulk)).alias("batch_id"),
    )


# Reviews as the text of a CSV file: line breaks, quotes and commas in the comment, a share spoiled.
CSV_CELLS = ("review_id", "order_id", "review_comment_message")
CSV_MESSAGE = "'said \"' || order_id || '\",' || chr(10) || 'on ' || chr(10) || review_id"
QUOTED = "'\"' || replace({}, '\"', '\"\"') || '\"'"
CSV_SPOILED = "CASE WHEN CAST(order_id AS BIGINT) % 97 = 0 THEN 'long' WHEN CAST(order_id AS BIGINT) % 89 = 0 THEN 'short' ELSE 'good' END"
CSV_RECORD = (
    f"{QUOTED.format('review_id')} || ',' || {QUOTED.format('order_id')}"
    f" || CASE WHEN spoiled = 'short' THEN '' ELSE ',' || {QUOTED.format('review_comment_message')} END"
    " || CASE WHEN spoiled = 'long' THEN ',more' ELSE '' END"
)


def review_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``record, batch_id``: the reviews as CSV text."""
    said = raw_reviews(spark, sf_dir).withColumn("review_comment_message", F.expr(CSV_MESSAGE))
    return said.withColumn("spoiled", F.expr(CSV_SPOILED)).select(F.expr(CSV_RECORD).alias("record"), "batch_id")


# --- reference data ------------------------------------------------------------------------

CATEGORY = "CASE WHEN p_partkey % 50 = 0 THEN CAST(NULL AS STRING) ELSE lower(p_type) END"
LENGTH_CM = "CAST(nullif(p_size % 7, 0) AS STRING)"
CITY = "'  ' || upper(n_name) || '   Town '"


REEXPORTED = "{} % 10 = 3"
EARLY, LATER = BATCHES.ids[0], BATCHES.ids[2]


def exported_twice(rows: DataFrame, key: str) -> DataFrame:
    """Every row with its batch; a tenth come early, when ``is_final`` is false, and again later."""
    again = F.expr(REEXPORTED.format(key))
    once = F.struct(F.lit(EARLY).alias("batch_id"), F.lit(True).alias("is_final"))
    early = F.struct(F.lit(EARLY).alias("batch_id"), F.lit(False).alias("is_final"))
    later = F.struct(F.lit(LATER).alias("batch_id"), F.lit(True).alias("is_final"))
    versions = F.when(again, F.array(early, later)).otherwise(F.array(once))
    return rows.withColumn("version", F.explode(versions)).select("*", "version.*").drop("version")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = exported_twice(table(spark, sf_dir, "part"), "p_partkey")
    return parts.select(
        F.expr("CAST(p_partkey AS STRING)").alias("product_id"),
        F.expr(f"CASE WHEN is_final THEN {CATEGORY} ELSE 'old' END").alias("product_category_name"),
        F.expr("CAST(length(p_name) AS STRING)").alias("product_name_lenght"),
        F.expr("CAST(p_size * 10 AS STRING)").alias("product_description_lenght"),
        F.expr("CAST(p_size % 5 AS STRING)").alias("product_photos_qty"),
        F.expr("CAST(p_size - 1 AS STRING)").alias("product_weight_g"),
        F.expr(LENGTH_CM).alias("product_length_cm"),
        F.expr("CAST(p_size AS STRING)").alias("product_height_cm"),
        F.expr("CAST(p_size + 1 AS STRING)").alias("product_width_cm"),
        F.lit("products.csv").alias("source_file"),
        "batch_id",
    )


def raw_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An English name per category; one category has none."""
    categories = table(spark, sf_dir, "part").select(F.lower("p_type").alias("c")).distinct()
    return categories.filter(F.col("c") != "promo").select(
        F.col("c").alias("product_category_name"),
        F.concat(F.lit("en_"), F.col("c")).alias("product_category_name_english"),
        F.lit("translation.csv").alias("source_file"),
        F.lit(BATCHES.ids[0]).alias("batch_id"),
    )


def _with_place(rows: DataFrame, nation_key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "inner"
    )
    return rows.join(nations, F.col(nation_key) == F.col("n_nationkey"), "left")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _with_place(table(spark, sf_dir, "customer"), "c_nationkey", spark, sf_dir)
    return exported_twice(placed, "c_custkey").select(
        F.expr("CAST(c_custkey AS STRING)").alias("customer_id"),
        F.expr("CASE WHEN is_final THEN c_name ELSE 'old' END").alias("customer_unique_id"),
        F.expr("lpad(CAST(c_nationkey AS STRING), 5, '0')").alias("customer_zip_code_prefix"),
        F.expr(CITY).alias("customer_city"),
        F.expr("CASE WHEN is_final THEN r_name ELSE 'OLD' END").alias("customer_state"),
        F.lit("customers.csv").alias("source_file"),
        "batch_id",
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _with_place(table(spark, sf_dir, "supplier"), "s_nationkey", spark, sf_dir)
    return exported_twice(placed, "s_suppkey").select(
        F.expr("CAST(s_suppkey AS STRING)").alias("seller_id"),
        F.expr("lpad(CAST(s_nationkey AS STRING), 5, '0')").alias("seller_zip_code_prefix"),
        F.expr(CITY).alias("seller_city"),
        F.expr("CASE WHEN is_final THEN r_name ELSE 'OLD' END").alias("seller_state"),
        F.lit("sellers.csv").alias("source_file"),
        "batch_id",
    )


# Points of even postal prefixes came partly with a later batch.
POINT_BATCH = (
    f"CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 4 = 1 THEN '{LATER}' ELSE '{EARLY}' END"
)


def raw_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point per customer: the postal prefix is the nation, the position its balance."""
    placed = _with_place(table(spark, sf_dir, "customer"), "c_nationkey", spark, sf_dir)
    return placed.select(
        F.expr("lpad(CAST(c_nationkey AS STRING), 5, '0')").alias("geolocation_zip_code_prefix"),
        F.expr("CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING)").alias("geolocation_lat"),
        F.expr("CAST(-c_custkey AS STRING)").alias("geolocation_lng"),
        F.expr("c_mktsegment").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
        F.expr(POINT_BATCH).alias("batch_id"),
    )


# --- runs ----------------------------------------------------------------------------------

RUN_STATUS = "CASE WHEN event_id % 2 = 0 THEN 'success' ELSE 'failed' END"


def batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records: one per event, the event type standing for the batch."""
    return table(spark, sf_dir, "events").select(
        F.expr("CAST(event_id AS STRING)").alias("run_id"),
        F.col("event_type").alias("batch_id"),
        F.expr(RUN_STATUS).alias("status"),
        F.lit(None).cast("string").alias("failed_model"),
        F.expr("event_id * 10").alias("rows_in"),
        F.expr("event_id * 9").alias("rows_out"),
        (F.col("ts") - F.expr("interval 5 minutes")).alias("started_at"),
        F.col("ts").alias("ended_at"),
    )
