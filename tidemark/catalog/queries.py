"""Every registered query: a callable from (session, folder) to a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import inputs
from tidemark.catalog.inputs import BATCHES, FIRST_INSTANT, table
from tidemark.catalog.tables import Tables
from tidemark.functions import calendar, casting, flags, text
from tidemark.operators import batches as batch_ops
from tidemark.operators import checks, compare, latest, sets
from tidemark.operators import key_ledger as ledger_of
from tidemark.operators.skew import lookup_join
from tidemark.plans import anomalies, gold, second_route, seeds, silver
from tidemark.plans.contract import GOLD_COLUMNS, GOLD_KEYS, KPI_TABLES, columns_of
from tidemark.sources import ledger, raw_csv, raw_leads, raw_logs, routed, tables
from tidemark.sources.csv_records import read_csv_records
from tidemark.sources.scratch import scratch_path
from tidemark.sources.state import KeyedState, Shape
from tidemark.sources.versions import Layer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources and sinks ---------------------------------------------------------------------


@query
def parse_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_logs.parse_log_lines(inputs.web_lines(spark, sf_dir))


@query
def parse_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = raw_leads.parse_json_lines(inputs.lead_lines(spark, sf_dir))
    return parsed.select(
        *raw_leads.LEAD_FIELDS,
        F.col("deal").isNotNull().alias("has_deal"),
        F.col("deal.seller_id").alias("deal_seller_id"),
        F.col("deal.won_date").alias("deal_won_date"),
        F.col("deal.declared_monthly_revenue").alias("deal_revenue"),
        "raw_json",
        "is_parsed",
        "batch_id",
    )


@query
def nest_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_leads.to_json_lines(inputs.replayed_leads(spark, sf_dir))


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as CSV per batch and back; a batch that has no file is skipped."""
    orders = inputs.raw_orders(spark, sf_dir)
    columns = [c for c in orders.columns if c not in ("batch_id", "source_file")]
    root = scratch_path(spark, "csv")
    for batch_id in BATCHES.ids:
        one_batch = orders.filter(F.col("batch_id") == batch_id).select(*columns)
        raw_csv.write_batch_csv(one_batch, root, batch_id, "orders.csv")
    return raw_csv.read_batch_csv(spark, root, [*BATCHES.ids, "no-such-batch"], "orders.csv", columns)


@query
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = inputs.raw_payments(spark, sf_dir).drop("source_file")
    audited = tables.add_audit_columns(payments, F.col("batch_id"), "order_payments.csv")
    return audited.drop("ingested_at")


@query
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches, then a corrected last batch: only that one is replaced."""
    path = scratch_path(spark, "payments")
    payments = inputs.raw_payments(spark, sf_dir)
    tables.overwrite_batches(payments, path)
    corrected = payments.filter(F.col("batch_id") == BATCHES.final_batch).withColumn(
        "payment_type", F.lit("corrected")
    )
    tables.overwrite_batches(corrected, path)
    tables.overwrite_batches(corrected, path)
    return spark.read.parquet(path)


@query
def catalog_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments in a catalog table: created, filled, and its last batch overwritten."""
    payments = inputs.raw_payments(spark, sf_dir)
    name = f"tidemark_checks.payments_{uuid.uuid4().hex}"
    columns = ", ".join(f"{c} string" for c in payments.columns)
    tables.create_table(spark, name, columns)
    tables.create_table(spark, name, columns)  # it is there: nothing happens
    tables.overwrite_table_batches(payments, name)
    last = payments.filter(F.col("batch_id") == BATCHES.final_batch)
    tables.overwrite_table_batches(last.withColumn("payment_type", F.lit("corrected")), name)
    return spark.table(name)


@query
def metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of all KPI tables, written as a sorted file and read from it."""
    path = scratch_path(spark, "metrics")
    compare.write_metrics(kpi_unpivot_long(spark, sf_dir), path)
    return compare.read_metrics(spark, path)


@query
def versioned_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments published by batch, wrong ones taken back, a draft never shown, the last batch corrected."""
    payments = inputs.raw_payments(spark, sf_dir)
    layer = Layer(spark, scratch_path(spark, "layer"))
    every, last = range(len(BATCHES.ids)), len(BATCHES.ids) - 1
    part = BATCHES.position_of(F.col("batch_id"))
    wrong = payments.withColumn("payment_type", F.lit("wrong")).withColumn("part", part)
    first = layer.draft()
    first.write_parts("payments", payments.withColumn("part", part), every)
    first.commit()
    bad = layer.draft()
    bad.write_parts("payments", wrong.where(part == 0), [0])
    bad.commit()
    layer.roll_back(1)
    layer.draft().write_parts("payments", wrong, every)
    corrected = layer.read("payments").withColumns({"payment_type": F.lit("corrected"), "part": part})
    draft = layer.draft()
    draft.write_parts("payments", corrected.where(part == last), [last])
    draft.commit()
    layer.prune()
    return layer.read("payments")


@query
def incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders from a state that took in one batch after the other, and the second one again."""
    bronze = Tables(spark, sf_dir)["bronze_orders"]
    layer = Layer(spark, scratch_path(spark, "state"))
    state = KeyedState(layer, Shape("orders", ("order_id",)), BATCHES)
    of = lambda *batch: silver.order_versions(bronze.where(F.col("batch_id").isin(*batch)))
    for batch in (*BATCHES.ids, BATCHES.ids[1]):
        draft = layer.draft()
        state.load(draft, batch, of(batch), lambda others: of(*others))
        draft.commit()
    return silver.latest_orders(state.current(layer.draft()), BATCHES)


@query
def routed_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads by batch and the deals that belong to none, written in one pass and read back from their folders."""
    parents = inputs.lead_parents(spark, sf_dir).where(F.expr(inputs.HAS_LEAD))
    nested, apart = routed.route_family(
        parents, inputs.deal_children(spark, sf_dir), "mql_id", "first_contact_date", "won_date", "deal",
        inputs.FIRST_DEAL, BATCHES,
    )
    deal = F.struct(*[c for c in apart.columns if c != "route"])
    records = raw_leads.to_json_lines(nested).select(F.col("batch_id").alias("route"), F.col("raw_json").alias("value"))
    records = records.unionByName(apart.select("route", F.to_json(deal).alias("value")))
    root = scratch_path(spark, "routed")
    routed.write_routed(records, root, "leads.jsonl")
    if routed.differing_routes(spark, root, "leads.jsonl"):
        raise ValueError("the files are not those of the manifest")
    shape = "mql_id string, sr_id string, won_date string, deal struct<sr_id:string, won_date:string>"
    read = routed.read_routed(spark, root, "leads.jsonl").withColumn("r", F.from_json("value", shape))
    return read.select(
        "route",
        "r.mql_id",
        F.coalesce("r.deal.sr_id", "r.sr_id").alias("sr_id"),
        F.coalesce("r.deal.won_date", "r.won_date").alias("won_date"),
    )


@query
def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as CSV text with line breaks in cells and bad records, read back from any split of the files."""
    columns = list(inputs.CSV_CELLS)
    root = scratch_path(spark, "csv")
    record, header = F.col("record"), ",".join(columns)
    # each file begins with the header: the first row of a task brings it along
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    for batch_id in BATCHES.ids:
        rows = inputs.review_records(spark, sf_dir).where(F.col("batch_id") == batch_id)
        rows.select(F.when(first, F.concat(F.lit(f"{header}\n"), record)).otherwise(record).alias("value")).write.text(f"{root}/{batch_id}/reviews.csv")
    return read_csv_records(spark, root, BATCHES.ids, "reviews.csv", columns)


@query
def batch_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = Tables(spark, sf_dir)["bronze_leads"]
    return tables.batch_load_summary(bronze, present="deal")


@query
def batch_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = inputs.raw_payments(spark, sf_dir)
    columns = [c for c in payments.columns if c not in ("batch_id", "source_file")]
    return tables.batch_fingerprint(payments, columns)


@query
def route_to_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return batch_ops.in_scope(lines, "l_shipdate", BATCHES)


@query
def post_cutoff_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return batch_ops.quarantined(lines, "l_shipdate", BATCHES)


@query
def kpi_unpivot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All KPI tables as one sorted list of metrics."""
    t = Tables(spark, sf_dir)
    metrics = [
        compare.to_metrics(t[name], name, GOLD_KEYS[name])
        for name in KPI_TABLES
    ]
    return checks.union_all(metrics).orderBy(*compare.METRIC_KEY)


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs, of which some are recorded again with another outcome."""
    runs = inputs.batch_runs(spark, sf_dir)
    changed = runs.filter(F.col("rows_in") % 70 == 0).withColumns(
        {"status": F.lit("success"), "ended_at": F.col("ended_at") + F.expr("interval 1 hour")}
    )
    return ledger.upsert_runs(runs, changed)


@query
def latest_status_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest_status_per_batch(inputs.batch_runs(spark, sf_dir))


@query
def newest_n_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.newest_runs(inputs.batch_runs(spark, sf_dir), limit=50, batch_id="purchase")


# --- casts and other column functions ------------------------------------------------------

# One messy text per row, spelled so that both engines read the same expression.
DAY_TEXT = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
MESSY_DATE = f"""CASE o_orderkey % 7 WHEN 0 THEN '  ' || {DAY_TEXT} || ' '
  WHEN 1 THEN substring({DAY_TEXT}, 1, 4) WHEN 2 THEN substring({DAY_TEXT}, 1, 4) || '-02-30'
  WHEN 3 THEN '' WHEN 4 THEN {DAY_TEXT} || ' 10:00:00' WHEN 5 THEN CAST(NULL AS STRING)
  ELSE {DAY_TEXT} END"""
MESSY_TIME = f"""CASE o_orderkey % 9 WHEN 0 THEN ' ' || {DAY_TEXT} || ' 23:59:59 '
  WHEN 1 THEN {DAY_TEXT} || ' 24:00:00' WHEN 2 THEN {DAY_TEXT} || ' 01:02:03.5'
  WHEN 3 THEN {DAY_TEXT} WHEN 4 THEN {DAY_TEXT} || 'T01:02:03' WHEN 5 THEN 'soon'
  WHEN 6 THEN {DAY_TEXT} || ' 01:02:03.123456' WHEN 7 THEN CAST(NULL AS STRING)
  ELSE substring({DAY_TEXT}, 1, 4) || '-02-30 01:02:03' END"""
MESSY_INT = """CASE o_orderkey % 8 WHEN 0 THEN ' ' || CAST(o_custkey AS STRING) || ' '
  WHEN 1 THEN '+' || CAST(o_custkey AS STRING) WHEN 2 THEN '-' || CAST(o_custkey AS STRING)
  WHEN 3 THEN CAST(o_custkey AS STRING) || '.0' WHEN 4 THEN '99999999999' WHEN 5 THEN ''
  WHEN 6 THEN 'x' || CAST(o_custkey AS STRING) ELSE CAST(o_custkey AS STRING) END"""
PRICE_TEXT = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)"
MESSY_NUMBER = f"""CASE o_orderkey % 9 WHEN 0 THEN ' ' || {PRICE_TEXT} WHEN 1 THEN '1e3'
  WHEN 2 THEN '.5' WHEN 3 THEN '-' || {PRICE_TEXT} WHEN 4 THEN '99999999999999.5'
  WHEN 5 THEN '12,5' WHEN 6 THEN CAST(NULL AS STRING) WHEN 7 THEN '2.5E-1' ELSE {PRICE_TEXT} END"""
MESSY_BOOLEAN = """CASE o_orderkey % 9 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' false ' WHEN 2 THEN '1'
  WHEN 3 THEN '0' WHEN 4 THEN '1.0' WHEN 5 THEN '0.0' WHEN 6 THEN 'yes' WHEN 7 THEN ''
  ELSE CAST(NULL AS STRING) END"""
MESSY_SIZE = """CASE o_orderkey % 5 WHEN 0 THEN CAST(o_custkey AS STRING) || '.0'
  WHEN 1 THEN CAST(o_custkey AS STRING) || '.5' WHEN 2 THEN CAST(o_custkey AS STRING)
  WHEN 3 THEN 'many' ELSE '1e2' END"""


def _messy(spark: SparkSession, sf_dir: str, expression: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(expression).alias("raw"))


def _cast_query(name: str, expression: str, cast: Callable) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _messy(spark, sf_dir, expression).select(
            "o_orderkey", "raw", cast(F.col("raw")).alias("value")
        )

    run.__name__ = name
    query(run)


_cast_query("safe_cast_date", MESSY_DATE, lambda c: casting.safe_cast(c, "DATE"))
_cast_query("safe_cast_timestamp", MESSY_TIME, lambda c: casting.safe_cast(c, "TIMESTAMP"))
_cast_query("safe_cast_int", MESSY_INT, lambda c: casting.safe_cast(c, "INT"))
_cast_query("safe_cast_decimal", MESSY_NUMBER, lambda c: casting.safe_cast(c, "DECIMAL(14, 2)"))
_cast_query("safe_cast_double", MESSY_NUMBER, lambda c: casting.safe_cast(c, "DOUBLE"))
_cast_query("safe_cast_boolean", MESSY_BOOLEAN, lambda c: casting.safe_cast(c, "BOOLEAN"))
_cast_query(
    "parse_bool_float",
    MESSY_BOOLEAN,
    lambda c: casting.boolean_from_number_words(text.blank_to_null(c)),
)
_cast_query("integral_double_to_int", MESSY_SIZE, casting.integral_to_int)
_cast_query("blank_to_null", MESSY_DATE, text.blank_to_null)
_cast_query("lenient_date", MESSY_TIME, calendar.lenient_date)
_cast_query("lenient_timestamp", MESSY_TIME, calendar.lenient_timestamp)


@query
def cast_failed_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = _messy(spark, sf_dir, MESSY_DATE)
    failed = casting.cast_failed_flag(
        F.col("raw"), casting.safe_cast(F.col("raw"), "DATE"), "order_date"
    )
    return messy.select("o_orderkey", "raw", failed.alias("flag"))


@query
def category_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("origin", F.expr(inputs.ORIGIN))
    has_child = F.col("o_orderstatus") != "P"
    return orders.select(
        "o_orderkey",
        text.lower_category_or_unknown(F.col("origin")).alias("origin"),
        F.when(has_child, text.category_or_unknown(F.col("origin"))).alias("child_category"),
    )


@query
def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested deal of each lead as columns beside a presence flag."""
    nested = inputs.replayed_leads(spark, sf_dir)
    return nested.select(
        "mql_id",
        "batch_id",
        F.col("deal").isNotNull().alias("has_deal"),
        *[
            text.blank_to_null(F.col(f"deal.{name}")).alias(name)
            for name in raw_leads.DEAL_FIELDS
        ],
    )


def _flagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    pairs = [
        ("P1", F.col("l_returnflag") == "N"),
        ("P_1", F.col("l_discount") == 0),
        ("P2", F.col("l_tax") == 0),
        ("T1:l_quantity", F.col("l_quantity") > 45),
        ("T1:l_extendedprice", F.col("l_extendedprice") < 1000),
    ]
    key = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return lines.select(*key, flags.flag_list(pairs).alias("dq_flag"))


@query
def dq_flag_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged_lines(spark, sf_dir)


@query
def dq_flag_has(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("dq_flag")
    return (
        _flagged_lines(spark, sf_dir)
        .groupBy("dq_flag")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            "dq_flag",
            "n_rows",
            flags.has_flag(flag, "P1").alias("has_p1"),
            flags.has_flag(flag, "P_1").alias("has_p_1"),
            flags.has_flag(flag, "T1").alias("has_t1"),
        )
    )


@query
def dq_flag_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _flagged_lines(spark, sf_dir)
    return (
        flagged.filter(flags.has_flag_prefix(F.col("dq_flag"), "T1"))
        .groupBy("l_suppkey")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query
def dq_flag_incidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    names = (
        "orders",
        "order_items",
        "order_payments",
        "order_reviews",
        "products",
        "leads",
        "clickstream_events",
    )
    return checks.flag_incidence({n: t[n] for n in names}, seeds.flag_catalog(spark))


@query
def reject_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = Tables(spark, sf_dir)["evaluated_events"]
    return evaluated.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (F.col("l_shipdate") + F.expr("interval 23 hours")).alias("shipped_at"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lookup_join(lines, orders, ["o_orderkey"], "inner")
    return joined.withColumn(
        "days", calendar.calendar_days(F.col("shipped_at"), F.col("o_orderdate"))
    )


@query
def post_cutoff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, and orders with either date, after the cutoff."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", (F.col("o_orderdate") + F.expr("interval 45 days")).alias("due")
    )
    late_orders = checks.no_dates_after_cutoff(orders, ["o_orderdate", "due"], BATCHES)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    late_lines = checks.not_after_cutoff(lines, "l_shipdate", BATCHES)
    return late_orders.select(
        F.lit("orders").alias("table_name"),
        F.col("o_orderkey").alias("row_key"),
        F.col("due").alias("late_value"),
    ).unionByName(
        late_lines.select(
            F.lit("lineitem").alias("table_name"),
            F.col("l_orderkey").alias("row_key"),
            F.col("l_shipdate").alias("late_value"),
        )
    )


@query
def surrogate_event_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.session_events(spark, sf_dir).withColumn("product_id", F.col("order_id"))
    return events.select(
        F.col("event_id").alias("source_id"), silver.event_key().alias("event_id")
    )


# --- joins, windows, sets ------------------------------------------------------------------


def _versioned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as snapshots: the year of shipment is the version; one supplier has no key."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_suppkey") % 50 != 7, F.col("l_orderkey")).alias("l_orderkey"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        F.year("l_shipdate").alias("version"),
    )


@query
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _versioned_lines(spark, sf_dir)
    return latest.latest_rows(lines, ["l_orderkey", "l_linenumber"], "version")


@query
def latest_snapshot_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey")]
    lines = _versioned_lines(spark, sf_dir)
    return latest.latest_row(lines, ["l_orderkey", "l_linenumber"], "version", order)


@query
def top1_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return gold.chosen_reviews(t["order_reviews"])


@query
def dedup_exact_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = batch_ops.with_batch_seq(inputs.web_lines(spark, sf_dir), BATCHES)
    return latest.distinct_lines(lines, "raw_line", [F.asc("batch_seq"), F.asc("source_file")])


@query
def flag_after_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = silver.mark_session_moments(inputs.session_events(spark, sf_dir))
    return marked.select(
        "event_id",
        "session_id",
        "first_purchase_ts",
        F.coalesce(F.col("event_ts") > F.col("first_purchase_ts"), F.lit(False)).alias(
            "is_after_purchase"
        ),
    )


@query
def flag_same_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that share their minute with another one of the session."""
    by_minute = inputs.session_events(spark, sf_dir).withColumn(
        "minute", F.substring(F.col("event_ts").cast("string"), 1, 16)
    )
    marked = silver.mark_session_moments(by_minute, instant="minute")
    return marked.select(
        "event_id",
        "session_id",
        "n_at_instant",
        (F.col("n_at_instant") > 1).alias("is_same_instant"),
    )


@query
def range_join_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return batch_ops.join_batch_ranges(lines, "l_shipdate", BATCHES, FIRST_INSTANT)


@query
def nest_child_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.replayed_leads(spark, sf_dir).select(
        "mql_id",
        "first_contact_date",
        F.col("deal").isNotNull().alias("has_deal"),
        F.col("deal.won_date").alias("won_date"),
        F.col("deal.sr_id").alias("sr_id"),
        "batch_id",
    )


@query
def key_set_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with lines up to the cutoff against orders with lines after it."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    kept = batch_ops.in_scope(lines, "l_shipdate", BATCHES)
    excluded = batch_ops.quarantined(lines, "l_shipdate", BATCHES)
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    without_order = sets.keys_without_match(excluded, orders, "l_orderkey")
    sizes = sets.key_set_sizes(kept, excluded, "l_orderkey")
    counts = without_order.agg(F.count(F.lit(1)).alias("n_rows"))
    tidy = sizes.unpivot([], sizes.columns, "measure", "n_rows")
    return tidy.unionByName(counts.select(F.lit("n_without_order").alias("measure"), "n_rows"))


@query
def amount_matches_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return checks.purchase_amount_problems(t["clickstream_events"], t["order_items"])


@query
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return checks.foreign_key_orphans({n: t[n] for n in GOLD_COLUMNS if n not in KPI_TABLES})


@query
def global_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lead totals, shown because they are not the published ones."""
    leads = Tables(spark, sf_dir)["leads"]
    return checks.final_lead_counts(leads, seeds.FINAL_LEADS, seeds.FINAL_DEALS)


@query
def order_items_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.order_items_rollup(Tables(spark, sf_dir)["order_items"])


@query
def topk_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_sellers(Tables(spark, sf_dir)["fact_order_item"], k=20)


@query
def geo_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = Tables(spark, sf_dir)["geolocation"]
    return rolled.withColumns(
        {c: F.round(c, 6) for c in ("geolocation_lat", "geolocation_lng")}
    )


# --- tables --------------------------------------------------------------------------------

TABLE_QUERIES = {
    "silver_leads": "leads",
    "silver_events": "clickstream_events",
    "silver_orders_flags": "orders",
    "silver_items_flags": "order_items",
    "silver_payments_flags": "order_payments",
    "silver_reviews_flags": "order_reviews",
    "silver_products_flags": "products",
} | {name: name for name in GOLD_COLUMNS}


def _table_query(key: str, name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Tables(spark, sf_dir).build(name)

    run.__name__ = key
    query(run)


for _key, _name in TABLE_QUERIES.items():
    _table_query(_key, _name)


@query
def silver_leads_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = silver.leads_rejects(Tables(spark, sf_dir)["evaluated_leads"])
    return rejects.withColumn("has_deal", F.col("deal").isNotNull()).drop("deal", "ingested_at")


@query
def silver_events_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.events_rejects(Tables(spark, sf_dir)["evaluated_events"]).drop("ingested_at")


PARTIES = ("customers", "sellers", "product_category_translation")


@query
def silver_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of customers, sellers and category names, one row per party and column."""
    t = Tables(spark, sf_dir)

    def cells(name: str) -> DataFrame:
        key, *others = columns_of(name)
        return (
            t.build(name)
            .unpivot([key], others, "column_name", "value")
            .select(F.lit(name).alias("table_name"), F.col(key).alias("party_id"), "column_name", "value")
        )

    return checks.union_all(cells(name) for name in PARTIES)


# --- checks --------------------------------------------------------------------------------


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = Tables(spark, sf_dir)["leads"]
    return checks.null_counts(
        leads,
        ["mql_id", "first_contact_date", "landing_page_id", "origin", "has_deal", "won_date",
         "seller_id", "has_company", "source_file", "batch_id"],
    )


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers that won more than one lead."""
    leads = Tables(spark, sf_dir)["leads"]
    return checks.unique(leads, ["seller_id"], where=F.col("seller_id").isNotNull())


@query
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders named by events that the orders table does not have."""
    t = Tables(spark, sf_dir)
    named = F.col("order_id").isNotNull()
    return checks.relationships(
        t["clickstream_events"], "order_id", t["orders"], "order_id", where=named
    )


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    events = table(spark, sf_dir, "events")
    outside = [
        ("l_returnflag", checks.accepted_values(lines, "l_returnflag", ["N", "R"])),
        ("event_type", checks.accepted_values(events, "event_type", ["view", "click", "purchase"])),
    ]
    return checks.union_all(
        rows.select(F.lit(name).alias("column_name"), "value", "n_rows") for name, rows in outside
    )


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column and table checks of leads and events with their severities."""
    t = Tables(spark, sf_dir)
    leads, events = t["leads"], t["clickstream_events"]
    bronze_leads = t["bronze_leads"]
    steps = list(gold.FUNNEL_STEPS)
    check, error, warn = checks.Check, checks.ERROR, checks.WARN
    return checks.report(
        [
            check("leads_mql_id_not_null", checks.not_null(leads, "mql_id"), error),
            check("leads_mql_id_unique", checks.unique(leads, ["mql_id"]), error),
            check(
                "leads_seller_id_unique",
                checks.unique(leads, ["seller_id"], F.col("seller_id").isNotNull()),
                warn,
            ),
            check("leads_bronze_unparsed", checks.unparsed(bronze_leads), error),
            check(
                "leads_rejects_empty",
                checks.no_rows(silver.leads_rejects(t["evaluated_leads"])),
                warn,
            ),
            check(
                "leads_dates_in_scope",
                checks.no_dates_after_cutoff(leads, ["first_contact_date", "won_date"], BATCHES),
                error,
            ),
            check("events_event_id_unique", checks.unique(events, ["event_id"]), error),
            check(
                "events_event_type_accepted",
                checks.accepted_values(events, "event_type", steps),
                error,
            ),
            check(
                "events_ts_in_scope", checks.not_after_cutoff(events, "event_ts", BATCHES), error
            ),
            check(
                "events_rejects_empty",
                checks.no_rows(silver.events_rejects(t["evaluated_events"])),
                error,
            ),
            check(
                "events_user_known",
                checks.relationships(events, "user_id", t["customers"], "customer_id"),
                error,
            ),
            check(
                "events_product_known",
                checks.relationships(
                    events, "product_id", t["products"], "product_id",
                    where=F.col("product_id").isNotNull(),
                ),
                error,
            ),
        ]
    )


@query
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.key_uniqueness(Tables(spark, sf_dir).gold(), GOLD_KEYS)


@query
def fact_grain_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated grains; order lines are taken as they are, with repeated line numbers."""
    t = Tables(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
    )
    facts = {
        "fact_order": t["fact_order"],
        "fact_order_item": lines,
        "fact_lead": t["fact_lead"],
        "fact_session": t["fact_session"],
    }
    return checks.grain_duplicates(facts, GOLD_KEYS)


@query
def layer_count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold against silver counts, and leads through bronze, silver and rejects."""
    t = Tables(spark, sf_dir)
    silver_names = (
        "customers", "products", "sellers", "orders", "order_items", "leads", "clickstream_events",
    )
    gold_names = (
        "dim_customer", "dim_product", "dim_seller", "fact_order", "fact_order_item", "fact_lead",
        "fact_session",
    )
    counts = checks.layer_counts(
        {n: t[n] for n in silver_names}, {n: t[n] for n in gold_names}
    ).select(
        "check_name",
        F.col("left_total").cast("bigint").alias("left_total"),
        F.col("right_total").cast("bigint").alias("right_total"),
    )
    leads = checks.lead_layer_counts(
        t["leads"], silver.leads_rejects(t["evaluated_leads"]), t["bronze_leads"]
    )
    pairs = {
        "leads and rejects vs bronze": (
            F.col("silver_leads") + F.col("reject_leads"), F.col("bronze_leads"),
        ),
        "deals vs bronze": (F.col("silver_deals"), F.col("bronze_deals")),
    }
    lead_rows = [
        leads.select(
            F.lit(name).alias("check_name"),
            left.alias("left_total"),
            right.alias("right_total"),
        )
        for name, (left, right) in pairs.items()
    ]
    return checks.union_all([counts, *lead_rows])


@query
def money_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    totals = checks.money_totals(
        {n: t[n] for n in ("order_items", "clickstream_events")},
        {n: t[n] for n in ("fact_order", "fact_order_item", "fact_session")},
    )
    differs = F.abs(F.col("left_total") - F.col("right_total")) > checks.MONEY_TOLERANCE
    return totals.withColumn("differs", differs)


@query
def kpi_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.kpi_additivity(Tables(spark, sf_dir).gold())


@query
def kpi_flag_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI rows that break a rule, counted per table, after one flag was turned over."""
    tampered = Tables(spark, sf_dir).gold()
    tampered["kpi_lead_origin"] = tampered["kpi_lead_origin"].withColumn(
        "is_small_sample", ~F.col("is_small_sample")
    )
    problems = checks.kpi_flag_problems(tampered)
    return problems.groupBy("table_name", "slice_key").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def calendar_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of the calendar, and of one whose Mondays are missing."""
    full = Tables(spark, sf_dir)["dim_date"]
    without_mondays = full.filter(F.dayofweek("date") != 2)
    states = [("full", full), ("without mondays", without_mondays)]
    return checks.union_all(
        checks.calendar_state(days, BATCHES).withColumn("calendar", F.lit(name))
        for name, days in states
    )


@query
def replay_guardrail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.replay_problems(Tables(spark, sf_dir)["bronze_leads"], BATCHES)


@query
def orphans_vs_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans known after each batch against the numbers that are tolerated."""
    events = Tables(spark, sf_dir)["clickstream_events"]
    children = {
        "order_reviews_to_orders": inputs.raw_reviews(spark, sf_dir),
        "clickstream_to_orders": events.filter(F.col("order_id").isNotNull()),
    }
    parents = inputs.raw_orders(spark, sf_dir).select(
        F.trim("order_id").alias("order_id"), "batch_id"
    )
    orphans = checks.union_all(
        checks.orphans_after_each_batch(rows, parents, "order_id", BATCHES).withColumn(
            "relation", F.lit(relation)
        )
        for relation, rows in children.items()
    )
    expected = seeds.expected_orphans(spark, BATCHES)
    return checks.orphans_against_expected(orphans, expected, BATCHES)


@query
def expected_counts_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag counts beside the published ones."""
    t = Tables(spark, sf_dir)
    codes = {
        "orders": ("D1", "D2", "D3", "D4", "D5", "D6", "D7"),
        "order_items": ("I1",),
        "order_reviews": ("R2",),
        "products": ("PR1", "PR2", "PR3"),
        "leads": ("C1",),
    }
    counted = [
        checks.flag_counts(t[name])
        .filter(F.col("sub_code").isin(*wanted))
        .select(F.lit(name).alias("table_name"), "sub_code", "actual_count")
        for name, wanted in codes.items()
    ]
    sessions = checks.session_flag_counts(t["clickstream_events"]).select(
        F.lit("clickstream_events").alias("table_name"), "sub_code", "actual_count"
    )
    expected = seeds.expected_anomalies(spark).filter(F.col("sub_code").isNotNull())
    return checks.expected_counts(
        checks.union_all([*counted, sessions]),
        expected.select("table_name", "sub_code", "expected_count"),
        ["table_name", "sub_code"],
    )


@query
def anomaly_counts_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All published anomalies, those without a flag too, beside their counts."""
    t = Tables(spark, sf_dir)
    names = (
        "orders", "order_items", "order_payments", "order_reviews", "products", "leads",
        "clickstream_events", "fact_order", "bronze_orders", "bronze_order_reviews",
    )
    raw = {
        "bronze_sellers": inputs.raw_sellers(spark, sf_dir),
        "bronze_geolocation": inputs.raw_points(spark, sf_dir),
    }
    actual = anomalies.anomaly_counts({n: t[n] for n in names} | raw, BATCHES)
    return anomalies.beside_expected(actual, seeds.expected_anomalies(spark))


@query
def batch_row_counts_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows per batch beside the published ones."""
    raw = {
        "orders": inputs.raw_orders,
        "order_items": inputs.raw_items,
        "order_payments": inputs.raw_payments,
        "order_reviews": inputs.raw_reviews,
        "customers": inputs.raw_customers,
        "products": inputs.raw_products,
        "sellers": inputs.raw_sellers,
        "product_category_translation": inputs.raw_translation,
        "geolocation": inputs.raw_points,
        "marketing_leads": inputs.lead_lines,
        "clickstream": inputs.web_lines,
    }
    actual = checks.union_all(
        reader(spark, sf_dir)
        .groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "batch_id", "n_rows")
        for name, reader in raw.items()
    )
    return checks.batch_row_counts(actual, seeds.expected_row_counts(spark, BATCHES))


@query
def raw_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, keys and excluded rows of each raw table and what breaks a rule, beside the published figures."""
    read = lambda name: table(spark, sf_dir, name)
    quarantined = lambda rows, at: batch_ops.quarantined(rows, at, BATCHES)
    lines, orders, items = read("lineitem"), read("orders"), inputs.item_totals(spark, sf_dir)
    reviewed = inputs.reviewed_lines(spark, sf_dir)
    # only keys and times count here: leads and first deals share one narrow shuffle
    leads = inputs.replayed_leads(spark, sf_dir, inputs.FIRST_DEAL)
    first_deal = latest.first_per_key(
        inputs.deal_children(spark, sf_dir).select("mql_id", *inputs.FIRST_DEAL), ["mql_id"], [F.asc(c) for c in inputs.FIRST_DEAL]
    )
    known_leads = read("orders").select(F.expr("CAST(o_orderkey AS STRING)").alias("mql_id"))
    web = inputs.web_lines(spark, sf_dir)
    # a line is spelled once for all sets that it is in
    web_role = F.when(F.col("batch_id").isNotNull(), ledger_of.RAW | ledger_of.IN_SCOPE).otherwise(ledger_of.RAW | ledger_of.EXCLUDED)
    line_key = ["l_orderkey", "l_linenumber"]
    review_key = [F.expr(inputs.REVIEW_ID), "l_orderkey"]
    order_key = [F.trim("order_id")]
    parents = {"orders": ("o_custkey", "c_custkey", "customer")}
    sets = [
        ("orders", orders, ["o_orderkey"], ledger_of.RAW),
        ("orders", inputs.raw_orders(spark, sf_dir), order_key, ledger_of.IN_SCOPE),
        ("orders", quarantined(orders, "o_orderdate"), ["o_orderkey"], ledger_of.EXCLUDED),
        ("orders_parent", quarantined(orders, "o_orderdate"), [parents["orders"][0]], ledger_of.EXCLUDED),
        ("orders_parent", read(parents["orders"][2]), [parents["orders"][1]], ledger_of.PARENT),
        ("order_items", lines, line_key, ledger_of.RAW),
        ("order_items", inputs.raw_items(spark, sf_dir), ["order_id", "order_item_id"], ledger_of.IN_SCOPE),
        ("order_items", quarantined(items, "limit"), line_key, ledger_of.EXCLUDED),
        ("order_payments", lines, line_key, ledger_of.RAW),
        ("order_payments", inputs.raw_payments(spark, sf_dir), ["order_id", "payment_sequential"], ledger_of.IN_SCOPE),
        ("order_payments", quarantined(lines, "l_shipdate"), line_key, ledger_of.EXCLUDED),
        ("order_reviews", reviewed, review_key, ledger_of.RAW),
        ("order_reviews", inputs.raw_reviews(spark, sf_dir), ["review_id", "order_id"], ledger_of.IN_SCOPE),
        ("order_reviews", quarantined(reviewed, "created"), review_key, ledger_of.EXCLUDED),
        ("customers", read("customer"), ["c_custkey"], ledger_of.RAW),
        ("customers", inputs.raw_customers(spark, sf_dir), ["customer_id"], ledger_of.IN_SCOPE),
        ("products", read("part"), ["p_partkey"], ledger_of.RAW),
        ("products", inputs.raw_products(spark, sf_dir), ["product_id"], ledger_of.IN_SCOPE),
        ("sellers", read("supplier"), ["s_suppkey"], ledger_of.RAW),
        ("sellers", inputs.raw_sellers(spark, sf_dir), ["seller_id"], ledger_of.IN_SCOPE),
        ("product_category_translation", inputs.raw_translation(spark, sf_dir), ["product_category_name"], ledger_of.RAW),
        ("product_category_translation", inputs.raw_translation(spark, sf_dir), ["product_category_name"], ledger_of.IN_SCOPE),
        ("geolocation", inputs.raw_points(spark, sf_dir), [], ledger_of.IN_SCOPE),
        ("marketing_leads", known_leads, ["mql_id"], ledger_of.RAW),
        ("marketing_leads", leads, ["mql_id"], ledger_of.IN_SCOPE),
        ("marketing_deals", first_deal, ["mql_id"], ledger_of.RAW),
        ("marketing_deals", leads.where("deal IS NOT NULL"), ["mql_id"], ledger_of.IN_SCOPE),
        ("marketing_deals", quarantined(first_deal, "won_date"), ["mql_id"], ledger_of.EXCLUDED),
        ("marketing_deals", known_leads, ["mql_id"], ledger_of.PARENT),
        ("clickstream", web, ["raw_line"], web_role),
    ]
    totals = ledger_of.ledger_totals(ledger_of.key_ledger(ledger_of.key_rows(*one) for one in sets))
    return ledger_of.beside_published(totals, seeds.published_totals(spark))


@query
def layer_row_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    silver_names = (
        "orders", "order_items", "order_payments", "order_reviews", "customers", "products",
        "sellers", "product_category_translation", "geolocation", "leads", "clickstream_events",
    )
    return checks.layer_rows({n: t[n] for n in (*silver_names, *GOLD_COLUMNS)})


RUN_BATCHES = ("signup", "view", "click", "purchase", "error")


@query
def batch_order_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches held back because the latest run of the one before did not succeed."""
    order = batch_ops.BatchPlan(
        tuple(batch_ops.Batch(name, BATCHES.cutoff_timestamp) for name in RUN_BATCHES)
    )
    runs = ledger.latest_status_per_batch(inputs.batch_runs(spark, sf_dir))
    return batch_ops.batch_order_problems(runs, order, ledger.SUCCESS)


@query
def kpi_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead KPIs of the models against the same figures straight from orders and lines.

    The second route knows no rejects, so months and origins that lost leads differ.
    """
    t = Tables(spark, sf_dir)
    actual = checks.union_all(
        compare.to_metrics(t[name], name, GOLD_KEYS[name])
        for name in ("kpi_lead_month", "kpi_lead_origin")
    )
    month = calendar.month_label(F.col("o_orderdate"))
    orders = table(spark, sf_dir, "orders").withColumns(
        {"year_month": month, "origin": F.lower("o_orderpriority")}
    )
    expected = checks.union_all(
        compare.to_metrics(
            orders.groupBy(key).agg(F.count(F.lit(1)).alias("n_leads")), name, [key]
        )
        for name, key in (("kpi_lead_month", "year_month"), ("kpi_lead_origin", "origin"))
    )
    return compare.compare_metrics(expected, actual)


def _second_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    orders = second_route.order_components(
        t["bronze_orders"], t["bronze_order_items"], t["bronze_order_reviews"], inputs.raw_customers(spark, sf_dir), BATCHES
    )
    tables_ = second_route.kpi_tables(
        orders, second_route.lead_components(t["bronze_leads"], BATCHES), second_route.session_components(t["bronze_events"]), BATCHES
    )
    return checks.union_all(second_route.metrics(tables_))


@query
def kpi_second_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metric of all KPI tables, from raw rows without silver or gold."""
    return _second_route(spark, sf_dir)


@query
def kpi_compare_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All KPI tables against the second route: how many metrics of each were compared, and how many disagree."""
    t = Tables(spark, sf_dir)
    actual = checks.union_all(compare.to_metrics(t[name], name, GOLD_KEYS[name]) for name in KPI_TABLES)
    return compare.agreement(_second_route(spark, sf_dir), actual)
