"""Checks: each returns the rows that break a rule; no rows means it holds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.flags import has_flag
from tidemark.functions.measures import SMALL_GROUP, SMALL_MONTH_ORDERS
from tidemark.functions.text import blank_to_null, joined_key
from tidemark.operators.batches import BatchPlan, with_batch_seq
from tidemark.operators.skew import lookup_join
from tidemark.sources.scratch import small_table

ERROR, WARN = "error", "warn"
# Fixed value: money totals may differ by half a cent.
MONEY_TOLERANCE = 0.005


@dataclass(frozen=True)
class Check:
    name: str
    violations: DataFrame
    severity: str = ERROR


class ChecksFailed(RuntimeError):
    """At least one check of severity ``error`` found violations."""


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def report(checks: Sequence[Check]) -> DataFrame:
    """check_name, severity, violations, status: one row per check."""
    counts = [
        check.violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            "violations",
        )
        for check in checks
    ]
    status = F.when(F.col("violations") == 0, "pass").otherwise(F.col("severity"))
    return union_all(counts).withColumn("status", status)


def raise_on_errors(checks_report: DataFrame) -> DataFrame:
    """Stop on errors, else the report as settled rows.

    Every check runs once: its row, one per check, is collected and given back.
    """
    rows = checks_report.collect()
    failed = [row for row in rows if row.status == ERROR]
    if failed:
        names = ", ".join(f"{row.check_name} ({row.violations})" for row in failed)
        raise ChecksFailed(names)
    settled = [tuple(row) for row in rows]
    return small_table(checks_report.sparkSession, settled, checks_report.schema.toDDL())


# --- column checks -------------------------------------------------------------------------


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNull())


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """check_name, violations for many columns in one pass."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "check_name", "violations")


def unique(rows: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Key values that occur more than once, with their number of rows; NULL is no value."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    chosen = rows.filter(complete if where is None else complete & where)
    return (
        chosen.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def relationships(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    where: Column | None = None,
) -> DataFrame:
    """Child values without a parent and their number of rows; NULL has no parent.

    Children are counted per value before the join, so it carries one row per
    value and a value that many rows share costs nothing extra.
    """
    chosen = child if where is None else child.filter(where)
    values = chosen.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_column).alias("known")).distinct()
    return values.join(known, F.col("value") == F.col("known"), "left_anti")


def orphan_rows(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    where: Column | None = None,
) -> DataFrame:
    """One row: how many child rows have no parent."""
    lost = relationships(child, column, parent, parent_column, where)
    return lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("n_orphans"))


def orphans_above(orphans: DataFrame, allowed: int) -> DataFrame:
    """The row of ``orphan_rows`` when it has more than ``allowed``."""
    return orphans.filter(F.col("n_orphans") > allowed)


def orphans_within(orphans: DataFrame, allowed: int) -> DataFrame:
    """The row of ``orphan_rows`` when there are some, up to ``allowed``."""
    return orphans.filter((F.col("n_orphans") > 0) & (F.col("n_orphans") <= allowed))


def accepted_values(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list and their number of rows."""
    return (
        rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def no_rows(rows: DataFrame) -> DataFrame:
    """For a table that should stay empty, such as rejects: all of it."""
    return rows


def not_after_cutoff(rows: DataFrame, column: str, plan: BatchPlan) -> DataFrame:
    return rows.filter(plan.after_cutoff(F.col(column)))


def no_dates_after_cutoff(rows: DataFrame, columns: Sequence[str], plan: BatchPlan) -> DataFrame:
    late = [F.coalesce(plan.after_cutoff_date(F.col(c)), F.lit(False)) for c in columns]
    return rows.filter(reduce(lambda a, b: a | b, late))


def unparsed(bronze: DataFrame) -> DataFrame:
    return bronze.filter(~F.coalesce(F.col("is_parsed"), F.lit(False)))


# --- keys, grain and foreign keys of the gold tables ---------------------------------------


def key_problems(table: DataFrame, table_name: str, keys: Sequence[str]) -> DataFrame:
    """table_name, n_problems: repeated keys plus rows whose key has a NULL part.

    Grouping by the key counts distinct keys without an expanded
    ``count(distinct)``, and a key with many copies is combined early.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    counts = per_key.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("n_rows"),
        F.count_if(complete).alias("n_keys"),
        F.coalesce(F.sum(F.when(~complete, F.col("__rows"))), F.lit(0)).alias("n_null"),
    )
    return counts.select(
        F.lit(table_name).alias("table_name"),
        (F.col("n_rows") - F.col("n_keys") + F.col("n_null")).alias("n_problems"),
    )


def key_uniqueness(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per table, also for tables without problems."""
    return union_all(key_problems(tables[name], name, keys[name]) for name in tables)


def grain_duplicates(
    facts: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]
) -> DataFrame:
    """fact_table, grain_key, n_rows for every grain that occurs more than once."""
    return union_all(
        unique(facts[name], keys[name]).select(
            F.lit(name).alias("fact_table"),
            joined_key(*[F.col(k) for k in keys[name]]).alias("grain_key"),
            "n_rows",
        )
        for name in facts
    )


# The foreign keys of the gold tables.
FOREIGN_KEYS = (
    ("fact_order", "customer_id", "dim_customer", "customer_id"),
    ("fact_order", "purchase_date", "dim_date", "date"),
    ("fact_order_item", "order_id", "fact_order", "order_id"),
    ("fact_order_item", "product_id", "dim_product", "product_id"),
    ("fact_order_item", "seller_id", "dim_seller", "seller_id"),
    ("fact_order_item", "purchase_date", "dim_date", "date"),
    ("fact_lead", "first_contact_date", "dim_date", "date"),
    ("fact_session", "session_date", "dim_date", "date"),
)


def foreign_key_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """fk_name, n_orphans for each foreign key; rows with a NULL key count."""
    return union_all(
        orphan_rows(tables[child], column, tables[parent], parent_column).select(
            F.lit(f"{child}.{column} -> {parent}").alias("fk_name"), "n_orphans"
        )
        for child, column, parent, parent_column in FOREIGN_KEYS
    )


# --- totals --------------------------------------------------------------------------------


def one_row_totals(frames: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """measure, total: one global aggregate per frame, as tidy rows."""
    return union_all(
        frame.agg(F.coalesce(total, F.lit(0)).cast("decimal(38,2)").alias("total")).select(
            F.lit(measure).alias("measure"), "total"
        )
        for measure, frame, total in frames
    )


def paired_totals(
    pairs: Sequence[tuple[str, tuple[DataFrame, Column], tuple[DataFrame, Column]]],
) -> DataFrame:
    """check_name, left_total, right_total for totals that should agree.

    Both sides become rows of one small frame and are pivoted by a grouped
    aggregate; nothing is cross joined.
    """
    sides = []
    for name, left, right in pairs:
        for column, (frame, total) in (("left_total", left), ("right_total", right)):
            value = F.coalesce(total, F.lit(0)).cast("decimal(38,2)")
            sides.append(
                frame.agg(value.alias("total")).select(
                    F.lit(name).alias("check_name"), F.lit(column).alias("side"), "total"
                )
            )
    return (
        union_all(sides)
        .groupBy("check_name")
        .agg(
            *[
                F.max(F.when(F.col("side") == side, F.col("total"))).alias(side)
                for side in ("left_total", "right_total")
            ]
        )
    )


def differing_totals(totals: DataFrame, tolerance: float = 0.0) -> DataFrame:
    return totals.filter(F.abs(F.col("left_total") - F.col("right_total")) > F.lit(tolerance))


def count_of(frame: DataFrame) -> tuple[DataFrame, Column]:
    return frame, F.count(F.lit(1))


def layer_counts(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> DataFrame:
    """Gold row counts beside those of the silver tables they come from."""
    events = silver["clickstream_events"]
    sessions = events.groupBy("session_id").agg(F.lit(1).alias("one"))
    same = (
        ("dim_customer", "customers"),
        ("dim_product", "products"),
        ("dim_seller", "sellers"),
        ("fact_order", "orders"),
        ("fact_order_item", "order_items"),
        ("fact_lead", "leads"),
    )
    pairs = [
        (f"{g} vs {s}", count_of(gold[g]), count_of(silver[s])) for g, s in same
    ]
    pairs.append(
        (
            "fact_session vs distinct sessions",
            count_of(gold["fact_session"]),
            count_of(sessions.filter(F.col("session_id").isNotNull())),
        )
    )
    pairs.append(
        (
            "fact_session events vs clickstream_events",
            (gold["fact_session"], F.sum("n_events")),
            count_of(events),
        )
    )
    return paired_totals(pairs)


def money_totals(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> DataFrame:
    item_price = (silver["order_items"], F.sum("price"))
    purchases = F.sum(F.when(F.col("event_type") == "purchase", F.col("amount")))
    return paired_totals(
        [
            ("fact_order_item price", (gold["fact_order_item"], F.sum("price")), item_price),
            ("fact_order revenue", (gold["fact_order"], F.sum("order_revenue")), item_price),
            (
                "fact_session purchase amount",
                (gold["fact_session"], F.sum("purchase_amount")),
                (silver["clickstream_events"], purchases),
            ),
        ]
    )


def _sums(names: Sequence[str]) -> dict[str, Column]:
    return {name: F.sum(name) for name in names}


SALES_SUMS = (
    "n_orders_total",
    "n_canceled_orders",
    "n_valid_orders",
    "sum_revenue",
)
DELIVERY_SUMS = (
    "n_delivered",
    "sum_delivery_days",
    "n_late",
    "n_on_time",
    "n_shipping_measured",
    "sum_shipping_days",
    "n_scored",
    "sum_score",
    "n_overdue_undelivered",
)
DELIVERY_SHARED = (
    "n_delivered",
    "sum_delivery_days",
    "n_late",
    "n_scored",
    "sum_score",
    "n_overdue_undelivered",
)
LEAD_SUMS = (
    "n_leads",
    "n_leads_with_deal",
    "n_close_time_valid_deals",
    "sum_days_to_close",
    "n_leads_not_excluded",
    "n_won_30d",
)
FUNNEL_SUMS = (
    "n_sessions",
    "n_purchase_sessions",
    "n_cart_sessions",
    "n_cart_abandoned_sessions",
    "n_sessions_ge2",
    "sum_duration_seconds",
)
FUNNEL_SHARED = (
    "n_sessions",
    "n_purchase_sessions",
    "n_cart_sessions",
    "sum_duration_seconds",
)


def _count_where(condition: Column) -> Column:
    return F.count_if(condition)


def _order_sums() -> dict[str, Column]:
    delivered, late = F.col("is_delivered_order"), F.col("is_late")
    return {
        "n_orders_total": F.count(F.lit(1)),
        "n_canceled_orders": _count_where(F.col("is_canceled")),
        "n_valid_orders": _count_where(F.col("is_valid_order")),
        "sum_revenue": F.sum(F.when(F.col("is_valid_order"), F.col("order_revenue"))),
        "n_delivered": _count_where(delivered),
        "sum_delivery_days": F.sum(F.when(delivered, F.col("delivery_days"))),
        "n_late": _count_where(delivered & late),
        "n_on_time": _count_where(delivered & ~late),
        "n_shipping_measured": _count_where(delivered & F.col("shipping_days").isNotNull()),
        "sum_shipping_days": F.sum(F.when(delivered, F.col("shipping_days"))),
        "n_scored": _count_where(F.col("review_score").isNotNull()),
        "sum_score": F.sum("review_score"),
        "n_overdue_undelivered": _count_where(F.col("is_overdue_undelivered")),
    }


def _lead_sums() -> dict[str, Column]:
    kept = ~F.col("is_close_time_excluded")
    days = F.col("days_to_close")
    measured = F.col("has_deal") & kept & days.isNotNull()
    return {
        "n_leads": F.count(F.lit(1)),
        "n_leads_with_deal": _count_where(F.col("has_deal")),
        "n_close_time_valid_deals": _count_where(measured),
        "sum_days_to_close": F.sum(F.when(measured, days)),
        "n_leads_not_excluded": _count_where(kept),
        "n_won_30d": _count_where(measured & (days <= 30)),
    }


def _session_sums() -> dict[str, Column]:
    cart, bought = F.col("has_add_to_cart"), F.col("has_purchase")
    several = F.col("n_events") >= 2
    return {
        "n_sessions": F.count(F.lit(1)),
        "n_purchase_sessions": _count_where(bought),
        "n_cart_sessions": _count_where(cart),
        "n_cart_abandoned_sessions": _count_where(cart & ~bought),
        "n_sessions_ge2": _count_where(several),
        "sum_duration_seconds": F.sum(F.when(several, F.col("duration_seconds"))),
    }


def kpi_additivity(gold: Mapping[str, DataFrame]) -> DataFrame:
    """check_name, component, left_total, right_total.

    KPI tables add up to their facts, and the coarser of two KPI tables to the
    finer one. Each table is aggregated once, all its components together.
    """
    totals = {name: (_sums(names), gold[name]) for name, names in (
        ("kpi_sales_month", SALES_SUMS),
        ("kpi_sales_state_month", SALES_SUMS),
        ("kpi_delivery_month", DELIVERY_SUMS),
        ("kpi_delivery_state_month", DELIVERY_SHARED),
        ("kpi_lead_month", LEAD_SUMS),
        ("kpi_lead_origin", LEAD_SUMS),
        ("kpi_funnel_day", FUNNEL_SUMS),
        ("kpi_funnel_month", FUNNEL_SHARED),
    )}
    totals["fact_order"] = (_order_sums(), gold["fact_order"])
    totals["fact_lead"] = (_lead_sums(), gold["fact_lead"])
    totals["fact_session"] = (_session_sums(), gold["fact_session"])

    def tidy(name: str) -> DataFrame:
        columns, table = totals[name]
        one_row = table.agg(
            *[F.coalesce(c, F.lit(0)).cast("decimal(38,2)").alias(n) for n, c in columns.items()]
        )
        return one_row.unpivot([], list(columns), "component", "total").withColumn(
            "table_name", F.lit(name)
        )

    pairs = (
        ("kpi_sales_month", "fact_order", SALES_SUMS),
        ("kpi_sales_state_month", "fact_order", SALES_SUMS),
        ("kpi_delivery_month", "fact_order", DELIVERY_SUMS),
        ("kpi_delivery_state_month", "kpi_delivery_month", DELIVERY_SHARED),
        ("kpi_lead_month", "fact_lead", LEAD_SUMS),
        ("kpi_lead_origin", "kpi_lead_month", LEAD_SUMS),
        ("kpi_funnel_day", "fact_session", FUNNEL_SUMS),
        ("kpi_funnel_month", "kpi_funnel_day", FUNNEL_SHARED),
    )
    spark = gold["fact_order"].sparkSession
    wanted = small_table(
        spark,
        [
            (f"{left} vs {right}", component, table, side)
            for left, right, components in pairs
            for component in components
            for table, side in ((left, "left_total"), (right, "right_total"))
        ],
        "check_name string, component string, table_name string, side string",
    )
    # a few dozen rows on both sides
    return (
        union_all(tidy(name) for name in totals)
        .join(F.broadcast(wanted), ["table_name", "component"], "inner")
        .groupBy("check_name", "component")
        .agg(
            *[
                F.max(F.when(F.col("side") == side, F.col("total"))).alias(side)
                for side in ("left_total", "right_total")
            ]
        )
    )


# --- rules on KPI rows ---------------------------------------------------------------------


def _zero_needs_null(pairs: Sequence[tuple[str, str]]) -> Column:
    """A ratio is set although its denominator is zero."""
    broken = [(F.col(den) == 0) & F.col(rate).isNotNull() for den, rate in pairs]
    return reduce(lambda a, b: a | b, broken)


def kpi_flag_problems(gold: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, slice_key of KPI rows with a wrong small-sample flag or a ratio over zero."""
    small = F.col("is_small_sample")
    group = lambda c: F.col(c) < SMALL_GROUP
    sales_zero = [("n_valid_orders", "avg_order_value"), ("n_orders_total", "cancel_rate")]
    delivery_zero = [
        ("n_delivered", "avg_delivery_days"),
        ("n_delivered", "late_rate"),
        ("n_shipping_measured", "avg_shipping_days"),
        ("n_scored", "avg_score"),
        ("n_scored_on_time", "score_gap"),
        ("n_scored_late", "score_gap"),
    ]
    lead_zero = [
        ("n_leads", "lead_to_deal_rate"),
        ("n_close_time_valid_deals", "avg_days_to_close"),
        ("n_leads_not_excluded", "won_30d_rate"),
    ]
    funnel_zero = [
        ("n_sessions", "conversion_rate"),
        ("n_cart_sessions", "abandon_rate"),
        ("n_sessions_ge2", "avg_duration_seconds"),
        ("n_reach_home", "step_rate_home_view"),
        ("n_reach_view", "step_rate_view_cart"),
        ("n_reach_cart", "step_rate_cart_purchase"),
    ]
    small_month = F.col("n_valid_orders") < SMALL_MONTH_ORDERS
    gap = F.col("is_small_gap_group") != (group("n_scored_on_time") | group("n_scored_late"))
    previous = F.col("__previous")
    growth_too_early = (
        F.coalesce(previous < SMALL_MONTH_ORDERS, F.lit(True)) & F.col("order_growth").isNotNull()
    )
    rules = {
        "kpi_sales_month": (small != small_month)
        | _zero_needs_null(sales_zero)
        | growth_too_early,
        "kpi_sales_state_month": (small != group("n_valid_orders"))
        | _zero_needs_null(sales_zero),
        "kpi_delivery_month": (small != (small_month | group("n_delivered")))
        | gap
        | _zero_needs_null(delivery_zero),
        "kpi_delivery_state_month": (small != group("n_delivered"))
        | gap
        | _zero_needs_null(delivery_zero),
        "kpi_lead_month": (small != group("n_leads_with_deal")) | _zero_needs_null(lead_zero),
        "kpi_lead_origin": (small != group("n_leads_with_deal")) | _zero_needs_null(lead_zero),
        "kpi_funnel_day": (small != group("n_sessions")) | _zero_needs_null(funnel_zero),
        "kpi_funnel_month": (small != group("n_sessions")) | _zero_needs_null(funnel_zero),
    }
    slices = {
        "kpi_sales_state_month": ("customer_state", "year_month"),
        "kpi_delivery_state_month": ("customer_state", "year_month"),
        "kpi_lead_origin": ("origin",),
        "kpi_funnel_day": ("session_date",),
    }
    frames = []
    for name, broken in rules.items():
        table = gold[name]
        if name == "kpi_sales_month":  # one row per calendar month
            month_order = Window.orderBy("year_month")
            table = table.withColumn("__previous", F.lag("n_valid_orders").over(month_order))
        key = joined_key(*[F.col(c) for c in slices.get(name, ("year_month",))])
        frames.append(
            table.filter(broken).select(F.lit(name).alias("table_name"), key.alias("slice_key"))
        )
    return union_all(frames)


def calendar_state(calendar: DataFrame, plan: BatchPlan) -> DataFrame:
    """One row describing the calendar, with the number of days it should have."""
    return calendar.agg(
        F.count(F.lit(1)).alias("actual_rows"),
        F.count_distinct("date").alias("distinct_days"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    ).withColumns(
        {
            "expected_end_date": F.lit(plan.cutoff_date).cast("date"),
            "expected_rows": F.datediff(F.lit(plan.cutoff_date).cast("date"), "min_date") + 1,
        }
    )


def calendar_gaps(calendar: DataFrame, plan: BatchPlan) -> DataFrame:
    return calendar_state(calendar, plan).filter(
        (F.col("actual_rows") == 0)
        | (F.col("actual_rows") != F.col("distinct_days"))
        | (F.col("max_date") != F.col("expected_end_date"))
        | (F.col("actual_rows") != F.col("expected_rows"))
    )


# --- expected counts -----------------------------------------------------------------------


def orphans_after_each_batch(
    child: DataFrame, parent: DataFrame, key: str, plan: BatchPlan
) -> DataFrame:
    """batch_id, n_orphans: child rows loaded by then whose parent was not.

    Both have ``key`` and ``batch_id``. Children are counted per key and batch
    before the join; an orphan lasts from its own batch to the one before its
    parent's.
    """
    values = (
        with_batch_seq(child, plan).groupBy(key, "batch_seq").agg(F.count(F.lit(1)).alias("n"))
    )
    known_from = (
        with_batch_seq(parent, plan).groupBy(key).agg(F.min("batch_seq").alias("__known_from"))
    )
    last_batch = F.lit(len(plan.ids) - 1)
    until = F.coalesce(F.col("__known_from") - 1, last_batch)
    lasting = (
        lookup_join(values, known_from, [key], "left")
        .filter(F.col("batch_seq") <= until)
        .select("n", F.explode(F.sequence("batch_seq", until)).alias("batch_seq"))
    )
    counts = lasting.groupBy("batch_seq").agg(F.sum("n").alias("n_orphans"))
    sequence = plan.sequence_frame(child.sparkSession).select("batch_id", "batch_seq")
    return counts.join(F.broadcast(sequence), "batch_seq", "inner").select("batch_id", "n_orphans")


def orphans_against_expected(orphans: DataFrame, expected: DataFrame, plan: BatchPlan) -> DataFrame:
    """relation, batch_id, actual, expected, status per relation and batch.

    ``orphans`` has relation, batch_id, n_orphans. More than expected is an
    error; some, up to the expected number, are a warning until the final batch.
    """
    actual = F.coalesce(F.col("n_orphans"), F.lit(0).cast("bigint"))
    status = (
        F.when(actual > F.col("expected_orphans"), ERROR)
        .when((actual > 0) & (F.col("batch_id") != plan.final_batch), WARN)
        .otherwise("pass")
    )
    # one row per relation and batch on both sides
    return expected.join(orphans, ["relation", "batch_id"], "left").select(
        "relation",
        "batch_id",
        actual.alias("actual_orphans"),
        "expected_orphans",
        status.alias("status"),
    )


def session_flag_counts(silver_events: DataFrame) -> DataFrame:
    """sub_code, actual_count: sessions flagged E1 and events flagged E2."""
    e1, e2 = (has_flag(F.col("dq_flag"), code) for code in ("E1", "E2"))
    per_session = silver_events.groupBy("session_id").agg(
        F.count_if(e1).alias("e1"), F.count_if(e2).alias("e2")
    )
    counted = per_session.agg(
        F.count_if(F.col("e1") > 0).alias("E1"),
        F.coalesce(F.sum("e2"), F.lit(0).cast("bigint")).alias("E2"),
    )
    return counted.unpivot([], ["E1", "E2"], "sub_code", "actual_count")


def flag_counts(rows: DataFrame) -> DataFrame:
    """sub_code, actual_count for every flag that occurs; ``T1:<column>`` counts as it stands."""
    return (
        rows.select(F.explode(F.split("dq_flag", ",")).alias("sub_code"))
        .groupBy("sub_code")
        .agg(F.count(F.lit(1)).alias("actual_count"))
    )


def flag_incidence(tables: Mapping[str, DataFrame], catalog: DataFrame) -> DataFrame:
    """Flags of the catalogue with the rows that carry them, zero where none does."""
    found = union_all(
        flag_counts(rows).withColumn("table_name", F.lit(name)) for name, rows in tables.items()
    ).withColumn("flag_id", F.substring_index("sub_code", ":", 1))
    totals = found.groupBy("table_name", "flag_id").agg(F.sum("actual_count").alias("n_rows"))
    known = catalog.filter(F.col("table_name").isin(*tables)).select("table_name", "flag_id")
    typed = catalog.filter(F.col("flag_id") == "T1").select(
        F.explode(F.array(*[F.lit(name) for name in tables])).alias("table_name"), "flag_id"
    )
    # a row per flag and table on both sides
    return (
        known.unionByName(typed)
        .join(totals, ["table_name", "flag_id"], "left")
        .fillna(0, subset=["n_rows"])
    )


def expected_counts(actual: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected counts beside the actual ones, -1 where nothing was counted."""
    return expected.join(actual, list(keys), "left").select(
        *keys,
        F.coalesce(F.col("actual_count"), F.lit(-1).cast("bigint")).alias("actual_count"),
        "expected_count",
    )


def count_mismatches(compared: DataFrame) -> DataFrame:
    return compared.filter(F.col("actual_count") != F.col("expected_count"))


def batch_row_counts(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """table_name, batch_id, actual and expected rows, and a total per table.

    ``actual`` has table_name, batch_id, n_rows; a batch on one side only counts
    as zero on the other.
    """
    both = expected.join(actual, ["table_name", "batch_id"], "full_outer").select(
        "table_name",
        "batch_id",
        F.coalesce(F.col("n_rows"), F.lit(0).cast("bigint")).alias("actual_rows"),
        F.coalesce(F.col("expected_rows"), F.lit(0).cast("bigint")).alias("expected_rows"),
    )
    totals = both.groupBy("table_name").agg(
        F.lit("total").alias("batch_id"),
        F.sum("actual_rows").alias("actual_rows"),
        F.sum("expected_rows").alias("expected_rows"),
    )
    return both.unionByName(totals).withColumn(
        "matches", F.col("actual_rows") == F.col("expected_rows")
    )


# --- checks between layers -----------------------------------------------------------------


def replay_problems(bronze_leads: DataFrame, plan: BatchPlan) -> DataFrame:
    """Leads replayed too often, or not first without and then with their deal."""
    has_deal = F.col("deal").isNotNull()
    first = F.col("batch_seq") == 0
    per_lead = (
        with_batch_seq(bronze_leads.filter(F.col("is_parsed")), plan)
        .groupBy("mql_id")
        .agg(
            F.count(F.lit(1)).alias("row_cnt"),
            F.count_if(first & has_deal).alias("bulk_with_deal"),
            F.count_if(~first & ~has_deal).alias("later_without_deal"),
        )
    )
    wrong_pair = (F.col("row_cnt") == 2) & (
        (F.col("bulk_with_deal") > 0) | (F.col("later_without_deal") > 0)
    )
    return per_lead.filter((F.col("row_cnt") > 2) | wrong_pair)


def lead_layer_counts(silver: DataFrame, rejects: DataFrame, bronze: DataFrame) -> DataFrame:
    """Leads and deals in silver, rejects and bronze as one row."""
    key = blank_to_null(F.col("mql_id"))
    per_key = (
        bronze.filter(F.col("is_parsed") & key.isNotNull())
        .groupBy(key.alias("mql_id"))
        .agg(F.bool_or(F.col("deal").isNotNull()).alias("has_deal"))
    )
    totals = one_row_totals(
        [
            ("silver_leads", silver, F.count(F.lit(1))),
            ("silver_deals", silver, F.count_if(F.col("has_deal"))),
            ("reject_leads", rejects, F.count(F.lit(1))),
            ("bronze_leads", per_key, F.count(F.lit(1))),
            ("bronze_deals", per_key, F.count_if(F.col("has_deal"))),
        ]
    )
    names = ("silver_leads", "silver_deals", "reject_leads", "bronze_leads", "bronze_deals")
    return totals.agg(
        *[
            F.max(F.when(F.col("measure") == n, F.col("total"))).cast("bigint").alias(n)
            for n in names
        ]
    )


def lead_layer_problems(counts: DataFrame) -> DataFrame:
    return counts.filter(
        (F.col("silver_leads") + F.col("reject_leads") != F.col("bronze_leads"))
        | (F.col("silver_deals") != F.col("bronze_deals"))
    )


def final_lead_counts(silver: DataFrame, n_leads: int, n_deals: int) -> DataFrame:
    """A row with the totals when they are not the expected ones, else none."""
    return silver.agg(
        F.count(F.lit(1)).alias("n_leads"), F.count_if(F.col("has_deal")).alias("n_deals")
    ).filter((F.col("n_leads") != n_leads) | (F.col("n_deals") != n_deals))


def purchase_amount_problems(events: DataFrame, items: DataFrame) -> DataFrame:
    """Purchases whose amount is not the total price of their order."""
    totals = items.groupBy("order_id").agg(
        F.sum("price").cast("decimal(20,2)").alias("total_price")
    )
    purchases = events.filter(
        (F.col("event_type") == "purchase") & F.col("order_id").isNotNull()
    ).select("event_id", "order_id", "amount")
    off = F.abs(F.col("amount") - F.col("total_price")) > MONEY_TOLERANCE
    return (
        lookup_join(purchases, totals, ["order_id"], "inner")
        .filter(F.col("amount").isNull() | off)
        .select("event_id", "order_id", "amount", "total_price")
    )


def layer_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, n_rows of every table and their sum as ``all``."""
    counts = union_all(
        rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name, rows in tables.items()
    )
    total = counts.agg(F.sum("n_rows").alias("n_rows")).select(
        F.lit("all").alias("table_name"), "n_rows"
    )
    return counts.unionByName(total)
