"""KPI metrics a second time, straight from raw-shaped rows, to hold the published tables against.

Nothing here reads silver or gold. Each fact is one frame of components (a number per row and component),
summed once for all its slices by grouping sets; rates are quotients of named sums. So a mistake in a flag,
a fact or a KPI model shows as a metric that differs, whichever slice it falls into.

Rows that silver rejects or cannot place are left out here by the same published rules: leads without id,
valid contact or landing page, events without session, user, type or time. What lies after the cutoff has
not happened. A delivered order without an estimate is neither late nor on time, as in gold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_days, elapsed_seconds, lenient_date, lenient_timestamp, month_label
from tidemark.functions.measures import SMALL_MONTH_ORDERS, ratio
from tidemark.operators.batches import BatchPlan
from tidemark.operators.compare import to_metrics
from tidemark.operators.latest import parted_by_repeat
from tidemark.plans.contract import GOLD_KEYS
from tidemark.sources.scratch import written_table

MONEY = "decimal(30,2)"
FIRST = "__first"
#: A session's kinds of event, in the order of the funnel.
KINDS = ("home", "product_view", "add_to_cart", "purchase")

#: Table, its slice, its sums, and its rates as (numerator, denominator).
SALES_SUMS = ("n_orders_total", "n_canceled_orders", "n_valid_orders", "sum_revenue")
SALES_RATES = {"avg_order_value": ("sum_revenue", "n_valid_orders"), "cancel_rate": ("n_canceled_orders", "n_orders_total")}
DELIVERY_SUMS = (
    "n_delivered",
    "sum_delivery_days",
    "n_late",
    "n_on_time",
    "n_shipping_measured",
    "sum_shipping_days",
    "n_scored",
    "sum_score",
    "n_scored_on_time",
    "sum_score_on_time",
    "n_scored_late",
    "sum_score_late",
    "n_overdue_undelivered",
)
DELIVERY_RATES = {
    "avg_delivery_days": ("sum_delivery_days", "n_delivered"),
    "late_rate": ("n_late", "n_delivered"),
    "avg_score": ("sum_score", "n_scored"),
    "avg_shipping_days": ("sum_shipping_days", "n_shipping_measured"),
}
LEAD_RATES = {
    "lead_to_deal_rate": ("n_leads_with_deal", "n_leads"),
    "avg_days_to_close": ("sum_days_to_close", "n_close_time_valid_deals"),
    "won_30d_rate": ("n_won_30d", "n_leads_not_excluded"),
}
FUNNEL_RATES = {
    "conversion_rate": ("n_purchase_sessions", "n_sessions"),
    "abandon_rate": ("n_cart_abandoned_sessions", "n_cart_sessions"),
    "avg_duration_seconds": ("sum_duration_seconds", "n_sessions_ge2"),
    "step_rate_home_view": ("n_reach_view", "n_reach_home"),
    "step_rate_view_cart": ("n_reach_cart", "n_reach_view"),
    "step_rate_cart_purchase": ("n_reach_purchase", "n_reach_cart"),
}


def _one(condition: Column) -> Column:
    return F.when(condition, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))


def _newest(rows: DataFrame, keys: Mapping[str, Column], wanted: Sequence[str], plan: BatchPlan) -> DataFrame:
    """The wanted columns of each key's row in the newest batch; keys that have one row need no aggregate."""
    position = F.coalesce(plan.position_of(F.col("batch_id")), F.lit(-1))
    named = rows.select(*[value.alias(name) for name, value in keys.items()], F.struct(position.alias("at"), *wanted).alias("row"))
    once, rest = parted_by_repeat(named, list(keys))
    newest = once.unionByName(rest.groupBy(*keys).agg(F.max("row").alias("row")))
    return newest.select(*keys, *[F.col(f"row.{c}").alias(c) for c in wanted])


# --- orders --------------------------------------------------------------------------------


def _scores(raw_reviews: DataFrame, orders: DataFrame, plan: BatchPlan) -> DataFrame:
    """The score of each order's newest usable review."""
    keys = {"review": F.trim("review_id"), "order": F.trim("order_id")}
    reviews = _newest(raw_reviews, keys, ["review_score", "review_creation_date", "review_answer_timestamp"], plan)
    number = F.col("review_score").try_cast("double")
    answered = lenient_timestamp(F.col("review_answer_timestamp"))
    created = lenient_date(F.col("review_creation_date"))
    usable = reviews.select(
        "order", "review", F.when(number == F.floor(number), number.cast("int")).alias("score"), answered.alias("answered"), created.alias("created")
    ).where(F.col("score").isNotNull() & (F.col("answered") <= F.lit(plan.cutoff_timestamp).cast("timestamp_ntz")))
    bought = orders.select(F.col("order"), F.col("bought").alias("bought"))
    in_time = usable.join(bought, "order").where("created IS NULL OR bought IS NULL OR created >= bought")
    best = F.max(F.struct("answered", "created", "review", "score"))
    return in_time.groupBy("order").agg(best.alias("best")).select("order", F.col("best.score").alias("score"))


def order_components(raw_orders: DataFrame, raw_items: DataFrame, raw_reviews: DataFrame, raw_customers: DataFrame, plan: BatchPlan) -> DataFrame:
    """A row per order with its month and state, and what it adds to each sales and delivery figure."""
    texts = ["order_status", "customer_id", "order_purchase_timestamp", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date"]
    newest = _newest(raw_orders.where("batch_id IS NOT NULL"), {"order": F.trim("order_id")}, texts, plan)
    cutoff = F.lit(plan.cutoff_timestamp).cast("timestamp_ntz")
    arrived, left = (lenient_timestamp(F.col(f"order_delivered_{who}_date")) for who in ("customer", "carrier"))
    orders = newest.select(
        "order",
        F.trim("customer_id").alias("customer"),
        F.trim("order_status").alias("status"),
        lenient_date(F.col("order_purchase_timestamp")).alias("bought"),
        F.when(arrived <= cutoff, arrived).alias("arrived"),
        (arrived > cutoff).alias("too_late"),
        F.when(left <= cutoff, left).alias("left"),
        lenient_date(F.col("order_estimated_delivery_date")).alias("expected"),
    )
    price = F.col("price").try_cast("decimal(10,2)")
    items = raw_items.where(price > 0).groupBy(F.trim("order_id").alias("order")).agg(F.count("*").alias("n_items"), F.sum(price).alias("worth"))
    states = _newest(raw_customers, {"customer": F.trim("customer_id")}, ["customer_state"], plan)
    rows = orders.join(items, "order", "left").join(_scores(raw_reviews, orders, plan), "order", "left").join(states, "customer", "left")
    canceled = F.col("status").isin("canceled", "unavailable")
    valid = ~canceled & (F.col("n_items") > 0)
    delivered = (F.col("status") == "delivered") & F.col("arrived").isNotNull() & ~F.coalesce(F.col("arrived") < F.col("left"), F.lit(False))
    # what the customer got after the cutoff was on its way then, if the carrier had it
    on_the_way = ((F.col("status") == "shipped") & F.col("arrived").isNull()) | ((F.col("status") == "delivered") & F.col("too_late") & F.col("left").isNotNull())
    late, scored = F.col("arrived").cast("date") > F.col("expected"), F.col("score").isNotNull()
    in_time, overtime = delivered & ~late, delivered & late
    days = calendar_days(F.col("arrived"), F.col("bought"))
    shipping = calendar_days(F.col("arrived"), F.col("left"))
    value = lambda condition, x: F.when(condition, x).otherwise(0).cast("long")
    return rows.select(
        F.col("bought").alias("day"),
        month_label(F.col("bought")).alias("year_month"),
        F.coalesce(F.trim("customer_state"), F.lit("")).alias("customer_state"),
        F.lit(1).cast("long").alias("n_orders_total"),
        _one(canceled).alias("n_canceled_orders"),
        _one(valid).alias("n_valid_orders"),
        F.when(valid, F.col("worth")).otherwise(0).cast(MONEY).alias("sum_revenue"),
        _one(delivered).alias("n_delivered"),
        value(delivered, F.coalesce(days, F.lit(0))).alias("sum_delivery_days"),
        _one(overtime).alias("n_late"),
        _one(in_time).alias("n_on_time"),
        _one(delivered & shipping.isNotNull()).alias("n_shipping_measured"),
        value(delivered, F.coalesce(shipping, F.lit(0))).alias("sum_shipping_days"),
        _one(scored).alias("n_scored"),
        value(scored, F.col("score")).alias("sum_score"),
        _one(scored & in_time).alias("n_scored_on_time"),
        value(scored & in_time, F.col("score")).alias("sum_score_on_time"),
        _one(scored & overtime).alias("n_scored_late"),
        value(scored & overtime, F.col("score")).alias("sum_score_late"),
        _one(on_the_way & (F.col("expected") <= F.lit(plan.cutoff_date).cast("date"))).alias("n_overdue_undelivered"),
    ).where(F.col("day") <= F.lit(plan.cutoff_date).cast("date"))


# --- leads and sessions --------------------------------------------------------------------


def lead_components(bronze_leads: DataFrame, plan: BatchPlan) -> DataFrame:
    """A row per lead with its month and origin, and what it adds to each figure."""
    contact = F.col("first_contact_date")
    placed = bronze_leads.where(F.col("is_parsed") & plan.position_of(F.col("batch_id")).isNotNull()).where(
        (F.trim("mql_id") != "") & (F.trim("landing_page_id") != "") & (F.length(F.trim(contact)) == 10) & lenient_date(contact).isNotNull()
    )
    newest = _newest(placed, {"lead": F.trim("mql_id")}, ["first_contact_date", "origin", "deal"], plan)
    day = lenient_date(contact)
    deal = F.col("deal").isNotNull()
    days = calendar_days(lenient_timestamp(F.col("deal.won_date")), day)
    kept = F.coalesce(days >= 0, F.lit(True))
    closed = deal & kept & days.isNotNull()
    origin = F.lower(F.trim("origin"))
    return newest.select(
        day.alias("day"),
        F.when(day <= F.lit(plan.cutoff_date).cast("date"), month_label(day)).alias("year_month"),
        F.when(origin != "", origin).otherwise("unknown").alias("origin"),
        F.lit(1).cast("long").alias("n_leads"),
        _one(deal).alias("n_leads_with_deal"),
        _one(closed).alias("n_close_time_valid_deals"),
        F.when(closed, days).otherwise(0).cast("long").alias("sum_days_to_close"),
        _one(kept).alias("n_leads_not_excluded"),
        _one(closed & (days <= 30)).alias("n_won_30d"),
    )


def session_components(bronze_events: DataFrame) -> DataFrame:
    """A row per session with its day and month, and what it adds to each figure."""
    filled = [F.trim(c) != "" for c in ("session_id", "user_id", "event_type")]
    events = bronze_events.where(F.col("is_parsed") & F.col("event_ts").isNotNull() & filled[0] & filled[1] & filled[2])
    # a line sent again has the digest of the first: it counts as one moment of its session
    lines = events.groupBy(F.trim("session_id").alias("session"), F.sha2("raw_line", 256).alias("line")).agg(
        F.min("event_ts").alias("at"), F.min(F.trim("event_type")).alias("kind")
    )
    kinds = [F.max(_one(F.col("kind") == k)).alias(k) for k in KINDS]
    sessions = lines.groupBy("session").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n"), *kinds)
    home, view, cart, bought = (F.col(k) for k in KINDS)
    several = _one(F.col("n") >= 2)
    return sessions.select(
        F.col("first").cast("date").alias("session_date"),
        month_label(F.col("first")).alias("year_month"),
        F.lit(1).cast("long").alias("n_sessions"),
        home.alias("n_reach_home"),
        (home * view).alias("n_reach_view"),
        (home * view * cart).alias("n_reach_cart"),
        (home * view * cart * bought).alias("n_reach_purchase"),
        bought.alias("n_purchase_sessions"),
        cart.alias("n_cart_sessions"),
        (cart * (1 - bought)).alias("n_cart_abandoned_sessions"),
        several.alias("n_sessions_ge2"),
        (several * elapsed_seconds(F.col("last"), F.col("first"))).alias("sum_duration_seconds"),
    )


# --- slices --------------------------------------------------------------------------------


def slice_sums(components: DataFrame, *slices: Sequence[str]) -> list[DataFrame]:
    """All components summed by each of the slices, with their first day, in one grouped pass over the rows.

    The sums, a row for each value of a slice, are written: a filter on one slice would else reach below the
    aggregate, and each reader would go through all rows again.
    """
    names = sorted({c for one in slices for c in one})
    labels = {*names, "day"}
    types = {f.name: f.dataType for f in components.schema}
    sums = [F.sum(c).cast(types[c]).alias(c) for c in components.columns if c not in labels]
    sums += [F.min("day").alias(FIRST)] if "day" in types and "day" not in names else []
    sums_of = components.groupingSets([list(one) for one in slices], *names).agg(F.grouping_id(*names).alias("__set"), *sums)
    grouped = written_table(sums_of, "slice_sums")
    # a column that a set leaves out has its bit, the first column the highest
    bits = [sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in one) for one in slices]
    return [grouped.where(F.col("__set") == bit).drop("__set", *[c for c in names if c not in one]) for bit, one in zip(bits, slices)]


def _with_rates(sums: DataFrame, rates: Mapping[str, tuple[str, str]]) -> DataFrame:
    return sums.withColumns({name: ratio(F.col(a), F.col(b)) for name, (a, b) in rates.items()})


def _every_month(figures: DataFrame, months: DataFrame) -> DataFrame:
    labels = ("year_month",)
    return months.join(figures, "year_month", "left").fillna(0, subset=[c for c in figures.columns if c not in labels])


def _with_gap(figures: DataFrame) -> DataFrame:
    gap = ratio(F.col("sum_score_on_time"), F.col("n_scored_on_time")) - ratio(F.col("sum_score_late"), F.col("n_scored_late"))
    return figures.withColumn("score_gap", gap)


def _with_growth(figures: DataFrame) -> DataFrame:
    """Growth by a join with the month after, of one row for each month."""
    after = F.date_format(F.add_months(F.to_date(F.concat("year_month", F.lit("-01"))), 1), "yyyy-MM")
    before = figures.select(after.alias("year_month"), F.col("n_valid_orders").alias("__before"))
    grown = F.when(F.col("__before") >= SMALL_MONTH_ORDERS, ratio(F.col("n_valid_orders") - F.col("__before"), F.col("__before")))
    return figures.join(before, "year_month", "left").withColumn("order_growth", grown).drop("__before")


def kpi_tables(orders: DataFrame, leads: DataFrame, sessions: DataFrame, plan: BatchPlan) -> dict[str, DataFrame]:
    """All KPI tables, without the columns that are no metrics, from the three kinds of components."""
    by_month, by_state = slice_sums(orders, ["year_month"], ["customer_state", "year_month"])
    lead_month, lead_origin = slice_sums(leads, ["year_month"], ["origin"])
    day, month = slice_sums(sessions, ["session_date"], ["year_month"])
    firsts = [rows.select(F.col(c).alias("day")) for rows, c in ((by_month, FIRST), (lead_month, FIRST), (day, "session_date"))]
    first = reduce(DataFrame.unionByName, firsts).agg(F.min("day").alias("day"))
    by_month, by_state, lead_month, lead_origin = (rows.drop(FIRST) for rows in (by_month, by_state, lead_month, lead_origin))
    end = F.lit(plan.cutoff_date).cast("date")
    steps = F.sequence(F.trunc("day", "month"), end, F.expr("interval 1 month"))
    months = first.where(F.col("day") <= end).select(F.explode(steps).alias("month")).select(month_label(F.col("month")).alias("year_month"))
    every = _every_month(by_month, months)
    delivery = lambda rows: _with_gap(_with_rates(rows, DELIVERY_RATES))
    return {
        "kpi_sales_month": _with_growth(_with_rates(every.select("year_month", *SALES_SUMS), SALES_RATES)),
        "kpi_sales_state_month": _with_rates(by_state.select("customer_state", "year_month", *SALES_SUMS), SALES_RATES),
        "kpi_delivery_month": delivery(every.select("year_month", "n_valid_orders", *DELIVERY_SUMS)),
        "kpi_delivery_state_month": delivery(by_state.select("customer_state", "year_month", *DELIVERY_SUMS)),
        "kpi_lead_month": _with_rates(lead_month.where("year_month IS NOT NULL"), LEAD_RATES),
        "kpi_lead_origin": _with_rates(lead_origin, LEAD_RATES),
        "kpi_funnel_day": _with_rates(day, FUNNEL_RATES),
        "kpi_funnel_month": _with_rates(month, FUNNEL_RATES),
    }


def metrics(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """One long frame for each KPI table."""
    return [to_metrics(rows, name, GOLD_KEYS[name]) for name, rows in tables.items()]
