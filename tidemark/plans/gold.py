"""Gold tables: dimensions, facts and KPI tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_days, elapsed_seconds, month_label
from tidemark.functions.flags import has_flag
from tidemark.functions.measures import (
    SMALL_MONTH_ORDERS,
    count_true,
    is_small_gap_group,
    is_small_month,
    is_small_sample,
    ratio,
    sum_where,
)
from tidemark.operators.batches import BatchPlan
from tidemark.operators.latest import first_per_key
from tidemark.operators.skew import lookup_join
from tidemark.plans.contract import conform

# Order states and funnel steps.
CANCELED_STATES = ("canceled", "unavailable")
DELIVERED, SHIPPED = "delivered", "shipped"
FUNNEL_STEPS = ("home", "product_view", "add_to_cart", "purchase")
QUICK_CLOSE_DAYS = 30


# --- dimensions ----------------------------------------------------------------------------


def dim_date(
    silver_orders: DataFrame, silver_leads: DataFrame, silver_events: DataFrame, plan: BatchPlan
) -> DataFrame:
    """Every day from the first one in the data up to the cutoff."""
    firsts = (
        silver_orders.agg(F.min(F.col("order_purchase_timestamp").cast("date")).alias("d"))
        .unionByName(silver_leads.agg(F.min("first_contact_date").alias("d")))
        .unionByName(silver_events.agg(F.min("event_date").alias("d")))
    )
    return calendar_from(firsts.agg(F.min("d").alias("first_day")), plan.cutoff_date)


def calendar_from(first_day: DataFrame, last_day: str) -> DataFrame:
    """Days from the single value of ``first_day`` to ``last_day``; none if it starts later."""
    end = F.lit(last_day).cast("date")
    days = first_day.filter(F.col("first_day") <= end).select(
        F.explode(F.sequence("first_day", end)).alias("date")
    )
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        month_label(F.col("date")).alias("year_month"),
    )


def dim_customer(silver_customers: DataFrame) -> DataFrame:
    return conform(silver_customers, "dim_customer")


def dim_product(silver_products: DataFrame) -> DataFrame:
    return conform(silver_products, "dim_product")


def dim_seller(silver_sellers: DataFrame) -> DataFrame:
    return conform(silver_sellers, "dim_seller")


# --- facts ---------------------------------------------------------------------------------


def order_items_rollup(silver_items: DataFrame) -> DataFrame:
    """Items and their total per order; only items with a price count."""
    return (
        silver_items.filter(F.col("price") > 0)
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.sum("price").cast("decimal(20,2)").alias("order_revenue"),
        )
    )


def chosen_reviews(silver_reviews: DataFrame) -> DataFrame:
    """The newest answered review per order, not counting those created before the purchase."""
    usable = silver_reviews.filter(
        F.col("review_score").isNotNull()
        & F.col("review_answer_timestamp").isNotNull()
        & ~has_flag(F.col("dq_flag"), "R2")
    )
    newest_first = [
        F.desc("review_answer_timestamp"),
        F.desc(F.col("review_creation_date").cast("date")),
        F.desc("review_id"),
    ]
    return first_per_key(usable, ["order_id"], newest_first).select("order_id", "review_score")


def is_overdue_undelivered(plan: BatchPlan) -> Column:
    """Shipped, not arrived, and expected by the cutoff's day."""
    expected = F.col("order_estimated_delivery_date").cast("date")
    return (
        (F.col("order_status") == SHIPPED)
        & F.col("order_delivered_customer_date").isNull()
        & (expected <= F.lit(plan.cutoff_date).cast("date"))
    )


def fact_order(
    silver_orders: DataFrame, silver_items: DataFrame, silver_reviews: DataFrame, plan: BatchPlan
) -> DataFrame:
    """One row per order; orders without an id match nothing and may be many."""
    status, flags = F.col("order_status"), F.col("dq_flag")
    purchase = F.col("order_purchase_timestamp")
    carrier = F.col("order_delivered_carrier_date")
    customer = F.col("order_delivered_customer_date")
    estimate = F.col("order_estimated_delivery_date")
    n_items = F.coalesce(F.col("n_items"), F.lit(0).cast("bigint"))
    canceled = F.coalesce(status.isin(*CANCELED_STATES), F.lit(False))
    delivered = (
        F.coalesce(status == DELIVERED, F.lit(False))
        & customer.isNotNull()
        & ~has_flag(flags, "D1")
        & ~has_flag(flags, "D2")
        & ~has_flag(flags, "D4")
    )
    with_items = lookup_join(silver_orders, order_items_rollup(silver_items), ["order_id"], "left")
    joined = lookup_join(with_items, chosen_reviews(silver_reviews), ["order_id"], "left")
    return conform(
        joined.select(
            "order_id",
            "customer_id",
            "order_status",
            purchase.cast("date").alias("purchase_date"),
            n_items.alias("n_items"),
            F.coalesce(F.col("order_revenue"), F.lit(0).cast("decimal(20,2)")).alias(
                "order_revenue"
            ),
            (~canceled & (n_items > 0)).alias("is_valid_order"),
            canceled.alias("is_canceled"),
            delivered.alias("is_delivered_order"),
            F.when(delivered, calendar_days(customer, purchase)).alias("delivery_days"),
            F.when(delivered, calendar_days(customer, carrier)).alias("shipping_days"),
            F.when(delivered, customer.cast("date") > estimate.cast("date")).alias("is_late"),
            F.coalesce(is_overdue_undelivered(plan), F.lit(False)).alias("is_overdue_undelivered"),
            "review_score",
            "batch_id",
        ),
        "fact_order",
    )


def fact_order_item(
    silver_items: DataFrame, silver_orders: DataFrame
) -> DataFrame:
    dates = silver_orders.select(
        "order_id", F.col("order_purchase_timestamp").cast("date").alias("purchase_date")
    )
    return conform(
        lookup_join(silver_items, dates, ["order_id"], "left"), "fact_order_item"
    )


def fact_lead(silver_leads: DataFrame) -> DataFrame:
    days = calendar_days(F.col("won_date"), F.col("first_contact_date"))
    return conform(
        silver_leads.withColumns(
            {
                "days_to_close": F.when(F.col("has_deal"), days),
                "is_close_time_excluded": has_flag(F.col("dq_flag"), "C1"),
            }
        ),
        "fact_lead",
    )


def fact_session(silver_events: DataFrame) -> DataFrame:
    """One row per session; its order is the one of the earliest purchase."""
    is_purchase = F.col("event_type") == "purchase"
    first_order = F.min(
        F.when(
            is_purchase & F.col("order_id").isNotNull(), F.struct("event_ts", "order_id")
        )
    )
    sessions = silver_events.groupBy("session_id").agg(
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
        F.count(F.lit(1)).alias("n_events"),
        *[
            F.bool_or(F.col("event_type") == step).alias(f"has_{step}") for step in FUNNEL_STEPS
        ],
        first_order.alias("first_order"),
        F.sum(F.when(is_purchase, F.col("amount"))).alias("purchase_amount"),
    )
    return conform(
        sessions.withColumns(
            {
                "session_date": F.col("first_event_ts").cast("date"),
                "duration_seconds": elapsed_seconds(
                    F.col("last_event_ts"), F.col("first_event_ts")
                ),
                "order_id": F.col("first_order.order_id"),
            }
        ),
        "fact_session",
    )


# --- KPI tables ----------------------------------------------------------------------------


def _months(calendar: DataFrame) -> DataFrame:
    return calendar.select("year_month").distinct()


def _dense_by_month(calendar: DataFrame, figures: DataFrame, components: Sequence[str]) -> DataFrame:
    """One row per calendar month, zeros where there was nothing. Both sides are month rows."""
    return _months(calendar).join(figures, "year_month", "left").fillna(0, subset=list(components))


def _by_month(
    facts: DataFrame, day: str, calendar: DataFrame, sums: Mapping[str, Column], *slices: str
) -> DataFrame:
    """Sums per calendar month (and slice); facts outside the calendar drop out.

    The facts are summed per day before they meet the calendar, combined ahead of their
    shuffle, so only a row per day and slice is joined and added up to months.
    """
    per_day = facts.groupBy(day, *slices).agg(*[total.alias(name) for name, total in sums.items()])
    days = calendar.select(F.col("date").alias(day), "year_month")
    types = {field.name: field.dataType for field in per_day.schema}
    return (
        per_day.join(days, day, "inner")
        .groupBy(*slices, "year_month")
        .agg(*[F.sum(name).cast(types[name]).alias(name) for name in sums])
    )


def with_customer_state(
    facts: DataFrame, customers: DataFrame
) -> DataFrame:
    """Orders with their customer's state, empty text where it is unknown."""
    states = customers.select("customer_id", "customer_state")
    joined = lookup_join(facts, states, ["customer_id"], "left")
    return joined.withColumn(
        "customer_state", F.coalesce(F.trim("customer_state"), F.lit(""))
    )


def _sales_sums() -> dict[str, Column]:
    valid = F.col("is_valid_order")
    return {
        "n_orders_total": F.count(F.lit(1)),
        "n_canceled_orders": count_true(F.col("is_canceled")),
        "n_valid_orders": count_true(valid),
        "sum_revenue": F.coalesce(
            F.sum(F.when(valid, F.col("order_revenue"))), F.lit(0).cast("decimal(30,2)")
        ),
    }


def _sales_rates(figures: DataFrame) -> DataFrame:
    return figures.withColumns(
        {
            "avg_order_value": ratio(F.col("sum_revenue"), F.col("n_valid_orders")),
            "cancel_rate": ratio(F.col("n_canceled_orders"), F.col("n_orders_total")),
            "n_obs": F.col("n_valid_orders"),
        }
    )


def kpi_sales_month(fact_orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every calendar month, with growth against the month before."""
    sums = _sales_sums()
    figures = _by_month(fact_orders, "purchase_date", calendar, sums)
    dense = _sales_rates(_dense_by_month(calendar, figures, list(sums)))
    # one row per calendar month, so a single ordered partition is small
    previous = F.lag("n_valid_orders").over(Window.orderBy("year_month"))
    return conform(
        dense.withColumn("__previous", previous).withColumns(
            {
                "order_growth": F.when(
                    F.col("__previous") >= SMALL_MONTH_ORDERS,
                    ratio(F.col("n_valid_orders") - F.col("__previous"), F.col("__previous")),
                ),
                "is_small_sample": is_small_month(F.col("n_valid_orders")),
            }
        ),
        "kpi_sales_month",
    )


def kpi_sales_state_month(
    fact_orders: DataFrame,
    customers: DataFrame,
    calendar: DataFrame,
) -> DataFrame:
    """Only the states and months that have orders."""
    by_state = with_customer_state(fact_orders, customers)
    figures = _by_month(by_state, "purchase_date", calendar, _sales_sums(), "customer_state")
    return conform(
        _sales_rates(figures).withColumn(
            "is_small_sample", is_small_sample(F.col("n_valid_orders"))
        ),
        "kpi_sales_state_month",
    )


def _delivery_sums() -> dict[str, Column]:
    delivered, late = F.col("is_delivered_order"), F.col("is_late")
    score = F.col("review_score")
    scored = score.isNotNull()
    shipping = F.col("shipping_days")
    return {
        "n_valid_orders": count_true(F.col("is_valid_order")),
        "n_delivered": count_true(delivered),
        "sum_delivery_days": sum_where(delivered, F.col("delivery_days")),
        "n_late": count_true(delivered & late),
        "n_on_time": count_true(delivered & ~late),
        "n_shipping_measured": count_true(delivered & shipping.isNotNull()),
        "sum_shipping_days": sum_where(delivered, shipping),
        "n_scored": count_true(scored),
        "sum_score": sum_where(scored, score),
        "n_scored_on_time": count_true(scored & delivered & ~late),
        "sum_score_on_time": sum_where(delivered & ~late, score),
        "n_scored_late": count_true(scored & delivered & late),
        "sum_score_late": sum_where(delivered & late, score),
        "n_overdue_undelivered": count_true(F.col("is_overdue_undelivered")),
    }


def _delivery_rates(figures: DataFrame) -> DataFrame:
    on_time = ratio(F.col("sum_score_on_time"), F.col("n_scored_on_time"))
    late = ratio(F.col("sum_score_late"), F.col("n_scored_late"))
    return figures.withColumns(
        {
            "avg_delivery_days": ratio(F.col("sum_delivery_days"), F.col("n_delivered")),
            "late_rate": ratio(F.col("n_late"), F.col("n_delivered")),
            "avg_score": ratio(F.col("sum_score"), F.col("n_scored")),
            "avg_shipping_days": ratio(F.col("sum_shipping_days"), F.col("n_shipping_measured")),
            "score_gap": on_time - late,
            "n_obs": F.col("n_delivered"),
            "is_small_gap_group": is_small_gap_group(
                F.col("n_scored_on_time"), F.col("n_scored_late")
            ),
        }
    )


def kpi_delivery_month(fact_orders: DataFrame, calendar: DataFrame) -> DataFrame:
    sums = _delivery_sums()
    figures = _by_month(fact_orders, "purchase_date", calendar, sums)
    dense = _delivery_rates(_dense_by_month(calendar, figures, list(sums)))
    small = is_small_sample(F.col("n_delivered"), orders=F.col("n_valid_orders"))
    return conform(dense.withColumn("is_small_sample", small), "kpi_delivery_month")


def kpi_delivery_state_month(
    fact_orders: DataFrame,
    customers: DataFrame,
    calendar: DataFrame,
) -> DataFrame:
    by_state = with_customer_state(fact_orders, customers)
    figures = _by_month(by_state, "purchase_date", calendar, _delivery_sums(), "customer_state")
    return conform(
        _delivery_rates(figures).withColumn(
            "is_small_sample", is_small_sample(F.col("n_delivered"))
        ),
        "kpi_delivery_state_month",
    )


def _lead_sums() -> dict[str, Column]:
    days, kept = F.col("days_to_close"), ~F.col("is_close_time_excluded")
    measured = F.col("has_deal") & kept & days.isNotNull()
    return {
        "n_leads": F.count(F.lit(1)),
        "n_leads_with_deal": count_true(F.col("has_deal")),
        "n_close_time_valid_deals": count_true(measured),
        "sum_days_to_close": sum_where(measured, days),
        "n_leads_not_excluded": count_true(kept),
        "n_won_30d": count_true(measured & (days <= QUICK_CLOSE_DAYS)),
    }


def _lead_rates(figures: DataFrame) -> DataFrame:
    return figures.withColumns(
        {
            "lead_to_deal_rate": ratio(F.col("n_leads_with_deal"), F.col("n_leads")),
            "avg_days_to_close": ratio(
                F.col("sum_days_to_close"), F.col("n_close_time_valid_deals")
            ),
            "won_30d_rate": ratio(F.col("n_won_30d"), F.col("n_leads_not_excluded")),
            "n_obs": F.col("n_leads_with_deal"),
            "is_small_sample": is_small_sample(F.col("n_leads_with_deal")),
        }
    )


def kpi_lead_month(fact_leads: DataFrame, calendar: DataFrame) -> DataFrame:
    figures = _by_month(fact_leads, "first_contact_date", calendar, _lead_sums())
    return conform(_lead_rates(figures), "kpi_lead_month")


def kpi_lead_origin(fact_leads: DataFrame) -> DataFrame:
    sums = [total.alias(name) for name, total in _lead_sums().items()]
    return conform(_lead_rates(fact_leads.groupBy("origin").agg(*sums)), "kpi_lead_origin")


def _funnel_figures(grouped) -> DataFrame:
    """Reaching a step needs all steps before it to be present, in any order."""
    home, view, cart, bought = (F.col(f"has_{step}") for step in FUNNEL_STEPS)
    several = F.col("n_events") >= 2
    figures = grouped.agg(
        F.count(F.lit(1)).alias("n_sessions"),
        count_true(home).alias("n_reach_home"),
        count_true(home & view).alias("n_reach_view"),
        count_true(home & view & cart).alias("n_reach_cart"),
        count_true(home & view & cart & bought).alias("n_reach_purchase"),
        count_true(bought).alias("n_purchase_sessions"),
        count_true(cart).alias("n_cart_sessions"),
        count_true(cart & ~bought).alias("n_cart_abandoned_sessions"),
        count_true(several).alias("n_sessions_ge2"),
        sum_where(several, F.col("duration_seconds")).alias("sum_duration_seconds"),
    )
    return figures.withColumns(
        {
            "conversion_rate": ratio(F.col("n_purchase_sessions"), F.col("n_sessions")),
            "abandon_rate": ratio(F.col("n_cart_abandoned_sessions"), F.col("n_cart_sessions")),
            "avg_duration_seconds": ratio(F.col("sum_duration_seconds"), F.col("n_sessions_ge2")),
            "step_rate_home_view": ratio(F.col("n_reach_view"), F.col("n_reach_home")),
            "step_rate_view_cart": ratio(F.col("n_reach_cart"), F.col("n_reach_view")),
            "step_rate_cart_purchase": ratio(F.col("n_reach_purchase"), F.col("n_reach_cart")),
            "n_obs": F.col("n_sessions"),
            "is_small_sample": is_small_sample(F.col("n_sessions")),
        }
    )


def kpi_funnel_day(fact_sessions: DataFrame) -> DataFrame:
    return conform(_funnel_figures(fact_sessions.groupBy("session_date")), "kpi_funnel_day")


def kpi_funnel_month(fact_sessions: DataFrame) -> DataFrame:
    by_month = fact_sessions.withColumn("year_month", month_label(F.col("session_date")))
    return conform(_funnel_figures(by_month.groupBy("year_month")), "kpi_funnel_month")


def top_sellers(fact_items: DataFrame, k: int) -> DataFrame:
    """Sellers by revenue; equal revenue by seller id."""
    revenue = fact_items.groupBy("seller_id").agg(
        F.sum("price").cast("decimal(20,2)").alias("revenue")
    )
    return revenue.orderBy(F.desc("revenue"), F.asc("seller_id")).limit(k)
