"""Counts of the known anomalies of the published data (``seeds.ANOMALIES``), each by its description there."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.flags import has_flag
from tidemark.functions.text import tidy_place_name
from tidemark.operators import checks
from tidemark.operators.batches import BatchPlan
from tidemark.operators.latest import parted_by_repeat
from tidemark.operators.skew import lookup_join
from tidemark.plans import gold, seeds, silver

KEYS = ("an_id", "sub_code", "table_name")
#: Totals of an order and its payments may differ by one cent.
CENT = 0.01
POINT = (
    "geolocation_zip_code_prefix",
    "geolocation_lat",
    "geolocation_lng",
    "geolocation_city",
    "geolocation_state",
)
_FLAG_IDS = {flag for flag, *_ in seeds.FLAGS}


def _key(an_id: str, sub_code: str | None = None) -> tuple[str, str | None, str]:
    """The seed's row of an anomaly."""
    return next(row[:3] for row in seeds.ANOMALIES if row[:2] == (an_id, sub_code))


def _counted(rows: DataFrame, counts: Mapping[tuple[str, str | None, str], Column]) -> DataFrame:
    """``KEYS``, actual_count: one pass over the rows, zero where nothing is found."""
    found = [
        F.struct(
            *[F.lit(part).cast("string").alias(name) for part, name in zip(key, KEYS)],
            F.coalesce(count, F.lit(0)).cast("bigint").alias("actual_count"),
        )
        for key, count in counts.items()
    ]
    return rows.agg(F.array(*found).alias("found")).select(F.inline("found"))


def _flags_of(table: str) -> dict[tuple[str, str | None, str], Column]:
    """Rows that carry a flag; the sessions of E1 are counted apart."""
    return {
        (an_id, code, name): F.count_if(has_flag(F.col("dq_flag"), code))
        for an_id, code, name, _ in seeds.ANOMALIES
        if name == table and code in _FLAG_IDS and code != "E1"
    }


def _rows(an_id: str, sub_code: str | None = None) -> dict[tuple[str, str | None, str], Column]:
    return {_key(an_id, sub_code): F.count(F.lit(1))}


def unlike_payments(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with items and payments whose totals are more than a cent apart; unknown amounts add nothing."""

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("decimal(30,2)")

    due = items.groupBy("order_id").agg((total("price") + total("freight_value")).alias("due"))
    paid = payments.groupBy("order_id").agg(total("payment_value").alias("paid"))
    both = lookup_join(due, paid, ["order_id"], "inner")
    return both.filter(F.abs(F.col("due") - F.col("paid")) > F.lit(CENT).cast("decimal(3,2)"))


def shared_reviews(reviews: DataFrame) -> DataFrame:
    """Review ids that stand for several orders."""
    used = reviews.filter(F.col("review_id").isNotNull() & F.col("order_id").isNotNull())
    _, rest = parted_by_repeat(used.select("review_id", "order_id"), ["review_id"])
    per_id = rest.distinct().groupBy("review_id").count()
    return per_id.filter(F.col("count") > 1)


def anomaly_counts(tables: Mapping[str, DataFrame], plan: BatchPlan) -> DataFrame:
    """an_id, sub_code, table_name, actual_count of every known anomaly.

    ``tables`` holds silver tables and ``fact_order`` by their names, and as ``bronze_...`` the
    orders, reviews, sellers and points as they came. What the source says of an order or review
    is its latest snapshot before silver blanks what is after the cutoff.
    """
    orders, items, reviews = tables["orders"], tables["order_items"], tables["order_reviews"]
    products, events = tables["products"], tables["clickstream_events"]

    happened = (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    )
    late = reduce(or_, [plan.after_cutoff(F.col(c)) for c in happened])
    exported, _ = silver.exported_orders(tables["bronze_orders"], plan)
    exported_reviews, _ = silver.exported_reviews(tables["bronze_order_reviews"], plan)
    carrier, customer = F.col(happened[2]), F.col(happened[3])
    overdue = gold.is_overdue_undelivered(plan)
    answered_late = F.count_if(plan.after_cutoff(F.col("review_answer_timestamp")))

    no_english = F.col("product_category_name").isNotNull() & F.col("product_category_en").isNull()
    odd = reduce(or_, [has_flag(F.col("dq_flag"), code) for code in ("P1", "P2", "P3")])
    newest_sellers = silver.newest_sellers(tables["bronze_sellers"], plan)
    city = F.col("seller_city")
    copies = tables["bronze_geolocation"].groupBy(*POINT).agg(F.count(F.lit(1)).alias("n"))
    late_sessions = events.filter(has_flag(F.col("dq_flag"), "E1")).select("session_id")

    return checks.union_all(
        [
            _counted(
                orders,
                _flags_of("orders")
                | {_key("AN-14", "silver_post_cutoff_expected"): F.count_if(late)},
            ),
            _counted(
                lookup_join(orders, items.select("order_id").distinct(), ["order_id"], "left_anti"),
                _rows("AN-04"),
            ),
            _counted(items, _flags_of("order_items")),
            _counted(
                tables["order_payments"], {_key("AN-06", "P1_P2_P3"): F.count_if(odd)}
            ),
            _counted(unlike_payments(items, tables["order_payments"]), _rows("AN-07")),
            _counted(shared_reviews(reviews), _rows("AN-08")),
            _counted(
                reviews,
                _flags_of("order_reviews")
                | {_key("AN-14", "reviews_silver_post_cutoff_expected"): answered_late},
            ),
            _counted(
                products,
                _flags_of("products")
                | {_key("AN-10", "missing_translation_products"): F.count_if(no_english)},
            ),
            _counted(
                products.filter(no_english).select("product_category_name").distinct(),
                _rows("AN-10", "missing_translation_categories"),
            ),
            _counted(
                newest_sellers, {_key("AN-11"): F.count_if(~city.eqNullSafe(tidy_place_name(city)))}
            ),
            _counted(copies, {_key("AN-12"): F.sum(F.col("n") - 1)}),
            _counted(tables["leads"], _flags_of("leads")),
            _counted(
                exported,
                {
                    _key("AN-14", "orders_source_excluded"): F.count_if(
                        plan.after_cutoff(customer)
                    ),
                    _key("AN-16", "shipped_overdue_undelivered"): F.count_if(overdue),
                    _key("AN-16", "post_cutoff_delivered_carrier"): F.count_if(
                        plan.after_cutoff(customer) & ~plan.after_cutoff(carrier)
                    ),
                },
            ),
            _counted(
                exported_reviews, {_key("AN-14", "reviews_source_excluded"): answered_late}
            ),
            _counted(events, _flags_of("clickstream_events")),
            _counted(late_sessions.distinct(), _rows("AN-15", "E1")),
            _counted(
                tables["fact_order"],
                {
                    _key("AN-16", "total_overdue_undelivered"): F.count_if(
                        F.col("is_overdue_undelivered")
                    )
                },
            ),
        ]
    )


def beside_expected(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Every published anomaly with its count; anomalies without a sub-code meet by their id."""

    def marked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("sub_code", F.coalesce("sub_code", F.lit("")))

    compared = checks.expected_counts(marked(actual), marked(expected), KEYS)
    return compared.withColumn("sub_code", F.nullif("sub_code", F.lit("")))
