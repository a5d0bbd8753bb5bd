"""Silver tables: clean, typed, deduplicated rows with quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import second_label
from tidemark.functions.casting import (
    boolean_from_number_words,
    cast_failed,
    integral_to_int,
    safe_cast,
)
from tidemark.functions.flags import FLAG_SEPARATOR, flag_list, is_reject, none_of, reject_reason
from tidemark.functions.text import (
    blank_to_null,
    category_or_unknown,
    is_blank,
    joined_key,
    lower_category_or_unknown,
    tidy_place_name,
)
from tidemark.operators.batches import FIRST_SEQ, BatchPlan, with_batch_seq
from tidemark.operators.latest import distinct_lines, latest_rows, newest_version, parted_by_repeat
from tidemark.operators.skew import join_on_keys, lookup_join
from tidemark.plans.contract import conform

# Fixed value: calendar days after purchase beyond which a shipping limit is implausible.
LONGEST_SHIPPING_LIMIT = 148
FAILED = "__failed"


# --- leads ---------------------------------------------------------------------------------


def _lead_faults() -> list[tuple[str, Column]]:
    contact = blank_to_null(F.col("first_contact_date"))
    return [
        ("MISSING_MQL_ID", is_blank(F.col("mql_id"))),
        ("MISSING_FIRST_CONTACT_DATE", contact.isNull()),
        (
            "INVALID_FIRST_CONTACT_DATE",
            contact.isNotNull() & safe_cast(contact, "DATE").isNull(),
        ),
        ("MISSING_LANDING_PAGE_ID", is_blank(F.col("landing_page_id"))),
    ]


def evaluate_leads(bronze: DataFrame) -> DataFrame:
    """Parsed bronze leads with ``reject_reason``; feeds both silver and its rejects."""
    parsed = bronze.filter(F.col("is_parsed"))
    return parsed.withColumn("reject_reason", reject_reason(_lead_faults()))


def leads_rejects(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(is_reject(F.col("reject_reason")))


def lead_versions(evaluated: DataFrame) -> DataFrame:
    """The valid rows of any batches, of which the latest per lead count."""
    return evaluated.filter(none_of(_lead_faults())).select(
        F.trim("mql_id").alias("mql_id"),
        safe_cast(F.col("first_contact_date"), "DATE").alias("first_contact_date"),
        F.trim("landing_page_id").alias("landing_page_id"),
        "origin",
        "deal",
        "source_file",
        "batch_id",
    )


def leads(evaluated: DataFrame, plan: BatchPlan) -> DataFrame:
    """One row per lead: the snapshot of its latest batch, the deal flattened."""
    versions = with_batch_seq(lead_versions(evaluated), plan)
    return typed_leads(latest_rows(versions, ["mql_id"], "batch_seq", FIRST_SEQ))


def typed_leads(latest: DataFrame) -> DataFrame:
    has_deal = F.col("deal").isNotNull()

    def deal(field: str) -> Column:
        return blank_to_null(F.col(f"deal.{field}"))

    def deal_category(field: str) -> Column:
        return F.when(has_deal, category_or_unknown(F.col(f"deal.{field}")))

    typed = latest.select(
        "mql_id",
        "first_contact_date",
        "landing_page_id",
        lower_category_or_unknown(F.col("origin")).alias("origin"),
        has_deal.alias("has_deal"),
        deal("seller_id").alias("seller_id"),
        deal("sdr_id").alias("sdr_id"),
        deal("sr_id").alias("sr_id"),
        safe_cast(deal("won_date"), "TIMESTAMP").alias("won_date"),
        deal_category("business_segment").alias("business_segment"),
        deal_category("lead_type").alias("lead_type"),
        deal_category("lead_behaviour_profile").alias("lead_behaviour_profile"),
        deal_category("average_stock").alias("average_stock"),
        deal_category("business_type").alias("business_type"),
        boolean_from_number_words(deal("has_company")).alias("has_company"),
        boolean_from_number_words(deal("has_gtin")).alias("has_gtin"),
        integral_to_int(deal("declared_product_catalog_size")).alias(
            "declared_product_catalog_size"
        ),
        safe_cast(deal("declared_monthly_revenue"), "DECIMAL(14, 2)").alias(
            "declared_monthly_revenue"
        ),
        "deal",
        "source_file",
        "batch_id",
    )
    checked = (
        "won_date",
        "has_company",
        "has_gtin",
        "declared_product_catalog_size",
        "declared_monthly_revenue",
    )
    flags = flag_list(
        [("C1", F.col("won_date").cast("date") < F.col("first_contact_date"))]
        + [(f"T1:{c}", cast_failed(F.col(f"deal.{c}"), F.col(c))) for c in checked]
    )
    return conform(typed.withColumn("dq_flag", flags), "leads")


# --- web events ----------------------------------------------------------------------------


def _event_faults() -> list[tuple[str, Column]]:
    return [
        ("unparsed_log_line", ~F.coalesce(F.col("is_parsed"), F.lit(False))),
        ("missing_session_id", is_blank(F.col("session_id"))),
        ("missing_event_ts", F.col("event_ts").isNull()),
        ("missing_event_type", is_blank(F.col("event_type"))),
        ("missing_user_id", is_blank(F.col("user_id"))),
    ]


def evaluate_events(bronze: DataFrame) -> DataFrame:
    """Bronze events with ``reject_reason``; unparsed lines are rejects here."""
    return bronze.withColumn("reject_reason", reject_reason(_event_faults()))


def events_rejects(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(is_reject(F.col("reject_reason")))


def mark_session_moments(
    events: DataFrame, instant: str = "event_ts"
) -> DataFrame:
    """Events with the first purchase of their session and the events at their instant.

    Both come from one narrow row per session and instant, so the full rows are
    shuffled once, and neither a busy session nor a busy instant is gathered in
    one task.
    """
    moments = events.groupBy("session_id", instant).agg(
        F.count(F.lit(1)).alias("n_at_instant"),
        F.min(F.when(F.col("event_type") == "purchase", F.col("event_ts"))).alias("__purchase"),
    )
    bought = moments.filter(F.col("__purchase").isNotNull()).groupBy("session_id")
    first = bought.agg(F.min("__purchase").alias("first_purchase_ts"))  # of the sessions that bought
    marked = join_on_keys(moments.drop("__purchase"), first, ["session_id"], "left")
    return lookup_join(events, marked, ["session_id", instant], "inner")


def event_versions(evaluated: DataFrame) -> DataFrame:
    """The valid lines of any batches with a digest of their text; of equal lines the earliest counts."""
    valid = evaluated.filter(none_of(_event_faults()))
    return valid.select(
        *_event_columns(), F.unhex(F.sha2("raw_line", 256)).alias("line"), "ingested_at"
    )


def distinct_events(evaluated: DataFrame, plan: BatchPlan) -> DataFrame:
    """One row per distinct log line; lines of batches that are not planned rank last and stay."""
    valid = evaluated.filter(none_of(_event_faults())).withColumn(
        "batch_seq", plan.position_of(F.col("batch_id"))
    )
    order = [F.asc_nulls_last("batch_seq"), F.asc("source_file"), F.asc("ingested_at")]
    once, rest = parted_by_repeat(valid, ["raw_line"])
    return once.unionByName(distinct_lines(rest, "raw_line", order)).select(*_event_columns())


def _event_columns() -> list[Column | str]:
    return [
        F.trim("user_id").alias("user_id"),
        F.trim("session_id").alias("session_id"),
        blank_to_null(F.col("order_id")).alias("order_id"),
        blank_to_null(F.col("product_id")).alias("product_id"),
        blank_to_null(F.col("outcome")).alias("outcome"),
        F.trim("event_type").alias("event_type"),
        safe_cast(F.col("amount"), "DECIMAL(10, 2)").alias("amount"),
        F.col("amount").isNotNull().alias("__had_amount"),
        "event_ts",
        "source_file",
        "batch_id",
    ]


def clickstream_events(unique: DataFrame) -> DataFrame:
    """Events with their key and flags, from ``distinct_events``.

    They are read three times, so the caller writes them first: shuffling all
    lines by their text is the dearest step.
    """
    marked = mark_session_moments(unique)
    flags = flag_list(
        [
            ("E1", F.col("event_ts") > F.col("first_purchase_ts")),
            ("E2", F.col("n_at_instant") > 1),
            ("T1:amount", F.col("__had_amount") & F.col("amount").isNull()),
        ]
    )
    return conform(
        marked.withColumns(
            {"event_id": event_key(), "event_date": F.col("event_ts").cast("date"), "dq_flag": flags}
        ),
        "clickstream_events",
    )


def event_key() -> Column:
    """Session, time to the second, type and product; not unique by construction."""
    return joined_key(
        F.col("session_id"),
        second_label(F.col("event_ts")),
        F.col("event_type"),
        F.coalesce(F.col("product_id"), F.lit("none")),
    )


# --- orders and what belongs to them -------------------------------------------------------


def _typed(raw: DataFrame, types: dict[str, str]) -> tuple[DataFrame, list[Column]]:
    """Columns cast in place, and the flags for text that did not fit."""
    cast = raw.withColumns(
        {f"__raw_{c}": blank_to_null(F.col(c)) for c in types}
        | {c: safe_cast(blank_to_null(F.col(c)), kind) for c, kind in types.items()}
    )
    failed = [(f"T1:{c}", cast_failed(F.col(f"__raw_{c}"), F.col(c))) for c in types]
    return cast, failed


def _with_failed(typed: DataFrame, failed: list[tuple[str, Column]]) -> DataFrame:
    """The flags of casts that failed as one column, so that a join carries no raw text beside the typed columns."""
    raw = [c for c in typed.columns if c.startswith("__raw_")]
    return typed.withColumn(FAILED, flag_list(failed)).drop(*raw)


def _and_failed(pairs: list[tuple[str, Column]]) -> Column:
    """The flags of ``pairs``, then those of ``_with_failed``."""
    return F.nullif(F.concat_ws(FLAG_SEPARATOR, flag_list(pairs), F.col(FAILED)), F.lit(""))


def _trimmed(raw: DataFrame, columns: list[str]) -> DataFrame:
    return raw.withColumns({c: blank_to_null(F.col(c)) for c in columns})


ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def order_versions(raw: DataFrame) -> DataFrame:
    """Exports of any batches, of which the latest per order count."""
    return _trimmed(raw, ["order_id", "customer_id", "order_status"])


def exported_orders(
    raw: DataFrame, plan: BatchPlan
) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """Latest snapshot per order as the source has it, and the flags of casts that failed."""
    versions = with_batch_seq(order_versions(raw), plan)
    return _typed_orders(latest_rows(versions, ["order_id"], "batch_seq", FIRST_SEQ))


def _typed_orders(latest: DataFrame) -> tuple[DataFrame, list[tuple[str, Column]]]:
    return _typed(latest, {c: "TIMESTAMP" for c in ORDER_TIMES})


def orders(raw: DataFrame, plan: BatchPlan) -> DataFrame:
    """Latest snapshot per order, as it stood at the cutoff."""
    return orders_at_cutoff(*exported_orders(raw, plan), plan)


def latest_orders(latest: DataFrame, plan: BatchPlan) -> DataFrame:
    """The same from rows that are the latest per order already."""
    return orders_at_cutoff(*_typed_orders(latest), plan)


def orders_at_cutoff(
    typed: DataFrame, failed: list[tuple[str, Column]], plan: BatchPlan
) -> DataFrame:
    """Times after the cutoff have not happened yet. An order delivered after it was
    therefore shipped, if the carrier had it by then, else approved or created.
    """
    happened = {
        c: F.when(~plan.after_cutoff(F.col(c)), F.col(c))
        for c in ORDER_TIMES[1:4]  # an estimate may lie in the future
    }
    purchase = F.col("order_purchase_timestamp")
    approved, carrier, customer = happened.values()
    not_yet = (F.col("order_status") == "delivered") & plan.after_cutoff(
        F.col("order_delivered_customer_date")
    )
    status = (
        F.when(not_yet & carrier.isNotNull(), "shipped")
        .when(not_yet & approved.isNotNull(), "approved")
        .when(not_yet, "created")
        .otherwise(F.col("order_status"))
    )
    delivered = status == "delivered"
    flags = flag_list(
        [
            ("D1", delivered & customer.isNull()),
            ("D2", (status != "delivered") & customer.isNotNull()),
            ("D3", carrier < purchase),
            ("D4", customer < carrier),
            ("D5", delivered & approved.isNull()),
            ("D6", carrier < approved),
            ("D7", delivered & carrier.isNull()),
        ]
        + failed
    )
    return conform(
        typed.withColumns(happened | {"order_status": status, "dq_flag": flags}), "orders"
    )


def _purchase_dates(silver_orders: DataFrame) -> DataFrame:
    return silver_orders.select(
        "order_id", F.col("order_purchase_timestamp").cast("date").alias("__purchase_date")
    )


def order_items(
    raw: DataFrame, silver_orders: DataFrame
) -> DataFrame:
    named = _trimmed(raw, ["order_id", "product_id", "seller_id"])
    typed, failed = _typed(
        named,
        {
            "order_item_id": "INT",
            "shipping_limit_date": "TIMESTAMP",
            "price": "DECIMAL(10, 2)",
            "freight_value": "DECIMAL(10, 2)",
        },
    )
    checked = _with_failed(typed, failed)
    dated = lookup_join(checked, _purchase_dates(silver_orders), ["order_id"], "left")
    days = F.datediff(F.col("shipping_limit_date").cast("date"), F.col("__purchase_date"))
    flags = _and_failed([("I1", days > LONGEST_SHIPPING_LIMIT)])
    return conform(dated.withColumn("dq_flag", flags), "order_items")


def order_payments(raw: DataFrame) -> DataFrame:
    named = _trimmed(raw, ["order_id", "payment_type"])
    typed, failed = _typed(
        named,
        {
            "payment_sequential": "INT",
            "payment_installments": "INT",
            "payment_value": "DECIMAL(10, 2)",
        },
    )
    flags = flag_list(
        [
            ("P1", F.col("payment_type") == "not_defined"),
            ("P2", F.col("payment_value") == 0),
            ("P3", F.col("payment_installments") == 0),
        ]
        + failed
    )
    return conform(typed.withColumn("dq_flag", flags), "order_payments")


def review_versions(raw: DataFrame) -> DataFrame:
    """Exports of any batches, of which the latest per review and order count."""
    return _trimmed(
        raw, ["review_id", "order_id", "review_comment_title", "review_comment_message"]
    )


def exported_reviews(
    raw: DataFrame, plan: BatchPlan
) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """Latest snapshot per review and order as the source has it, and the flags of casts that failed."""
    versions = with_batch_seq(review_versions(raw), plan)
    return _typed_reviews(latest_rows(versions, ["review_id", "order_id"], "batch_seq", FIRST_SEQ))


def _typed_reviews(latest: DataFrame) -> tuple[DataFrame, list[tuple[str, Column]]]:
    scored = latest.withColumns(
        {
            "__raw_score": blank_to_null(F.col("review_score")),
            "review_score": integral_to_int(blank_to_null(F.col("review_score"))),
        }
    )
    typed, failed = _typed(
        scored,
        {"review_creation_date": "TIMESTAMP", "review_answer_timestamp": "TIMESTAMP"},
    )
    not_a_score = ("T1:review_score", cast_failed(F.col("__raw_score"), F.col("review_score")))
    return typed, [not_a_score, *failed]


def order_reviews(
    raw: DataFrame,
    silver_orders: DataFrame,
    plan: BatchPlan,
) -> DataFrame:
    """Latest snapshot per review and order; answers after the cutoff are blank."""
    return reviews_at_cutoff(*exported_reviews(raw, plan), silver_orders, plan)


def latest_reviews(latest: DataFrame, silver_orders: DataFrame, plan: BatchPlan) -> DataFrame:
    """The same from rows that are the latest per review and order already."""
    return reviews_at_cutoff(*_typed_reviews(latest), silver_orders, plan)


def reviews_at_cutoff(
    typed: DataFrame, failed: list[tuple[str, Column]], silver_orders: DataFrame, plan: BatchPlan
) -> DataFrame:
    answered = F.col("review_answer_timestamp")
    checked = _with_failed(typed, failed)
    dated = lookup_join(checked, _purchase_dates(silver_orders), ["order_id"], "left")
    flags = _and_failed([("R2", F.col("review_creation_date").cast("date") < F.col("__purchase_date"))])
    flagged = dated.withColumn("dq_flag", flags).withColumn(
        "review_answer_timestamp", F.when(~plan.after_cutoff(answered), answered)
    )
    return conform(flagged, "order_reviews")


# --- reference data ------------------------------------------------------------------------


def _newest(rows: DataFrame, key: str, plan: BatchPlan) -> DataFrame:
    return newest_version(rows, [key], plan.position_of(F.col("batch_id")))


def product_category_translation(raw: DataFrame, plan: BatchPlan) -> DataFrame:
    """The newest export of each category."""
    named = _trimmed(raw, ["product_category_name", "product_category_name_english"])
    return conform(
        _newest(named, "product_category_name", plan), "product_category_translation"
    )


def products(raw: DataFrame, translation: DataFrame, plan: BatchPlan) -> DataFrame:
    """The newest export of each product with its English category; a weight of zero is no weight."""
    renamed = raw.withColumnsRenamed(
        {
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        }
    )
    named = _newest(
        _trimmed(renamed, ["product_id", "product_category_name"]), "product_id", plan
    )
    typed, failed = _typed(
        named,
        {
            "product_name_length": "INT",
            "product_description_length": "INT",
            "product_photos_qty": "INT",
            "product_weight_g": "INT",
            "product_length_cm": "INT",
            "product_height_cm": "INT",
            "product_width_cm": "INT",
        },
    )
    english = translation.select(
        "product_category_name",
        F.col("product_category_name_english").alias("product_category_en"),
    )
    translated = lookup_join(typed, english, ["product_category_name"], "left")
    no_dimension = (
        F.col("product_length_cm").isNull()
        | F.col("product_height_cm").isNull()
        | F.col("product_width_cm").isNull()
    )
    flags = flag_list(
        [
            ("PR1", F.col("product_category_name").isNull()),
            ("PR2", F.col("product_weight_g") == 0),
            ("PR3", no_dimension),
        ]
        + failed
    )
    flagged = translated.withColumn("dq_flag", flags).withColumn(
        "product_weight_g", F.nullif(F.col("product_weight_g"), F.lit(0))
    )
    return conform(flagged, "products")


def customers(raw: DataFrame, plan: BatchPlan) -> DataFrame:
    """The newest export of each customer."""
    named = _trimmed(
        raw, ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_state"]
    )
    newest = _newest(named, "customer_id", plan)
    return conform(
        newest.withColumn("customer_city", tidy_place_name(F.col("customer_city"))), "customers"
    )


def newest_sellers(raw: DataFrame, plan: BatchPlan) -> DataFrame:
    """The newest export of each seller, its city's name as it came."""
    named = _trimmed(raw, ["seller_id", "seller_zip_code_prefix", "seller_state"])
    return _newest(named, "seller_id", plan)


def sellers(raw: DataFrame, plan: BatchPlan) -> DataFrame:
    """The newest export of each seller."""
    newest = newest_sellers(raw, plan)
    return conform(
        newest.withColumn("seller_city", tidy_place_name(F.col("seller_city"))), "sellers"
    )


def geolocation(raw: DataFrame, plan: BatchPlan) -> DataFrame:
    """One row per postal prefix: mean position, commonest place name, point count, latest batch.

    Names are counted per prefix first, so the commonest one (the first in the
    alphabet on a tie) is picked among names, not among points.
    """
    zip_code, city, state = (
        "geolocation_zip_code_prefix",
        "geolocation_city",
        "geolocation_state",
    )
    points = raw.select(
        blank_to_null(F.col(zip_code)).alias(zip_code),
        tidy_place_name(F.col(city)).alias(city),
        blank_to_null(F.col(state)).alias(state),
        safe_cast(F.col("geolocation_lat"), "DECIMAL(18, 12)").alias("lat"),
        safe_cast(F.col("geolocation_lng"), "DECIMAL(18, 12)").alias("lng"),
        F.struct(
            F.coalesce(plan.position_of(F.col("batch_id")), F.lit(-1)).alias("position"),
            "batch_id",
        ).alias("batch"),
    )
    places = points.groupBy(zip_code, city, state).agg(
        F.max("batch").alias("batch"),
        F.count(F.lit(1)).alias("n"),
        F.sum("lat").alias("lat"),
        F.count("lat").alias("n_lat"),
        F.sum("lng").alias("lng"),
        F.count("lng").alias("n_lng"),
    )
    commonest = F.struct(F.negative("n"), city, state)
    per_zip = places.groupBy(zip_code).agg(
        F.sum("lat").alias("lat"),
        F.sum("n_lat").alias("n_lat"),
        F.sum("lng").alias("lng"),
        F.sum("n_lng").alias("n_lng"),
        F.min(commonest).alias("place"),
        F.sum("n").alias("n_points"),
        F.max("batch").alias("batch"),
    )
    return conform(
        per_zip.select(
            zip_code,
            F.try_divide(F.col("lat").cast("double"), F.col("n_lat")).alias("geolocation_lat"),
            F.try_divide(F.col("lng").cast("double"), F.col("n_lng")).alias("geolocation_lng"),
            F.col(f"place.{city}").alias(city),
            F.col(f"place.{state}").alias(state),
            "n_points",
            F.col("batch.batch_id").alias("batch_id"),
        ),
        "geolocation",
    )
