"""All published anomalies are counted, on hand-made rows."""

from __future__ import annotations

from decimal import Decimal

from tests.test_plans import D, ORDER, order
from tidemark.operators.batches import MARKETPLACE_BATCHES as PLAN
from tidemark.plans import anomalies, gold, seeds, silver

AFTER = "2018-09-05 00:00:00"


def test_every_published_anomaly_is_counted(spark):
    def frame(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    raw_orders = frame(
        ", ".join(f"{c} string" for c in ORDER.split()),
        order("ok", "delivered", D("01"), D("01"), D("02"), D("05"), D("09")),
        order("due", "shipped", D("01"), D("01"), D("02"), None, D("09")),
        order("sent", "delivered", D("01"), D("01"), D("02"), AFTER, D("09")),
        order("unsent", "delivered", D("01"), D("01"), AFTER, AFTER, D("09")),
    )
    raw_reviews = frame(
        "review_id string, order_id string, review_score string, review_comment_title string, "
        "review_comment_message string, review_creation_date string, review_answer_timestamp string, "
        "source_file string, batch_id string",
        ("r1", "ok", "5", None, None, D("06"), D("07"), "f", PLAN.ids[0]),
        ("r1", "due", "5", None, None, D("06"), AFTER, "f", PLAN.ids[0]),
        ("r2", "ok", "5", None, None, D("06"), D("07"), "f", PLAN.ids[0]),
    )
    orders = silver.orders(raw_orders, PLAN)
    reviews = silver.order_reviews(raw_reviews, orders, PLAN)
    items = frame(
        "order_id string, price decimal(10,2), freight_value decimal(10,2), dq_flag string",
        ("ok", Decimal(10), Decimal(1), None), ("due", Decimal(10), None, None),
        ("sent", Decimal(10), Decimal(1), None),
    )
    tables = {
        "orders": orders,
        "order_items": items,
        "order_reviews": reviews,
        "order_payments": frame(
            "order_id string, payment_value decimal(10,2), dq_flag string",
            ("ok", Decimal(11), None), ("due", Decimal(7), "P1,P2"), ("due", Decimal(3), "T1:payment_installments"),
            ("sent", Decimal(10), "P3"), ("unsent", Decimal(9), None),
        ),
        "products": frame(
            "product_category_name string, product_category_en string, dq_flag string",
            ("a", "A", None), ("b", None, "PR2"), ("b", None, None), (None, None, "PR1,PR3"),
        ),
        "leads": frame("dq_flag string", ("C1",), (None,)),
        "clickstream_events": frame(
            "session_id string, dq_flag string", ("s", "E1,E2"), ("s", "E1"), ("t", "E2"), ("t", None)
        ),
        "fact_order": gold.fact_order(orders, items, reviews, PLAN),
        "bronze_orders": raw_orders,
        "bronze_order_reviews": raw_reviews,
        "bronze_sellers": frame(
            "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string, batch_id string",
            ("s1", "1", "Rio", "RJ", PLAN.ids[0]), ("s1", "1", "rio", "RJ", PLAN.ids[1]),
            ("s2", "1", "sao  paulo", "SP", PLAN.ids[0]), ("s3", "1", None, "SP", PLAN.ids[0]),
        ),
        "bronze_geolocation": frame(
            ", ".join(f"{c} string" for c in (*anomalies.POINT, "batch_id")),
            *[("1", "2", "3", "x", "y", b) for b in (*PLAN.ids[:2], None)], ("1", "2", "3", "X", "y", PLAN.ids[0]),
        ),
    }
    compared = anomalies.beside_expected(
        anomalies.anomaly_counts(tables, PLAN), seeds.expected_anomalies(spark)
    )
    rows = compared.collect()
    assert {tuple(r)[:3] + (r.expected_count,) for r in rows} == set(seeds.ANOMALIES)
    got = {(r.an_id, r.sub_code): r.actual_count for r in rows}
    assert len(rows) == len(got) == 30 and min(got.values()) == 0
    assert {k: n for k, n in got.items() if n} == {
        ("AN-04", None): 1,
        ("AN-06", "P1_P2_P3"): 2,
        ("AN-07", None): 1,
        ("AN-08", None): 1,
        ("AN-10", "PR1"): 1,
        ("AN-10", "PR2"): 1,
        ("AN-10", "PR3"): 1,
        ("AN-10", "missing_translation_categories"): 1,
        ("AN-10", "missing_translation_products"): 2,
        ("AN-11", None): 1,
        ("AN-12", None): 2,
        ("AN-13", "C1"): 1,
        ("AN-14", "orders_source_excluded"): 2,
        ("AN-14", "reviews_source_excluded"): 1,
        ("AN-15", "E1"): 1,
        ("AN-15", "E2"): 2,
        ("AN-16", "shipped_overdue_undelivered"): 1,
        ("AN-16", "post_cutoff_delivered_carrier"): 1,
        ("AN-16", "total_overdue_undelivered"): 2,
    }
