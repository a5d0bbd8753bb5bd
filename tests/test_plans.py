"""Table models on hand-made rows, and whole batches from raw files."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.operators.batches import MARKETPLACE_BATCHES as PLAN
from tidemark.plans import contract, gold, pipeline, seeds, silver
from tidemark.sources import ledger
from tidemark.sources.raw_leads import parse_json_lines
from tidemark.sources.raw_logs import parse_log_lines

BULK = PLAN.ids[0]


def log_line(at, session="s1", kind="home", order="N/A", product="N/A", amount="N/A", user="u1"):
    return (
        f"{at} [INFO] - USER_ID: {user}, SESSION_ID: {session}, ORDER_ID: {order}, "
        f"EVENT_TYPE: {kind}, PRODUCT_ID: {product}, AMOUNT: {amount}, OUTCOME: N/A"
    )


def bronze_events(spark, rows):
    """rows: (line, batch_id, source_file)"""
    lines = spark.createDataFrame(rows, "raw_line string, batch_id string, source_file string")
    return parse_log_lines(lines).withColumn("ingested_at", F.current_timestamp())


def test_events(spark):
    first = log_line("2018-05-01 10:00:00.000001")
    rows = [
        (first, BULK, "a"), (first, "2018-06", "a"),  # the same line again: the bulk one stays
        (log_line("2018-05-01 10:00:01.0", kind="purchase", order="o1", amount="5.5"), BULK, "a"),
        (log_line("2018-05-01 10:00:02.0", kind="product_view", product="p1"), BULK, "a"),
        (log_line("2018-05-01 10:00:02.0", kind="add_to_cart", product="p1"), BULK, "a"),
        (log_line("2018-05-01 10:00:03.0", "s2", "purchase", "o2", amount="1e12"), BULK, "a"),
        ("garbage", BULK, "a"),
        (log_line("2018-05-01 10:00:04.1234567", user=" "), BULK, "a"),
    ]
    evaluated = silver.evaluate_events(bronze_events(spark, rows))
    events = silver.clickstream_events(silver.distinct_events(evaluated, PLAN))
    assert events.columns == contract.columns_of("clickstream_events")
    got = {(r.session_id, r.event_type): r for r in events.collect()}
    assert len(got) == 5 and got["s1", "home"].batch_id == BULK
    assert {k: r.dq_flag for k, r in got.items()} == {
        ("s1", "home"): None,
        ("s1", "purchase"): None,
        ("s1", "product_view"): "E1,E2",
        ("s1", "add_to_cart"): "E1,E2",
        ("s2", "purchase"): "T1:amount",
    }
    assert got["s1", "purchase"].amount == Decimal("5.50")
    assert got["s1", "product_view"].event_id == "s1|2018-05-01 10:00:02|product_view|p1"
    reasons = {r.reject_reason for r in silver.events_rejects(evaluated).collect()}
    assert reasons == {
        "unparsed_log_line;missing_session_id;missing_event_ts;missing_event_type;missing_user_id",
        "missing_event_ts;missing_user_id",
    }

    session = {r.session_id: r for r in gold.fact_session(events).collect()}["s1"]
    assert (session.n_events, session.duration_seconds, session.order_id) == (4, 1, "o1")
    assert session.purchase_amount == Decimal("5.50") and session.has_add_to_cart
    funnel = gold.kpi_funnel_day(gold.fact_session(events)).first()
    assert (funnel.n_sessions, funnel.n_reach_purchase, funnel.n_purchase_sessions) == (2, 1, 2)
    assert funnel.is_small_sample and funnel.abandon_rate == 0.0


def leads_of(spark, rows):
    lines = spark.createDataFrame(rows, "raw_json string, batch_id string, source_file string")
    evaluated = silver.evaluate_leads(parse_json_lines(lines))
    return silver.leads(evaluated, PLAN), silver.leads_rejects(evaluated)


def test_leads(spark):
    def lead(mql_id, contact="2018-01-10", page="p", deal=""):
        return f'{{"mql_id":"{mql_id}","first_contact_date":"{contact}","landing_page_id":"{page}"{deal}}}'

    won = ',"deal":{"won_date":"%s","has_company":"%s","declared_product_catalog_size":"%s","lead_type":" "}'
    leads, rejects = leads_of(
        spark,
        [
            (lead("a"), BULK, "f"),
            (lead("a", deal=won % ("2018-06-02 10:00:00", "1.0", "100.0")), "2018-06", "f"),
            (lead("b", deal=won % ("2018-01-09", "maybe", "100.5")), BULK, "f"),
            (lead("c", contact="2018-02-30"), BULK, "f"),
            (lead(" ", contact="", page=" "), BULK, "f"),
            ("{bad", BULK, "f"),
        ],
    )
    assert leads.columns == contract.columns_of("leads")
    got = {r.mql_id: r for r in leads.collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].has_deal and got["a"].has_company and got["a"].batch_id == "2018-06"
    assert (got["a"].declared_product_catalog_size, got["a"].lead_type) == (100, "unknown")
    assert (got["a"].dq_flag, got["a"].origin) == (None, "unknown")
    assert got["b"].dq_flag == "C1,T1:has_company,T1:declared_product_catalog_size"
    assert {r.reject_reason for r in rejects.collect()} == {
        "INVALID_FIRST_CONTACT_DATE",
        "MISSING_MQL_ID;MISSING_FIRST_CONTACT_DATE;MISSING_LANDING_PAGE_ID",
    }
    facts = {r.mql_id: r for r in gold.fact_lead(leads).collect()}
    assert facts["a"].days_to_close == 143 and not facts["a"].is_close_time_excluded
    assert facts["b"].days_to_close == -1 and facts["b"].is_close_time_excluded
    kpi = gold.kpi_lead_origin(gold.fact_lead(leads)).first()
    assert (kpi.n_leads, kpi.n_leads_with_deal, kpi.n_close_time_valid_deals) == (2, 2, 1)
    assert (kpi.avg_days_to_close, kpi.won_30d_rate, kpi.n_leads_not_excluded) == (143.0, 0.0, 1)


ORDER = "order_id customer_id order_status order_purchase_timestamp order_approved_at " \
    "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date " \
    "source_file batch_id"  # fmt: skip


def order(order_id, status, bought, approved, carrier, customer, estimate, batch=BULK):
    return (order_id, "c", status, bought, approved, carrier, customer, estimate, "f", batch)


def silver_orders(spark, rows):
    return silver.orders(
        spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ORDER.split())), PLAN
    )


D = "2018-01-{} 00:00:00".format


def test_order_flags(spark):
    orders = silver_orders(
        spark,
        [
            order("ok", "delivered", D("01"), D("01"), D("02"), D("05"), D("09")),
            order("ok", "shipped", D("01"), None, None, None, D("09"), "1999-01"),  # unknown batch
            order("none", "delivered", D("01"), None, None, None, D("09")),
            order("odd", "shipped", D("05"), D("04"), D("03"), D("02"), D("09")),
            order("after", "delivered", D("01"), D("01"), D("02"), "2018-09-05 00:00:00", D("09")),
            order("unsent", "delivered", D("01"), D("01"), "2018-09-04 00:00:00", "2018-09-05 00:00:00", D("09")),
            order("late", "shipped", D("05"), "x", D("06"), "2018-09-01 00:00:00", D("09")),
        ],
    )
    got = {r.order_id: r for r in orders.collect()}
    assert {k: r.dq_flag for k, r in got.items()} == {
        "ok": None,
        "none": "D1,D5,D7",
        "odd": "D2,D3,D4,D6",
        "after": None,
        "unsent": None,
        "late": "T1:order_approved_at",  # delivered after the cutoff has not happened
    }
    assert got["late"].order_delivered_customer_date is None
    # delivered after the cutoff: shipped by then only if the carrier had it
    assert (got["after"].order_status, got["unsent"].order_status) == ("shipped", "approved")


def test_newest_exports(spark):
    rows = [
        ("c1", "u", "01", "X", "RJ", BULK), ("c1", "u", "01", "X", "SP", "2018-06"),
        ("c2", "u", "01", "X", "RJ", "2018-06"), ("c2", "u", "01", "X", "SP", "1999-01"),  # unplanned
        ("c3", "u", "01", "X", "AA", None), ("c4", "u", "01", "X", "RJ", BULK),
        ("c4", "u", "01", "X", "SP", BULK), (" ", "u", "01", "X", "A", BULK), (None, "u", "01", "X", "B", BULK),
    ]
    names = "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state batch_id"
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names.split()))
    got = silver.customers(raw.withColumn("source_file", F.lit("f")), PLAN).collect()
    assert {(r.customer_id, r.customer_state) for r in got} == {
        ("c1", "SP"), ("c2", "RJ"), ("c3", "AA"), ("c4", "SP"), (None, "A"), (None, "B"),
    }
    assert len(got) == 6


def test_orders_to_kpis(spark):
    orders = silver_orders(
        spark,
        [
            order("a", "delivered", D("01"), D("01"), D("02"), D("11"), D("09")),  # late
            order("b", "delivered", D("01"), D("01"), D("02"), D("05"), D("09")),  # on time
            order("n", "delivered", D("01"), D("01"), D("02"), D("05"), None),  # nobody knows
            order("s", "shipped", D("01"), D("01"), D("02"), None, D("09")),  # overdue
            order("x", "canceled", D("01"), None, None, None, D("09")),
        ],
    )
    items = silver.order_items(
        spark.createDataFrame(
            [("a", "1", "10.00"), ("a", "2", "0"), ("b", "1", "5.5"), ("n", "1", "1"), ("x", "1", "7")],
            "order_id string, order_item_id string, price string",
        ).select(
            "order_id", "order_item_id", F.lit("p").alias("product_id"),
            F.lit("s").alias("seller_id"), F.lit("2018-08-01").alias("shipping_limit_date"),
            "price", F.lit("1").alias("freight_value"), F.lit("f").alias("source_file"),
            F.lit(BULK).alias("batch_id"),
        ),
        orders,
    )
    assert {r.dq_flag for r in items.collect()} == {"I1"}
    reviews = silver.order_reviews(
        spark.createDataFrame(
            [
                ("r1", "a", "1.0", "2018-01-12", "2018-01-13 00:00:00"),
                ("r2", "a", "5.0", "2018-01-12", "2018-01-14 00:00:00"),  # the newest answer
                ("r3", "a", "3", "2017-12-31", "2018-01-20 00:00:00"),  # before the purchase
                ("r4", "b", "4", "2018-01-12", None),  # not answered
                ("r5", "n", "2", "2018-01-12", "2018-09-13 00:00:00"),  # answered after the cutoff
                ("r6", "x", "5", "2018-01-12", "2018-01-13 00:00:00"),
            ],
            "review_id string, order_id string, review_score string, "
            "review_creation_date string, review_answer_timestamp string",
        ).withColumns(
            {
                "review_comment_title": F.lit(None).cast("string"),
                "review_comment_message": F.lit(""),
                "source_file": F.lit("f"),
                "batch_id": F.lit(BULK),
            }
        ),
        orders,
        PLAN,
    )
    facts = gold.fact_order(orders, items, reviews, PLAN)
    got = {r.order_id: r for r in facts.collect()}
    assert (got["a"].n_items, got["a"].order_revenue, got["a"].review_score) == (1, 10, 5)
    assert {k: r.is_late for k, r in got.items()} == {
        "a": True, "b": False, "n": None, "s": None, "x": None,
    }
    assert (got["a"].delivery_days, got["a"].shipping_days) == (10, 9)
    assert got["s"].is_overdue_undelivered and not got["s"].is_valid_order
    assert got["b"].review_score is None and got["n"].review_score is None

    calendar = gold.calendar_from(
        spark.createDataFrame([(date(2017, 12, 31),)], "first_day date"), "2018-02-28"
    )
    delivery = {r.year_month: r for r in gold.kpi_delivery_month(facts, calendar).collect()}
    assert set(delivery) == {"2017-12", "2018-01", "2018-02"}
    january, empty = delivery["2018-01"], delivery["2018-02"]
    # an order without an estimate is neither late nor on time
    assert (january.n_delivered, january.n_late, january.n_on_time) == (3, 1, 1)
    assert (january.n_scored, january.n_scored_late, january.score_gap) == (2, 1, None)
    assert empty.n_delivered == 0 and empty.late_rate is None and empty.is_small_sample
    sales = {r.year_month: r for r in gold.kpi_sales_month(facts, calendar).collect()}
    assert (sales["2018-01"].n_orders_total, sales["2018-01"].n_valid_orders) == (5, 3)
    assert sales["2018-01"].sum_revenue == Decimal("16.50") and sales["2018-02"].sum_revenue == 0
    customers = spark.createDataFrame([("c", " SP ")], "customer_id string, customer_state string")
    state = gold.kpi_sales_state_month(facts, customers, calendar).collect()
    assert [(r.customer_state, r.n_orders_total) for r in state] == [("SP", 5)]
    unknown = gold.kpi_sales_state_month(facts, customers.limit(0), calendar).first()
    assert unknown.customer_state == ""


def test_growth_needs_a_large_month_before(spark):
    counts = {"2018-01": 99, "2018-02": 100, "2018-03": 150}
    facts = None
    for month, n in counts.items():
        rows = spark.range(n).select(
            F.lit(f"{month}-01").cast("date").alias("purchase_date"),
            F.lit(True).alias("is_valid_order"), F.lit(False).alias("is_canceled"),
            F.lit(1).cast("decimal(20,2)").alias("order_revenue"),
        )
        facts = rows if facts is None else facts.unionByName(rows)
    calendar = gold.calendar_from(
        spark.createDataFrame([(date(2018, 1, 1),)], "first_day date"), "2018-04-30"
    )
    got = {r.year_month: r for r in gold.kpi_sales_month(facts, calendar).collect()}
    assert {m: r.order_growth for m, r in got.items()} == {
        "2018-01": None, "2018-02": None, "2018-03": 0.5, "2018-04": -1.0,
    }
    assert {m: r.is_small_sample for m, r in got.items()} == {
        "2018-01": True, "2018-02": False, "2018-03": False, "2018-04": True,
    }


def test_calendar_edges(spark):
    late = spark.createDataFrame([(date(2019, 1, 1),)], "first_day date")
    assert gold.calendar_from(late, "2018-08-31").isEmpty()
    full = gold.calendar_from(
        spark.createDataFrame([(date(2016, 9, 4),)], "first_day date"), "2018-08-31"
    )
    assert full.count() == 727 and checks.calendar_gaps(full, PLAN).isEmpty()
    assert checks.calendar_gaps(full.filter("date <> '2017-01-01'"), PLAN).count() == 1


def test_geolocation_and_products(spark):
    points = spark.createDataFrame(
        [("01", "1.0", "-2.0", "SAO  Paulo", "SP"), ("01", "3.0", "-4.0", " sao paulo", "SP"),
         ("01", "5.0", "x", "osasco", "SP")],
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, "
        "geolocation_city string, geolocation_state string",
    ).withColumn("batch_id", F.lit(BULK))
    later = points.limit(1).withColumn("batch_id", F.lit("2018-06"))
    assert silver.geolocation(points.unionByName(later), PLAN).first().batch_id == "2018-06"
    row = silver.geolocation(points, PLAN).first()
    assert (row.geolocation_lat, row.geolocation_lng, row.n_points) == (3.0, -3.0, 3)
    assert row.geolocation_city == "sao paulo"

    raw = spark.createDataFrame(
        [("p1", "beleza", "0", "1"), ("p2", None, "5", None)],
        "product_id string, product_category_name string, product_weight_g string, "
        "product_length_cm string",
    ).withColumns(
        {c: F.lit("1") for c in ("product_name_lenght", "product_description_lenght",
                                 "product_photos_qty", "product_height_cm", "product_width_cm",
                                 "source_file", "batch_id")}
    )
    names = spark.createDataFrame(
        [("beleza", "beauty")], "product_category_name string, product_category_name_english string"
    )
    got = {r.product_id: r for r in silver.products(raw, names, PLAN).collect()}
    assert (got["p1"].dq_flag, got["p1"].product_category_en) == ("PR2", "beauty")
    assert got["p1"].product_weight_g is None and got["p2"].dq_flag == "PR1,PR3"


def test_contract_and_seeds(spark):
    assert len(contract.SILVER_COLUMNS) == 11 and len(contract.GOLD_COLUMNS) == 16
    frame = spark.createDataFrame([], "year int, date date, month int")
    assert contract.contract_problems(frame, "dim_date") == ["missing year_month"]
    swapped = spark.createDataFrame([], "year int, date date, month int, year_month string")
    assert "order is" in contract.contract_problems(swapped, "dim_date")[0]
    assert seeds.flag_catalog(spark).count() == 19
    assert seeds.expected_anomalies(spark).count() == 30
    assert seeds.expected_orphans(spark).count() == 8
    totals = seeds.expected_row_counts(spark).groupBy("table_name").sum("expected_rows")
    assert {r[0]: r[1] for r in totals.collect()}["clickstream"] == 992031


# --- whole batches -------------------------------------------------------------------------


def write_raw(root, batch, source, name, text):
    folder = root / "raw" / source / batch
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def write_csv(root, batch, table, rows):
    header = ",".join(contract.RAW_CSV_COLUMNS[table])
    body = "\n".join(",".join(row) for row in rows)
    write_raw(root, batch, "csv", f"{table}.csv", f"﻿{header}\n{body}\n")


def first_batch(root):
    write_csv(root, BULK, "orders", [
        ("o1", "c1", "shipped", D("02"), D("02"), D("03"), "", D("20")),
        ("o2", "c2", "canceled", D("03"), "", "", "", D("20")),
    ])
    write_csv(root, BULK, "order_items", [
        ("o1", "1", "p1", "s1", D("05"), "10.00", "1.00"), ("o2", "1", "p1", "s1", D("05"), "3.00", "1.00"),
    ])
    write_csv(root, BULK, "order_payments", [("o1", "1", "card", "1", "11.00")])
    write_csv(root, BULK, "order_reviews", [
        ("r1", "o1", "4", "", '"two\nlines"', D("10"), D("11")),
    ])
    write_csv(root, BULK, "customers", [("c1", "u1", "01", "X", "SP"), ("c2", "u2", "02", "Y", "RJ")])
    write_csv(root, BULK, "sellers", [("s1", "01", " X ", "SP")])
    write_csv(root, BULK, "products", [("p1", "cat", "1", "1", "1", "1", "1", "1", "1")])
    write_csv(root, BULK, "product_category_translation", [("cat", "category")])
    write_csv(root, BULK, "geolocation", [("01", "1.0", "2.0", "X", "SP")])
    write_raw(root, BULK, "clickstream", "access_log.txt", "\n".join([
        log_line("2018-01-02 10:00:00.0", user="c1"),
        log_line("2018-01-02 10:00:01.0", kind="product_view", product="p1", user="c1"),
        log_line("2018-01-02 10:00:09.0", kind="purchase", order="o1", amount="10.00", user="c1"),
    ]) + "\n")
    write_raw(root, BULK, "marketing_funnel", "marketing_leads.jsonl",
              '{"mql_id":"m1","first_contact_date":"2018-01-05","landing_page_id":"p"}\n')


def second_batch(root):
    write_csv(root, "2018-06", "orders", [
        ("o1", "c1", "delivered", D("02"), D("02"), D("03"), "2018-06-02 00:00:00", D("20")),
    ])
    write_raw(root, "2018-06", "marketing_funnel", "marketing_leads.jsonl",
              '{"mql_id":"m1","first_contact_date":"2018-01-05","landing_page_id":"p",'
              '"deal":{"won_date":"2018-06-03","seller_id":"s1"}}\n')  # fmt: skip


def test_batches_from_raw_files(spark, tmp_path):
    root = str(tmp_path)
    layout = pipeline.Layout(root)
    with pytest.raises(pipeline.BatchOrderError):
        pipeline.run_batch(spark, root, "2018-06")
    first_batch(tmp_path)
    report = pipeline.run_batch(spark, root, BULK)
    assert {r.check_name for r in report.filter("violations > 0").collect()} == set()

    second_batch(tmp_path)
    pipeline.run_batch(spark, root, "2018-06")
    order_one = layout.read(spark, "gold", "fact_order").filter("order_id = 'o1'").first()
    assert order_one.is_delivered_order and order_one.is_late and order_one.review_score == 4
    lead = layout.read(spark, "gold", "fact_lead").first()
    assert lead.has_deal and lead.days_to_close == 149 and lead.batch_id == "2018-06"

    before = {n: layout.read(spark, "gold", n).count() for n in contract.GOLD_COLUMNS}
    pipeline.run_batch(spark, root, "2018-06")  # again: nothing changes
    assert before == {n: layout.read(spark, "gold", n).count() for n in contract.GOLD_COLUMNS}
    assert layout.read(spark, "bronze", "marketing_leads").count() == 2
    manifest = layout.read(spark, "ops/manifest", "marketing_leads")
    assert {str(r.batch_id) for r in manifest.collect()} == {BULK, "2018-06"}

    # a broken log line fails the run, and the next batch is held back
    write_raw(tmp_path, "2018-07", "clickstream", "access_log.txt", "garbage\n")
    with pytest.raises(checks.ChecksFailed, match="events rejects empty"):
        pipeline.run_batch(spark, root, "2018-07", run_id="broken")
    runs = ledger.read_runs(spark, layout.table("ops", "runs"))
    failed = runs.filter("run_id = 'broken'").first()
    assert (failed.status, failed.failed_model, failed.rows_in) == ("failed", "silver", 1)
    assert runs.filter("status = 'success' and rows_out > 0").count() == 3
    with pytest.raises(pipeline.BatchOrderError, match="2018-07 is failed"):
        pipeline.run_batch(spark, root, "2018-08")


def settled(report):
    return {r.check_name: (r.violations, r.status) for r in report.collect()}


def test_checks_of_a_batch(spark, tmp_path):
    """Orphans up to the published number warn in a middle batch; more stop it, as all do in the last."""
    root = str(tmp_path)
    first_batch(tmp_path)
    layout = pipeline.Layout(root)
    bought = lambda n: [
        log_line(f"2018-01-03 10:00:0{i}.0", f"x{i}", "purchase", f"gone{i}", amount="1.00", user="c1")
        for i in range(n)
    ]
    write_raw(tmp_path, BULK, "clickstream", "access_log.txt", "\n".join(bought(3)) + "\n")
    report = settled(pipeline.run_batch(spark, root, BULK))
    assert report["events order orphans within expected"] == (1, "warn")
    assert report["events order orphans above expected"] == (0, "pass")
    final = {c.name: c for c in pipeline.batch_checks(spark, layout, PLAN, PLAN.final_batch)}
    got = settled(checks.report(list(final.values())))
    assert got == {
        "events order orphans above expected": (1, "error"),
        "events flag counts": (2, "warn"),
        "leads close time count": (1, "warn"),
        "leads final totals": (1, "warn"),
    }
    write_raw(tmp_path, BULK, "clickstream", "access_log.txt", "\n".join(bought(4)) + "\n")
    with pytest.raises(checks.ChecksFailed, match="orphans above expected"):
        pipeline.run_batch(spark, root, BULK)
    write_raw(tmp_path, BULK, "clickstream", "access_log.txt", "\n".join(bought(1)) + "\n")
    write_raw(tmp_path, BULK, "marketing_funnel", "marketing_leads.jsonl",
              '{"mql_id":"m","first_contact_date":"2018-01-05","landing_page_id":"p","origin":"moon"}\n')
    with pytest.raises(checks.ChecksFailed, match="leads origin accepted"):
        pipeline.run_batch(spark, root, BULK)


def test_a_batch_without_some_tables(spark, tmp_path):
    bare = tmp_path / "bare"
    write_csv(bare, BULK, "orders", [("o1", "c1", "shipped", D("02"), D("02"), D("03"), "", D("20"))])
    layout = pipeline.Layout(str(bare))
    pipeline.load_bronze(spark, layout, BULK)
    pipeline.build_silver(spark, layout, PLAN)
    assert layout.read(spark, "silver", "orders").count() == 1
    for name in ("geolocation", "leads", "clickstream_events", "products"):
        assert layout.read(spark, "silver", name).count() == 0


def test_calendar_has_no_longest_length(spark):
    first = spark.sql("SELECT DATE'1970-01-01' AS first_day")
    row = gold.calendar_from(first, "2018-08-31").selectExpr("count(*) AS n", "max(date) AS last").first()
    assert (row.n, str(row.last)) == (17775, "2018-08-31")


def test_events_of_unplanned_batches_stay(spark):
    columns = (
        "user_id string, session_id string, order_id string, product_id string, outcome string, event_type string, "
        "amount double, event_ts timestamp_ntz, raw_line string, is_parsed boolean, batch_id string, source_file string, ingested_at timestamp"
    )
    rows = [
        ("u", "s", None, None, None, "home", None, datetime(2018, 6, 1), line, True, batch, "f", datetime(2018, 7, 1))
        for line, batch in (("a", "2018-06"), ("b", "2019-01"), ("c", None), ("a", "2019-01"))
    ]
    evaluated = silver.evaluate_events(spark.createDataFrame(rows, columns))
    events = silver.clickstream_events(silver.distinct_events(evaluated, PLAN))
    assert sorted((r.batch_id or "") for r in events.collect()) == ["", "2018-06", "2019-01"]
