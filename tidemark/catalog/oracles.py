"""The SQL each registered query is checked against."""

from __future__ import annotations

from tidemark.catalog import inputs as i
from tidemark.catalog import queries as q
from tidemark.catalog.oracle_tables import (
    BULK,
    CUTOFF,
    CUTOFF_DATE,
    EVENT_REJECT,
    FINAL,
    MEASURED,
    RAW_JSON,
    batch_of,
    blank,
    codes,
    number_boolean,
    safe_cast,
    seq_of,
    sql,
)
from tidemark.operators.checks import (
    DELIVERY_SHARED,
    DELIVERY_SUMS,
    FOREIGN_KEYS,
    FUNNEL_SHARED,
    FUNNEL_SUMS,
    LEAD_SUMS,
    SALES_SUMS,
)
from tidemark.operators.compare import NOT_METRICS
from tidemark.plans import seeds
from tidemark.plans.contract import GOLD_COLUMNS, GOLD_KEYS, KPI_TABLES, columns_of
from tidemark.sources.raw_leads import DEAL_FIELDS

LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"

# The name of each published table among the subqueries.
SUBQUERY = {
    "leads": "silver_leads",
    "clickstream_events": "silver_events",
    "orders": "silver_orders",
    "order_items": "silver_items",
    "order_payments": "silver_payments",
    "order_reviews": "silver_reviews",
    "products": "silver_products",
    "customers": "silver_customers",
    "sellers": "silver_sellers",
    "product_category_translation": "silver_translation",
    "dim_customer": "silver_customers",
    "dim_product": "silver_products",
    "dim_seller": "silver_sellers",
}


def exported(name: str, source: str, key: str) -> str:
    """Raw rows per batch of a table whose rows partly come again."""
    return f"""UNION ALL SELECT '{name}', '{BULK}', count(*) FROM {source}
              UNION ALL SELECT '{name}', '{i.LATER}', count(*) FROM {source}
              WHERE {i.REEXPORTED.format(key)}"""


def from_table(name: str) -> str:
    return f"SELECT {', '.join(columns_of(name))} FROM {SUBQUERY.get(name, name)}"


def cast_oracle(expression: str, value: str) -> str:
    return f"""SELECT o_orderkey, raw, {value} AS value
      FROM (SELECT o_orderkey, {expression} AS raw FROM orders)"""


def ledger_part(table: str, keys: str, role: int, rows: str) -> str:
    """The keys of one set, as text."""
    parts = [f"CAST({k.strip()} AS VARCHAR)" for k in keys.split(";") if k]
    key = " || '|' || ".join(parts) or "CAST(NULL AS VARCHAR)"
    return f"SELECT '{table}' AS table_name, {key} AS key, {role} AS role FROM {rows}"


CORRECTED_PAYMENTS = f"""
  SELECT * EXCLUDE (payment_type),
    CASE WHEN batch_id = '{FINAL}' THEN 'corrected' ELSE payment_type END AS payment_type
  FROM raw_payments"""
AFTER = f"> TIMESTAMP '{CUTOFF}'"
ITEMS = "(SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_limit FROM lineitem GROUP BY 1, 2)"
REVIEWED = f"(SELECT *, l_shipdate + INTERVAL {i.REVIEW_DELAY_DAYS} DAY AS created FROM lineitem)"
FIRST_DEALS = f"""(SELECT * FROM (SELECT CAST(l_orderkey AS VARCHAR) AS mql_id, {', '.join(f'{i.DEAL_TEXT[c]} AS {c}' for c in i.FIRST_DEAL)} FROM lineitem)
  QUALIFY row_number() OVER (PARTITION BY mql_id ORDER BY {', '.join(i.FIRST_DEAL)}) = 1)"""
# Table, key, set and rows of the raw verification; a key's parts are parted by semicolons.
LEDGER_SETS = (
    ("orders", "o_orderkey", 1, "orders"),
    ("orders", "trim(order_id)", 2, "raw_orders"),
    ("orders", "o_orderkey", 4, f"orders WHERE o_orderdate {AFTER}"),
    ("orders_parent", "o_custkey", 4, f"orders WHERE o_orderdate {AFTER}"),
    ("orders_parent", "c_custkey", 8, "customer"),
    ("order_items", "l_orderkey; l_linenumber", 1, "lineitem"),
    ("order_items", "order_id; order_item_id", 2, "raw_items"),
    ("order_items", "l_orderkey; l_linenumber", 4, f"{ITEMS} WHERE l_limit {AFTER}"),
    ("order_payments", "l_orderkey; l_linenumber", 1, "lineitem"),
    ("order_payments", "order_id; payment_sequential", 2, "raw_payments"),
    ("order_payments", "l_orderkey; l_linenumber", 4, f"lineitem WHERE l_shipdate {AFTER}"),
    ("order_reviews", f"{i.REVIEW_ID}; l_orderkey", 1, REVIEWED),
    ("order_reviews", "review_id; order_id", 2, "raw_reviews"),
    ("order_reviews", f"{i.REVIEW_ID}; l_orderkey", 4, f"{REVIEWED} WHERE created {AFTER}"),
    ("customers", "c_custkey", 1, "customer"),
    ("customers", "c_custkey", 2, f"(SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer WHERE {i.REEXPORTED.format('c_custkey')})"),
    ("products", "p_partkey", 1, "part"),
    ("products", "p_partkey", 2, f"(SELECT p_partkey FROM part UNION ALL SELECT p_partkey FROM part WHERE {i.REEXPORTED.format('p_partkey')})"),
    ("sellers", "s_suppkey", 1, "supplier"),
    ("sellers", "s_suppkey", 2, f"(SELECT s_suppkey FROM supplier UNION ALL SELECT s_suppkey FROM supplier WHERE {i.REEXPORTED.format('s_suppkey')})"),
    ("product_category_translation", "product_category_name", 1, "silver_translation"),
    ("product_category_translation", "product_category_name", 2, "silver_translation"),
    ("geolocation", "", 2, "customer"),
    ("marketing_leads", "o_orderkey", 1, "orders"),
    ("marketing_leads", "mql_id", 2, "replayed_leads"),
    ("marketing_deals", "mql_id", 1, FIRST_DEALS),
    ("marketing_deals", "mql_id", 2, "replayed_leads WHERE has_deal"),
    ("marketing_deals", "mql_id", 4, f"{FIRST_DEALS} WHERE CAST(won_date AS TIMESTAMP) {AFTER}"),
    ("marketing_deals", "o_orderkey", 8, "orders"),
    ("clickstream", "raw_line", 1, "web_lines"),
    ("clickstream", "raw_line", 2, "web_lines WHERE batch_id IS NOT NULL"),
    ("clickstream", "raw_line", 4, "web_lines WHERE batch_id IS NULL"),
)


def values(rows, names: str) -> str:
    def literal(v):
        return "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS t({names})"


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def batch_values(names: str = "batch_id, batch_seq") -> str:
    return values([(b, n) for n, b in enumerate(i.BATCHES.ids)], names)


def flag_pairs() -> str:
    return codes(
        ",",
        [
            ("P1", "l_returnflag = 'N'"),
            ("P_1", "l_discount = 0"),
            ("P2", "l_tax = 0"),
            ("T1:l_quantity", "l_quantity > 45"),
            ("T1:l_extendedprice", "l_extendedprice < 1000"),
        ],
    )


FLAGGED = f"(SELECT {LINE_KEY}, {flag_pairs()} AS dq_flag FROM lineitem)"
SNAPSHOT = """(SELECT CASE WHEN l_suppkey % 50 <> 7 THEN l_orderkey END AS l_orderkey, l_linenumber,
  l_partkey, l_suppkey, l_shipdate, CAST(year(l_shipdate) AS INT) AS version FROM lineitem)"""


PAYMENT_CELLS = " || '|' || ".join(
    f"coalesce(length({c}) || ':' || {c}, '-')"
    for c in ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")
)


def stored_text(value: str, kind: str) -> str:
    if kind == "double":
        return f"regexp_replace(printf('%.10f', {value}), '\\.?0+$', '')"
    return f"CAST({value} AS VARCHAR)"


def metrics_of(table: str) -> str:
    """Long form of one KPI table."""
    key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in GOLD_KEYS[table])
    parts = []
    for name in columns_of(table):
        if name in GOLD_KEYS[table] or name in NOT_METRICS:
            continue
        is_double = name.startswith(("avg_", "step_rate", "score_gap", "order_growth")) or (
            name.endswith("_rate")
        )
        value = stored_text(name, "double" if is_double else "other")
        parts.append(
            f"SELECT '{table}' AS table_name, {key} AS slice_key, '{name}' AS kpi_name, "
            f"{value} AS value FROM {table}"
        )
    return union(parts)


def fk_part(child: str, column: str, parent: str, parent_column: str) -> str:
    return f"""SELECT '{child}.{column} -> {parent}' AS fk_name, count(*) AS n_orphans
      FROM {SUBQUERY.get(child, child)} c LEFT JOIN (SELECT DISTINCT {parent_column} AS k
        FROM {SUBQUERY.get(parent, parent)}) p ON c.{column} = p.k WHERE p.k IS NULL"""


def uniqueness_part(table: str) -> str:
    keys = GOLD_KEYS[table]
    joined = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    null = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""SELECT '{table}' AS table_name, CAST(count(*) - count(DISTINCT {joined})
      + count(*) FILTER (WHERE {null}) AS BIGINT) AS n_problems FROM {SUBQUERY.get(table, table)}"""


def pair(name: str, left: str, right: str, cast: str = "BIGINT") -> str:
    return (
        f"SELECT '{name}' AS check_name, CAST(coalesce(({left}), 0) AS {cast}) AS left_total, "
        f"CAST(coalesce(({right}), 0) AS {cast}) AS right_total"
    )


def count_sql(table: str) -> str:
    return f"SELECT count(*) FROM {SUBQUERY.get(table, table)}"


ORDER_SUMS = {
    "n_orders_total": "count(*)",
    "n_canceled_orders": "count(*) FILTER (WHERE is_canceled)",
    "n_valid_orders": "count(*) FILTER (WHERE is_valid_order)",
    "sum_revenue": "sum(order_revenue) FILTER (WHERE is_valid_order)",
    "n_delivered": "count(*) FILTER (WHERE is_delivered_order)",
    "sum_delivery_days": "sum(delivery_days) FILTER (WHERE is_delivered_order)",
    "n_late": "count(*) FILTER (WHERE is_delivered_order AND is_late)",
    "n_on_time": "count(*) FILTER (WHERE is_delivered_order AND NOT is_late)",
    "n_shipping_measured": "count(shipping_days) FILTER (WHERE is_delivered_order)",
    "sum_shipping_days": "sum(shipping_days) FILTER (WHERE is_delivered_order)",
    "n_scored": "count(review_score)",
    "sum_score": "sum(review_score)",
    "n_overdue_undelivered": "count(*) FILTER (WHERE is_overdue_undelivered)",
}
LEAD_FACT_SUMS = {
    "n_leads": "count(*)",
    "n_leads_with_deal": "count(*) FILTER (WHERE has_deal)",
    "n_close_time_valid_deals": f"count(*) FILTER (WHERE {MEASURED})",
    "sum_days_to_close": f"sum(days_to_close) FILTER (WHERE {MEASURED})",
    "n_leads_not_excluded": "count(*) FILTER (WHERE NOT is_close_time_excluded)",
    "n_won_30d": f"count(*) FILTER (WHERE {MEASURED} AND days_to_close <= 30)",
}
SESSION_FACT_SUMS = {
    "n_sessions": "count(*)",
    "n_purchase_sessions": "count(*) FILTER (WHERE has_purchase)",
    "n_cart_sessions": "count(*) FILTER (WHERE has_add_to_cart)",
    "n_cart_abandoned_sessions": "count(*) FILTER (WHERE has_add_to_cart AND NOT has_purchase)",
    "n_sessions_ge2": "count(*) FILTER (WHERE n_events >= 2)",
    "sum_duration_seconds": "sum(duration_seconds) FILTER (WHERE n_events >= 2)",
}
FACT_SUMS = {
    "fact_order": ORDER_SUMS,
    "fact_lead": LEAD_FACT_SUMS,
    "fact_session": SESSION_FACT_SUMS,
}


def additivity(left: str, right: str, components: tuple[str, ...]) -> str:
    def total(table: str, component: str) -> str:
        total_sql = FACT_SUMS.get(table, {}).get(component, f"sum({component})")
        return f"(SELECT CAST(coalesce({total_sql}, 0) AS DECIMAL(38,2)) FROM {table})"

    return union(
        f"SELECT '{left} vs {right}' AS check_name, '{c}' AS component, "
        f"{total(left, c)} AS left_total, {total(right, c)} AS right_total"
        for c in components
    )


def check_row(name: str, severity: str, violations: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{severity}' AS severity, n AS violations,
      CASE WHEN n = 0 THEN 'pass' ELSE '{severity}' END AS status
      FROM (SELECT count(*) AS n FROM ({violations}))"""


def repeated(table: str, column: str) -> str:
    return f"""SELECT {column} FROM {table} WHERE {column} IS NOT NULL
      GROUP BY {column} HAVING count(*) > 1"""


def unknown_values(child: str, column: str, parent: str, key: str) -> str:
    return f"""SELECT DISTINCT {column} FROM {child} WHERE {column} IS NOT NULL
      AND {column} NOT IN (SELECT {key} FROM {parent})"""


CHILDREN = f"""
  SELECT 'order_reviews_to_orders' AS relation, order_id, {seq_of('batch_id')} AS seq
  FROM raw_reviews
  UNION ALL
  SELECT 'clickstream_to_orders', order_id, {seq_of('batch_id')} FROM silver_events
  WHERE order_id IS NOT NULL"""
EXPECTED_ORPHANS = values(
    [
        (relation, batch_id, count)
        for relation, _, _, counts in seeds.ORPHANS
        for batch_id, count in zip(i.BATCHES.ids, counts)
    ],
    "relation, batch_id, expected_orphans",
)
EXPECTED_ROWS = values(
    [
        (table, batch_id, count)
        for table, counts, _, _ in seeds.RAW_ROW_COUNTS
        for batch_id, count in zip(i.BATCHES.ids, counts)
    ],
    "table_name, batch_id, expected_rows",
)
FLAGGED_TABLES = (
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "products",
    "leads",
    "clickstream_events",
)
EVERY_FLAG = union(
    f"SELECT '{t}' AS table_name, unnest(string_split(dq_flag, ',')) AS flag FROM {SUBQUERY[t]}"
    for t in FLAGGED_TABLES
)
SILVER_TABLES = (
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "customers",
    "products",
    "sellers",
    "product_category_translation",
    "leads",
    "clickstream_events",
)
ROW_TOTALS = union(
    [f"SELECT '{t}' AS table_name, ({count_sql(t)}) AS n_rows" for t in (*SILVER_TABLES, *GOLD_COLUMNS)]
    + ["SELECT 'geolocation', (SELECT count(DISTINCT c_nationkey) FROM customer)"]
)


def _bodies() -> dict[str, str]:
    lead_metrics = union(
        f"SELECT '{t}' AS table_name, CAST({k} AS VARCHAR) AS slice_key, 'n_leads' AS kpi_name, "
        f"CAST(n_leads AS VARCHAR) AS value FROM {t}"
        for t, k in (("kpi_lead_month", "year_month"), ("kpi_lead_origin", "origin"))
    )
    lead_other = union(
        f"SELECT * FROM ({metrics_of(t)}) WHERE kpi_name <> 'n_leads'"
        for t in ("kpi_lead_month", "kpi_lead_origin")
    )
    rate_text = (
        "CASE WHEN starts_with(kpi_name, 'avg_') OR ends_with(kpi_name, '_rate') "
        "THEN CAST(round(CAST(value AS DECIMAL(38,18)), 4) AS VARCHAR) ELSE value END"
    )
    return {
        # --- sources and sinks
        "parse_log_lines": "SELECT * FROM bronze_events",
        "parse_json_lines": f"""
          SELECT mql_id, first_contact_date, landing_page_id, origin,
            coalesce(deal IS NOT NULL, false) AS has_deal,
            json_extract_string(deal, '$.seller_id') AS deal_seller_id,
            json_extract_string(deal, '$.won_date') AS deal_won_date,
            json_extract_string(deal, '$.declared_monthly_revenue') AS deal_revenue,
            raw_json, is_parsed, batch_id
          FROM (SELECT raw_json, json_valid(raw_json) AS is_parsed, batch_id,
              {', '.join(f"CASE WHEN json_valid(raw_json) THEN json_extract_string(raw_json, '$.{n}') END AS {n}"
                         for n in ('mql_id', 'first_contact_date', 'landing_page_id', 'origin'))},
              CASE WHEN json_valid(raw_json) THEN json_extract(raw_json, '$.deal') END AS deal
            FROM (SELECT * EXCLUDE (raw_json), {i.SPOILED_JSON} AS raw_json FROM spoiled_leads))""",
        "nest_to_json": f"SELECT {RAW_JSON} AS raw_json, batch_id FROM replayed_leads",
        "csv_roundtrip": "SELECT * FROM raw_orders",
        "audit_columns": "SELECT * FROM raw_payments",
        "partition_overwrite": CORRECTED_PAYMENTS,
        "catalog_overwrite": CORRECTED_PAYMENTS,
        "versioned_publish": CORRECTED_PAYMENTS,
        "incremental_orders": "SELECT * FROM silver_orders",
        "routed_leads": f"""
          WITH deals AS (SELECT *, row_number() OVER (PARTITION BY mql_id ORDER BY {', '.join(i.FIRST_DEAL)}) AS place
            FROM (SELECT CAST(l_orderkey AS VARCHAR) AS mql_id, {', '.join(f'{i.DEAL_TEXT[c]} AS {c}' for c in i.FIRST_DEAL)} FROM lineitem))
          SELECT batch_id AS route, mql_id, CASE WHEN has_deal THEN d_sr_id END AS sr_id, CASE WHEN has_deal THEN d_won_date END AS won_date
          FROM replayed_leads WHERE {i.HAS_LEAD}
          UNION ALL SELECT * FROM (
            SELECT CASE WHEN place > 1 THEN '_repeated' WHEN NOT {i.HAS_LEAD} THEN '_orphans'
              WHEN CAST(won_date AS TIMESTAMP) {AFTER} THEN '_excluded' END AS route, mql_id, sr_id, won_date FROM deals)
          WHERE route IS NOT NULL""",
        "csv_records": f"""
          WITH said AS (SELECT review_id, order_id, batch_id, {i.CSV_MESSAGE} AS review_comment_message FROM raw_reviews),
            judged AS (SELECT *, {i.CSV_SPOILED} AS spoiled FROM said)
          SELECT {', '.join(f"CASE WHEN spoiled = 'good' THEN {c} END AS {c}" for c in i.CSV_CELLS)}, spoiled = 'good' AS is_parsed,
            CASE WHEN spoiled <> 'good' THEN {i.CSV_RECORD} END AS raw_record, batch_id, 'reviews.csv' AS source_file
          FROM judged""",
        "raw_verification": f"""
          WITH sets AS ({union(ledger_part(*x) for x in LEDGER_SETS)}),
            keyed AS (SELECT table_name, key, bool_or(role = 1) AS raw, bool_or(role = 2) AS scoped, bool_or(role = 4) AS excluded,
                bool_or(role = 8) AS parent, count(*) FILTER (role = 2) AS n_scoped, count(*) FILTER (role = 4) AS n_out
              FROM sets GROUP BY table_name, key),
            totals AS (SELECT table_name, CAST(sum(n_scoped) AS BIGINT) AS n_rows,
                CAST(sum(CASE WHEN key IS NULL THEN n_scoped WHEN scoped THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct,
                CAST(sum(n_out) AS BIGINT) AS n_excluded,
                count(*) FILTER (key IS NOT NULL AND raw AND NOT scoped AND NOT excluded) AS n_unaccounted,
                count(*) FILTER (key IS NOT NULL AND NOT raw AND (scoped OR excluded)) AS n_unknown,
                count(*) FILTER (key IS NOT NULL AND excluded AND NOT parent) AS n_without_parent
              FROM keyed GROUP BY table_name),
            published AS (SELECT * FROM {values([(t, sum(c), k, x) for t, c, k, x in seeds.RAW_ROW_COUNTS] + [seeds.PUBLISHED_DEALS], 'table_name, expected_rows, expected_distinct, expected_excluded')})
          SELECT table_name, n_rows, n_distinct, n_excluded, n_unaccounted, n_unknown, n_without_parent,
            CAST(expected_rows AS BIGINT) AS expected_rows, CAST(expected_distinct AS BIGINT) AS expected_distinct,
            CAST(expected_excluded AS BIGINT) AS expected_excluded,
            n_rows IS NOT DISTINCT FROM expected_rows AND n_distinct IS NOT DISTINCT FROM expected_distinct
              AND n_excluded IS NOT DISTINCT FROM expected_excluded AS matches
          FROM totals FULL JOIN published USING (table_name)""",
        "batch_load_summary": """
          SELECT batch_id, count(*) AS n_rows, count(*) FILTER (WHERE has_deal) AS n_present,
            count(*) FILTER (WHERE NOT is_parsed) AS n_unparsed
          FROM bronze_leads GROUP BY 1""",
        "batch_fingerprint": f"""
          SELECT batch_id, count(*) AS n_rows,
            CAST(sum(CAST(('0x' || substring(digest, 1, 15)) AS BIGINT)) AS DECIMAL(38,0))
              AS content_digest
          FROM (SELECT batch_id, sha256({PAYMENT_CELLS}) AS digest FROM raw_payments)
          GROUP BY 1""",
        "route_to_batches": f"""
          SELECT {LINE_KEY}, {batch_of('l_shipdate')} AS batch_id FROM lineitem
          WHERE l_shipdate <= TIMESTAMP '{CUTOFF}'""",
        "post_cutoff_quarantine": f"""
          SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
          WHERE l_shipdate > TIMESTAMP '{CUTOFF}'""",
        "kpi_unpivot_long": union(metrics_of(t) for t in KPI_TABLES),
        "metrics_roundtrip": union(metrics_of(t) for t in KPI_TABLES),
        "kpi_second_route": union(metrics_of(t) for t in KPI_TABLES),
        "kpi_compare_all": f"""
          SELECT table_name, count(*) AS n_metrics, CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra,
            CAST(0 AS BIGINT) AS n_different FROM ({union(metrics_of(t) for t in KPI_TABLES)}) GROUP BY 1""",
        "upsert_latest": """
          SELECT run_id, batch_id, CASE WHEN rows_in % 70 = 0 THEN 'success' ELSE status END AS status,
            failed_model, rows_in, rows_out, started_at,
            CASE WHEN rows_in % 70 = 0 THEN ended_at + INTERVAL 1 HOUR ELSE ended_at END AS ended_at
          FROM batch_runs""",
        "latest_status_per_batch": """
          SELECT * FROM batch_runs QUALIFY row_number() OVER (
            PARTITION BY batch_id ORDER BY ended_at DESC, started_at DESC, run_id DESC) = 1""",
        "newest_n_runs": """
          SELECT * FROM batch_runs WHERE batch_id = 'purchase'
          ORDER BY ended_at DESC, started_at DESC, run_id DESC LIMIT 50""",
        # --- column functions
        "safe_cast_date": cast_oracle(q.MESSY_DATE, safe_cast("raw", "DATE")),
        "safe_cast_timestamp": cast_oracle(q.MESSY_TIME, safe_cast("raw", "TIMESTAMP")),
        "safe_cast_int": cast_oracle(q.MESSY_INT, safe_cast("raw", "INT")),
        "safe_cast_decimal": cast_oracle(q.MESSY_NUMBER, safe_cast("raw", "DECIMAL(14, 2)")),
        "safe_cast_double": cast_oracle(q.MESSY_NUMBER, safe_cast("raw", "DOUBLE")),
        "safe_cast_boolean": cast_oracle(q.MESSY_BOOLEAN, safe_cast("raw", "BOOLEAN")),
        "parse_bool_float": cast_oracle(q.MESSY_BOOLEAN, number_boolean("trim(raw)")),
        "integral_double_to_int": cast_oracle(
            q.MESSY_SIZE,
            "CASE WHEN TRY_CAST(raw AS DOUBLE) = floor(TRY_CAST(raw AS DOUBLE)) "
            "THEN CAST(TRY_CAST(raw AS DOUBLE) AS INT) END",
        ),
        "blank_to_null": cast_oracle(q.MESSY_DATE, blank("raw")),
        "lenient_date": cast_oracle(
            q.MESSY_TIME, "TRY_CAST(substring(trim(raw), 1, 10) AS DATE)"
        ),
        "lenient_timestamp": cast_oracle(
            q.MESSY_TIME,
            "CASE WHEN raw NOT LIKE '%T%' AND raw NOT LIKE '%24:00:00' "
            "THEN TRY_CAST(trim(raw) AS TIMESTAMP) END",
        ),
        "cast_failed_flag": f"""
          SELECT o_orderkey, raw, CASE WHEN {blank('raw')} IS NOT NULL
            AND ({safe_cast('raw', 'DATE')}) IS NULL THEN 'T1:order_date' END AS flag
          FROM (SELECT o_orderkey, {q.MESSY_DATE} AS raw FROM orders)""",
        "category_default": f"""
          SELECT o_orderkey, coalesce(lower({blank('origin')}), 'unknown') AS origin,
            CASE WHEN o_orderstatus <> 'P' THEN coalesce({blank('origin')}, 'unknown') END
              AS child_category
          FROM (SELECT *, {i.ORIGIN} AS origin FROM orders)""",
        "flatten_struct": f"""
          SELECT mql_id, batch_id, has_deal,
            {', '.join(f"{blank(f'd_{n}')} AS {n}" for n in DEAL_FIELDS)}
          FROM replayed_leads""",
        "dq_flag_build": f"SELECT * FROM {FLAGGED}",
        "dq_flag_has": f"""
          SELECT dq_flag, count(*) AS n_rows,
            coalesce(list_contains(string_split(dq_flag, ','), 'P1'), false) AS has_p1,
            coalesce(list_contains(string_split(dq_flag, ','), 'P_1'), false) AS has_p_1,
            coalesce(regexp_matches(dq_flag, '(^|,)T1(:|,|$)'), false) AS has_t1
          FROM {FLAGGED} GROUP BY dq_flag""",
        "dq_flag_prefix": f"""
          SELECT l_suppkey, count(*) AS n_rows FROM {FLAGGED}
          WHERE regexp_matches(dq_flag, '(^|,)T1:') GROUP BY 1""",
        "dq_flag_incidence": f"""
          WITH found AS (SELECT table_name, split_part(flag, ':', 1) AS flag_id, count(*) AS n
              FROM ({EVERY_FLAG}) GROUP BY 1, 2),
            known AS (SELECT DISTINCT table_name, flag_id FROM {values(
                [(t, f) for f, t, *_ in seeds.FLAGS if t in FLAGGED_TABLES]
                + [(t, 'T1') for t in FLAGGED_TABLES], 'table_name, flag_id')})
          SELECT table_name, flag_id, CAST(coalesce(n, 0) AS BIGINT) AS n_rows
          FROM known LEFT JOIN found USING (table_name, flag_id)""",
        "reject_reason": f"""
          SELECT {EVENT_REJECT} AS reject_reason, count(*) AS n_rows FROM bronze_events GROUP BY 1""",
        "calendar_days": """
          SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey,
            l_shipdate + INTERVAL 23 HOUR AS shipped_at, o_orderdate,
            CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INT) AS days
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "post_cutoff_rows": f"""
          SELECT 'orders' AS table_name, o_orderkey AS row_key,
            o_orderdate + INTERVAL 45 DAY AS late_value
          FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '{CUTOFF_DATE}'
            OR CAST(o_orderdate + INTERVAL 45 DAY AS DATE) > DATE '{CUTOFF_DATE}'
          UNION ALL
          SELECT 'lineitem', l_orderkey, l_shipdate FROM lineitem
          WHERE l_shipdate > TIMESTAMP '{CUTOFF}'""",
        "surrogate_event_key": """
          SELECT event_id AS source_id, session_id || '|' || strftime(event_ts, '%Y-%m-%d %H:%M:%S')
            || '|' || event_type || '|' || coalesce(order_id, 'none') AS event_id
          FROM session_events""",
        # --- joins, windows, sets
        "latest_snapshot": f"""
          SELECT * FROM {SNAPSHOT} QUALIFY rank() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY version DESC) = 1""",
        "latest_snapshot_single": f"""
          SELECT * FROM {SNAPSHOT} QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY version DESC, l_shipdate DESC, l_partkey, l_suppkey) = 1""",
        "top1_per_group": "SELECT * FROM chosen_reviews",
        "dedup_exact_line": f"""
          SELECT raw_line, batch_id, source_file, {seq_of('batch_id')} AS batch_seq FROM web_lines
          QUALIFY row_number() OVER (
            PARTITION BY raw_line ORDER BY {seq_of('batch_id')}, source_file) = 1""",
        "flag_after_purchase": """
          SELECT event_id, session_id, first_purchase_ts,
            coalesce(event_ts > first_purchase_ts, false) AS is_after_purchase
          FROM (SELECT *, min(CASE WHEN event_type = 'purchase' THEN event_ts END)
                  OVER (PARTITION BY session_id) AS first_purchase_ts FROM session_events)""",
        "flag_same_instant": """
          SELECT event_id, session_id, n_at_instant, n_at_instant > 1 AS is_same_instant
          FROM (SELECT *, count(*) OVER (
                  PARTITION BY session_id, date_trunc('minute', event_ts)) AS n_at_instant
                FROM session_events)""",
        "range_join_batches": f"""
          SELECT {LINE_KEY}, b.batch_id, b.starts_at, b.ends_at
          FROM lineitem JOIN (
            SELECT batch_id, CAST(s AS TIMESTAMP) AS starts_at, CAST(e AS TIMESTAMP) AS ends_at
            FROM {values([
                (BULK, i.FIRST_INSTANT, '2001-05-01 00:00:00'),
                ('2001-05', '2001-05-01 00:00:00', '2001-06-01 00:00:00'),
                ('2001-06', '2001-06-01 00:00:00', '2001-07-01 00:00:00'),
                ('2001-07', '2001-07-01 00:00:00', '2001-08-01 00:00:00'),
            ], 'batch_id, s, e')}) b
          ON l_shipdate >= b.starts_at AND l_shipdate < b.ends_at""",
        "nest_child_replay": """
          SELECT mql_id, first_contact_date, has_deal, d_won_date AS won_date, d_sr_id AS sr_id,
            batch_id FROM replayed_leads""",
        "key_set_reconcile": f"""
          WITH a AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_shipdate <= TIMESTAMP '{CUTOFF}'),
            b AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_shipdate > TIMESTAMP '{CUTOFF}')
          SELECT 'n_left' AS measure, (SELECT count(*) FROM a) AS n_rows
          UNION ALL SELECT 'n_right', (SELECT count(*) FROM b)
          UNION ALL SELECT 'n_both', (SELECT count(*) FROM (FROM a INTERSECT FROM b))
          UNION ALL SELECT 'n_either', (SELECT count(*) FROM (FROM a UNION FROM b))
          UNION ALL SELECT 'n_left_only', (SELECT count(*) FROM (FROM a EXCEPT FROM b))
          UNION ALL SELECT 'n_right_only', (SELECT count(*) FROM (FROM b EXCEPT FROM a))
          UNION ALL SELECT 'n_without_order', (SELECT count(*) FROM b
            WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))""",
        "amount_matches_total": """
          SELECT event_id, e.order_id, amount, total_price
          FROM silver_events e JOIN (
            SELECT order_id, CAST(sum(price) AS DECIMAL(20,2)) AS total_price
            FROM silver_items GROUP BY 1) t ON e.order_id = t.order_id
          WHERE event_type = 'purchase' AND (amount IS NULL OR abs(amount - total_price) > 0.005)""",
        "fk_orphans": union(fk_part(*fk) for fk in FOREIGN_KEYS),
        "global_having": f"""
          SELECT count(*) AS n_leads, count(*) FILTER (WHERE has_deal) AS n_deals FROM silver_leads
          HAVING count(*) <> {seeds.FINAL_LEADS}
            OR count(*) FILTER (WHERE has_deal) <> {seeds.FINAL_DEALS}""",
        "order_items_rollup": "SELECT * FROM order_items_rollup",
        "topk_sellers": """
          SELECT seller_id, CAST(sum(price) AS DECIMAL(20,2)) AS revenue FROM fact_order_item
          GROUP BY 1 ORDER BY revenue DESC, seller_id LIMIT 20""",
        "geo_rollup": f"""
          WITH p AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip,
              lower(c_mktsegment) AS city, r_name AS state,
              CAST(c_acctbal AS DECIMAL(12,2)) AS lat, -c_custkey AS lng,
              {i.POINT_BATCH} AS batch_id
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
            LEFT JOIN region ON n_regionkey = r_regionkey),
          named AS (SELECT * FROM (SELECT zip, city, state, count(*) AS n FROM p GROUP BY ALL)
            QUALIFY row_number() OVER (PARTITION BY zip ORDER BY n DESC, city, state) = 1)
          SELECT g.zip AS geolocation_zip_code_prefix,
            round(CAST(g.lat AS DOUBLE) / g.n_points, 6) AS geolocation_lat,
            round(CAST(g.lng AS DOUBLE) / g.n_points, 6) AS geolocation_lng,
            city AS geolocation_city, state AS geolocation_state, g.n_points, batch_id
          FROM (SELECT zip, sum(lat) AS lat, sum(lng) AS lng, count(*) AS n_points,
                  arg_max(batch_id, {seq_of('batch_id')}) AS batch_id
                FROM p GROUP BY 1) g JOIN named ON g.zip = named.zip""",
        # --- tables
        **{key: from_table(name) for key, name in q.TABLE_QUERIES.items()},
        "silver_leads_rejects": """
          SELECT mql_id, first_contact_date, landing_page_id, origin, has_deal, raw_json, is_parsed,
            batch_id, source_file, reject_reason
          FROM evaluated_leads WHERE reject_reason IS NOT NULL""",
        "silver_events_rejects": "SELECT * FROM evaluated_events WHERE reject_reason IS NOT NULL",
        "silver_parties": union(
            f"SELECT '{name}' AS table_name, {columns_of(name)[0]} AS party_id, "
            f"'{column}' AS column_name, {column} AS value FROM {SUBQUERY[name]}"
            for name in q.PARTIES
            for column in columns_of(name)[1:]
        ),
        # --- checks
        "dq_not_null": union(
            f"SELECT '{c}' AS check_name, count(*) FILTER (WHERE {c} IS NULL) AS violations "
            "FROM silver_leads"
            for c in (
                "mql_id", "first_contact_date", "landing_page_id", "origin", "has_deal", "won_date",
                "seller_id", "has_company", "source_file", "batch_id",
            )
        ),
        "dq_unique": """
          SELECT seller_id, count(*) AS n_rows FROM silver_leads WHERE seller_id IS NOT NULL
          GROUP BY 1 HAVING count(*) > 1""",
        "dq_relationships": """
          SELECT order_id AS value, count(*) AS n_rows FROM silver_events
          WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM silver_orders)
          GROUP BY 1""",
        "dq_accepted_values": """
          SELECT 'l_returnflag' AS column_name, l_returnflag AS value, count(*) AS n_rows
          FROM lineitem WHERE l_returnflag NOT IN ('N', 'R') GROUP BY 2
          UNION ALL SELECT 'event_type', event_type, count(*) FROM events
          WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 2""",
        "dq_report": union(
            [
                check_row(
                    "leads_mql_id_not_null", "error",
                    "SELECT 1 FROM silver_leads WHERE mql_id IS NULL",
                ),
                check_row("leads_mql_id_unique", "error", repeated("silver_leads", "mql_id")),
                check_row("leads_seller_id_unique", "warn", repeated("silver_leads", "seller_id")),
                check_row(
                    "leads_bronze_unparsed", "error",
                    "SELECT 1 FROM bronze_leads WHERE NOT is_parsed",
                ),
                check_row(
                    "leads_rejects_empty", "warn",
                    "SELECT 1 FROM evaluated_leads WHERE reject_reason IS NOT NULL",
                ),
                check_row(
                    "leads_dates_in_scope", "error",
                    f"SELECT 1 FROM silver_leads WHERE first_contact_date > DATE '{CUTOFF_DATE}' "
                    f"OR CAST(won_date AS DATE) > DATE '{CUTOFF_DATE}'",
                ),
                check_row("events_event_id_unique", "error", repeated("silver_events", "event_id")),
                check_row(
                    "events_event_type_accepted", "error",
                    "SELECT DISTINCT event_type FROM silver_events WHERE event_type NOT IN "
                    "('home', 'product_view', 'add_to_cart', 'purchase')",
                ),
                check_row(
                    "events_ts_in_scope", "error",
                    f"SELECT 1 FROM silver_events WHERE event_ts > TIMESTAMP '{CUTOFF}'",
                ),
                check_row(
                    "events_rejects_empty", "error",
                    "SELECT 1 FROM evaluated_events WHERE reject_reason IS NOT NULL",
                ),
                check_row(
                    "events_user_known", "error",
                    unknown_values("silver_events", "user_id", "silver_customers", "customer_id"),
                ),
                check_row(
                    "events_product_known", "error",
                    unknown_values("silver_events", "product_id", "silver_products", "product_id"),
                ),
            ]
        ),
        "key_uniqueness": union(uniqueness_part(t) for t in GOLD_COLUMNS),
        "fact_grain_dups": """
          SELECT 'fact_order' AS fact_table, order_id AS grain_key, count(*) AS n_rows
          FROM fact_order GROUP BY 2 HAVING count(*) > 1
          UNION ALL SELECT 'fact_order_item', CAST(l_orderkey AS VARCHAR) || '|'
            || CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY 2 HAVING count(*) > 1
          UNION ALL SELECT 'fact_lead', mql_id, count(*) FROM fact_lead GROUP BY 2 HAVING count(*) > 1
          UNION ALL SELECT 'fact_session', session_id, count(*) FROM fact_session
          GROUP BY 2 HAVING count(*) > 1""",
        "layer_count_reconcile": union(
            [
                pair(f"{g} vs {s}", count_sql(g), count_sql(s))
                for g, s in (
                    ("dim_customer", "customers"),
                    ("dim_product", "products"),
                    ("dim_seller", "sellers"),
                    ("fact_order", "orders"),
                    ("fact_order_item", "order_items"),
                    ("fact_lead", "leads"),
                )
            ]
            + [
                pair(
                    "fact_session vs distinct sessions",
                    count_sql("fact_session"),
                    "SELECT count(DISTINCT session_id) FROM silver_events",
                ),
                pair(
                    "fact_session events vs clickstream_events",
                    "SELECT sum(n_events) FROM fact_session",
                    count_sql("clickstream_events"),
                ),
                pair(
                    "leads and rejects vs bronze",
                    "SELECT (SELECT count(*) FROM silver_leads) + (SELECT count(*) "
                    "FROM evaluated_leads WHERE reject_reason IS NOT NULL)",
                    "SELECT count(DISTINCT nullif(trim(mql_id), '')) FROM bronze_leads",
                ),
                pair(
                    "deals vs bronze",
                    "SELECT count(*) FROM silver_leads WHERE has_deal",
                    "SELECT count(DISTINCT nullif(trim(mql_id), '')) FROM bronze_leads WHERE has_deal",
                ),
            ]
        ),
        "money_reconcile": "SELECT *, abs(left_total - right_total) > 0.005 AS differs FROM ("
        + union(
            [
                pair(
                    "fact_order_item price",
                    "SELECT sum(price) FROM fact_order_item",
                    "SELECT sum(price) FROM silver_items",
                    "DECIMAL(38,2)",
                ),
                pair(
                    "fact_order revenue",
                    "SELECT sum(order_revenue) FROM fact_order",
                    "SELECT sum(price) FROM silver_items",
                    "DECIMAL(38,2)",
                ),
                pair(
                    "fact_session purchase amount",
                    "SELECT sum(purchase_amount) FROM fact_session",
                    "SELECT sum(amount) FROM silver_events WHERE event_type = 'purchase'",
                    "DECIMAL(38,2)",
                ),
            ]
        )
        + ")",
        "kpi_additivity": union(
            [
                additivity("kpi_sales_month", "fact_order", SALES_SUMS),
                additivity("kpi_sales_state_month", "fact_order", SALES_SUMS),
                additivity("kpi_delivery_month", "fact_order", DELIVERY_SUMS),
                additivity("kpi_delivery_state_month", "kpi_delivery_month", DELIVERY_SHARED),
                additivity("kpi_lead_month", "fact_lead", LEAD_SUMS),
                additivity("kpi_lead_origin", "kpi_lead_month", LEAD_SUMS),
                additivity("kpi_funnel_day", "fact_session", FUNNEL_SUMS),
                additivity("kpi_funnel_month", "kpi_funnel_day", FUNNEL_SHARED),
            ]
        ),
        # every origin's flag was turned over, no other rule is broken
        "kpi_flag_rules": """
          SELECT 'kpi_lead_origin' AS table_name, origin AS slice_key, CAST(1 AS BIGINT) AS n_rows
          FROM kpi_lead_origin""",
        "calendar_contiguous": union(
            f"""SELECT '{name}' AS calendar, count(*) AS actual_rows,
              count(DISTINCT date) AS distinct_days, min(date) AS min_date, max(date) AS max_date,
              DATE '{CUTOFF_DATE}' AS expected_end_date,
              CAST(date_diff('day', min(date), DATE '{CUTOFF_DATE}') + 1 AS INT) AS expected_rows
            FROM dim_date WHERE {condition}"""
            for name, condition in (("full", "true"), ("without mondays", "dayofweek(date) <> 1"))
        ),
        "replay_guardrail": f"""
          SELECT mql_id, count(*) AS row_cnt,
            count(*) FILTER (WHERE seq = 0 AND has_deal) AS bulk_with_deal,
            count(*) FILTER (WHERE seq > 0 AND NOT has_deal) AS later_without_deal
          FROM (SELECT *, {seq_of('batch_id')} AS seq FROM bronze_leads WHERE is_parsed)
          GROUP BY mql_id
          HAVING count(*) > 2 OR (count(*) = 2 AND (
            count(*) FILTER (WHERE seq = 0 AND has_deal) > 0
            OR count(*) FILTER (WHERE seq > 0 AND NOT has_deal) > 0))""",
        "orphans_vs_expected": f"""
          WITH children AS ({CHILDREN}),
            known AS (SELECT trim(order_id) AS order_id, min({seq_of('batch_id')}) AS since
                      FROM raw_orders GROUP BY 1),
            counted AS (
              SELECT relation, batch_id, count(*) AS n
              FROM children c JOIN {batch_values('batch_id, batch_seq')} ON c.seq <= batch_seq
              LEFT JOIN known k ON c.order_id = k.order_id
              WHERE k.since IS NULL OR k.since > batch_seq GROUP BY 1, 2)
          SELECT relation, batch_id, coalesce(n, 0) AS actual_orphans,
            CAST(expected_orphans AS BIGINT) AS expected_orphans,
            CASE WHEN coalesce(n, 0) > expected_orphans THEN 'error'
              WHEN coalesce(n, 0) > 0 AND batch_id <> '{FINAL}' THEN 'warn' ELSE 'pass' END AS status
          FROM (SELECT * FROM {EXPECTED_ORPHANS}) LEFT JOIN counted USING (relation, batch_id)""",
        "expected_counts_check": f"""
          WITH counted AS (
            SELECT table_name, flag AS sub_code, count(*) AS n FROM ({EVERY_FLAG})
            WHERE flag NOT IN ('E1', 'E2', 'P1', 'P2', 'P3') AND flag NOT LIKE 'T1%'
            GROUP BY 1, 2
            UNION ALL SELECT 'clickstream_events', 'E1', count(DISTINCT session_id)
            FROM silver_events WHERE list_contains(string_split(dq_flag, ','), 'E1')
            UNION ALL SELECT 'clickstream_events', 'E2', count(*)
            FROM silver_events WHERE list_contains(string_split(dq_flag, ','), 'E2'))
          SELECT table_name, sub_code, coalesce(n, -1) AS actual_count,
            CAST(expected_count AS BIGINT) AS expected_count
          FROM (SELECT * FROM {values(
              [(t, c, n) for _, c, t, n in seeds.ANOMALIES if c],
              'table_name, sub_code, expected_count')})
          LEFT JOIN counted USING (table_name, sub_code)""",
        "anomaly_counts_check": f"""
          WITH late AS (SELECT *, order_delivered_customer_date > TIMESTAMP '{CUTOFF}' AS is_late
              FROM latest_orders),
            flagged AS (SELECT table_name, flag, count(*) AS n FROM ({EVERY_FLAG}) GROUP BY ALL),
            due AS (SELECT order_id, coalesce(sum(price), 0) + coalesce(sum(freight_value), 0) AS total
              FROM silver_items GROUP BY 1),
            paid AS (SELECT order_id, coalesce(sum(payment_value), 0) AS total
              FROM silver_payments GROUP BY 1),
            newest_reviews AS (SELECT review_answer_timestamp FROM raw_reviews
              QUALIFY {seq_of('batch_id')} = max({seq_of('batch_id')}) OVER (
                PARTITION BY review_id, order_id)),
            untranslated AS (SELECT product_category_name FROM silver_products
              WHERE product_category_name IS NOT NULL AND product_category_en IS NULL),
            counted AS (
              SELECT an_id, sub_code, coalesce(n, 0) AS n
              FROM (SELECT * FROM {values(
                  [(a, c, t) for a, c, t, _ in seeds.ANOMALIES
                   if c in {f for f, *_ in seeds.FLAGS} - {'E1'}],
                  'an_id, sub_code, table_name')}) k
              LEFT JOIN flagged f ON f.table_name = k.table_name AND f.flag = k.sub_code
              UNION ALL SELECT 'AN-15', 'E1', count(DISTINCT session_id) FROM silver_events
              WHERE list_contains(string_split(dq_flag, ','), 'E1')
              UNION ALL SELECT 'AN-04', NULL, count(*) FROM silver_orders o
              WHERE NOT EXISTS (SELECT 1 FROM silver_items i WHERE i.order_id = o.order_id)
              UNION ALL SELECT 'AN-06', 'P1_P2_P3', count(*) FROM silver_payments
              WHERE dq_flag SIMILAR TO '.*P[123].*'
              UNION ALL SELECT 'AN-07', NULL, count(*) FROM due JOIN paid USING (order_id)
              WHERE abs(due.total - paid.total) > 0.01
              UNION ALL SELECT 'AN-08', NULL, count(*) FROM (SELECT review_id FROM silver_reviews
                WHERE review_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT order_id) > 1)
              UNION ALL SELECT 'AN-10', 'missing_translation_categories',
                count(DISTINCT product_category_name) FROM untranslated
              UNION ALL SELECT 'AN-10', 'missing_translation_products', count(*) FROM untranslated
              UNION ALL SELECT 'AN-11', NULL, count(*) FROM (
                SELECT {i.CITY} AS city, lower(n_name) || ' town' AS tidy
                FROM supplier JOIN nation ON s_nationkey = n_nationkey) WHERE city <> tidy
              UNION ALL SELECT 'AN-12', NULL, coalesce(sum(n - 1), 0) FROM (
                SELECT count(*) AS n FROM customer
                GROUP BY c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)), c_custkey, c_mktsegment)
              UNION ALL SELECT 'AN-14', 'orders_source_excluded', count(*) FROM late WHERE is_late
              UNION ALL SELECT 'AN-14', 'reviews_source_excluded', count(*) FROM newest_reviews
              WHERE {safe_cast('review_answer_timestamp', 'TIMESTAMP')} > TIMESTAMP '{CUTOFF}'
              UNION ALL SELECT 'AN-14', 'silver_post_cutoff_expected', count(*) FROM silver_orders
              WHERE greatest(order_purchase_timestamp, order_approved_at,
                order_delivered_carrier_date, order_delivered_customer_date) > TIMESTAMP '{CUTOFF}'
              UNION ALL SELECT 'AN-14', 'reviews_silver_post_cutoff_expected', count(*)
              FROM silver_reviews WHERE review_answer_timestamp > TIMESTAMP '{CUTOFF}'
              UNION ALL SELECT 'AN-16', 'shipped_overdue_undelivered', count(*) FROM late
              WHERE order_status = 'shipped' AND order_delivered_customer_date IS NULL
                AND CAST(order_estimated_delivery_date AS DATE) <= DATE '{CUTOFF_DATE}'
              UNION ALL SELECT 'AN-16', 'post_cutoff_delivered_carrier', count(*) FROM late
              WHERE is_late AND order_delivered_carrier_date <= TIMESTAMP '{CUTOFF}'
              UNION ALL SELECT 'AN-16', 'total_overdue_undelivered', count(*) FROM fact_order
              WHERE is_overdue_undelivered)
          SELECT e.an_id, e.sub_code, e.table_name, CAST(coalesce(n, -1) AS BIGINT) AS actual_count,
            CAST(expected_count AS BIGINT) AS expected_count
          FROM (SELECT * FROM {values(seeds.ANOMALIES, 'an_id, sub_code, table_name, expected_count')}) e
          LEFT JOIN counted c ON c.an_id = e.an_id AND c.sub_code IS NOT DISTINCT FROM e.sub_code""",
        "batch_row_counts_check": f"""
          WITH actual AS (
              SELECT 'orders' AS table_name, batch_id, count(*) AS n FROM raw_orders GROUP BY 2
              UNION ALL SELECT 'order_items', batch_id, count(*) FROM raw_items GROUP BY 2
              UNION ALL SELECT 'order_payments', batch_id, count(*) FROM raw_payments GROUP BY 2
              UNION ALL SELECT 'order_reviews', batch_id, count(*) FROM raw_reviews GROUP BY 2
              {exported('customers', 'customer', 'c_custkey')}
              {exported('products', 'part', 'p_partkey')}
              {exported('sellers', 'supplier', 's_suppkey')}
              UNION ALL SELECT 'product_category_translation', '{BULK}', count(*) FROM silver_translation
              UNION ALL SELECT 'geolocation', {i.POINT_BATCH}, count(*) FROM customer GROUP BY 2
              UNION ALL SELECT 'marketing_leads', batch_id, count(*) FROM bronze_leads GROUP BY 2
              UNION ALL SELECT 'clickstream', batch_id, count(*) FROM web_lines GROUP BY 2),
            pairs AS (
              SELECT table_name, batch_id, CAST(coalesce(n, 0) AS BIGINT) AS actual_rows,
                CAST(coalesce(expected_rows, 0) AS BIGINT) AS expected_rows
              FROM (SELECT * FROM {EXPECTED_ROWS}) FULL JOIN actual USING (table_name, batch_id))
          SELECT *, actual_rows = expected_rows AS matches FROM (
            SELECT * FROM pairs
            UNION ALL SELECT table_name, 'total', CAST(sum(actual_rows) AS BIGINT),
              CAST(sum(expected_rows) AS BIGINT) FROM pairs GROUP BY 1)""",
        "layer_row_totals": f"""
          WITH counted AS ({ROW_TOTALS})
          SELECT table_name, CAST(n_rows AS BIGINT) AS n_rows FROM counted
          UNION ALL SELECT 'all', CAST(sum(n_rows) AS BIGINT) FROM counted""",
        "batch_order_check": f"""
          WITH newest AS (SELECT * FROM batch_runs QUALIFY row_number() OVER (
              PARTITION BY batch_id ORDER BY ended_at DESC, started_at DESC, run_id DESC) = 1),
            planned AS (SELECT *, lag(batch_id) OVER (ORDER BY batch_seq) AS previous_batch
              FROM {values([(b, n) for n, b in enumerate(q.RUN_BATCHES)], 'batch_id, batch_seq')})
          SELECT p.batch_id, CAST(p.batch_seq AS INT) AS batch_seq, p.previous_batch,
            n.status AS previous_status
          FROM planned p LEFT JOIN newest n ON n.batch_id = p.previous_batch
          WHERE p.previous_batch IS NOT NULL AND n.status IS DISTINCT FROM 'success'""",
        "kpi_compare": f"""
          WITH actual AS ({lead_metrics} UNION ALL SELECT table_name, slice_key, kpi_name,
              {rate_text} AS value FROM ({lead_other})),
            expected AS (
              SELECT 'kpi_lead_month' AS table_name, strftime(o_orderdate, '%Y-%m') AS slice_key,
                'n_leads' AS kpi_name, CAST(count(*) AS VARCHAR) AS value FROM orders GROUP BY 2
              UNION ALL SELECT 'kpi_lead_origin', lower(o_orderpriority), 'n_leads',
                CAST(count(*) AS VARCHAR) FROM orders GROUP BY 2)
          SELECT * FROM (
            SELECT table_name, slice_key, kpi_name, e.value AS expected, a.value AS actual,
              CASE WHEN a.kpi IS NULL THEN 'missing' WHEN e.kpi IS NULL THEN 'extra'
                WHEN e.value IS DISTINCT FROM a.value THEN 'different' END AS problem
            FROM (SELECT *, kpi_name AS kpi FROM expected) e
            FULL JOIN (SELECT *, kpi_name AS kpi FROM actual) a
              USING (table_name, slice_key, kpi_name))
          WHERE problem IS NOT NULL""",
    }


def oracle_sql() -> dict[str, str]:
    return {name: _nested(body) for name, body in _bodies().items()}


def _nested(body: str) -> str:
    """A statement with its own WITH becomes a subquery, so the shared ones go in front."""
    stripped = body.strip()
    return sql(f"SELECT * FROM ({stripped})" if stripped.startswith("WITH ") else stripped)
