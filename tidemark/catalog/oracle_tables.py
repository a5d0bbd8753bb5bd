"""The same tables in SQL, as named subqueries over the driver tables.

``sql(body)`` puts in front of a statement the subqueries it needs, directly or
through others.
"""

from __future__ import annotations

import re

from tidemark.catalog import inputs as i
from tidemark.functions import casting as c
from tidemark.functions.measures import SMALL_GROUP, SMALL_MONTH_ORDERS
from tidemark.sources.raw_leads import DEAL_FIELDS, LEAD_FIELDS
from tidemark.sources.raw_logs import LOG_LINE

BULK, *_, FINAL = i.BATCHES.ids


def exported_in(key: str) -> str:
    """The batch of the newest export of a row."""
    return f"CASE WHEN {i.REEXPORTED.format(key)} THEN '{i.LATER}' ELSE '{BULK}' END AS batch_id"


CUTOFF_DATE = i.BATCHES.cutoff_date
CUTOFF = i.BATCHES.cutoff_timestamp


def batch_of(instant: str) -> str:
    cases = " ".join(
        f"WHEN {instant} <= TIMESTAMP '{b.last_instant}' THEN '{b.batch_id}'"
        for b in i.BATCHES.batches
    )
    return f"CASE {cases} END"


def seq_of(batch: str) -> str:
    cases = " ".join(f"WHEN '{b}' THEN {n}" for n, b in enumerate(i.BATCHES.ids))
    return f"CASE {batch} {cases} END"


def safe_cast(value: str, kind: str) -> str:
    text = f"trim(CAST({value} AS VARCHAR))"
    upper = kind.upper()
    if upper == "DATE":
        return f"CASE WHEN regexp_matches({text}, '{c.DATE_FORM}') THEN TRY_CAST({text} AS DATE) END"
    if upper == "TIMESTAMP":
        return (
            f"CASE WHEN regexp_matches({text}, '{c.TIMESTAMP_FORM}') "
            f"THEN TRY_CAST({text} AS TIMESTAMP) END"
        )
    if upper in ("INT", "BIGINT"):
        return (
            f"CASE WHEN regexp_matches({text}, '{c.INTEGER_FORM}') THEN TRY_CAST({text} AS {kind}) END"
        )
    if upper.startswith("DECIMAL"):
        return (
            f"CASE WHEN regexp_matches({text}, '{c.PLAIN_NUMBER_FORM}') "
            f"THEN TRY_CAST({text} AS {kind}) WHEN regexp_matches({text}, '{c.EXPONENT_FORM}') "
            f"THEN TRY_CAST(TRY_CAST({text} AS DOUBLE) AS {kind}) END"
        )
    if upper == "DOUBLE":
        return f"CASE WHEN regexp_matches({text}, '{c.NUMBER_FORM}') THEN TRY_CAST({text} AS DOUBLE) END"
    if upper == "BOOLEAN":
        return (
            f"CASE WHEN lower({text}) IN ('true', '1') THEN true "
            f"WHEN lower({text}) IN ('false', '0') THEN false END"
        )
    raise ValueError(kind)


def number_boolean(value: str) -> str:
    return (
        f"CASE WHEN lower({value}) IN ('true', '1', '1.0') THEN true "
        f"WHEN lower({value}) IN ('false', '0', '0.0') THEN false END"
    )


def blank(value: str) -> str:
    return f"nullif(trim({value}), '')"


def ratio(numerator: str, denominator: str) -> str:
    return f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0)"


def codes(separator: str, pairs: list[tuple[str, str]]) -> str:
    parts = ", ".join(f"CASE WHEN {condition} THEN '{code}' END" for code, condition in pairs)
    return f"nullif(concat_ws('{separator}', {parts}), '')"


def has(flag: str) -> str:
    return f"coalesce(list_contains(string_split(dq_flag, ','), '{flag}'), false)"


def failed(raw: str, column: str) -> tuple[str, str]:
    return f"T1:{column}", f"{blank(raw)} IS NOT NULL AND {column} IS NULL"


def count_where(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


def sum_where(condition: str, value: str, name: str) -> str:
    return f"CAST(coalesce(sum({value}) FILTER (WHERE {condition}), 0) AS BIGINT) AS {name}"


def group(n: int) -> str:
    return f"regexp_extract(raw_line, '{LOG_LINE}', {n})"


STAMP, DAY = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')", "strftime(ts, '%Y%m%d')"
MIDNIGHT = i.MIDNIGHT.format

LEAD_REJECT = codes(
    ";",
    [
        ("MISSING_MQL_ID", f"{blank('mql_id')} IS NULL"),
        ("MISSING_FIRST_CONTACT_DATE", f"{blank('first_contact_date')} IS NULL"),
        (
            "INVALID_FIRST_CONTACT_DATE",
            f"{blank('first_contact_date')} IS NOT NULL "
            f"AND ({safe_cast('first_contact_date', 'DATE')}) IS NULL",
        ),
        ("MISSING_LANDING_PAGE_ID", f"{blank('landing_page_id')} IS NULL"),
    ],
)
EVENT_REJECT = codes(
    ";",
    [
        ("unparsed_log_line", "NOT is_parsed"),
        ("missing_session_id", f"{blank('session_id')} IS NULL"),
        ("missing_event_ts", "event_ts IS NULL"),
        ("missing_event_type", f"{blank('event_type')} IS NULL"),
        ("missing_user_id", f"{blank('user_id')} IS NULL"),
    ],
)
LEAD_TYPED = (
    "won_date",
    "has_company",
    "has_gtin",
    "declared_product_catalog_size",
    "declared_monthly_revenue",
)
CATEGORIES = (
    "business_segment",
    "lead_type",
    "lead_behaviour_profile",
    "average_stock",
    "business_type",
)
CATALOG_SIZE = safe_cast("d_declared_product_catalog_size", "DOUBLE")


def _json_member(name: str, value: str) -> str:
    return f"""'"{name}":"' || {value} || '"'"""


DEAL_JSON = (
    """CASE WHEN has_deal THEN '"deal":{' || concat_ws(',', """
    + ", ".join(_json_member(n, f"d_{n}") for n in DEAL_FIELDS)
    + ") || '}' END"
)
RAW_JSON = (
    "'{' || concat_ws(',', "
    + ", ".join(_json_member(n, n) for n in LEAD_FIELDS)
    + f", {DEAL_JSON}) || '}}'"
)
DEALS = ", ".join(f"d_{n}" for n in DEAL_FIELDS)

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def happened(value: str) -> str:
    return f"CASE WHEN {value} <= TIMESTAMP '{CUTOFF}' THEN {value} END"


def _typed(columns: dict[str, str]) -> str:
    return ", ".join(
        f"{whole_number(f'r.{n}') if kind == WHOLE else safe_cast(f'r.{n}', kind)} AS {n}"
        for n, kind in columns.items()
    )


WHOLE = "whole number"


def whole_number(value: str) -> str:
    number = safe_cast(value, "DOUBLE")
    return f"CASE WHEN {number} = floor({number}) THEN TRY_CAST({number} AS INT) END"


ITEM_TYPES = {
    "order_item_id": "INT",
    "shipping_limit_date": "TIMESTAMP",
    "price": "DECIMAL(10, 2)",
    "freight_value": "DECIMAL(10, 2)",
}
PAYMENT_TYPES = {
    "payment_sequential": "INT",
    "payment_installments": "INT",
    "payment_value": "DECIMAL(10, 2)",
}
REVIEW_TYPES = {
    "review_score": WHOLE,
    "review_creation_date": "TIMESTAMP",
    "review_answer_timestamp": "TIMESTAMP",
}

SALES = f"""
  count(*) AS n_orders_total,
  {count_where('is_canceled', 'n_canceled_orders')},
  {count_where('is_valid_order', 'n_valid_orders')},
  CAST(coalesce(sum(order_revenue) FILTER (WHERE is_valid_order), 0) AS DECIMAL(30,2)) AS sum_revenue
"""
DELIVERED_LATE = "is_delivered_order AND is_late"
DELIVERED_ON_TIME = "is_delivered_order AND NOT is_late"
DELIVERY = f"""
  {count_where('is_valid_order', 'n_valid_orders')},
  {count_where('is_delivered_order', 'n_delivered')},
  {sum_where('is_delivered_order', 'delivery_days', 'sum_delivery_days')},
  {count_where(DELIVERED_LATE, 'n_late')},
  {count_where(DELIVERED_ON_TIME, 'n_on_time')},
  {count_where('is_delivered_order AND shipping_days IS NOT NULL', 'n_shipping_measured')},
  {sum_where('is_delivered_order', 'shipping_days', 'sum_shipping_days')},
  {count_where('review_score IS NOT NULL', 'n_scored')},
  {sum_where('true', 'review_score', 'sum_score')},
  {count_where('review_score IS NOT NULL AND ' + DELIVERED_ON_TIME, 'n_scored_on_time')},
  {sum_where(DELIVERED_ON_TIME, 'review_score', 'sum_score_on_time')},
  {count_where('review_score IS NOT NULL AND ' + DELIVERED_LATE, 'n_scored_late')},
  {sum_where(DELIVERED_LATE, 'review_score', 'sum_score_late')},
  {count_where('is_overdue_undelivered', 'n_overdue_undelivered')}
"""
DELIVERY_NAMES = re.findall(r"AS (\w+)\s*(?:,|$)", DELIVERY.replace("AS BIGINT", ""))
DELIVERY_RATES = f"""
  {ratio('sum_delivery_days', 'n_delivered')} AS avg_delivery_days,
  {ratio('n_late', 'n_delivered')} AS late_rate,
  {ratio('sum_score', 'n_scored')} AS avg_score,
  {ratio('sum_shipping_days', 'n_shipping_measured')} AS avg_shipping_days,
  ({ratio('sum_score_on_time', 'n_scored_on_time')})
    - ({ratio('sum_score_late', 'n_scored_late')}) AS score_gap,
  n_delivered AS n_obs
"""
GAP = f"n_scored_on_time < {SMALL_GROUP} OR n_scored_late < {SMALL_GROUP} AS is_small_gap_group"
MEASURED = "has_deal AND NOT is_close_time_excluded AND days_to_close IS NOT NULL"
LEAD_FIGURES = f"""
  count(*) AS n_leads,
  {count_where('has_deal', 'n_leads_with_deal')},
  {count_where(MEASURED, 'n_close_time_valid_deals')},
  {sum_where(MEASURED, 'days_to_close', 'sum_days_to_close')},
  {count_where('NOT is_close_time_excluded', 'n_leads_not_excluded')},
  {count_where(MEASURED + ' AND days_to_close <= 30', 'n_won_30d')}
"""
LEAD_RATES = f"""
  {ratio('n_leads_with_deal', 'n_leads')} AS lead_to_deal_rate,
  {ratio('sum_days_to_close', 'n_close_time_valid_deals')} AS avg_days_to_close,
  {ratio('n_won_30d', 'n_leads_not_excluded')} AS won_30d_rate,
  n_leads_with_deal AS n_obs, n_leads_with_deal < {SMALL_GROUP} AS is_small_sample
"""
REACH = "has_home AND has_product_view"
FUNNEL = f"""
  count(*) AS n_sessions,
  {count_where('has_home', 'n_reach_home')},
  {count_where(REACH, 'n_reach_view')},
  {count_where(REACH + ' AND has_add_to_cart', 'n_reach_cart')},
  {count_where(REACH + ' AND has_add_to_cart AND has_purchase', 'n_reach_purchase')},
  {count_where('has_purchase', 'n_purchase_sessions')},
  {count_where('has_add_to_cart', 'n_cart_sessions')},
  {count_where('has_add_to_cart AND NOT has_purchase', 'n_cart_abandoned_sessions')},
  {count_where('n_events >= 2', 'n_sessions_ge2')},
  {sum_where('n_events >= 2', 'duration_seconds', 'sum_duration_seconds')}
"""
FUNNEL_RATES = f"""
  {ratio('n_purchase_sessions', 'n_sessions')} AS conversion_rate,
  {ratio('n_cart_abandoned_sessions', 'n_cart_sessions')} AS abandon_rate,
  {ratio('sum_duration_seconds', 'n_sessions_ge2')} AS avg_duration_seconds,
  {ratio('n_reach_view', 'n_reach_home')} AS step_rate_home_view,
  {ratio('n_reach_cart', 'n_reach_view')} AS step_rate_view_cart,
  {ratio('n_reach_purchase', 'n_reach_cart')} AS step_rate_cart_purchase,
  n_sessions AS n_obs, n_sessions < {SMALL_GROUP} AS is_small_sample
"""


def session_rollup(events: str) -> str:
    return f"""
      SELECT session_id, CAST(min(event_ts) AS DATE) AS session_date,
        min(event_ts) AS first_event_ts,
        CAST(floor((epoch_us(max(event_ts)) - epoch_us(min(event_ts))) / 1000000) AS BIGINT)
          AS duration_seconds,
        count(*) AS n_events,
        bool_or(event_type = 'home') AS has_home,
        bool_or(event_type = 'product_view') AS has_product_view,
        bool_or(event_type = 'add_to_cart') AS has_add_to_cart,
        bool_or(event_type = 'purchase') AS has_purchase,
        arg_min(order_id, (event_ts, order_id))
          FILTER (WHERE event_type = 'purchase' AND order_id IS NOT NULL) AS order_id,
        CAST(sum(amount) FILTER (WHERE event_type = 'purchase') AS DECIMAL(20,2)) AS purchase_amount
      FROM {events} GROUP BY session_id"""


TABLES = {
    # --- web events
    "shifted_events": f"""
      SELECT event_id, user_id, event_type, value, props,
        CASE WHEN event_id % 11 = 0
          THEN CAST(date_trunc('day', ts - INTERVAL {i.EVENT_SHIFT_DAYS} DAY) AS TIMESTAMP)
          ELSE ts - INTERVAL {i.EVENT_SHIFT_DAYS} DAY END AS ts
      FROM events""",
    "sent_lines": f"""
      SELECT {i.web_line(STAMP, DAY)} AS raw_line, {batch_of('ts')} AS batch_id,
        'access_log.txt' AS source_file, event_id
      FROM shifted_events""",
    "web_lines": f"""
      SELECT raw_line, batch_id, source_file FROM sent_lines
      UNION ALL
      SELECT raw_line, '{FINAL}', 'resent_log.txt' FROM sent_lines WHERE event_id % 20 = 3""",
    "bronze_events": f"""
      SELECT {group(2)} AS user_id, {group(3)} AS session_id,
        nullif({group(4)}, 'N/A') AS order_id, nullif({group(6)}, 'N/A') AS product_id,
        nullif({group(8)}, 'N/A') AS outcome, {group(5)} AS event_type,
        TRY_CAST(nullif({group(7)}, 'N/A') AS DOUBLE) AS amount,
        CASE WHEN regexp_matches({group(1)}, '\\.\\d{{1,6}}$')
          THEN TRY_CAST({group(1)} AS TIMESTAMP) END AS event_ts,
        raw_line,
        {group(1)} <> '' AND {group(3)} <> '' AND {group(2)} <> '' AS is_parsed,
        batch_id, source_file
      FROM web_lines""",
    "evaluated_events": f"SELECT *, {EVENT_REJECT} AS reject_reason FROM bronze_events",
    "unique_events": f"""
      SELECT trim(user_id) AS user_id, trim(session_id) AS session_id,
        {blank('order_id')} AS order_id, {blank('product_id')} AS product_id,
        {blank('outcome')} AS outcome, trim(event_type) AS event_type,
        amount AS amount_raw, TRY_CAST(amount AS DECIMAL(10,2)) AS amount,
        event_ts, source_file, batch_id
      FROM (SELECT *, row_number() OVER (
              PARTITION BY raw_line ORDER BY {seq_of('batch_id')}, source_file) AS rn
            FROM evaluated_events WHERE reject_reason IS NULL)
      WHERE rn = 1""",
    "silver_events": f"""
      SELECT session_id || '|' || strftime(event_ts, '%Y-%m-%d %H:%M:%S') || '|' || event_type
          || '|' || coalesce(product_id, 'none') AS event_id,
        session_id, user_id, event_ts, CAST(event_ts AS DATE) AS event_date, event_type,
        product_id, order_id, amount, outcome,
        {codes(',', [('E1', 'event_ts > bought_at'), ('E2', 'n_same > 1'),
                     ('T1:amount', 'amount_raw IS NOT NULL AND amount IS NULL')])} AS dq_flag,
        source_file, batch_id
      FROM (SELECT *,
              min(CASE WHEN event_type = 'purchase' THEN event_ts END)
                OVER (PARTITION BY session_id) AS bought_at,
              count(*) OVER (PARTITION BY session_id, event_ts) AS n_same
            FROM unique_events)""",
    "session_events": f"""
      SELECT event_id, CAST(user_id AS VARCHAR) || '-' || {DAY} AS session_id, ts AS event_ts,
        {i.EVENT_KIND} AS event_type,
        CASE WHEN event_type = 'purchase' THEN CAST(event_id * 2 AS VARCHAR) END AS order_id,
        CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(10,2)) END AS amount
      FROM shifted_events WHERE event_type <> 'error'""",
    # --- leads
    "lead_parents": f"""
      SELECT CAST(o_orderkey AS VARCHAR) AS mql_id,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS first_contact_date,
        {i.LANDING_PAGE} AS landing_page_id, {i.ORIGIN} AS origin
      FROM orders""",
    "deal_children": f"""
      SELECT CAST(l_orderkey AS VARCHAR) AS mql_id,
        {', '.join(f'{i.DEAL_TEXT[n]} AS d_{n}' for n in DEAL_FIELDS)}
      FROM lineitem""",
    "first_deals": f"""
      SELECT *, {batch_of('TRY_CAST(d_won_date AS TIMESTAMP)')} AS deal_batch
      FROM deal_children
      QUALIFY row_number() OVER (PARTITION BY mql_id
        ORDER BY {', '.join(f'd_{n}' for n in i.FIRST_DEAL)}) = 1""",
    "leads_and_deals": f"""
      SELECT p.*, d.* EXCLUDE (mql_id),
        {batch_of('TRY_CAST(p.first_contact_date AS TIMESTAMP)')} AS own_batch
      FROM lead_parents p LEFT JOIN first_deals d ON p.mql_id = d.mql_id""",
    "replayed_leads": f"""
      SELECT mql_id, first_contact_date, landing_page_id, origin, true AS has_deal, {DEALS},
        deal_batch AS batch_id
      FROM leads_and_deals WHERE deal_batch IS NOT NULL
      UNION ALL
      SELECT mql_id, first_contact_date, landing_page_id, origin, false,
        {', '.join('NULL' for _ in DEAL_FIELDS)}, own_batch
      FROM leads_and_deals WHERE own_batch IS NOT NULL AND own_batch IS DISTINCT FROM deal_batch""",
    "spoiled_leads": f"""
      SELECT *, {RAW_JSON} AS raw_json FROM (
        SELECT CAST(mql_id AS BIGINT) AS lead_key, {i.SPOILED_MQL_ID} AS mql_id,
          {i.SPOILED_CONTACT} AS first_contact_date, landing_page_id, origin, has_deal, {DEALS},
          batch_id, 'marketing_leads.jsonl' AS source_file
        FROM (SELECT *, CAST(mql_id AS BIGINT) AS lead_key FROM replayed_leads))""",
    "bronze_leads": f"""
      SELECT {', '.join(f'CASE WHEN is_parsed THEN {n} END AS {n}' for n in LEAD_FIELDS)},
        is_parsed AND has_deal AS has_deal,
        {', '.join(f'CASE WHEN is_parsed THEN d_{n} END AS d_{n}' for n in DEAL_FIELDS)},
        raw_json, is_parsed, batch_id, source_file
      FROM (SELECT * EXCLUDE (raw_json), {i.SPOILED_JSON} AS raw_json,
              lead_key % 401 <> 0 AS is_parsed FROM spoiled_leads)""",
    "evaluated_leads": f"""
      SELECT *, {LEAD_REJECT} AS reject_reason FROM bronze_leads WHERE is_parsed""",
    "typed_leads": f"""
      SELECT trim(mql_id) AS mql_id, {safe_cast('first_contact_date', 'DATE')} AS first_contact_date,
        trim(landing_page_id) AS landing_page_id,
        coalesce(lower({blank('origin')}), 'unknown') AS origin, has_deal,
        {', '.join(f"{blank(f'd_{n}')} AS {n}" for n in ('seller_id', 'sdr_id', 'sr_id'))},
        {safe_cast('d_won_date', 'TIMESTAMP')} AS won_date,
        {', '.join(f"CASE WHEN has_deal THEN coalesce({blank(f'd_{n}')}, 'unknown') END AS {n}"
                   for n in CATEGORIES)},
        {number_boolean('d_has_company')} AS has_company, {number_boolean('d_has_gtin')} AS has_gtin,
        CASE WHEN ({CATALOG_SIZE}) = floor({CATALOG_SIZE}) THEN CAST({CATALOG_SIZE} AS INT) END
          AS declared_product_catalog_size,
        {safe_cast('d_declared_monthly_revenue', 'DECIMAL(14, 2)')} AS declared_monthly_revenue,
        {', '.join(f'd_{n}' for n in LEAD_TYPED)}, source_file, batch_id
      FROM (SELECT *, {seq_of('batch_id')} AS seq,
              max({seq_of('batch_id')}) OVER (PARTITION BY trim(mql_id)) AS last_seq
            FROM evaluated_leads WHERE reject_reason IS NULL)
      WHERE seq = last_seq""",
    "silver_leads": f"""
      SELECT * EXCLUDE ({', '.join(f'd_{n}' for n in LEAD_TYPED)}),
        {codes(',', [('C1', 'CAST(won_date AS DATE) < first_contact_date')]
               + [failed(f'd_{n}', n) for n in LEAD_TYPED])} AS dq_flag
      FROM typed_leads""",
    # --- orders
    "order_times": """
      SELECT l_orderkey, min(l_shipdate) FILTER (WHERE l_returnflag = 'N') AS approved,
        min(l_shipdate) FILTER (WHERE l_returnflag = 'A') AS carrier,
        max(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS customer
      FROM lineitem GROUP BY 1""",
    "dated_orders": f"""
      SELECT *, coalesce(customer > o_orderdate AND arrived_in <> bought_in, false) AS later FROM (
        SELECT o.*, t.* EXCLUDE (l_orderkey),
          o_orderdate + INTERVAL {i.ESTIMATE_DAYS} DAY AS estimate,
          {batch_of('o_orderdate')} AS bought_in, {batch_of('customer')} AS arrived_in
        FROM orders o LEFT JOIN order_times t ON o_orderkey = l_orderkey)
      WHERE bought_in IS NOT NULL""",
    "order_versions": """
      SELECT *, CASE WHEN later THEN arrived_in ELSE bought_in END AS batch_id, true AS is_final
      FROM dated_orders
      UNION ALL SELECT *, bought_in, false FROM dated_orders WHERE later""",
    "raw_orders": f"""
      SELECT {i.ORDER_ID} AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
        CASE WHEN is_final THEN {i.ORDER_STATUS} ELSE 'shipped' END AS order_status,
        {MIDNIGHT('o_orderdate')} AS order_purchase_timestamp,
        {i.APPROVED} AS order_approved_at, {MIDNIGHT('carrier')} AS order_delivered_carrier_date,
        CASE WHEN is_final THEN {MIDNIGHT('customer')} END AS order_delivered_customer_date,
        {MIDNIGHT('estimate')} AS order_estimated_delivery_date,
        'orders.csv' AS source_file, batch_id
      FROM order_versions""",
    "latest_orders": f"""
      SELECT {blank('order_id')} AS order_id, {blank('customer_id')} AS customer_id,
        {blank('order_status')} AS order_status,
        {', '.join(f"{safe_cast(n, 'TIMESTAMP')} AS {n}" for n in ORDER_TIMES)},
        {', '.join(f'{n} AS raw_{n}' for n in ORDER_TIMES)}, source_file, batch_id
      FROM (SELECT *, {seq_of('batch_id')} AS seq,
              max({seq_of('batch_id')}) OVER (PARTITION BY trim(order_id)) AS last_seq
            FROM raw_orders)
      WHERE seq = last_seq""",
    "silver_orders": f"""
      SELECT order_id, customer_id, order_status, order_purchase_timestamp, approved AS order_approved_at,
        carrier AS order_delivered_carrier_date, customer AS order_delivered_customer_date,
        order_estimated_delivery_date,
        {codes(',', [
            ('D1', "order_status = 'delivered' AND customer IS NULL"),
            ('D2', "order_status <> 'delivered' AND customer IS NOT NULL"),
            ('D3', 'carrier < order_purchase_timestamp'),
            ('D4', 'customer < carrier'),
            ('D5', "order_status = 'delivered' AND approved IS NULL"),
            ('D6', 'carrier < approved'),
            ('D7', "order_status = 'delivered' AND carrier IS NULL"),
        ] + [failed(f'raw_{n}', n) for n in ORDER_TIMES])} AS dq_flag,
        source_file, batch_id
      FROM (SELECT * REPLACE (CASE WHEN order_status = 'delivered'
                AND order_delivered_customer_date > TIMESTAMP '{CUTOFF}'
              THEN CASE WHEN carrier IS NOT NULL THEN 'shipped'
                WHEN approved IS NOT NULL THEN 'approved' ELSE 'created' END
              ELSE order_status END AS order_status)
            FROM (SELECT *, {happened('order_approved_at')} AS approved,
                    {happened('order_delivered_carrier_date')} AS carrier,
                    {happened('order_delivered_customer_date')} AS customer
                  FROM latest_orders))""",
    "raw_items": f"""
      SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
        CAST(product AS VARCHAR) AS product_id, CAST(seller AS VARCHAR) AS seller_id,
        {MIDNIGHT('lim')} AS shipping_limit_date, {i.ITEM_PRICE} AS price,
        CAST(freight AS VARCHAR) AS freight_value, 'order_items.csv' AS source_file,
        {batch_of('lim')} AS batch_id
      FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS product, min(l_suppkey) AS seller,
              max(l_shipdate) AS lim,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(12,2)) AS price,
              CAST(sum(CAST(l_quantity AS DECIMAL(10,2))) AS DECIMAL(12,2)) AS freight
            FROM lineitem GROUP BY 1, 2)
      WHERE {batch_of('lim')} IS NOT NULL""",
    "silver_items": f"""
      SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price,
        freight_value,
        {codes(',', [('I1', "date_diff('day', bought, CAST(shipping_limit_date AS DATE)) > 148")]
               + [failed(f'raw_{n}', n) for n in ITEM_TYPES])} AS dq_flag,
        source_file, batch_id
      FROM (SELECT r.order_id, r.product_id, r.seller_id, {_typed(ITEM_TYPES)},
              {', '.join(f'r.{n} AS raw_{n}' for n in ITEM_TYPES)}, r.source_file, r.batch_id,
              CAST(o.order_purchase_timestamp AS DATE) AS bought
            FROM raw_items r LEFT JOIN silver_orders o ON r.order_id = o.order_id)""",
    "raw_payments": f"""
      SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
        CAST(l_linenumber AS VARCHAR) AS payment_sequential, {i.PAYMENT_TYPE} AS payment_type,
        CAST(l_linenumber - 1 AS VARCHAR) AS payment_installments,
        {i.PAYMENT_VALUE} AS payment_value, 'order_payments.csv' AS source_file,
        {batch_of('l_shipdate')} AS batch_id
      FROM lineitem WHERE {batch_of('l_shipdate')} IS NOT NULL""",
    "silver_payments": f"""
      SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value,
        {codes(',', [('P1', "payment_type = 'not_defined'"), ('P2', 'payment_value = 0'),
                     ('P3', 'payment_installments = 0')])} AS dq_flag,
        source_file, batch_id
      FROM (SELECT r.order_id, r.payment_type, {_typed(PAYMENT_TYPES)}, r.source_file, r.batch_id
            FROM raw_payments r)""",
    "routed_reviews": f"""
      SELECT *, {batch_of('created')} AS routed FROM (
        SELECT *, l_shipdate + INTERVAL {i.REVIEW_DELAY_DAYS} DAY AS created FROM lineitem)
      WHERE {batch_of('created')} IS NOT NULL""",
    "raw_reviews": f"""
      SELECT {i.REVIEW_ID} AS review_id, CAST(l_orderkey AS VARCHAR) AS order_id,
        {i.REVIEW_SCORE} AS review_score, CAST(NULL AS VARCHAR) AS review_comment_title,
        'flag ' || l_returnflag AS review_comment_message,
        {MIDNIGHT('created')} AS review_creation_date,
        CASE WHEN is_final THEN {i.REVIEW_ANSWER} END AS review_answer_timestamp,
        'order_reviews.csv' AS source_file, batch_id
      FROM (SELECT *, true AS is_final, routed AS batch_id FROM routed_reviews
            UNION ALL
            SELECT *, false, '{BULK}' FROM routed_reviews
            WHERE l_suppkey % 10 = 0 AND routed <> '{BULK}')""",
    "silver_reviews": f"""
      SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
        review_creation_date, {happened('review_answer_timestamp')} AS review_answer_timestamp,
        {codes(',', [('R2', 'CAST(review_creation_date AS DATE) < bought')]
               + [failed(f'raw_{n}', n) for n in REVIEW_TYPES])} AS dq_flag,
        source_file, batch_id
      FROM (SELECT r.review_id, r.order_id, r.review_comment_title, r.review_comment_message,
              {_typed(REVIEW_TYPES)}, {', '.join(f'r.{n} AS raw_{n}' for n in REVIEW_TYPES)},
              r.source_file, r.batch_id, CAST(o.order_purchase_timestamp AS DATE) AS bought
            FROM (SELECT *, {seq_of('batch_id')} AS seq,
                    max({seq_of('batch_id')}) OVER (PARTITION BY review_id, order_id) AS last_seq
                  FROM raw_reviews) r
            LEFT JOIN silver_orders o ON r.order_id = o.order_id
            WHERE r.seq = r.last_seq)""",
    # --- reference data
    "silver_translation": f"""
      SELECT DISTINCT lower(p_type) AS product_category_name,
        'en_' || lower(p_type) AS product_category_name_english,
        'translation.csv' AS source_file, '{BULK}' AS batch_id
      FROM part WHERE lower(p_type) <> 'promo'""",
    "silver_products": f"""
      SELECT p.product_id, p.product_category_name, t.product_category_name_english AS product_category_en,
        product_name_length, product_description_length, product_photos_qty,
        nullif(weight, 0) AS product_weight_g, product_length_cm, product_height_cm,
        product_width_cm,
        {codes(',', [('PR1', 'p.product_category_name IS NULL'), ('PR2', 'weight = 0'),
                     ('PR3', 'product_length_cm IS NULL')])} AS dq_flag,
        'products.csv' AS source_file, {exported_in('p_partkey')}
      FROM (SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS product_id, {i.CATEGORY} AS product_category_name,
              CAST(length(p_name) AS INT) AS product_name_length,
              CAST(p_size * 10 AS INT) AS product_description_length,
              CAST(p_size % 5 AS INT) AS product_photos_qty, CAST(p_size - 1 AS INT) AS weight,
              CAST(nullif(p_size % 7, 0) AS INT) AS product_length_cm,
              CAST(p_size AS INT) AS product_height_cm, CAST(p_size + 1 AS INT) AS product_width_cm
            FROM part) p
      LEFT JOIN silver_translation t ON p.product_category_name = t.product_category_name""",
    "silver_customers": f"""
      SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
        lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
        lower(n_name) || ' town' AS customer_city, r_name AS customer_state,
        'customers.csv' AS source_file, {exported_in('c_custkey')}
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN region ON n_regionkey = r_regionkey""",
    "silver_sellers": f"""
      SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
        lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
        lower(n_name) || ' town' AS seller_city, r_name AS seller_state,
        'sellers.csv' AS source_file, {exported_in('s_suppkey')}
      FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
      LEFT JOIN region ON n_regionkey = r_regionkey""",
    # --- gold
    "dim_date": f"""
      SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
        strftime(d, '%Y-%m') AS year_month
      FROM (SELECT unnest(generate_series(CAST(least(
          (SELECT min(order_purchase_timestamp) FROM silver_orders),
          (SELECT min(first_contact_date) FROM silver_leads),
          (SELECT min(event_ts) FROM silver_events)) AS DATE),
        DATE '{CUTOFF_DATE}', INTERVAL 1 DAY)) AS d)""",
    "order_items_rollup": """
      SELECT order_id, count(*) AS n_items, CAST(sum(price) AS DECIMAL(20,2)) AS order_revenue
      FROM silver_items WHERE price > 0 GROUP BY order_id""",
    "chosen_reviews": f"""
      SELECT order_id, review_score FROM silver_reviews
      WHERE review_score IS NOT NULL AND review_answer_timestamp IS NOT NULL AND NOT {has('R2')}
      QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC,
        CAST(review_creation_date AS DATE) DESC, review_id DESC) = 1""",
    "fact_order": f"""
      SELECT order_id, customer_id, order_status, bought AS purchase_date, n_items, order_revenue,
        NOT is_canceled AND n_items > 0 AS is_valid_order, is_canceled,
        delivered AS is_delivered_order,
        CASE WHEN delivered THEN CAST(date_diff('day', bought, arrived) AS INT) END AS delivery_days,
        CASE WHEN delivered THEN CAST(date_diff('day', sent, arrived) AS INT) END AS shipping_days,
        CASE WHEN delivered THEN arrived > estimate END AS is_late,
        coalesce(order_status = 'shipped' AND arrived IS NULL
          AND estimate <= DATE '{CUTOFF_DATE}', false) AS is_overdue_undelivered,
        review_score, batch_id
      FROM (SELECT o.order_id, o.customer_id, o.order_status,
              CAST(order_purchase_timestamp AS DATE) AS bought,
              CAST(order_delivered_carrier_date AS DATE) AS sent,
              CAST(order_delivered_customer_date AS DATE) AS arrived,
              CAST(order_estimated_delivery_date AS DATE) AS estimate,
              coalesce(n_items, 0) AS n_items,
              CAST(coalesce(order_revenue, 0) AS DECIMAL(20,2)) AS order_revenue,
              coalesce(order_status IN ('canceled', 'unavailable'), false) AS is_canceled,
              coalesce(order_status = 'delivered', false)
                AND order_delivered_customer_date IS NOT NULL
                AND NOT {has('D1')} AND NOT {has('D2')} AND NOT {has('D4')} AS delivered,
              review_score, o.batch_id
            FROM silver_orders o LEFT JOIN order_items_rollup i ON o.order_id = i.order_id
            LEFT JOIN chosen_reviews r ON o.order_id = r.order_id)""",
    "fact_order_item": """
      SELECT i.order_id, order_item_id, product_id, seller_id, price,
        CAST(order_purchase_timestamp AS DATE) AS purchase_date, i.batch_id
      FROM silver_items i LEFT JOIN silver_orders o ON i.order_id = o.order_id""",
    "fact_lead": f"""
      SELECT mql_id, first_contact_date, origin, has_deal, won_date,
        CASE WHEN has_deal THEN CAST(date_diff('day', first_contact_date, CAST(won_date AS DATE))
          AS INT) END AS days_to_close,
        {has('C1')} AS is_close_time_excluded, batch_id
      FROM silver_leads""",
    "fact_session": session_rollup("silver_events"),
    "months": "SELECT DISTINCT year_month FROM dim_date",
    "orders_by_state": """
      SELECT f.*, coalesce(trim(c.customer_state), '') AS customer_state, d.year_month
      FROM fact_order f JOIN dim_date d ON f.purchase_date = d.date
      LEFT JOIN silver_customers c ON f.customer_id = c.customer_id""",
    "sales_by_month": f"SELECT year_month, {SALES} FROM orders_by_state GROUP BY 1",
    "kpi_sales_month": f"""
      SELECT year_month, n_orders_total, n_canceled_orders, n_valid_orders, sum_revenue,
        {ratio('sum_revenue', 'n_valid_orders')} AS avg_order_value,
        {ratio('n_canceled_orders', 'n_orders_total')} AS cancel_rate,
        CASE WHEN previous >= {SMALL_MONTH_ORDERS}
          THEN {ratio('n_valid_orders - previous', 'previous')} END AS order_growth,
        n_valid_orders AS n_obs, n_valid_orders < {SMALL_MONTH_ORDERS} AS is_small_sample
      FROM (SELECT *, lag(n_valid_orders) OVER (ORDER BY year_month) AS previous FROM (
        SELECT m.year_month, coalesce(n_orders_total, 0) AS n_orders_total,
          coalesce(n_canceled_orders, 0) AS n_canceled_orders,
          coalesce(n_valid_orders, 0) AS n_valid_orders,
          CAST(coalesce(sum_revenue, 0) AS DECIMAL(30,2)) AS sum_revenue
        FROM months m LEFT JOIN sales_by_month s ON m.year_month = s.year_month))""",
    "kpi_sales_state_month": f"""
      SELECT *, {ratio('sum_revenue', 'n_valid_orders')} AS avg_order_value,
        {ratio('n_canceled_orders', 'n_orders_total')} AS cancel_rate,
        n_valid_orders AS n_obs, n_valid_orders < {SMALL_GROUP} AS is_small_sample
      FROM (SELECT customer_state, year_month, {SALES} FROM orders_by_state GROUP BY 1, 2)""",
    "delivery_by_month": f"SELECT year_month, {DELIVERY} FROM orders_by_state GROUP BY 1",
    "kpi_delivery_month": f"""
      SELECT *, {DELIVERY_RATES},
        n_valid_orders < {SMALL_MONTH_ORDERS} OR n_delivered < {SMALL_GROUP} AS is_small_sample,
        {GAP}
      FROM (SELECT m.year_month, {', '.join(f'coalesce({n}, 0) AS {n}' for n in DELIVERY_NAMES)}
            FROM months m LEFT JOIN delivery_by_month d ON m.year_month = d.year_month)""",
    "kpi_delivery_state_month": f"""
      SELECT * EXCLUDE (n_valid_orders), {DELIVERY_RATES},
        n_delivered < {SMALL_GROUP} AS is_small_sample, {GAP}
      FROM (SELECT customer_state, year_month, {DELIVERY} FROM orders_by_state GROUP BY 1, 2)""",
    "kpi_lead_month": f"""
      SELECT *, {LEAD_RATES} FROM (
        SELECT d.year_month, {LEAD_FIGURES}
        FROM fact_lead f JOIN dim_date d ON f.first_contact_date = d.date GROUP BY 1)""",
    "kpi_lead_origin": f"""
      SELECT *, {LEAD_RATES} FROM (SELECT origin, {LEAD_FIGURES} FROM fact_lead GROUP BY 1)""",
    "kpi_funnel_day": f"""
      SELECT *, {FUNNEL_RATES} FROM (
        SELECT session_date, {FUNNEL} FROM fact_session GROUP BY 1)""",
    "kpi_funnel_month": f"""
      SELECT *, {FUNNEL_RATES} FROM (
        SELECT strftime(session_date, '%Y-%m') AS year_month, {FUNNEL}
        FROM fact_session GROUP BY 1)""",
    # --- runs
    "batch_runs": f"""
      SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS batch_id,
        {i.RUN_STATUS} AS status, CAST(NULL AS VARCHAR) AS failed_model,
        event_id * 10 AS rows_in, event_id * 9 AS rows_out,
        ts - INTERVAL 5 MINUTE AS started_at, ts AS ended_at
      FROM events""",
}


def _needed(text: str, found: dict[str, None]) -> None:
    for name in set(re.findall(r"\w+", text)) & TABLES.keys():
        if name not in found:
            _needed(TABLES[name], found)
            found[name] = None


def sql(body: str) -> str:
    found: dict[str, None] = {}
    _needed(body, found)
    ordered = [name for name in TABLES if name in found]
    if not ordered:
        return body
    # a subquery used by many is computed once
    parts = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name]})" for name in ordered)
    return f"WITH {parts}\n{body}"
