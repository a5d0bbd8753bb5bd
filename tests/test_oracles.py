"""Registered queries against their SQL at the smallest scale.

``TIDEMARK_ALL_ORACLES=1`` runs every query; the default is a share of them that
still touches each model. ``tools/compare_oracles.py`` does the same from a shell.
"""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tests.support import rows_of_duckdb, rows_of_spark
from tidemark.catalog.inputs import BATCHES
from tidemark.plans.contract import columns_of
from tidemark.catalog.queries import QUERIES, TABLE_QUERIES

SF_DIR = os.environ.get("TIDEMARK_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
QUICK = (
    "parse_log_lines parse_json_lines nest_to_json batch_fingerprint route_to_batches "
    "safe_cast_date safe_cast_timestamp safe_cast_int safe_cast_decimal safe_cast_double "
    "safe_cast_boolean lenient_timestamp dq_flag_build dq_flag_has calendar_days post_cutoff_rows "
    "latest_snapshot latest_snapshot_single dedup_exact_line flag_after_purchase flag_same_instant "
    "range_join_batches nest_child_replay key_set_reconcile geo_rollup silver_leads silver_events "
    "silver_orders_flags silver_items_flags silver_payments_flags silver_reviews_flags "
    "silver_products_flags fact_order fact_session kpi_funnel_day kpi_lead_origin "
    "kpi_delivery_month kpi_sales_state_month orphans_vs_expected batch_order_check "
    "versioned_publish catalog_overwrite incremental_orders csv_records routed_leads raw_verification "
    "kpi_second_route"
).split()
ALL = list(QUERIES)
NAMES = ALL if os.environ.get("TIDEMARK_ALL_ORACLES") else QUICK

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(ALL) <= set(contract.oracle_sql())
    assert set(QUICK) <= set(ALL)


@needs_data
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, duck, name):
    columns, rows = rows_of_spark(contract.queries()[name](spark, SF_DIR))
    want_columns, want = rows_of_duckdb(duck.execute(contract.oracle_sql()[name]))
    assert columns == want_columns
    assert rows == want and rows


@needs_data
@pytest.mark.parametrize("key", ["silver_orders_flags", "fact_order", "kpi_delivery_state_month"])
def test_tables_keep_their_contract(spark, key):
    assert contract.queries()[key](spark, SF_DIR).columns == columns_of(TABLE_QUERIES[key])


@needs_data
def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert rows and BATCHES.cutoff_date >= str(max(r.session_date for r in rows))


@needs_data
@pytest.mark.parametrize("key", ["kpi_sales_month", "kpi_delivery_month", "fact_order"])
def test_models_read_finished_tables(spark, key):
    plan = contract.queries()[key](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("Relation [") <= 4 and "lineitem" not in plan
