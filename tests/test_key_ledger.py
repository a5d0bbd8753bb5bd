"""Sets of keys: a row in several sets at once counts as one row for each of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import inputs
from tidemark.operators import key_ledger as ledger_of

SF = "/root/testdata/sf0.001"


def test_a_row_in_several_sets_counts_in_each(spark):
    rows = spark.createDataFrame([("a", "b1"), ("a", None), ("b", None), (None, "b1"), (None, None)], "line string, batch_id string")
    routed, apart = F.col("batch_id").isNotNull(), F.col("batch_id").isNull()
    both = F.when(routed, ledger_of.RAW | ledger_of.IN_SCOPE).otherwise(ledger_of.RAW | ledger_of.EXCLUDED)
    apiece = [
        ledger_of.key_rows("t", rows, ["line"], ledger_of.RAW),
        ledger_of.key_rows("t", rows.where(routed), ["line"], ledger_of.IN_SCOPE),
        ledger_of.key_rows("t", rows.where(apart), ["line"], ledger_of.EXCLUDED),
    ]
    at_once = [ledger_of.key_rows("t", rows, ["line"], both)]
    want, got = (sorted(map(str, ledger_of.key_ledger(parts).collect())) for parts in (apiece, at_once))
    assert got == want
    total = ledger_of.ledger_totals(ledger_of.key_ledger(at_once)).first()
    assert (total.n_rows, total.n_excluded) == (2, 3)


def test_leads_with_fewer_deal_fields_are_the_same_rows(spark):
    whole = inputs.replayed_leads(spark, SF)
    narrow = inputs.replayed_leads(spark, SF, inputs.FIRST_DEAL)
    plain = lambda rows: sorted(map(str, rows.select("mql_id", "batch_id", "deal.won_date", "deal.seller_id").collect()))
    assert narrow.schema["deal"].dataType.names == list(inputs.FIRST_DEAL)
    assert plain(narrow) == plain(whole)
