"""In which of several sets each key occurs: one grouped pass with a bit for each set, for any number of tables.

Every row of a set becomes a narrow row of its table's name, its key and the set's bit; all tables share one
shuffle, combined before it, so a key with many rows arrives as one row for each task. Reconciling sets
pair by pair would shuffle each of them again for each pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the source has, what was routed to a batch, what was set apart, and what the latter may belong to.
RAW, IN_SCOPE, EXCLUDED, PARENT = 1, 2, 4, 8


def key_rows(table: str, rows: DataFrame, keys: Sequence[str | Column], role: int | Column) -> DataFrame:
    """``table_name, key, role``; parts of a key go in with their length, rows with a null part have no key.

    A row that is in several sets at once may give the sum of their bits as its ``role``.
    """

    def cell(key: str | Column) -> Column:
        text = (F.col(key) if isinstance(key, str) else key).cast("string")
        return F.concat(F.length(text).cast("string"), F.lit(":"), text)

    # one null part makes the text null; without keys every row stands for itself
    key = F.concat(*[cell(k) for k in keys]) if keys else F.lit(None).cast("string")
    return rows.select(F.lit(table).alias("table_name"), key.alias("key"), F.lit(role).cast("int").alias("role"))


def key_ledger(parts: Iterable[DataFrame]) -> DataFrame:
    """``table_name, key, sets`` and the rows of each key in scope and excluded."""
    rows = reduce(DataFrame.unionByName, parts)

    def in_set(role: int) -> Column:
        return F.col("role").bitwiseAND(F.lit(role)) != 0

    return rows.groupBy("table_name", "key").agg(
        F.bit_or("role").alias("sets"),
        F.count_if(in_set(IN_SCOPE)).alias("n_in_scope"),
        F.count_if(in_set(EXCLUDED)).alias("n_excluded"),
    )


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Per table: rows and keys in scope, excluded rows, and the keys that break a rule.

    ``n_unaccounted`` source keys are neither in scope nor excluded, ``n_unknown`` keys of either are not in
    the source, ``n_without_parent`` excluded keys have no parent. A table whose rows have no key counts
    its rows as keys.
    """
    def has(role: int) -> Column:
        return F.col("sets").bitwiseAND(F.lit(role)) != 0

    no_key, routed = F.col("key").isNull(), has(IN_SCOPE) | has(EXCLUDED)
    return ledger.groupBy("table_name").agg(
        F.sum("n_in_scope").alias("n_rows"),
        F.sum(F.when(no_key, F.col("n_in_scope")).when(has(IN_SCOPE), 1).otherwise(0)).cast("long").alias("n_distinct"),
        F.sum("n_excluded").alias("n_excluded"),
        F.count_if(~no_key & has(RAW) & ~routed).alias("n_unaccounted"),
        F.count_if(~no_key & routed & ~has(RAW)).alias("n_unknown"),
        F.count_if(~no_key & has(EXCLUDED) & ~has(PARENT)).alias("n_without_parent"),
    )


def beside_published(totals: DataFrame, published: DataFrame) -> DataFrame:
    """Totals beside ``table_name, expected_rows, expected_distinct, expected_excluded``."""
    figures = ("rows", "distinct", "excluded")
    both = totals.join(published, "table_name", "full_outer")
    return both.withColumn("matches", reduce(Column.__and__, [F.col(f"n_{x}").eqNullSafe(F.col(f"expected_{x}")) for x in figures]))
