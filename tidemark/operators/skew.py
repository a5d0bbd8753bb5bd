"""Joins and group values that survive one key holding a large share of the rows.

Spark splits an oversized partition of a join over several tasks while the query
runs (adaptive skew join), but only where both inputs of the join are fresh
shuffles, and not where a later aggregate relies on the join's partitioning.
Both functions here therefore join on the null-safe equality of the keys: it is
planned on an expression of the key, so each side gets a shuffle of its own
that can be split, and an aggregate by the same key afterwards is combined
before a shuffle of its own. A side that turns out small is broadcast instead;
that decision is Spark's, made on the measured size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on_keys(
    rows: DataFrame, unique_side: DataFrame, keys: Sequence[str], how: str, also: Column | None = None
) -> DataFrame:
    """``also`` is a further condition on columns of both sides."""
    added = [c for c in unique_side.columns if c not in keys]
    right = unique_side.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *added)
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
    joined = rows.join(right, same_key if also is None else same_key & also, how)
    kept = rows.columns if how in ("left_semi", "left_anti") else [*rows.columns, *added]
    return joined.select(*kept)


def lookup_join(
    rows: DataFrame, unique_side: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join many rows to at most one row per key (``left``, ``inner``, semi or anti).

    A key with a NULL part matches nothing. For sides that are both unique per
    key an ordinary join does as well.
    """
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return join_on_keys(rows, unique_side.filter(complete), keys, how)


def with_group_values(
    rows: DataFrame, keys: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Every row with aggregates of its group, NULL keys forming one group.

    Same result as an unordered window over ``keys``, which would gather each
    group in one task. The aggregate is combined before its shuffle, and the
    join back can be split.
    """
    groups = rows.groupBy(*keys).agg(*[v.alias(name) for name, v in values.items()])
    return join_on_keys(rows, groups, keys, "inner")
