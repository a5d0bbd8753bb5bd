"""Reconciling two sets of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_set_sizes(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys on each side, in both, in either, and only on one side.

    One grouped pass over both sides: a key is one row however often it occurs.
    """
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    seen = (
        tagged.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("l").alias("l"), F.max("r").alias("r"))
    )
    return seen.agg(
        F.count_if(F.col("l") == 1).alias("n_left"),
        F.count_if(F.col("r") == 1).alias("n_right"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("n_both"),
        F.count(F.lit(1)).alias("n_either"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 0)).alias("n_left_only"),
        F.count_if((F.col("l") == 0) & (F.col("r") == 1)).alias("n_right_only"),
    )


def keys_without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")
