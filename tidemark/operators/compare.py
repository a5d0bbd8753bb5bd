"""Long-format metrics and the keyed comparison of two sets of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.measures import comparable_text, stored_text
from tidemark.functions.text import joined_key

METRIC_KEY = ("table_name", "slice_key", "kpi_name")
METRIC_SCHEMA = "table_name string, slice_key string, kpi_name string, value string"

# Which metrics are rates, and which columns are not metrics.
RATE_PREFIXES = ("avg_", "sum_revenue", "order_growth", "score_gap")
RATE_SUFFIX = "_rate"
NO_SLICE = "(none)"  # stands for NULL in a slice
NOT_METRICS = ("n_obs", "is_small_sample", "is_small_gap_group")


def to_metrics(table: DataFrame, table_name: str, slice_columns: Sequence[str]) -> DataFrame:
    """One row per metric of a KPI table."""
    types = dict(table.dtypes)
    metrics = [c for c in table.columns if c not in slice_columns and c not in NOT_METRICS]
    as_text = table.select(
        F.lit(table_name).alias("table_name"),
        joined_key(
            *[F.coalesce(F.col(c).cast("string"), F.lit(NO_SLICE)) for c in slice_columns]
        ).alias("slice_key"),
        *[stored_text(F.col(c), types[c]).alias(c) for c in metrics],
    )
    return as_text.unpivot(["table_name", "slice_key"], metrics, "kpi_name", "value")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One sorted CSV: KPI metrics are a handful per slice, so one file holds them."""
    metrics.orderBy(*METRIC_KEY).coalesce(1).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).option("header", True).csv(path)


def is_rate(kpi_name: Column) -> Column:
    rate = kpi_name.endswith(RATE_SUFFIX)
    for prefix in RATE_PREFIXES:
        rate = rate | kpi_name.startswith(prefix)
    return rate


def _judged(expected: DataFrame, actual: DataFrame) -> DataFrame:
    keys = list(METRIC_KEY)

    def side(metrics: DataFrame, name: str) -> DataFrame:
        return metrics.select(
            *keys,
            comparable_text(F.col("value"), is_rate(F.col("kpi_name"))).alias(name),
            F.lit(True).alias(f"__in_{name}"),
        )

    both = side(expected, "expected").join(side(actual, "actual"), keys, "full_outer")
    problem = (
        F.when(F.col("__in_actual").isNull(), F.lit("missing"))
        .when(F.col("__in_expected").isNull(), F.lit("extra"))
        .when(~F.col("expected").eqNullSafe(F.col("actual")), F.lit("different"))
    )
    return both.select(*keys, "expected", "actual", problem.alias("problem"))


def compare_metrics(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Metrics that are missing, extra or different; empty when the two sets agree."""
    return _judged(expected, actual).filter(F.col("problem").isNotNull())


def agreement(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Per table: how many metrics there are on either side, and how many are missing, extra or different."""
    kinds = ("missing", "extra", "different")
    counts = [F.count_if(F.col("problem") == kind).alias(f"n_{kind}") for kind in kinds]
    return _judged(expected, actual).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_metrics"), *counts)
