"""Web log lines: one text line per event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import not_available_to_null

# Fixed value: the layout of a log line; eight groups from timestamp to outcome.
LOG_LINE = (
    r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d+) \[INFO\] - "
    r"USER_ID: ([^,]+), SESSION_ID: ([^,]+), ORDER_ID: ([^,]+), "
    r"EVENT_TYPE: ([^,]+), PRODUCT_ID: ([^,]+), AMOUNT: ([^,]+), OUTCOME: (.+)$"
)
# Fixed value: event times carry at most microseconds.
EVENT_TIME_FORM = r"\.\d{1,6}$"
GROUPS = (
    "__time",
    "user_id",
    "session_id",
    "__order",
    "event_type",
    "__product",
    "__amount",
    "__outcome",
)
BREAK = "\n"  # cannot occur inside a line


def read_lines(spark: SparkSession, path: str | list[str], column: str) -> DataFrame:
    """One row per line, the line kept verbatim."""
    return spark.read.text(path).withColumnRenamed("value", column)


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """Typed columns beside ``raw_line``; other columns of ``lines`` pass through.

    The pattern runs once per line: it rewrites the line to its groups, one per
    row of text, which are then split. A line of another layout gives empty
    text in every group and ``is_parsed`` false.
    """
    raw = F.col("raw_line")
    rewritten = F.regexp_replace(
        raw, LOG_LINE, BREAK.join(f"${g}" for g in range(1, len(GROUPS) + 1))
    )
    carried = [c for c in lines.columns if c != "raw_line"]
    split = lines.withColumn("__parts", F.split(rewritten, BREAK, -1))
    fits = (F.size("__parts") == len(GROUPS)) & ~raw.contains(BREAK)
    grouped = split.select("raw_line", *carried, F.when(fits, F.col("__parts")).alias("__groups"))
    cut = grouped.select(
        "raw_line",
        *carried,
        *[
            F.coalesce(F.col("__groups")[n], F.lit("")).alias(name)
            for n, name in enumerate(GROUPS)
        ],
    )
    return cut.select(
        "user_id",
        "session_id",
        not_available_to_null(F.col("__order")).alias("order_id"),
        not_available_to_null(F.col("__product")).alias("product_id"),
        not_available_to_null(F.col("__outcome")).alias("outcome"),
        "event_type",
        not_available_to_null(F.col("__amount")).try_cast("double").alias("amount"),
        F.when(
            F.col("__time").rlike(EVENT_TIME_FORM), F.col("__time").try_cast("timestamp_ntz")
        ).alias("event_ts"),
        "raw_line",
        (
            (F.col("__time") != "") & (F.col("session_id") != "") & (F.col("user_id") != "")
        ).alias("is_parsed"),
        *carried,
    )
