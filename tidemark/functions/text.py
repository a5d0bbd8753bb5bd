"""Text clean-up used by every silver table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker for "no value" in log lines, the label for a missing category.
NOT_AVAILABLE = "N/A"
UNKNOWN = "unknown"


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def not_available_to_null(value: Column) -> Column:
    return F.when(value != NOT_AVAILABLE, value)


def category_or_unknown(value: Column) -> Column:
    return F.coalesce(blank_to_null(value), F.lit(UNKNOWN))


def lower_category_or_unknown(value: Column) -> Column:
    return F.coalesce(F.lower(blank_to_null(value)), F.lit(UNKNOWN))


def tidy_place_name(value: Column) -> Column:
    """Lower case, single spaces, no outer blanks."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(value), r"\s+", " ")), F.lit(""))


def joined_key(*parts: Column) -> Column:
    """Parts joined by a pipe; NULL when any part is NULL."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("|"), part.cast("string")]
    return F.concat(*pieces)
