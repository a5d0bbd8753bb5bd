"""Ratios, small-sample flags and the text form of compared values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below these counts a figure is marked as a small sample.
SMALL_GROUP = 30
SMALL_MONTH_ORDERS = 100
# Decimals kept when two figures are compared, and when one is stored as text.
COMPARED_DECIMALS = 4
STORED_DECIMALS = 10


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def is_small_sample(group: Column, orders: Column | None = None) -> Column:
    small = group < SMALL_GROUP
    return small if orders is None else small | (orders < SMALL_MONTH_ORDERS)


def is_small_month(orders: Column) -> Column:
    return orders < SMALL_MONTH_ORDERS


def is_small_gap_group(scored_on_time: Column, scored_late: Column) -> Column:
    return (scored_on_time < SMALL_GROUP) | (scored_late < SMALL_GROUP)


def count_true(condition: Column) -> Column:
    """Rows where the condition holds: 0, not NULL, over no rows."""
    return F.count_if(condition)


def sum_where(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0).cast("bigint"))


def stored_text(value: Column, type_name: str) -> Column:
    """Text form of one metric: doubles plain, to ten decimals, without trailing zeros.

    The whole part is split off first: what remains is exact and small, so its
    decimals are those of the double and not of its shortest spelling.
    """
    if type_name in ("double", "float"):
        whole = F.floor(value)
        fraction = F.round((value - whole).cast("decimal(30,20)"), STORED_DECIMALS)
        plain = (whole.cast("decimal(20,0)") + fraction).cast(f"decimal(38,{STORED_DECIMALS})")
        return F.regexp_replace(plain.cast("string"), r"\.?0+$", "")
    return value.cast("string")


def rounded_text(value: Column) -> Column:
    """Half-up rounding to the compared number of decimals, as text."""
    return F.round(value.try_cast("decimal(38,18)"), COMPARED_DECIMALS).cast("string")


def comparable_text(value: Column, is_rate: Column) -> Column:
    """One text form for values that should count as equal.

    Blank is NULL; a whole number that is not a rate loses its fraction;
    any other number is rounded; other text is trimmed.
    """
    text = F.trim(value)
    number = text.try_cast("decimal(38,18)")
    whole = F.when(number == F.floor(number), number.cast("decimal(38,0)").cast("string"))
    return F.when(
        text != "",
        F.coalesce(F.when(~is_rate, whole), rounded_text(text), text),
    )
