"""Dates: calendar-day differences, lenient parsing, month labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The timestamp layouts a lenient reader tries, in this order.
LENIENT_TIMESTAMP_FORMS = (
    r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}$",
    r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$",
    r"^\d{4}-\d{1,2}-\d{1,2}$",
)
LENIENT_DATE_FORM = r"^\d{4}-\d{1,2}-\d{1,2}$"


def calendar_days(end: Column, start: Column) -> Column:
    """``end`` minus ``start`` in whole calendar days, time of day dropped."""
    return F.datediff(end.cast("date"), start.cast("date"))


def month_label(value: Column) -> Column:
    """``yyyy-MM`` of a date or wall-clock time.

    Taken from its text: ``date_format`` would go through the session's time
    zone, where an hour may not exist.
    """
    return F.substring(value.cast("string"), 1, 7)


def second_label(value: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a wall-clock time."""
    return F.substring(value.cast("string"), 1, 19)


def lenient_date(value: Column) -> Column:
    """Date from the first ten characters of a date or timestamp text."""
    head = F.substring(F.trim(value), 1, 10)
    return F.when(head.rlike(LENIENT_DATE_FORM), head.try_cast("date"))


def lenient_timestamp(value: Column) -> Column:
    """Timestamp from text with microseconds, with seconds, or a date alone."""
    text = F.trim(value)
    known_layout = F.lit(False)
    for form in LENIENT_TIMESTAMP_FORMS:
        known_layout = known_layout | text.rlike(form)
    return F.when(known_layout, text.try_cast("timestamp_ntz"))


def elapsed_seconds(end: Column, start: Column) -> Column:
    """Whole seconds between two wall-clock times, fraction dropped."""
    return (end - start).cast("interval second").cast("bigint")
