"""Column functions on hand-made values."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar, casting, flags, measures, text


def evaluate(spark, values, function, kind="string"):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    found = rows.select("n", function(F.col("v")).alias("r")).orderBy("n").collect()
    return [row.r for row in found]


CASTS = {
    "DATE": (
        ["2018-01-31", " 2018-01-31 ", "2018-02-30", "2018", "2018-1-1", "", None, "2018-01-31 10:00:00"],
        [date(2018, 1, 31), date(2018, 1, 31), None, None, None, None, None, None],
    ),
    "TIMESTAMP": (
        ["2018-01-31", "2018-01-31 10:11:12", "2018-01-31 10:11:12.123456789", "2018-01-31T10:11:12",
         "2018-01-31 24:00:00", "2018-02-30 00:00:00"],
        [datetime(2018, 1, 31), datetime(2018, 1, 31, 10, 11, 12),
         datetime(2018, 1, 31, 10, 11, 12, 123456), None, None, None],
    ),
    "INT": (
        ["7", " 7 ", "+5", "-5", "1e3", "7.0", "", "99999999999"],
        [7, 7, 5, -5, None, None, None, None],
    ),
    "BIGINT": (["99999999999", "9999999999999999999999"], [99999999999, None]),
    "DECIMAL(10, 2)": (
        [".5", "1e3", "-1.005", "99999999999.5", "1,5", "2.5E-1"],
        [Decimal("0.50"), Decimal("1000.00"), Decimal("-1.01"), None, None, Decimal("0.25")],
    ),
    "DOUBLE": ([".5", "1e3", "+2", "x", "NaN", "1."], [0.5, 1000.0, 2.0, None, None, None]),
    "BOOLEAN": (
        ["TRUE", "1", " false ", "0", "1.0", "yes", None],
        [True, True, False, False, None, None, None],
    ),
}


@pytest.mark.parametrize("kind", CASTS)
def test_safe_cast(spark, kind):
    values, expected = CASTS[kind]
    assert evaluate(spark, values, lambda c: casting.safe_cast(c, kind)) == expected


def test_safe_cast_of_numbers_and_other_types(spark):
    as_decimal = lambda c: casting.safe_cast(c, "DECIMAL(10, 2)")
    assert evaluate(spark, [490.02, 1.0e-3, 1.0e12], as_decimal, "double") == [
        Decimal("490.02"),
        Decimal("0.00"),
        None,
    ]
    assert evaluate(spark, ["a"], lambda c: casting.safe_cast(c, "STRING")) == ["a"]


def test_number_words_and_integral_doubles(spark):
    assert evaluate(spark, ["1.0", "0.0", "True", "2", None], casting.boolean_from_number_words) == [
        True, False, True, None, None,
    ]
    assert evaluate(spark, ["100.0", "100.5", "1e2", "9e99", "x", None], casting.integral_to_int) == [
        100, None, 100, None, None, None,
    ]


def test_cast_failed_flag(spark):
    flag = lambda c: casting.cast_failed_flag(c, casting.safe_cast(c, "INT"), "n")
    assert evaluate(spark, ["x", "1", "", "  ", None], flag) == ["T1:n", None, None, None, None]


def test_text(spark):
    assert evaluate(spark, ["", "  ", " a ", None], text.blank_to_null) == [None, None, "a", None]
    assert evaluate(spark, ["N/A", "", "x", None], text.not_available_to_null) == [
        None, "", "x", None,
    ]
    assert evaluate(spark, [" Email ", "", None], text.lower_category_or_unknown) == [
        "email", "unknown", "unknown",
    ]
    assert evaluate(spark, ["  SAO   Paulo ", " ", None], text.tidy_place_name) == [
        "sao paulo", None, None,
    ]
    assert evaluate(spark, ["a", None], lambda c: text.joined_key(c, F.lit(1))) == ["a|1", None]


def test_flag_lists(spark):
    row = spark.range(1).select(
        flags.flag_list([("A", F.lit(True)), ("B", F.lit(None).cast("boolean")), ("C", F.lit(True))])
        .alias("some"),
        flags.flag_list([("A", F.lit(False))]).alias("none"),
        flags.flag_list([]).alias("empty"),
        flags.reject_reason([("x", F.lit(True)), ("y", F.lit(True))]).alias("reason"),
    ).first()
    assert (row.some, row.none, row.empty, row.reason) == ("A,C", None, None, "x;y")
    assert evaluate(spark, ["x", " ", None], flags.is_reject) == [True, False, False]


def test_has_flag(spark):
    values = ["D1", "D10,D2", "T1:won_date", "T1", None, "P_1"]
    assert evaluate(spark, values, lambda c: flags.has_flag(c, "D1")) == [
        True, False, False, False, False, False,
    ]
    assert evaluate(spark, values, lambda c: flags.has_flag(c, "T1")) == [
        False, False, True, True, False, False,
    ]
    # an underscore is a letter, not a wildcard
    assert evaluate(spark, ["PX1", "P_1"], lambda c: flags.has_flag(c, "P_1")) == [False, True]
    assert evaluate(spark, values, lambda c: flags.has_flag_prefix(c, "T1")) == [
        False, False, True, False, False, False,
    ]


def test_calendar(spark):
    assert evaluate(
        spark,
        ["2018-01-31 10:00:00", "2018-1-5", "2018-02-30", " ", None],
        calendar.lenient_date,
    ) == [date(2018, 1, 31), date(2018, 1, 5), None, None, None]
    assert evaluate(
        spark, ["2018-01-31 10:00:00.5", "2018-01-31", "31/01/2018", None], calendar.lenient_timestamp
    ) == [datetime(2018, 1, 31, 10, 0, 0, 500000), datetime(2018, 1, 31), None, None]
    row = spark.sql(
        "select timestamp_ntz'2018-01-02 00:00:01' b, timestamp_ntz'2018-01-01 23:59:59' a, "
        "timestamp_ntz'2018-01-01 00:00:00.9' s, timestamp_ntz'2018-01-01 00:00:02.1' e"
    ).select(
        calendar.calendar_days(F.col("b"), F.col("a")).alias("days"),
        calendar.elapsed_seconds(F.col("e"), F.col("s")).alias("seconds"),
        calendar.month_label(F.col("a")).alias("month"),
    ).first()
    assert (row.days, row.seconds, row.month) == (1, 1, "2018-01")


def test_wall_clock_times_ignore_the_session_time_zone(spark):
    zone = "spark.sql.session.timeZone"
    before = spark.conf.get(zone)
    spark.conf.set(zone, "America/Sao_Paulo")  # where this hour was skipped
    try:
        row = spark.sql(
            "select timestamp_ntz'2017-10-15 00:30:00' t, timestamp_ntz'2017-10-14 23:30:00' s"
        ).select(
            calendar.second_label(F.col("t")).alias("second"),
            calendar.month_label(F.col("t")).alias("month"),
            calendar.elapsed_seconds(F.col("t"), F.col("s")).alias("seconds"),
            calendar.calendar_days(F.col("t"), F.col("s")).alias("days"),
        ).first()
        assert tuple(row) == ("2017-10-15 00:30:00", "2017-10", 3600, 1)
        years = spark.sql("select timestamp_ntz'2018-01-01' e, timestamp_ntz'1998-01-01' s")
        assert years.select(calendar.elapsed_seconds(F.col("e"), F.col("s"))).first()[0] == 7305 * 86400
    finally:
        spark.conf.set(zone, before)


def test_measures(spark):
    assert evaluate(spark, [0, 4], lambda c: measures.ratio(F.lit(1), c), "int") == [None, 0.25]
    assert evaluate(spark, [29, 30], measures.is_small_sample, "int") == [True, False]
    assert evaluate(
        spark, [99, 100], lambda c: measures.is_small_sample(F.lit(50), orders=c), "int"
    ) == [True, False]
    gap = lambda c: measures.is_small_gap_group(F.lit(30), c)
    assert evaluate(spark, [29, 30], gap, "int") == [True, False]
    stored = lambda c: measures.stored_text(c, "double")
    assert evaluate(spark, [100.0, 0.0, 10.5, 1 / 3, -2.25, None], stored, "double") == [
        "100", "0", "10.5", "0.3333333333", "-2.25", None,
    ]


def test_comparable_text(spark):
    whole = lambda c: measures.comparable_text(c, F.lit(False))
    rate = lambda c: measures.comparable_text(c, F.lit(True))
    values = ["5.0", "0.12345", "true", " x ", "", None]
    assert evaluate(spark, values, whole) == ["5", "0.1235", "true", "x", None, None]
    assert evaluate(spark, values, rate) == ["5.0000", "0.1235", "true", "x", None, None]
