"""The comparison of KPI tables finds what is missing, extra or off, and nothing else."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import compare
from tidemark.plans import second_route


def metrics(spark, rows):
    return spark.createDataFrame([("kpi", s, k, v) for s, k, v in rows], compare.METRIC_SCHEMA)


def test_what_a_comparison_finds(spark):
    same = [("a", "n_orders", "3"), ("a", "late_rate", "0.25"), ("b", "n_orders", None), ("b", "late_rate", "0.5")]
    assert compare.compare_metrics(metrics(spark, same), metrics(spark, same)).count() == 0
    near = [("a", "n_orders", "3.0"), ("a", "late_rate", "0.25001"), ("b", "n_orders", " "), ("b", "late_rate", "0.500049")]
    assert compare.compare_metrics(metrics(spark, same), metrics(spark, near)).count() == 0
    off = [("a", "n_orders", "4"), ("a", "late_rate", "0.251"), ("b", "n_orders", None), ("c", "late_rate", "0.5")]
    found = {(r.slice_key, r.kpi_name): r.problem for r in compare.compare_metrics(metrics(spark, same), metrics(spark, off)).collect()}
    assert found == {
        ("a", "n_orders"): "different", ("a", "late_rate"): "different", ("b", "late_rate"): "missing", ("c", "late_rate"): "extra",
    }
    row = compare.agreement(metrics(spark, same), metrics(spark, off)).first()
    assert tuple(row) == ("kpi", 5, 1, 1, 2)


def test_slices_are_summed_in_one_pass(spark):
    days = [date(2020, 1, 1), date(2020, 1, 9), date(2020, 2, 1), None]
    rows = [(d, str(d)[:7] if d else None, s, 1) for d in days for s in ("x", None)]
    frame = spark.createDataFrame(rows, "day date, year_month string, state string, n long")
    by_month, by_state, by_day = second_route.slice_sums(frame, ["year_month"], ["state", "year_month"], ["day"])
    shown = lambda f: {tuple(r) for r in f.collect()}
    assert shown(by_month) == {("2020-01", 4), ("2020-02", 2), (None, 2)}
    # a null that is a value stays apart from one that stands for all values
    assert shown(by_state) == {(m, s, n) for m, n in (("2020-01", 2), ("2020-02", 1), (None, 1)) for s in ("x", None)} or shown(by_state) == {
        (s, m, n) for m, n in (("2020-01", 2), ("2020-02", 1), (None, 1)) for s in ("x", None)
    }
    assert {r.day for r in by_day.collect()} == set(days) and by_day.agg(F.sum("n")).first()[0] == 8
