"""Operators against brute force and hand-made edges."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import batches, checks, compare, latest, sets, skew
from tidemark.operators.batches import MARKETPLACE_BATCHES as PLAN


def tuples(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# --- skew ----------------------------------------------------------------------------------


@pytest.fixture
def splitting(spark):
    """Settings under which a partition of a few hundred kilobytes counts as oversized."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def hot_rows(spark, n=120_000):
    """A third of the rows share one key, and some have none."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 100 == 1, F.lit(None))
        .otherwise((F.col("id") % 5000).cast("string"))
    )
    return spark.range(0, n, 1, 8).select(
        "id", key.alias("k"), (F.col("id") % 7).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
    )


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_group_is_split_and_values_are_right(spark, splitting):
    rows = hot_rows(spark)
    marked = skew.with_group_values(rows, ["k"], {"n": F.count(F.lit(1)), "top": F.max("v")})
    assert "skew=true" in final_plan(marked.agg(F.max("pad"), F.sum("n")))
    counts, tops = Counter(), defaultdict(int)
    source = rows.select("k", "v").collect()
    for k, v in source:
        counts[k] += 1
        tops[k] = max(tops[k], v)
    got = marked.groupBy("k").agg(F.count(F.lit(1)), F.min("n"), F.max("n"), F.max("top")).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {
        k: (n, n, n, tops[k]) for k, n in counts.items()
    }


def test_hot_lookup_is_split_and_later_aggregate_is_combined_first(spark, splitting):
    rows = hot_rows(spark)
    names = rows.select("k").distinct().filter("k is not null").withColumn("name", F.concat(F.lit("n-"), "k"))
    joined = skew.lookup_join(rows, names, ["k"])
    plan = final_plan(joined.groupBy("k").agg(F.max("pad"), F.max("name")))
    assert "skew=true" in plan and "partial_max" in plan
    assert joined.count() == rows.count()
    assert joined.filter("k is null and name is not null").count() == 0
    assert joined.filter("k is not null and name <> concat('n-', k)").count() == 0


def test_lookup_kinds(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    known = spark.createDataFrame([("a", "A"), (None, "N")], "k string, name string")
    assert tuples(skew.lookup_join(rows, known, ["k"])) == sorted(
        [("a", 1, "A"), ("b", 2, None), (None, 3, None)], key=repr
    )
    assert tuples(skew.lookup_join(rows, known, ["k"], "inner")) == [("a", 1, "A")]
    assert tuples(skew.lookup_join(rows, known, ["k"], "left_semi")) == [("a", 1)]
    assert tuples(skew.lookup_join(rows, known, ["k"], "left_anti")) == sorted(
        [("b", 2), (None, 3)], key=repr
    )


# --- latest --------------------------------------------------------------------------------


def snapshots(spark):
    bulk = PLAN.ids[0]
    rows = [
        ("a", bulk, 1), ("a", "2018-06", 2),
        ("b", "2018-07", 3), ("b", "2018-07", 4),
        ("c", bulk, 5), (None, bulk, 6), (None, "2018-06", 7), (None, "2018-06", 8),
        ("d", "1999-01", 9),
    ]
    return batches.with_batch_seq(
        spark.createDataFrame(rows, "k string, batch_id string, v int"), PLAN
    )


def test_latest_rows_keeps_ties_and_null_keys_and_ignores_unknown_batches(spark):
    latest_v = {r.v for r in latest.latest_rows(snapshots(spark), ["k"], "batch_seq").collect()}
    assert latest_v == {2, 3, 4, 5, 7, 8}


def test_latest_row_keeps_one(spark):
    one = latest.latest_row(snapshots(spark), ["k"], "batch_seq", [F.desc("v")])
    assert {r.v for r in one.collect()} == {2, 4, 5, 8}


def test_first_per_key_is_cut_down_before_the_shuffle(spark):
    rows = hot_rows(spark)
    first = latest.first_per_key(rows, ["k"], [F.desc("v"), F.asc("id")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    best = {}
    for r in rows.select("k", "v", "id").collect():
        best[r.k] = min(best.get(r.k, (9, 9)), (-r.v, r.id))
    assert {r.k: (-r.v, r.id) for r in first.collect()} == best


def test_upsert(spark):
    current = spark.createDataFrame([(1, "old"), (2, "old")], "id int, s string")
    changes = spark.createDataFrame([(2, "new"), (3, "new")], "id int, s string")
    assert tuples(latest.upsert(current, changes, ["id"])) == [(1, "old"), (2, "new"), (3, "new")]


# --- batches -------------------------------------------------------------------------------


def test_batch_plan():
    assert PLAN.resolve(" ALL ") == PLAN.ids and PLAN.resolve("2018-06") == ["2018-06"]
    assert PLAN.previous("2018-06") == PLAN.ids[0] and PLAN.previous(PLAN.ids[0]) is None
    assert PLAN.is_final("2018-08 ") and PLAN.cutoff_date == "2018-08-31"
    for wrong in ("", "2018-09"):
        with pytest.raises(ValueError):
            PLAN.resolve(wrong)


def times(spark):
    values = [
        "2018-05-31 23:59:59", "2018-06-01 00:00:00", "2018-06-30 23:59:59", "2018-08-31 23:59:59",
        "2018-09-01 00:00:00", None,
    ]
    return spark.createDataFrame([(v,) for v in values], "t string").withColumn(
        "at", F.col("t").cast("timestamp_ntz")
    )


def test_routing_and_ranges_agree(spark):
    routed = batches.route_to_batches(times(spark), "t", PLAN)
    by_time = {r.t: r.batch_id for r in routed.collect()}
    assert list(by_time.values()) == [PLAN.ids[0], "2018-06", "2018-06", "2018-08", None, None]
    kept = batches.in_scope(times(spark), "at", PLAN)
    assert {r.t: r.batch_id for r in kept.collect()} == {t: b for t, b in by_time.items() if b}
    assert batches.quarantined(times(spark), "at", PLAN).count() == 2
    ranged = batches.join_batch_ranges(times(spark), "at", PLAN, "2016-09-01 00:00:00")
    assert {r.t: r.batch_id for r in ranged.collect()} == {t: b for t, b in by_time.items() if b}
    assert "NestedLoop" not in ranged._jdf.queryExecution().executedPlan().toString()


def test_replay_children(spark):
    parents = spark.createDataFrame(
        [("a", "2018-01-05"), ("b", "2018-06-05"), ("c", "2018-06-05"), ("d", "2018-09-05"),
         ("e", "2018-06-01")],
        "id string, seen string",
    )
    children = spark.createDataFrame(
        [("a", "2018-06-01", 1), ("a", "2018-07-01", 2), ("b", "2018-06-20", 3),
         ("c", "2018-09-20", 4), ("d", "2018-08-20", 5), ("x", "2018-06-01", 6)],
        "id string, won string, n int",
    )
    replayed = batches.replay_children(
        parents, children, "id", "seen", "won", "child", [F.asc("won")], PLAN
    )
    got = {(r.id, r.batch_id, r.child.n if r.child else None) for r in replayed.collect()}
    assert got == {
        ("a", PLAN.ids[0], None),
        ("a", "2018-06", 1),  # later batch, with its first child
        ("b", "2018-06", 3),  # same batch, once
        ("c", "2018-06", None),  # child after the cutoff
        ("d", "2018-08", 5),  # parent after the cutoff, child in scope
        ("e", "2018-06", None),
    }


def test_batch_order_problems(spark):
    runs = spark.createDataFrame(
        [(PLAN.ids[0], "success"), ("2018-06", "failed")], "batch_id string, status string"
    )
    held = batches.batch_order_problems(runs, PLAN, "success")
    assert {r.batch_id for r in held.collect()} == {"2018-07", "2018-08"}


# --- sets and comparison -------------------------------------------------------------------


def test_key_sets(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("b",), ("c",), ("c",)], "k string")
    assert tuple(sets.key_set_sizes(left, right, "k").first()) == (2, 2, 1, 3, 1, 1)
    assert {r.k for r in sets.keys_without_match(left, right, "k").collect()} == {"a", None}


def test_metrics_roundtrip_and_comparison(spark, tmp_path):
    table = spark.createDataFrame(
        [("2018-01", 3, 0.25, 3, True), ("2018-02", 0, None, 0, True)],
        "year_month string, n_leads bigint, won_rate double, n_obs bigint, is_small_sample boolean",
    )
    metrics = compare.to_metrics(table, "kpi", ["year_month"])
    path = str(tmp_path / "metrics")
    compare.write_metrics(metrics, path)
    stored = compare.read_metrics(spark, path)
    assert tuples(stored) == tuples(metrics) and stored.count() == 4
    assert compare.compare_metrics(stored, metrics).isEmpty()

    changed = metrics.filter("not (slice_key = '2018-01' and kpi_name = 'n_leads')").withColumn(
        "value", F.when(F.col("value") == "0.25", "0.251").otherwise(F.col("value"))
    )
    extra = changed.unionByName(changed.limit(1).withColumn("slice_key", F.lit("2018-03")))
    problems = compare.compare_metrics(metrics, extra)
    assert Counter(r.problem for r in problems.collect()) == {
        "missing": 1, "extra": 1, "different": 1,
    }
    # below the compared precision nothing differs
    close = metrics.withColumn("value", F.regexp_replace("value", "0.25", "0.250004"))
    assert compare.compare_metrics(metrics, close).isEmpty()


# --- checks --------------------------------------------------------------------------------


def test_column_checks(spark):
    rows = spark.createDataFrame(
        [("a", "x"), ("a", None), (None, "y")], "k string, v string"
    )
    parent = spark.createDataFrame([("a",)], "id string")
    assert checks.not_null(rows, "v").count() == 1
    assert tuples(checks.null_counts(rows, ["k", "v"])) == [("k", 1), ("v", 1)]
    assert tuples(checks.unique(rows, ["k"])) == [("a", 2)]
    assert tuples(checks.relationships(rows, "k", parent, "id")) == [(None, 1)]
    assert checks.relationships(rows, "k", parent, "id", F.col("k").isNotNull()).isEmpty()
    assert tuples(checks.accepted_values(rows, "v", ["x"])) == [("y", 1)]
    assert checks.orphan_rows(rows, "v", parent, "id").first().n_orphans == 3


def test_report_stops_on_errors_only(spark):
    rows = spark.createDataFrame([(1,)], "a int")
    warn = checks.report([checks.Check("w", rows, checks.WARN), checks.Check("ok", rows.limit(0))])
    assert {r.check_name: r.status for r in warn.collect()} == {"w": "warn", "ok": "pass"}
    checks.raise_on_errors(warn)
    with pytest.raises(checks.ChecksFailed, match="bad"):
        checks.raise_on_errors(checks.report([checks.Check("bad", rows)]))


def test_key_problems_count_repeats_and_nulls(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), ("b", None)], "k string, n int")
    assert checks.key_problems(rows, "t", ["k"]).first().n_problems == 1 + 2
    assert checks.key_problems(rows, "t", ["k", "n"]).first().n_problems == 1 + 4


def test_orphans_last_until_their_parent_arrives(spark):
    bulk = PLAN.ids[0]
    child = spark.createDataFrame(
        [("a", bulk), ("a", bulk), ("b", "2018-06"), ("c", bulk), ("z", "2018-08")],
        "order_id string, batch_id string",
    )
    parent = spark.createDataFrame(
        [("a", "2018-07"), ("b", "2018-06"), ("c", bulk)], "order_id string, batch_id string"
    )
    got = checks.orphans_after_each_batch(child, parent, "order_id", PLAN)
    assert {r.batch_id: r.n_orphans for r in got.collect()} == {bulk: 2, "2018-06": 2, "2018-08": 1}


def test_orphan_status(spark):
    expected = spark.createDataFrame(
        [("r", b, 2) for b in PLAN.ids], "relation string, batch_id string, expected_orphans bigint"
    )
    orphans = spark.createDataFrame(
        [("r", PLAN.ids[0], 2), ("r", "2018-06", 3), ("r", "2018-08", 1)],
        "relation string, batch_id string, n_orphans bigint",
    )
    got = checks.orphans_against_expected(orphans, expected, PLAN)
    assert {r.batch_id: r.status for r in got.collect()} == {
        PLAN.ids[0]: "warn", "2018-06": "error", "2018-07": "pass", "2018-08": "pass",
    }


def test_expected_counts_and_row_counts(spark):
    expected = spark.createDataFrame([("E1", 2), ("E2", 1)], "sub_code string, expected_count bigint")
    actual = spark.createDataFrame([("E1", 2)], "sub_code string, actual_count bigint")
    compared = checks.expected_counts(actual, expected, ["sub_code"])
    assert tuples(checks.count_mismatches(compared)) == [("E2", -1, 1)]
    raw = spark.createDataFrame([("t", "b1", 5), ("t", "b9", 1)], "table_name string, batch_id string, n_rows bigint")
    planned = spark.createDataFrame([("t", "b1", 5), ("t", "b2", 1)], "table_name string, batch_id string, expected_rows bigint")
    got = {r.batch_id: (r.actual_rows, r.expected_rows, r.matches) for r in checks.batch_row_counts(raw, planned).collect()}
    assert got == {"b1": (5, 5, True), "b2": (0, 1, False), "b9": (1, 0, False), "total": (6, 6, True)}


def test_replay_problems(spark):
    deal = "struct<won_date:string>"
    rows = [
        ("ok", PLAN.ids[0], None), ("ok", "2018-06", ("x",)),
        ("wrong", PLAN.ids[0], ("x",)), ("wrong", "2018-06", ("x",)),
        ("thrice", PLAN.ids[0], None), ("thrice", "2018-06", ("x",)), ("thrice", "2018-07", ("x",)),
    ]
    bronze = spark.createDataFrame(rows, f"mql_id string, batch_id string, deal {deal}").withColumn(
        "is_parsed", F.lit(True)
    )
    assert {r.mql_id for r in checks.replay_problems(bronze, PLAN).collect()} == {"wrong", "thrice"}


def test_cutoff_checks(spark):
    rows = spark.createDataFrame(
        [(datetime(2018, 8, 31, 23, 59, 59, 999999),), (datetime(2018, 9, 1),), (None,)],
        "t timestamp_ntz",
    )
    assert checks.not_after_cutoff(rows, "t", PLAN).count() == 1
    assert checks.no_dates_after_cutoff(rows, ["t"], PLAN).count() == 1
