"""One pass writes every record to its folder; nothing is lost or there twice."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators.batches import Batch, BatchPlan
from tidemark.sources import routed

PLAN = BatchPlan((Batch("one", "2020-01-31 23:59:59"), Batch("two", "2020-02-28 23:59:59")))
FILE = "t.jsonl"


def records(spark, rows):
    return spark.createDataFrame(rows, "route string, value string")


def test_every_record_is_read_back(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = [("one", "a"), ("one", "a"), ("2018-06", "b"), ("_excluded", "c"), ("one", "é \\ \""), ("one", "")]
    totals = routed.write_routed(records(spark, rows).repartition(3), root, FILE)
    assert {r: t.n_records for r, t in totals.items()} == {"one": 4, "2018-06": 1, "_excluded": 1}
    assert routed.manifest(spark, root) == totals and routed.differing_routes(spark, root, FILE) == []
    assert Counter(map(tuple, routed.read_routed(spark, root, FILE).collect())) == Counter(rows)
    assert spark.read.text(f"{root}/2018-06/{FILE}").first().value == "b"
    assert not [p.name for p in (tmp_path / "raw").iterdir() if p.name.startswith(".staged")]


def test_writing_again_replaces_every_route(spark, tmp_path):
    root = str(tmp_path / "raw")
    routed.write_routed(records(spark, [("one", "a"), ("two", "b")]), root, FILE)
    (tmp_path / "raw" / "two" / "other.txt").write_text("not ours")
    routed.write_routed(records(spark, [("one", "c")]), root, FILE)
    assert [tuple(r) for r in routed.read_routed(spark, root, FILE).collect()] == [("one", "c")]
    assert not (tmp_path / "raw" / "two" / FILE).exists() and (tmp_path / "raw" / "two" / "other.txt").exists()


def test_a_changed_file_is_told(spark, tmp_path):
    root = str(tmp_path / "raw")
    assert routed.manifest(spark, root) is None
    routed.write_routed(records(spark, [("one", "a"), ("two", "b")]), root, FILE)
    (tmp_path / "raw" / "two" / FILE / "part-extra.txt").write_text("b\n")
    assert routed.differing_routes(spark, root, FILE) == ["two"]


def test_every_child_is_in_one_place(spark):
    parents = spark.createDataFrame([("p1", "2020-01-05"), ("p2", "2020-01-06"), ("p3", "2020-03-01")], "k string, seen string")
    children = [
        ("p1", "2020-02-02", "late"), ("p1", "2020-02-03", "second"), ("p1", "2020-02-02", "late"),
        ("p2", "2020-03-03", "after"), ("x", "2020-01-01", "orphan"), ("x", "2020-01-02", "orphan 2"),
        (None, "2020-01-01", "no key"), ("p3", "2020-01-01", "parent after"), ("hot", "2020-01-01", "same"),
        *[("hot", "2020-01-01", "same")] * 50,
    ]
    frame = spark.createDataFrame(children, "k string, won string, name string")
    nested, apart = routed.route_family(parents, frame, "k", "seen", "won", "child", ["won", "name"], PLAN)
    got = Counter((r.route, r.name) for r in apart.collect())
    assert got == {
        ("_repeated", "second"): 1, ("_repeated", "late"): 1, ("_excluded", "after"): 1, ("_orphans", "orphan"): 1,
        ("_repeated", "orphan 2"): 1, ("_orphans", "no key"): 1, ("_orphans", "same"): 1, ("_repeated", "same"): 50,
    }
    shown = sorted((r.batch_id, r.k, r.child.name if r.child else None) for r in nested.collect())
    assert shown == [("one", "p1", None), ("one", "p2", None), ("one", "p3", "parent after"), ("two", "p1", "late")]
    placed = apart.count() + nested.where(F.col("child").isNotNull()).count()
    assert placed == len(children)


def test_lines_are_compressed(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = [("one", f"the same long line of text, {n % 3}" * 20) for n in range(5000)]
    routed.write_routed(records(spark, rows), root, FILE)
    written = sum(p.stat().st_size for p in (tmp_path / "raw" / "one" / FILE).glob("part-*"))
    assert written < sum(len(value) for _, value in rows) / 10
    assert Counter(map(tuple, routed.read_routed(spark, root, FILE).collect())) == Counter(rows)


def test_children_of_a_hot_key_are_compared_by_parts(spark, monkeypatch):
    monkeypatch.setattr(routed, "HOT_ROWS", 10)
    rows = [("hot", n, "x") for n in range(40)] + [("hot", 0, "x")] * 3 + [(None, n, "n") for n in range(20)] + [("cold", 2, "b"), ("cold", 1, None)]
    frame = spark.createDataFrame(rows, "k string, n int, name string").repartition(5)
    first, repeated = routed.first_and_repeated(frame, ["k"], ["n"])
    got = Counter(map(tuple, first.collect()))
    assert got == Counter([("hot", 0, "x"), (None, 0, "n"), ("cold", 1, None)])
    assert got + Counter(map(tuple, repeated.collect())) == Counter(rows)


def test_children_are_shuffled_once(spark):
    """What follows reads them as they were numbered."""
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n int")
    for found in routed.first_and_repeated(frame, ["k"], ["n"]):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "LogicalRDD" not in plan
