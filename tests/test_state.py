"""States that are changed batch by batch equal the rebuild, and layers show what was committed."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.batches import Batch, BatchPlan
from tidemark.sources.state import KEY, SEQUENCE, KeyedState, Shape
from tidemark.sources.versions import Layer, MissingTable, VersionConflict

PLAN = BatchPlan(tuple(Batch(b, f"2020-0{i}-01 00:00:00") for i, b in enumerate(("z-bulk", "b", "c", "a"), 1)))
ROW = "k string, line string, value int, batch_id string, source_file string"
SNAPSHOT = Shape("snapshot", ("k",), parts=4, buckets=8, spread=3)
LINES = Shape("lines", ("k", "line"), within=("k",), newest=False, order=("source_file",), parts=4, buckets=8, spread=3)


def content(seed):
    """Rows by batch: keys that come again, a null and a hot key, ties, and lines sent twice."""
    r = random.Random(seed)
    keys = [None, "", "hot", *map(str, range(40))]
    return {
        b: [
            (k, f"line {r.randrange(3)}", r.randrange(9), b, f"f{r.randrange(2)}")
            for k in [*r.sample(keys, 25), *["hot"] * r.choice([0, 30]), *[None] * 3]
        ]
        for b in PLAN.ids
    }


def by_hand(shape, batches):
    order = {b: i for i, b in enumerate(PLAN.ids)}
    groups = {}
    for row in (r for rows in batches.values() for r in rows):
        groups.setdefault(row[:1] if shape is SNAPSHOT else row[:2], []).append(row)
    if shape is SNAPSHOT:
        best = {k: max(order[r[3]] for r in rows) for k, rows in groups.items()}
        return sorted(str(r) for k, rows in groups.items() for r in rows if order[r[3]] == best[k])
    # among equal lines of one batch and file the value is open
    return sorted(str((*k, *min((order[r[3]], r[4]) for r in rows))) for k, rows in groups.items())


def shown(shape, rows):
    order = {b: i for i, b in enumerate(PLAN.ids)}
    got = [tuple(r[c] for c in ("k", "line", "value", "batch_id", "source_file")) for r in rows.collect()]
    return sorted(str(r) if shape is SNAPSHOT else str((*r[:2], order[r[3]], r[4])) for r in got)


@pytest.mark.parametrize("shape", [SNAPSHOT, LINES])
def test_loads_in_any_order_equal_the_rebuild(spark, tmp_path, shape):
    layer = Layer(spark, str(tmp_path / "state"))
    state = KeyedState(layer, shape, PLAN)
    batches, asked = {}, []

    def others(wanted):
        asked.append(wanted)
        return spark.createDataFrame([r for b in wanted for r in batches[b]], ROW)

    first, changed = content(1), content(2)
    steps = [(b, first) for b in PLAN.ids] + [(PLAN.ids[i], changed) for i in (1, 3, 0, 2)] + [("b", {"b": []}), ("b", first)]
    for number, (batch, source) in enumerate(steps):
        batches[batch] = source[batch]
        draft = layer.draft()
        state.load(draft, batch, spark.createDataFrame(source[batch], ROW), others)
        draft.commit()
        assert shown(shape, state.current(draft)) == by_hand(shape, batches), (number, batch)
        if number < 4:
            assert not asked  # batches in their order need no older rows
    assert asked
    draft = layer.draft()
    state.rebuild(draft, spark.createDataFrame([r for rows in batches.values() for r in rows], ROW), PLAN.ids)
    assert shown(shape, state.current(draft)) == by_hand(shape, batches)


def test_a_load_writes_the_parts_of_its_keys_only(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "state"))
    shape = Shape("snapshot", ("k",), parts=16, buckets=4)
    state = KeyedState(layer, shape, PLAN)
    rows = lambda keys, b: spark.createDataFrame([(str(k), "", 1, b, "f") for k in keys], ROW)
    draft = layer.draft()
    assert state.load(draft, "z-bulk", rows(range(500), "z-bulk"), None) == list(range(16))
    draft.commit()
    before = layer.pointer()["tables"]["snapshot"]["folders"]
    draft = layer.draft()
    touched = state.load(draft, "b", rows([7, 900], "b"), None)
    draft.commit()
    after = layer.pointer()["tables"]["snapshot"]["folders"]
    assert 1 <= len(touched) <= 2 and {int(p) for p in after if after[p] != before.get(p)} == set(touched)
    assert state.current(layer.draft()).where("batch_id = 'b'").count() == 2
    assert state.current(layer.draft()).count() == 501


def test_the_state_is_joined_without_a_shuffle(spark, tmp_path):
    """The kept rows come bucket by bucket: under the anti-join only the batch's keys are exchanged."""
    from tidemark.sources.state import CO_PARTITION, _setting

    for shape in (SNAPSHOT, LINES):
        layer = Layer(spark, str(tmp_path / shape.name))
        state = KeyedState(layer, shape, PLAN)
        draft = layer.draft()
        state.load(draft, "z-bulk", spark.createDataFrame(content(1)["z-bulk"], ROW), None)
        new = shape.keyed(spark.createDataFrame(content(1)["b"], ROW))
        with _setting(spark, CO_PARTITION, "false"), _setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            kept = shape.matched(state.current(draft), shape.keys_of(new), "left_anti")
            plan = kept._jdf.queryExecution().executedPlan().toString()
        left = plan.split("keyed_state")[0].splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
        scan = next(i for i, line in enumerate(plan.splitlines()) if "keyed_state" in line)
        above = plan.splitlines()[:scan]
        least = depth(plan.splitlines()[scan])
        path = []
        for line in reversed(above):
            if depth(line) < least:
                least = depth(line)
                path.append(line)
        assert left and any("Anti" in line for line in path)
        assert not any("Exchange" in line for line in path), plan


def test_another_session_finds_the_state(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "state"))
    state = KeyedState(layer, SNAPSHOT, PLAN)
    draft = layer.draft()
    state.load(draft, "z-bulk", spark.createDataFrame(content(1)["z-bulk"], ROW), None)
    draft.commit()
    wanted = shown(SNAPSHOT, state.current(layer.draft()))
    spark.sql(f"DROP TABLE {state.table}")  # an external table: its files stay
    again = KeyedState(Layer(spark, layer.path), SNAPSHOT, PLAN)
    found = again.current(again.layer.draft())
    assert shown(SNAPSHOT, found) == wanted and {KEY, SEQUENCE} < set(found.columns)


# --- versions ------------------------------------------------------------------------------


def numbers(spark, *values):
    return spark.createDataFrame([(v, v % 3) for v in values], "n int, part int")


def listed(layer, name, version=None):
    return sorted(r.n for r in layer.read(name, version).collect())


def test_readers_see_committed_versions_only(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "gold"))
    with pytest.raises(MissingTable):
        layer.read("t")
    draft = layer.draft()
    draft.write("t", numbers(spark, 1, 2))
    draft.write("u", numbers(spark, 5))
    with pytest.raises(MissingTable):
        layer.read("t")  # as after a driver that was killed before its commit
    assert draft.read("t").count() == 2
    draft.commit()
    held = layer.read("t")
    late, draft = layer.draft(), layer.draft()
    draft.write("t", numbers(spark, 3))
    assert listed(layer, "t") == [1, 2] and listed(layer, "u") == [5]
    draft.commit()
    assert listed(layer, "t") == [3] and listed(layer, "u") == [5]
    assert held.count() == 2  # what a reader resolved stays readable
    late.write("t", numbers(spark, 9))
    with pytest.raises(VersionConflict):
        late.commit()
    assert listed(layer, "t") == [3] and layer.versions() == [1, 2]


def test_going_back_and_pruning(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "gold"))
    for value in (1, 2, 3):
        draft = layer.draft()
        draft.write("t", numbers(spark, value))
        draft.commit()
    abandoned = layer.draft()
    abandoned.write("t", numbers(spark, 8))
    assert layer.roll_back(1) == 4
    assert listed(layer, "t") == [1] and listed(layer, "t", 3) == [3]
    gone = layer.prune(keep=2)
    assert layer.versions() == [3, 4] and listed(layer, "t") == [1] and listed(layer, "t", 3) == [3]
    assert len(gone) == 2  # version 2 and the draft that can no longer become version 4


def test_parts_of_a_table(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "silver"))
    draft = layer.draft()
    draft.write_parts("t", numbers(spark, 0, 1, 2, 3, 4), [0, 1, 2])
    draft.commit()
    draft = layer.draft()
    draft.write_parts("t", numbers(spark, 10).where(F.col("part") == 1), [1, 2])
    assert listed(layer, "t") == [0, 1, 2, 3, 4]
    draft.commit()
    assert listed(layer, "t") == [0, 3, 10] and layer.read("t").columns == ["n"]
    draft = layer.draft()
    draft.write_parts("t", numbers(spark), [0, 1, 2])
    draft.commit()
    assert listed(layer, "t") == []
