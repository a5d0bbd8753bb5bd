"""Records with line breaks, found from any split, equal the multi-line reader; bad ones are kept."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from tidemark.sources import csv_records, raw_csv

COLUMNS = ["id", "title", "message", "score"]


def cells(seed, n):
    r = random.Random(seed)
    stock = ["a", "é", ",", '"', "\n", "\r\n", " ", "word", "\n\n", '""', "x" * 30]
    return [(str(i), "".join(r.choices(stock, k=r.randrange(9))), "".join(r.choices(stock, k=r.randrange(20))), "5") for i in range(n)]


def as_csv(rows, header=COLUMNS):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows([header, *rows])
    return out.getvalue()


def put(root, text, batch="b1", name="t.csv"):
    (root / batch).mkdir(parents=True, exist_ok=True)
    (root / batch / name).write_bytes(text.encode())


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_any_split_as_the_multi_line_reader(spark, tmp_path, small_splits):
    for number, batch in enumerate(("b1", "b2")):
        put(tmp_path, "﻿" * number + as_csv(cells(number, 300)), batch)
    lines = csv_records._numbered_lines(spark, str(tmp_path / "b1" / "t.csv"))
    assert lines.select("__split").distinct().count() >= 8
    got = csv_records.read_csv_records(spark, str(tmp_path), ["b1", "b2", "none"], "t.csv", COLUMNS)
    whole = raw_csv.read_batch_csv(spark, str(tmp_path), ["b1", "b2", "none"], "t.csv", COLUMNS, multi_line=True)
    key = lambda r: (r.batch_id, int(r.id))
    assert got.where("NOT is_parsed OR raw_record IS NOT NULL").count() == 0
    wanted = sorted(whole.collect(), key=key)
    assert sorted(got.select(*whole.columns).collect(), key=key) == wanted and len(wanted) == 600


def test_bad_records_are_kept(spark, tmp_path, small_splits):
    text = as_csv(cells(7, 40)) + '40,"short\nrow"\n41,"t","m","5","more"\n\n42,"t","m","5"\r\n'
    put(tmp_path, text)
    got = csv_records.read_csv_records(spark, str(tmp_path), ["b1"], "t.csv", COLUMNS)
    bad = {r.raw_record: tuple(r)[:4] for r in got.where("NOT is_parsed").collect()}
    assert bad == {'40,"short\nrow"': (None,) * 4, '41,"t","m","5","more"': (None,) * 4}
    assert {int(r.id) for r in got.where("is_parsed").collect()} == {*range(40), 42}
    assert got.where("id = '42' AND score = '5' AND raw_record IS NULL").count() == 1


def test_a_quote_too_many_keeps_all_lines(spark, tmp_path, small_splits):
    put(tmp_path, as_csv(cells(8, 30)) + '30,"open,m,5\n' + "\n".join(f"{i},t,m,5" for i in range(31, 400)) + "\n")
    got = csv_records.read_csv_records(spark, str(tmp_path), ["b1"], "t.csv", COLUMNS)
    assert got.where("is_parsed").count() == 30
    kept = [r.raw_record for r in got.where("NOT is_parsed").collect()]
    assert sorted(kept) == sorted(['30,"open,m,5', *(f"{i},t,m,5" for i in range(31, 400))])


def test_a_record_of_too_many_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_records, "LONGEST_RECORD", 5)
    put(tmp_path, as_csv([("1", "t", "a\n" * 4 + "b", "5"), ("2", "t", "a\n" * 5 + "b", "5"), ("3", "t", "m", "5")]))
    got = csv_records.read_csv_records(spark, str(tmp_path), ["b1"], "t.csv", COLUMNS)
    assert sorted(r.id for r in got.where("is_parsed").collect()) == ["1", "3"]
    assert got.where("NOT is_parsed").count() == 6


def test_a_moved_column_is_an_error(spark, tmp_path):
    put(tmp_path, as_csv(cells(9, 3), ["id", "message", "title", "score"]))
    with pytest.raises(PySparkException, match="are not those of"):
        csv_records.read_csv_records(spark, str(tmp_path), ["b1"], "t.csv", COLUMNS).collect()


def test_a_file_with_a_header_only(spark, tmp_path):
    put(tmp_path, as_csv([]))
    assert csv_records.read_csv_records(spark, str(tmp_path), ["b1"], "t.csv", COLUMNS).count() == 0


@pytest.mark.parametrize("batch_rows", ["1", "3", "50"])
def test_long_records_over_batches_and_splits(spark, tmp_path, small_splits, monkeypatch, batch_rows):
    monkeypatch.setattr(csv_records, "LONGEST_RECORD", 7)
    r = random.Random(11)
    sizes = [r.choice([1, 1, 2, 5, 7, 8, 40, 120]) for _ in range(120)]
    put(tmp_path, as_csv([(str(i), "t", "\n".join(["m"] * n), "5") for i, n in enumerate(sizes)]))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, batch_rows)
    try:
        rows = csv_records.read_csv_records(spark, str(tmp_path), ["b1"], "t.csv", COLUMNS).collect()
    finally:
        spark.conf.set(name, before)
    assert sorted(int(x.id) for x in rows if x.is_parsed) == [i for i, n in enumerate(sizes) if n <= 7]
    assert sum(not x.is_parsed for x in rows) == sum(n for n in sizes if n > 7)


def test_lines_of_whole_records_are_not_shuffled(spark, tmp_path, small_splits):
    put(tmp_path, as_csv(cells(12, 300)))
    got = csv_records.read_csv_records(spark, str(tmp_path), ["b1"], "t.csv", COLUMNS)
    records = csv_records._records(csv_records._numbered_lines(spark, str(tmp_path / "b1" / "t.csv")))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert records.count() == 301
    assert plan.count("Aggregate") == 1  # of the records that go over the end of a split


def test_splits_that_change_while_reading_are_an_error(spark, tmp_path, small_splits):
    put(tmp_path, as_csv(cells(13, 100)))
    got = csv_records.read_csv_records(spark, str(tmp_path), ["b1"], "t.csv", COLUMNS)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900b")
    with pytest.raises(PySparkException, match="splits changed"):
        got.collect()
