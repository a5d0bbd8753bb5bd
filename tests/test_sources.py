"""Readers, writers and the run ledger."""

from __future__ import annotations

from datetime import datetime, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.sources import ledger, raw_csv, raw_leads, raw_logs, scratch, tables
from tidemark.streaming import incremental

GOOD = (
    "2018-06-01 10:00:00.123456 [INFO] - USER_ID: u1, SESSION_ID: s1, ORDER_ID: o1, "
    "EVENT_TYPE: purchase, PRODUCT_ID: N/A, AMOUNT: 12.50, OUTCOME: paid, in full"
)


def parsed_log(spark, line):
    return raw_logs.parse_log_lines(spark.createDataFrame([(line,)], "raw_line string")).first()


def test_log_line(spark):
    row = parsed_log(spark, GOOD)
    assert row.is_parsed and row.raw_line == GOOD
    assert (row.user_id, row.session_id, row.order_id, row.product_id) == ("u1", "s1", "o1", None)
    assert (row.event_type, row.amount, row.outcome) == ("purchase", 12.5, "paid, in full")
    assert row.event_ts == datetime(2018, 6, 1, 10, 0, 0, 123456)


@pytest.mark.parametrize("line", ["", "garbage", GOOD.replace("[INFO]", "[WARN]"), "a\n" + GOOD])
def test_other_lines_give_empty_groups(spark, line):
    row = parsed_log(spark, line)
    assert not row.is_parsed and row.raw_line == line
    assert (row.user_id, row.session_id, row.order_id, row.event_type) == ("", "", "", "")
    assert row.event_ts is None and row.amount is None


def test_log_details(spark):
    assert parsed_log(spark, GOOD.replace(".123456", ".1234567")).event_ts is None
    assert parsed_log(spark, GOOD.replace(".123456", ".5")).event_ts.microsecond == 500000
    assert parsed_log(spark, GOOD.replace("12.50", "twelve")).amount is None
    assert parsed_log(spark, GOOD.replace("12.50", "N/A")).amount is None
    blank_user = parsed_log(spark, GOOD.replace("USER_ID: u1", "USER_ID:  "))
    assert blank_user.is_parsed and blank_user.user_id == " "


LEADS = {
    '{"mql_id":"1","origin":"email","deal":{"seller_id":"s","has_company":true}}': (True, "1", "s"),
    '{"mql_id":2,"extra":[1]}': (True, "2", None),
    "{bad": (False, None, None),
    "[]": (False, None, None),
    "": (False, None, None),
    '{"mql_id":"3","deal":"text"}': (False, None, None),
    '{"mql_id":"4","deal":{}}': (True, "4", None),
}


def test_json_lines(spark):
    lines = spark.createDataFrame([(line,) for line in LEADS], "raw_json string")
    got = {r.raw_json: r for r in raw_leads.parse_json_lines(lines).collect()}
    for line, (is_parsed, mql_id, seller) in LEADS.items():
        row = got[line]
        assert (row.is_parsed, row.mql_id) == (is_parsed, mql_id), line
        assert (row.deal.seller_id if row.deal else None) == seller, line
    # an empty deal is still a deal
    assert got['{"mql_id":"4","deal":{}}'].deal is not None


def test_json_writer_leaves_out_absent_values(spark):
    lines = spark.createDataFrame(
        [('{"mql_id":"1","deal":{"won_date":"2018-01-01"}}',), ('{"mql_id":"2"}',)], "raw_json string"
    )
    written = raw_leads.to_json_lines(raw_leads.parse_json_lines(lines).drop("raw_json", "is_parsed"))
    assert {r.raw_json for r in written.collect()} == {r.raw_json for r in lines.collect()}


def test_csv_batches(spark, tmp_path):
    for batch, body in (
        ("b1", "id,name\r\n1, x \r\n2,\"a,\"\"b\"\"\"\r\n"),
        ("b2", "id,name\r\n3,\r\n"),
    ):
        folder = tmp_path / batch
        folder.mkdir()
        (folder / "t.csv").write_text("﻿" + body, encoding="utf-8")
    read = raw_csv.read_batch_csv(spark, str(tmp_path), ["b1", "b2", "b3"], "t.csv", ["id", "name"])
    assert sorted(tuple(r) for r in read.fillna("-").collect()) == [
        ("1", " x ", "b1", "t.csv"),
        ("2", 'a,"b"', "b1", "t.csv"),
        ("3", "-", "b2", "t.csv"),
    ]
    moved = raw_csv.read_batch_csv(spark, str(tmp_path), ["b1"], "t.csv", ["name", "id"])
    with pytest.raises(Exception, match="(?i)header"):
        moved.collect()


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "b1").mkdir()
    (tmp_path / "b1" / "t.csv").write_text('﻿id,note\n1,"two\nlines"\n', encoding="utf-8")
    read = raw_csv.read_batch_csv(
        spark, str(tmp_path), ["b1"], "t.csv", ["id", "note"], multi_line=True
    )
    assert [(r.id, r.note) for r in read.collect()] == [("1", "two\nlines")]


def batch_rows(spark, rows):
    return spark.createDataFrame(rows, "v int, batch_id string")


def test_overwriting_a_batch_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_batches(batch_rows(spark, [(1, "a"), (2, "b"), (3, "b")]), path)
    for _ in range(2):
        tables.overwrite_batches(batch_rows(spark, [(9, "b")]), path)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b")}
    one = spark.read.parquet(path).filter(F.col("batch_id") == "b")
    assert "PartitionFilters: [isnotnull(batch_id" in one._jdf.queryExecution().toString()


def test_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS tidemark_bronze.t")
    tables.create_table(spark, "tidemark_bronze.t", "v INT, batch_id STRING")
    tables.create_table(spark, "tidemark_bronze.t", "v INT, batch_id STRING")
    try:
        tables.overwrite_table_batches(batch_rows(spark, [(1, "a"), (2, "b")]), "tidemark_bronze.t")
        tables.overwrite_table_batches(
            batch_rows(spark, [(3, "b")]).select("batch_id", "v"), "tidemark_bronze.t"
        )
        rows = spark.table("tidemark_bronze.t").collect()
        assert {(r.v, r.batch_id) for r in rows} == {(1, "a"), (3, "b")}
    finally:
        spark.sql("DROP DATABASE tidemark_bronze CASCADE")


def test_audit_summary_and_fingerprint(spark):
    audited = tables.add_audit_columns(spark.range(3), "b1", "f.txt")
    assert audited.columns == ["id", "batch_id", "source_file", "ingested_at"]
    loaded = batch_rows(spark, [(1, "a"), (None, "a"), (3, "b")]).withColumn("is_parsed", F.col("v") != 3)
    summary = {r.batch_id: (r.n_rows, r.n_present) for r in tables.batch_load_summary(loaded, "v").collect()}
    assert summary == {"a": (2, 1), "b": (1, 1)}
    assert tables.batch_load_summary(loaded, batch_id="b").first().n_unparsed == 1

    def digest(rows):
        return {tuple(r) for r in tables.batch_fingerprint(batch_rows(spark, rows), ["v"]).collect()}

    rows = [(1, "a"), (2, "a"), (None, "a")]
    assert digest(rows) == digest(rows[::-1]) == digest(rows)
    assert digest(rows) != digest([(1, "a"), (3, "a"), (None, "a")])
    assert digest(rows) != digest(rows + rows[:1])


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "runs")
    at = [datetime(2018, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3)]
    ledger.record_run(spark, path, "r1", "b1", "failed", at[0], at[1], failed_model="silver")
    ledger.record_run(spark, path, "r1", "b1", "success", at[0], at[1], rows_in=5, rows_out=7)
    ledger.record_run(spark, path, "r2", "b1", "failed", at[1], at[2])
    runs = ledger.read_runs(spark, path)
    assert {r.run_id: (r.status, r.rows_in) for r in runs.collect()} == {
        "r1": ("success", 5),
        "r2": ("failed", None),
    }
    assert ledger.latest_status_per_batch(runs).first().run_id == "r2"
    assert [r.run_id for r in ledger.newest_runs(runs, 1).collect()] == ["r2"]
    assert ledger.newest_runs(runs, batch_id="b2").isEmpty()
    with pytest.raises(ValueError):
        ledger.record_run(spark, path, "r3", "b1", "done", at[0], at[1])


def test_scratch_uses_the_shared_folder(spark):
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "s/"}[key]))
    first, second = (scratch.scratch_path(named, "x") for _ in range(2))
    assert first.startswith("s/x-") and first != second


def test_written_table_has_no_lineage(spark):
    back = scratch.written_table(spark.range(5), "ids")
    assert back.count() == 5 and "Range" not in back._jdf.queryExecution().toString()


def test_new_batches_are_loaded_once(spark, tmp_path):
    raw, bronze, marks = (str(tmp_path / n) for n in ("raw", "bronze", "marks"))

    def arrive(batch, *lines):
        folder = tmp_path / "raw" / batch
        folder.mkdir(parents=True)
        (folder / "access_log.txt").write_text("\n".join(lines) + "\n")

    def load():
        incremental.load_new_logs(spark, raw, bronze, marks).awaitTermination()
        counts = spark.read.parquet(bronze).groupBy("batch_id").count().collect()
        return {str(r.batch_id): r["count"] for r in counts}

    arrive("b1", GOOD, "garbage")
    assert load() == {"b1": 2}
    assert load() == {"b1": 2}
    arrive("b2", GOOD)
    assert load() == {"b1": 2, "b2": 1}


def test_new_leads_skip_the_excluded_folder(spark, tmp_path):
    for folder in ("b1", "_excluded"):
        (tmp_path / "raw" / folder).mkdir(parents=True)
        (tmp_path / "raw" / folder / "leads.jsonl").write_text('{"mql_id":"1"}\n')
    bronze = str(tmp_path / "bronze")
    incremental.load_new_leads(
        spark, str(tmp_path / "raw"), bronze, str(tmp_path / "marks")
    ).awaitTermination()
    assert [r.batch_id for r in spark.read.parquet(bronze).collect()] == ["b1"]
