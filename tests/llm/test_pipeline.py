"""Registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.support import rows_of_duckdb, rows_of_spark
from tidemark.llm import secrets
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_as_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert rows_of_spark(QUERIES[name](spark, SF)) == rows_of_duckdb(duck.execute(ORACLES[name]))


def test_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_pipeline_stages_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        after = {r.doc_id: r for r in docs.collect()}
        gone = set(before) - set(after)
        if name == "toxicity":
            labelled = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert len(gone & toxic) >= 0.7 * len(toxic & set(before)) and len(gone & labelled - toxic) <= 0.1 * len(labelled)
        elif name == "exact dedup":
            assert len({r.text.lower() for r in after.values()}) <= len(after) == len({secrets_lower(r.text) for r in before.values()})
        elif name == "secret scans":
            assert not gone
            for i, r in after.items():
                found = secrets.found_in((before[i].text or "").encode(), secrets.scanner())
                assert (r.text == before[i].text) == (not found) and r.n_chars == len(r.text)
        before = after
        docs = spark.createDataFrame(list(after.values()), docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == set(before)
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


def secrets_lower(text: str) -> str:
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
