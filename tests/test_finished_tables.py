"""Finished tables follow their input files."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.catalog.tables import Tables
from tidemark.sources.scratch import written_table


def test_replaced_files_are_read_anew(spark, tmp_path):
    pq.write_table(pa.table({"n_nationkey": [1], "n_name": ["PERU"], "n_regionkey": [1]}), tmp_path / "nation.parquet")
    pq.write_table(pa.table({"r_regionkey": [1], "r_name": ["AMERICA"]}), tmp_path / "region.parquet")

    def customers(keys):
        rows = pa.table({"c_custkey": keys, "c_name": [f"c{k}" for k in keys], "c_nationkey": [1] * len(keys)})
        pq.write_table(rows, tmp_path / "customer.parquet")
        return Tables(spark, str(tmp_path))["customers"]

    first = customers([1, 2])
    assert {r.customer_id for r in first.collect()} == {"1", "2"}
    assert Tables(spark, str(tmp_path))["customers"] is first  # unchanged files: written once
    assert {r.customer_id for r in customers([3, 4, 5]).collect()} == {"3", "4", "5"}


def test_tables_are_written_in_methods_that_are_compiled(spark, monkeypatch):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before, seen, write = spark.conf.get(limit), [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: (seen.append(int(spark.conf.get(limit))), write(*a, **k))[1])
    assert written_table(spark.range(3), "few").count() == 3
    with pytest.raises(Exception, match="no table"):
        written_table(spark.range(3).select(F.raise_error(F.lit("no table")).alias("x")), "none")
    assert seen == [8000, 8000] and spark.conf.get(limit) == before
