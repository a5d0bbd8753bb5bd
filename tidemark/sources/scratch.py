"""Written intermediate tables, and small lookup tables that ship with the code."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names for checkpoints.

    Without one only a session on this machine alone (a test) gets a local folder; a cluster's
    executors would each write to their own disk, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: HotSpot leaves longer methods (in bytes) interpreted; Spark's own limit is far above it.
LONGEST_METHOD = 8000


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Inside, a stage whose one generated method is too long to be compiled runs operator by operator, in short methods."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(min(LONGEST_METHOD, int(before))))
    try:
        yield
    finally:
        spark.conf.set(limit, before)


def written_table(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once and read back, for a frame that feeds several branches.

    The folder goes when the driver ends.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    with compiled_methods(spark):
        rows.write.parquet(path, compression="zstd")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(rows.schema).parquet(path)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Lookup rows as literals in the plan: one task, however large the cluster.

    Times are given as text, so no time zone of the driver gets in.
    """
    fields = T.StructType.fromDDL(schema).fields
    literals = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    return (
        spark.range(0, 1, 1, 1).select(F.explode(F.array(*literals)).alias("row")).select("row.*")
    )
