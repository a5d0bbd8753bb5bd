"""Bronze and published tables: audit columns, sinks, read-back summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

AUDIT_COLUMNS = ("batch_id", "source_file", "ingested_at")
BATCH = "batch_id"
MISSING = "-"  # stands for NULL in a digest; texts begin with their length


def add_audit_columns(
    rows: DataFrame, batch_id: str | Column, source_file: str | Column
) -> DataFrame:
    def as_column(value):
        return value if isinstance(value, Column) else F.lit(value)

    return rows.withColumns(
        {
            "batch_id": as_column(batch_id),
            "source_file": as_column(source_file),
            "ingested_at": F.current_timestamp(),
        }
    )


def overwrite_batches(rows: DataFrame, path: str, partition: str = BATCH) -> None:
    """Replace only the partitions that ``rows`` contains; running twice changes nothing.

    Rebalancing gives files of even size and splits a batch that holds most of
    the rows over several tasks, which a hash on the batch would not.
    """
    (
        rows.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def overwrite_counted(rows: DataFrame, path: str, partition: str = BATCH) -> int:
    """As ``overwrite_batches``; how many rows went in, counted on their way.

    A task that runs again after a lost executor may count its rows twice, so a caller that finds
    another number in the table counts once more before it believes it.
    """
    seen = Observation()
    overwrite_batches(rows.observe(seen, F.count(F.lit(1)).alias("n_rows")), path, partition)
    return seen.get["n_rows"]


def create_table(
    spark: SparkSession, name: str, columns_ddl: str, partition: str = BATCH, using: str = "parquet"
) -> None:
    """Database and partitioned table, if they are not there yet."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING {using} "
        f"PARTITIONED BY ({partition})"
    )


def overwrite_table_batches(rows: DataFrame, name: str, partition: str = BATCH) -> None:
    """As ``overwrite_batches``, into a catalog table; columns are matched by name.

    Inserting into a table takes the overwrite mode from the session alone, so
    it is set for this statement and put back.
    """
    spark = rows.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        (
            rows.select(*spark.table(name).columns)
            .hint("rebalance", F.col(partition))
            .write.mode("overwrite")
            .insertInto(name)
        )
    finally:
        spark.conf.set(mode, before)


def batch_load_summary(
    table: DataFrame, present: str | None = None, batch_id: str | None = None
) -> DataFrame:
    """Rows, rows with ``present`` and unparsed rows per batch, in one pass.

    Filtering on the partition column reads only that batch.
    """
    chosen = table if batch_id is None else table.filter(F.col(BATCH) == batch_id)
    measures = [F.count(F.lit(1)).alias("n_rows")]
    if present is not None:
        measures.append(F.count(present).alias("n_present"))
    if "is_parsed" in table.columns:
        measures.append(F.count_if(~F.col("is_parsed")).alias("n_unparsed"))
    return chosen.groupBy(BATCH).agg(*measures)


def batch_fingerprint(rows: DataFrame, columns: Sequence[str], partition: str = BATCH) -> DataFrame:
    """Row count and an order-free content digest per batch.

    Each row's SHA-256 gives a 60-bit number; their exact sum does not depend
    on row order or file layout, and copies count. Values go in with their length,
    so neither a separator inside a text nor a missing value can stand for another row.
    """

    def cell(column: str) -> Column:
        text = F.col(column).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(MISSING))

    text = F.concat_ws("|", *[cell(c) for c in columns])
    row_digest = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(28,0)")
    return rows.groupBy(partition).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(row_digest).alias("content_digest")
    )


def write_manifest(rows: DataFrame, columns: Sequence[str], path: str) -> None:
    """Readiness manifest: a batch is ready once its fingerprint row is there."""
    overwrite_batches(batch_fingerprint(rows, columns), path)
