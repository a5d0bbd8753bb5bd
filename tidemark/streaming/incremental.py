"""Raw batch folders loaded as they arrive, each file exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.raw_leads import parse_json_lines
from tidemark.sources.raw_logs import parse_log_lines

BATCH_FOLDER = r"/([^/]+)/[^/]+$"


def _new_lines(spark: SparkSession, pattern: str, column: str) -> DataFrame:
    lines = spark.readStream.text(pattern)
    return lines.select(
        F.col("value").alias(column),
        F.regexp_extract("_metadata.file_path", BATCH_FOLDER, 1).alias("batch_id"),
        F.col("_metadata.file_name").alias("source_file"),
    )


def _append(bronze: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append what is new and stop; the checkpoint remembers which files were read."""
    return (
        bronze.withColumn("ingested_at", F.current_timestamp())
        .writeStream.format("parquet")
        .partitionBy("batch_id")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(table_path)
    )


def load_new_logs(
    spark: SparkSession, raw_root: str, table_path: str, checkpoint: str
) -> StreamingQuery:
    """``<raw_root>/<batch_id>/<file>.txt`` into the bronze event table."""
    lines = _new_lines(spark, f"{raw_root.rstrip('/')}/*/*.txt", "raw_line")
    return _append(parse_log_lines(lines), table_path, checkpoint)


def load_new_leads(
    spark: SparkSession, raw_root: str, table_path: str, checkpoint: str
) -> StreamingQuery:
    """``<raw_root>/<batch_id>/<file>.jsonl`` into the bronze lead table; ``_…`` folders are skipped."""
    lines = _new_lines(spark, f"{raw_root.rstrip('/')}/[!_]*/*.jsonl", "raw_json")
    return _append(parse_json_lines(lines), table_path, checkpoint)
