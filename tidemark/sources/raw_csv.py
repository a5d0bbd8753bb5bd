"""CSV exports, one folder per batch: ``<root>/<batch_id>/<file>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTE_ORDER_MARK = "\ufeff"


def read_batch_csv(
    spark: SparkSession,
    root: str,
    batch_ids: Sequence[str],
    file_name: str,
    columns: Sequence[str],
    multi_line: bool = False,
) -> DataFrame:
    """All batches of one export in one scan, every value as text.

    Batches without the file are skipped by the path pattern. The header of
    every file must name ``columns`` in order: a moved column is an error, not
    a silent shift. ``multi_line`` allows line breaks inside quotes, at the
    price of one task per file.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    pattern = f"{root.rstrip('/')}/{{{','.join(batch_ids)}}}/{file_name}"
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .csv(pattern)
    )
    return rows.select(
        *columns,
        F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+(?:/part-[^/]+)?$", 1).alias(
            "batch_id"
        ),
        F.lit(file_name).alias("source_file"),
    )


def write_batch_csv(rows: DataFrame, root: str, batch_id: str, file_name: str) -> None:
    """One batch as CSV parts with header and byte order mark, empty cells for NULL."""
    first, *rest = rows.columns
    (
        rows.select(F.col(first).alias(f"{BYTE_ORDER_MARK}{first}"), *rest)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(f"{root.rstrip('/')}/{batch_id}/{file_name}")
    )
