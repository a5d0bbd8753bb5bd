"""CSV files whose quoted cells hold line breaks, read by many tasks, with bad records kept.

A line break ends a record only if an even number of quotes stands before it in the file. A task that reads
a split from its middle cannot know that number, but it can tell whether its own split holds an odd number:

1. each split gives its parity and the first and last of its lines with an odd number of quotes (no text is
   shuffled for this);
2. a running sum of parities over the splits of a file tells which splits begin or end within a record. Up to
   its first odd line such a split goes on with a record, from its last odd line it leaves one open; the lines
   between are whole records. These zones are up to three rows for each split, and are written;
3. lines of whole records are joined and parsed where they are, in the order in which a task reads them; only
   lines of records that go over the end of a split meet, by the split where their record starts.

A record that never ends (a quote too many) would take in the rest of its file, one of more than
``LONGEST_RECORD`` lines cannot be told from such: their lines are kept one by one as records that are not
parsed. So are records with too few or too many cells; of those nothing is kept but the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.raw_csv import BYTE_ORDER_MARK
from tidemark.sources.scratch import written_table

#: Lines of the longest record with line breaks.
LONGEST_RECORD = 10_000
PARSED, RECORD = "is_parsed", "raw_record"

_FILE, _SPLIT, _LENGTH, _ROW, _LINE, _PARITY = "__file", "__split", "__length", "__row", "__line", "__parity"
_CORRUPT = "__corrupt"


def _numbered_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """The lines of each split with an increasing number, and whether their quotes are odd (1).

    A split's lines come in order from one task, so their numbers have no gaps.
    """
    lines = spark.read.option("lineSep", "\n").text(pattern).select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_SPLIT),
        F.col("_metadata.file_block_length").alias(_LENGTH),
        F.monotonically_increasing_id().alias(_ROW),
        F.col("value").alias(_LINE),
    )
    quotes = F.length(_LINE) - F.length(F.replace(_LINE, F.lit('"'), F.lit("")))
    return lines.withColumn(_PARITY, F.pmod(quotes, F.lit(2)))


def _zones(lines: DataFrame) -> DataFrame:
    """For each split its ranges of lines: whole records, and parts of the record that began in split ``__of``.

    ``__whole`` is false for the parts of a record without an end, or of too many lines.
    """
    odd_row = F.when(F.col(_PARITY) == 1, F.col(_ROW))
    ends = lines.groupBy(_FILE, _SPLIT, _LENGTH).agg(
        F.pmod(F.sum(_PARITY), F.lit(2)).alias("__odd"),
        F.min(_ROW).alias("__first_row"),
        F.max(_ROW).alias("__last_row"),
        F.min(odd_row).alias("__closes"),
        F.max(odd_row).alias("__opens"),
    )
    earlier = Window.partitionBy(_FILE).orderBy(_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    entered = ends.withColumn("__entry", F.pmod(F.coalesce(F.sum("__odd").over(earlier), F.lit(0)), F.lit(2)) == 1)
    left_open = (F.col("__entry") != (F.col("__odd") == 1)) & F.col("__opens").isNotNull()
    placed = entered.withColumn("__left", left_open).withColumn(
        "__open", F.last(F.when(F.col("__left"), F.col(_SPLIT)), ignorenulls=True).over(earlier)
    )
    closed_at = F.coalesce("__closes", "__last_row")

    def zone(begin: Column, end: Column, of: Column, closed: Column) -> Column:
        return F.struct(begin.alias("__begin"), end.alias("__end"), of.cast("long").alias("__of"), closed.alias("__closed"))

    first, last, opens = F.col("__first_row"), F.col("__last_row"), F.col("__opens")
    inner_begin = F.when(F.col("__entry"), closed_at + 1).otherwise(first)
    inner_end = F.when(F.col("__left"), opens - 1).otherwise(last)
    zones = F.array_compact(
        F.array(
            F.when(F.col("__entry"), zone(first, closed_at, F.col("__open"), F.col("__closes").isNotNull())),
            F.when(inner_begin <= inner_end, zone(inner_begin, inner_end, F.lit(None), F.lit(True))),
            F.when(F.col("__left"), zone(opens, last, F.col(_SPLIT), F.lit(False))),
        )
    )
    each = placed.select(_FILE, _SPLIT, _LENGTH, "__first_row", F.explode(zones).alias("__zone")).select("*", "__zone.*").drop("__zone")
    record = Window.partitionBy(_FILE, "__of")
    n_lines = F.sum(F.col("__end") - F.col("__begin") + 1).over(record)
    ended = F.max("__closed").over(record) & (n_lines <= LONGEST_RECORD)
    return each.select(
        F.col(_FILE).alias("__of_file"),
        F.col(_SPLIT).alias("__of_split"),
        F.col(_LENGTH).alias("__of_length"),
        "__first_row",
        "__begin",
        "__end",
        "__of",
        (F.col("__of").isNull() | ended).alias("__whole"),
    )


def _joined_in_order(longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Joins lines that follow each other to records; those of more than ``longest`` lines stay lines.

    Where zones meet no record is open, so neither files nor splits need be told apart.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # lines of a record that is open where a batch ends; of one that is too long, only that it is open
        held, lost = None, False
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            held, n = None, rows.num_rows
            if n == 0:
                continue
            files, lines, parity, first, loose = rows.columns
            alone = loose.to_numpy(zero_copy_only=False).copy()
            odd = np.where(alone, 0, parity.to_numpy(zero_copy_only=False)).astype(np.int64)
            after = (np.cumsum(odd) + lost) % 2
            if lost:
                closing = np.flatnonzero(odd)
                alone[: closing[0] + 1 if len(closing) else n] = True
            begins = alone | ((after + odd) % 2 == 0)
            starts = np.flatnonzero(begins)
            sizes = np.diff(starts, append=n)
            alone |= np.repeat(sizes > longest, sizes)
            starts = np.flatnonzero(begins | alone)
            is_open = after[-1] == 1
            lost = bool(is_open and alone[-1])
            if is_open and not lost:
                held, n = rows.slice(starts[-1]), int(starts[-1])
                starts = starts[:-1]
            at = pa.array(starts, pa.int64())
            texts = pa.ListArray.from_arrays(pa.array(np.append(starts, n), pa.int32()), lines)
            yield pa.RecordBatch.from_arrays(
                [files.take(at), pc.binary_join(texts, "\n"), first.take(at), pa.array(~alone[starts])],
                names=[_FILE, RECORD, "__first", "__whole"],
            )

    return joined


def _records(lines: DataFrame) -> DataFrame:
    """``__file``, the text of each record, whether it is the file's first, and whether it is whole."""
    zones = F.broadcast(written_table(_zones(lines), "csv_zones"))
    of_split = (F.col(_FILE) == F.col("__of_file")) & (F.col(_SPLIT) == F.col("__of_split")) & (F.col(_LENGTH) == F.col("__of_length"))
    placed = lines.join(zones, of_split & F.col(_ROW).between(F.col("__begin"), F.col("__end")), "left")
    # the splits of a file may change with the cluster or the settings of the session; then no zone fits
    moved = F.raise_error(F.concat(F.lit("splits changed while reading "), F.col(_FILE))).cast("boolean")
    met = F.when(F.col("__whole").isNull(), moved).otherwise(F.col("__of").isNotNull() & F.col("__whole"))
    is_first = (F.col(_SPLIT) == 0) & (F.col(_ROW) == F.col("__first_row"))
    marked = placed.withColumn("__first", is_first)
    in_order = marked.where(~met).select(_FILE, _LINE, _PARITY, "__first", (~F.col("__whole")).alias("__loose"))
    here = in_order.mapInArrow(_joined_in_order(LONGEST_RECORD), f"{_FILE} string, {RECORD} string, __first boolean, __whole boolean")
    parts = F.array_sort(F.collect_list(F.struct(_SPLIT, _ROW, _LINE)))
    joined = marked.where(met).groupBy(_FILE, "__of").agg(
        F.array_join(F.transform(parts, lambda x: x[_LINE]), "\n").alias(RECORD), F.max("__first").alias("__first")
    )
    return here.unionByName(joined.select(_FILE, RECORD, "__first", F.lit(True).alias("__whole")))


def _without_header(records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each file's first record names the columns in their order, or reading fails."""
    names = F.split(F.regexp_replace(F.replace(F.regexp_replace(RECORD, f"^{BYTE_ORDER_MARK}", ""), F.lit('"'), F.lit("")), "\r$", ""), ",")
    right = names == F.array(*[F.lit(c) for c in columns])
    complaint = F.concat(F.lit(f"columns {', '.join(columns)} are not those of "), F.col(_FILE), F.lit(": "), F.col(RECORD))
    passed = F.when(~F.col("__first"), F.lit(True)).when(right, F.lit(False))
    return records.where(passed.otherwise(F.raise_error(complaint).cast("boolean")))


def _parsed(record: Column, columns: Sequence[str]) -> Column:
    shape = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, _CORRUPT)])
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_csv(record, shape.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)


def read_csv_lines(spark: SparkSession, root: str, batch_ids: Sequence[str], file_name: str, columns: Sequence[str]) -> DataFrame:
    """As ``read_csv_records`` for exports without line breaks in cells: every line is a record, no text is shuffled."""
    shape = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, RECORD)])
    pattern = f"{root.rstrip('/')}/{{{','.join(batch_ids)}}}/{file_name}"
    rows = (
        spark.read.schema(shape)
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", RECORD)
        .csv(pattern)
    )
    good = F.col(RECORD).isNull()
    return rows.select(
        *[F.when(good, F.col(c)).alias(c) for c in columns],
        good.alias(PARSED),
        RECORD,
        F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+(?:/part-[^/]+)?$", 1).alias("batch_id"),
        F.lit(file_name).alias("source_file"),
    )


def read_csv_records(spark: SparkSession, root: str, batch_ids: Sequence[str], file_name: str, columns: Sequence[str]) -> DataFrame:
    """All batches of one export, every value as text, with ``is_parsed``, ``raw_record`` and ``batch_id``.

    ``raw_record`` is the text of a record that is not parsed. Batches without the file are skipped by the
    path pattern; empty lines between records are none.
    """
    pattern = f"{root.rstrip('/')}/{{{','.join(batch_ids)}}}/{file_name}"
    records = _without_header(_records(_numbered_lines(spark, pattern)), columns)
    text = F.regexp_replace(RECORD, "\r$", "")
    filled = records.where(text != "").withColumns({RECORD: text, "__cells": F.when(F.col("__whole"), _parsed(text, columns))})
    good = F.col("__cells").isNotNull() & F.col(f"__cells.{_CORRUPT}").isNull()
    return filled.withColumn(PARSED, good).select(
        *[F.when(F.col(PARSED), F.col(f"__cells.{c}")).alias(c) for c in columns],
        PARSED,
        F.when(~F.col(PARSED), F.col(RECORD)).alias(RECORD),
        F.regexp_extract(_FILE, r"/([^/]+)/[^/]+(?:/part-[^/]+)?$", 1).alias("batch_id"),
        F.lit(file_name).alias("source_file"),
    )
