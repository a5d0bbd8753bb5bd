"""What the text operators share: reading, Arrow passes, and tables written to cut lineage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and UTF-8 bytes that a Python worker gets and holds at once (one longer text is a batch of its own).
BATCH_ROWS = 1000
BATCH_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the whole text, null as empty; other columns, whatever their names, are left out."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def stored(frame: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder and read from there: lost executors lose nothing.

    The folder is the one the session names; only where it names none (tests) one is set here.
    """
    context = frame.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
        context.setCheckpointDir(named)
    return frame.checkpoint(eager=True)


def map_arrow(frame: DataFrame, each: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with batches of at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES``.

    A worker gives back what a task has freed before it waits for the next one, perhaps of another operator.
    """
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from each(batches)
        give_back_memory()

    return frame.mapInArrow(run, schema)


def give_back_memory() -> None:
    """Freed memory of this worker goes back to the system: a worker is used again, by tasks that need less."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def portions(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``most`` bytes of the column each."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        begin = held = 0
        for row, length in enumerate(lengths):
            if row > begin and held + length > most:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += length
        if begin < len(lengths):
            yield batch.slice(begin)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def table(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in columns.values()], names=list(columns))
