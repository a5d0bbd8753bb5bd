"""Windows of units (bytes or words) grouped by their minimiser, shared by the two substring operators.

Of the k-grams inside a window the one with the least hash (the leftmost of equal ones) is its minimiser.
Equal windows have equal minimisers at the same place, so windows need to meet only others of their
minimiser; consecutive windows that share one travel as one packed string. A minimiser that
occurs once in all texts cannot belong to a repeated window, and is dropped before any text moves.

Steps that both operators share, all keyed so that a hot key is split:

1. ``repeated_keys``: minimisers' hashes counted with a map-side combine.
2. ``packed_strings``: the documents that hold repeated ones are joined with them, and the packed strings
   cut out and written, compressed, to the shared folder.
3. the operator tells for each distinct string which of its windows are repeated;
4. ``spans_of_rows`` brings that back to the documents as spans of units.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import _powers, _ranges, piece_hashes
from tidemark.llm.common import as_bytes, map_arrow, portions, stored

#: Windows of one text that are looked at together; longer texts are cut, with overlap.
SEGMENT = 1 << 20
#: Bytes of strings that a task holds before it hands them on: one text may give a string for each of its windows.
HELD_BYTES = 4 << 20
_FIRST = -(1 << 63)


@dataclass(frozen=True)
class Shape:
    """Windows of ``size`` units, minimisers of ``gram`` units; units are bytes, or words parted by ASCII white space."""

    size: int
    gram: int
    words: bool

    def units(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the units begin and end, and a value for each."""
        if not self.words:
            begins = np.arange(len(raw))
            return begins, begins + 1, raw.astype(np.uint64) + np.uint64(1)
        edge = np.diff(_IN_WORD[raw], prepend=0, append=0)
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return begins, ends, piece_hashes(raw, begins, ends)


_IN_WORD = np.ones(256, np.int8)
_IN_WORD[[*range(9, 14), 32]] = 0


def super_kmers(values: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text's units: each run of windows by one minimiser, as first and last window, minimiser's place and hash."""
    windows = len(values) - shape.size + 1
    if windows <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64)
    parts = [_runs(values[at : min(len(values), at + SEGMENT + shape.size - 1)], shape, at) for at in range(0, windows, SEGMENT)]
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(4))


def _runs(values: np.ndarray, shape: Shape, before: int) -> tuple[np.ndarray, ...]:
    n, k = len(values), shape.gram
    powers = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers[0][:n], out=sums[1:])
    grams = (sums[k:] - sums[:-k]) * powers[1][: n - k + 1]
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(0x94D049BB133111EB)
    grams ^= grams >> np.uint64(30)
    least = grams & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
    width, span = shape.size - k + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: span - width], least[width - span :])
    places = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
    last = np.append(first[1:], len(places)) - 1
    return first + before, last + before, places[first] + before, grams[places[first]]


def rows_of(documents: DataFrame) -> DataFrame:
    """``doc, row, text``: null ids come first, null texts are empty; ``row`` tells texts of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST))
    return documents.select(doc.alias("doc"), F.xxhash64(doc, text).alias("row"), text.alias("text"))


def _anchors(shape: Shape) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            keys, rows, order = [], [], []
            for row, text in zip(batch.column("row").to_pylist(), as_bytes(batch.column("text"))):
                if len(text) < shape.size:
                    continue
                found = super_kmers(shape.units(np.frombuffer(text, np.uint8))[2], shape)[3]
                keys.append(found.view(np.int64))
                rows.append(np.full(len(found), row))
                order.append(np.arange(len(found), dtype=np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, rows, order)], names=["key", "row", "number"])

    return run


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in portions(batches):
        packed = [packer.compress(x) for x in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("row"), pa.array(packed, pa.binary())], names=["doc", "row", "packed"])


def unpacked(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def compressed(rows: DataFrame) -> DataFrame:
    """The texts as a third of their bytes, for the shuffle."""
    return map_arrow(rows, _compressed, "doc long, row long, packed binary")


@contextmanager
def written(frame: DataFrame) -> Iterator[DataFrame]:
    """The frame as a compressed table in the shared checkpoint folder, which is removed at the end."""
    spark = frame.sparkSession
    stored(spark.range(1))  # makes sure that the folder is set
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/table-{uuid.uuid4().hex}")
    frame.write.option("compression", "zstd").parquet(path.toString())
    try:
        yield spark.read.schema(frame.schema).parquet(path.toString())
    finally:
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def packed_strings(rows: DataFrame, shape: Shape) -> DataFrame:
    """``key, place, string, sid_a, sid_b, doc, row, first``: the strings of repeated minimisers.

    ``place`` is the minimiser's unit in the string, ``first`` the string's first unit in its text, the two
    ids are the string's 128-bit digest.
    """
    anchors = map_arrow(rows.select("row", "text"), _anchors(shape), "key long, row long, number int")
    repeated = anchors.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("twice"))
    # null-safe equality gives the join shuffles of its own, of which Spark can split a hot key's
    wanted = anchors.join(repeated, F.col("key").eqNullSafe(F.col("twice")), "left_semi").groupBy("row").agg(F.collect_set("number").alias("numbers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "packed", 1 << 20):
            out: list[tuple] = []
            held = 0
            for doc, row, raw, numbers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                text = unpacked(raw)
                begins, ends, values = shape.units(np.frombuffer(text, np.uint8))
                first, last, place, key = super_kmers(values, shape)
                for i in sorted(numbers):
                    if i >= len(first):
                        continue  # another text with this row's hash
                    a, b = int(first[i]), int(last[i]) + shape.size - 1
                    string = text[begins[a] : ends[b]]
                    if shape.words:
                        string = b" ".join(string.split())
                    digest = np.frombuffer(hashlib.blake2b(string, digest_size=16).digest(), np.int64)
                    out.append((int(key[i : i + 1].view(np.int64)[0]), int(place[i]) - a, string, int(digest[0]), int(digest[1]), doc, row, a))
                    held += len(string)
                    if len(out) >= 20_000 or held >= HELD_BYTES:
                        yield _string_rows(out)
                        out, held = [], 0
            if out:
                yield _string_rows(out)

    joined = compressed(rows).join(wanted, "row").select("doc", "row", "packed", "numbers")
    return map_arrow(joined, run, "key long, place int, string binary, sid_a long, sid_b long, doc long, row long, first int")


def _string_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    names = ("key", "place", "string", "sid_a", "sid_b", "doc", "row", "first")
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=list(names))


def spans_of_rows(strings: DataFrame, covered: DataFrame, condition: F.Column | None = None) -> DataFrame:
    """``doc, row, spans``: ``covered`` has ``sid_a, sid_b, runs`` (begin and end of units within the string)."""
    members = strings.select("sid_a", "sid_b", "doc", "row", "first")
    found = members.join(covered, ["sid_a", "sid_b"]).select("doc", "row", "first", F.explode("runs").alias("run"))
    if condition is not None:
        found = found.where(condition)
    span = F.struct((F.col("first") + F.col("run.begin")).alias("begin"), (F.col("first") + F.col("run.end")).alias("end"))
    return found.groupBy("doc", "row").agg(F.collect_set(span).alias("spans"))


def removed_units(spans: list[dict], n: int) -> tuple[np.ndarray, int]:
    """Which of n units the spans cover, and in how many maximal runs."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, [s["begin"] for s in spans], 1)
    np.add.at(edge, [s["end"] for s in spans], -1)
    gone = np.cumsum(edge)[:n] > 0
    return gone, int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc, packed, spans`` of every row; ``spans`` is null where nothing goes."""
    return compressed(rows).join(spans, ["doc", "row"], "left").select("doc", "packed", "spans")


__all__ = ["Shape", "_ranges", "compressed", "packed_strings", "removed_units", "rows_of", "spans_of_rows", "super_kmers", "unpacked", "with_spans", "written"]
