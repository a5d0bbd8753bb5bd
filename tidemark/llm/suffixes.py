"""Repeated byte strings, by sorted suffixes: every byte under a string of ``SHAPE.size`` bytes that starts twice.

The suffixes that are sorted stand at minimisers (see ``windows``): every window holds one, at the same
place in equal windows. Packed strings carry a suffix from its minimiser on, and the bytes before it;
equal strings are combined on the way and counted. Buckets are ranges of the suffixes' leading bytes between
sampled splitters, and a splitter never parts suffixes that lead alike, so no window's two occurrences
are on both sides of a boundary. A bucket sorts the suffixes, and the reversed bytes before them, by
multikey quicksort on eight-byte symbols; neighbours' common prefixes then tell for each split of a window
into bytes before and bytes from the minimiser on which windows are equal. Leads with more than
``BUCKET_STRINGS`` distinct strings are dealt out window by window instead, by 128-bit digests.

Null texts are empty. Every row is a text of its own, so repeated rows repeat each other; extra columns
play no part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, portions, stored
from tidemark.llm.windows import _FIRST, Shape, packed_strings, removed_units, rows_of, spans_of_rows, unpacked, with_spans, written

SHAPE = Shape(size=200, gram=64, words=False)
BUCKET_STRINGS = 100_000
#: Distinct strings that a bucket sorts together (one lead's strings are never parted).
SORTED_STRINGS = 20_000
_COVERED = "sid_a long, sid_b long, runs array<struct<begin:int,end:int>>"
_RUNS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def multikey_order(symbols: np.ndarray) -> np.ndarray:
    """The order of the rows, by their first symbol, then the second, and so on.

    Multikey quicksort over all open groups at once: a level orders each group by the next symbol; what
    is less or greater is done with it, what is equal stays a group and goes on to the symbol after.
    """
    n, depth = symbols.shape
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # of each position: the position at which its group begins
    open_ = np.arange(n)
    for level in range(depth):
        if not len(open_):
            break
        own = order[open_]
        inner = np.lexsort((symbols[own, level], group[open_]))
        order[open_] = own = own[inner]
        keys, groups = symbols[own, level], group[open_]
        new = np.append(True, (keys[1:] != keys[:-1]) | (groups[1:] != groups[:-1]))
        heads = np.flatnonzero(new)
        group[open_] = open_[heads][np.cumsum(new) - 1]
        sizes = np.diff(np.append(heads, len(open_)))
        open_ = open_[np.repeat(sizes > 1, sizes)]
    return order


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Bytes that each sorted row shares with the one before (the first: 0)."""
    differ = rows[1:] != rows[:-1]
    return np.append(0, np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])) if len(rows) else np.zeros(0, np.int64)


def _classes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the byte rows, and what each shares with the one before."""
    order = multikey_order(np.ascontiguousarray(rows).view(">u8").astype(np.uint64))
    return order, common_prefixes(rows[order])


def repeated_windows(strings: list[bytes], places: np.ndarray, counts: np.ndarray, shape: Shape) -> np.ndarray:
    """Row by string, column by window: whether the window occurs more than once in all strings (with counts)."""
    n, size = len(strings), shape.size
    before = size - shape.gram  # bytes before a minimiser, at most
    lengths = np.fromiter(map(len, strings), np.int64, n)
    joined = np.frombuffer(b"".join(strings), np.uint8)
    begins = np.cumsum(lengths) - lengths
    after = _rows(joined, begins + places, lengths - places, -(-size // 8) * 8, 1)
    prior = _rows(joined, begins + places - 1, places, -(-before // 8) * 8, -1)
    (right, right_shared), (left, left_shared) = _classes(after), _classes(prior)
    windows = lengths - size + 1
    found = np.zeros((n, int(windows.max(initial=0))), bool)
    for d in range(before + 1):
        use = np.flatnonzero((places >= d) & (places - d < windows))
        if not len(use):
            continue
        right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
        right_class[right] = np.cumsum(right_shared < size - d)
        left_class[left] = np.cumsum(left_shared < d) if d else 0
        _, which = np.unique(right_class[use] * (n + 1) + left_class[use], return_inverse=True)
        found[use, places[use] - d] = np.bincount(which, counts[use])[which] > 1
    return found


def _rows(joined: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, step: int) -> np.ndarray:
    """A row of bytes from each start on, forwards or backwards, zeros after its end."""
    columns = np.arange(width)
    inside = columns < lengths[:, None]
    return np.where(inside, joined[np.where(inside, starts[:, None] + step * columns, 0)], 0).astype(np.uint8)


def runs_of(windows: np.ndarray, size: int) -> list[dict]:
    edge = np.diff(windows.astype(np.int8), prepend=0, append=0)
    return [{"begin": int(a), "end": int(b) - 1 + size} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def _sorted_buckets(shape: Shape):
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated_windows([r[1] for r in rows], np.array([r[2] for r in rows]), np.array([r[5] for r in rows]), shape)
        out = [(r[3], r[4], runs_of(own, shape.size)) for r, own in zip(rows, found)]
        kinds = (pa.int64(), pa.int64(), _RUNS)
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["sid_a", "sid_b", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if len(held) >= SORTED_STRINGS and row[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    return run


def _digested(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "string", 1 << 16):
            rows = []
            for string, a, b, count in zip(*(batch.column(x).to_pylist() for x in ("string", "sid_a", "sid_b", "count"))):
                rows += [(a, b, count, i, hashlib.blake2b(string[i : i + size], digest_size=16).digest()) for i in range(len(string) - size + 1)]
            kinds = (*[pa.int64()] * 4, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["sid_a", "sid_b", "count", "number", "window"])

    return run


def covered_bytes(distinct: DataFrame, shape: Shape, bucket_strings: int) -> DataFrame:
    """``sid_a, sid_b, runs`` of distinct strings ``key, place, string, sid_a, sid_b, count``."""
    sizes = distinct.groupBy("key").agg(F.count("*").alias("strings"))
    heavy = stored(sizes.where(F.col("strings") > bucket_strings).select("key"))
    lead = F.substring("string", F.col("place") + 1, F.lit(shape.gram))
    light = distinct.join(heavy, "key", "left_anti").select(lead.alias("lead"), "string", "place", "sid_a", "sid_b", "count")
    buckets = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = map_arrow(light.repartitionByRange(buckets, "lead").sortWithinPartitions("lead"), _sorted_buckets(shape), _COVERED)
    if heavy.isEmpty():
        return found
    windows = map_arrow(distinct.join(heavy, "key", "left_semi").select("string", "sid_a", "sid_b", "count"), _digested(shape.size), "sid_a long, sid_b long, count long, number long, window binary")
    repeated = windows.groupBy("window").agg(F.sum("count").alias("all")).where("all > 1").select("window")
    run = F.struct(F.col("number").cast("int").alias("begin"), (F.col("number") + shape.size).cast("int").alias("end"))
    return found.unionByName(windows.join(repeated, "window", "left_semi").groupBy("sid_a", "sid_b").agg(F.collect_list(run).alias("runs")))


def repeated_spans(rows: DataFrame, shape: Shape = SHAPE, bucket_strings: int = BUCKET_STRINGS) -> DataFrame:
    """``doc, row, spans`` of bytes under repeated strings (stored)."""
    with written(packed_strings(rows, shape)) as strings:
        distinct = strings.groupBy("key", "place", "sid_a", "sid_b").agg(F.first("string").alias("string"), F.count("*").alias("count"))
        with written(distinct) as single:
            covered = covered_bytes(single, shape, bucket_strings).where("size(runs) > 0")
            return stored(spans_of_rows(strings, covered))


def without_repeats(documents: DataFrame, shape: Shape = SHAPE, bucket_strings: int = BUCKET_STRINGS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row; ``kept`` has the bytes that remain."""
    rows = rows_of(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "packed", 1 << 20):
            out = []
            for doc, raw, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text, kept, runs = unpacked(raw), None, 0
                if spans:
                    gone, runs = removed_units(spans, len(text))
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                kept = text if kept is None else kept
                out.append((None if doc == _FIRST else doc, len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
            kinds = (*[pa.int64()] * 4, pa.string(), pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)

    return map_arrow(with_spans(rows, repeated_spans(rows, shape, bucket_strings)), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
