"""Repeated passages of words, by super-k-mers: every window of ``SHAPE.size`` words that an earlier document has too.

Consecutive windows that share a minimiser travel as one packed string (see ``windows``). Equal strings
are combined on the way, with the least id of their documents; in the minimiser's bucket the windows of
the distinct strings are sorted, and equal neighbours share the least id of all. A minimiser with
more than ``BUCKET_STRINGS`` distinct strings is not gathered in one task: its windows are dealt out by their
own 128-bit digests and aggregated.

A word goes if a window over it also starts in a document with a smaller ``doc_id`` (null: the smallest
of all). Null texts have no words. Rows that repeat an id are not earlier than one another; repeated rows
get the same result each; extra columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, portions, stored
from tidemark.llm.windows import _FIRST, Shape, packed_strings, removed_units, rows_of, spans_of_rows, unpacked, with_spans, written

SHAPE = Shape(size=50, gram=16, words=True)
BUCKET_STRINGS = 20_000
_COVERED = "sid_a long, sid_b long, runs array<struct<begin:int,end:int,doc:long>>"
_RUNS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("doc", pa.int64())]))


def window_bytes(string: bytes, size: int) -> list[bytes]:
    """Each window of the packed string."""
    cuts = [-1, *np.flatnonzero(np.frombuffer(string, np.uint8) == 32).tolist(), len(string)]
    return [string[cuts[i] + 1 : cuts[i + size]] for i in range(len(cuts) - size)]


def runs_of(least: list[int], size: int) -> list[dict]:
    """Units covered by consecutive windows whose least document is the same."""
    found, at = [], 0
    for doc, same in groupby(least):
        n = len(list(same))
        found.append({"begin": at, "end": at + n - 1 + size, "doc": doc})
        at += n
    return found


def _sorted_buckets(size: int):
    def solve(group: list[tuple]) -> list[tuple]:
        entries = []
        for i, (_, string, _, _, doc) in enumerate(group):
            entries += [(window, doc, i, j) for j, window in enumerate(window_bytes(string, size))]
        entries.sort(key=lambda e: e[0])
        least = [{} for _ in group]
        for _, same in groupby(entries, key=lambda e: e[0]):
            same = list(same)
            low = min(e[1] for e in same)
            for _, _, i, j in same:
                least[i][j] = low
        return [(a, b, runs_of([low[j] for j in range(len(low))], size)) for (_, _, a, b, _), low in zip(group, least)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if group and row[0] != group[0][0]:
                    out += solve(group)
                    group = []
                    if len(out) >= 5_000:
                        yield _covered(out)
                        out = []
                group.append(row)
        if group:
            out += solve(group)
        if out:
            yield _covered(out)

    return run


def _covered(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), _RUNS)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["sid_a", "sid_b", "runs"])


def _digested(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "string", 1 << 18):
            columns: list[list] = [[], [], [], []]
            digests = []
            for string, a, b, doc in zip(*(batch.column(x).to_pylist() for x in ("string", "sid_a", "sid_b", "doc"))):
                windows = window_bytes(string, size)
                digests += [hashlib.blake2b(w, digest_size=16).digest() for w in windows]
                for column, values in zip(columns, ([a] * len(windows), [b] * len(windows), [doc] * len(windows), range(len(windows)))):
                    column += values
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(digests, pa.binary())], names=["sid_a", "sid_b", "doc", "number", "window"])

    return run


def least_documents(distinct: DataFrame, shape: Shape, bucket_strings: int) -> DataFrame:
    """``sid_a, sid_b, runs`` of distinct strings ``key, string, sid_a, sid_b, doc``; only windows of several documents matter."""
    sizes = distinct.groupBy("key").agg(F.count("*").alias("strings"))
    heavy = stored(sizes.where(F.col("strings") > bucket_strings).select("key"))
    light = distinct.join(heavy, "key", "left_anti")
    bucketed = light.select("key", "string", "sid_a", "sid_b", "doc").repartition("key").sortWithinPartitions("key")
    found = map_arrow(bucketed, _sorted_buckets(shape.size), _COVERED)
    if heavy.isEmpty():
        return found
    windows = map_arrow(distinct.join(heavy, "key", "left_semi").select("string", "sid_a", "sid_b", "doc"), _digested(shape.size), "sid_a long, sid_b long, doc long, number long, window binary")
    least = windows.groupBy("window").agg(F.min("doc").alias("least"))
    run = F.struct(F.col("number").cast("int").alias("begin"), (F.col("number") + shape.size).cast("int").alias("end"), F.col("least").alias("doc"))
    joined = windows.join(least, "window").groupBy("sid_a", "sid_b").agg(F.collect_list(run).alias("runs"))
    return found.unionByName(joined)


def earlier_spans(rows: DataFrame, shape: Shape = SHAPE, bucket_strings: int = BUCKET_STRINGS) -> DataFrame:
    """``doc, row, spans`` of words that windows of earlier documents cover (stored)."""
    with written(packed_strings(rows, shape)) as strings:
        distinct = strings.groupBy("key", "sid_a", "sid_b").agg(F.first("string").alias("string"), F.min("doc").alias("doc"))
        with written(distinct) as single:
            covered = least_documents(single, shape, bucket_strings)
            return stored(spans_of_rows(strings, covered, F.col("run.doc") < F.col("doc")))


def without_earlier_passages(documents: DataFrame, shape: Shape = SHAPE, bucket_strings: int = BUCKET_STRINGS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` of every row; ``kept`` is the rest of its text, words parted by one space."""
    rows = rows_of(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "packed", 1 << 20):
            out = []
            for doc, raw, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = unpacked(raw).split()
                n = len(words)
                if spans:
                    gone, _ = removed_units(spans, n)
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept = b" ".join(words)
                out.append((None if doc == _FIRST else doc, n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)

    return map_arrow(with_spans(rows, earlier_spans(rows, shape, bucket_strings)), run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
