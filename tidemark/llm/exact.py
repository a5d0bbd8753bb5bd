"""Exact copies: counting quotient filters find repeated fingerprints, the texts' bytes decide.

Texts are equal when they are the same bytes after lower-casing A-Z only; null counts as empty.

1. One pass gives each row its 64-bit fingerprint and digest (a small stored table).
2. Each partition builds a counting quotient filter; its slices by fingerprint range go to that range's
   merger. A hot group reaches the shuffle as one counter for each partition.
3. Rows with a fingerprint counted twice or more are fetched by ``doc_id``, and grouped by their
   normalised text itself: two texts that share a fingerprint stay apart. Spark combines copies before
   the shuffle.

Of equal texts the rows with the largest ``doc_id`` stay (nulls lose; rows that repeat that id are the
same document and stay together). An empty table gives no rows. Columns besides ``doc_id`` and ``text``
play no part.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, id_and_text, map_arrow, stored, table
from tidemark.llm.quotient import CountingQuotientFilter, merged_all

#: Rows for each range of the fingerprint space, about; ranges are merged apart, and grow in number with the rows.
RANGE_ROWS = 1 << 20
LEAST_RANGE_BITS = 10

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def normalised(text: str | F.Column) -> F.Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x.translate(_LOWER) for x in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.array([xxhash.xxh3_64_intdigest(x) for x in texts], np.uint64).view(np.int64)),
                pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary()),
            ],
            names=["doc_id", "print", "digest"],
        )


def range_bits(rows: int) -> int:
    return max(LEAST_RANGE_BITS, (rows // RANGE_ROWS).bit_length())


def _filters(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The partition's filter, cut by fingerprint range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = merged_all(CountingQuotientFilter.of(batch.column("print").to_numpy().view(np.uint64)) for batch in batches)
        if held is None:
            return
        prints, counts = held.entries()
        ranges = (prints >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])[: len(ranges)])
        # the range's own bits are the same for all of it: shifted out, they leave quotients their full use
        slices = [
            CountingQuotientFilter.of_sorted(prints[a:b] << np.uint64(bits), counts[a:b]).to_bytes()
            for a, b in zip(cuts, [*cuts[1:], len(prints)])
        ]
        yield table({"range": (ranges[cuts].tolist(), pa.int32()), "filter": (slices, pa.binary())})

    return run


def _repeated(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Merges the filters of one range after the other (rows come sorted by range)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
        for batch in batches:
            yield from zip(batch.column("range").to_pylist(), batch.column("filter").to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, own in groupby(rows(batches), itemgetter(0)):
            prints, counts = merged_all(CountingQuotientFilter.from_bytes(raw) for _, raw in own).entries()
            prints = prints[counts > 1] >> np.uint64(bits) | np.uint64(number << (64 - bits))
            yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64))], names=["print"])

    return run


def exact_copies(documents: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row."""
    docs = id_and_text(documents)
    prints = stored(map_arrow(docs, _prints, "doc_id long, print long, digest binary"))
    bits = range_bits(prints.count())
    filters = map_arrow(prints.select("print"), _filters(bits), "range int, filter binary")
    repeated = map_arrow(filters.repartition("range").sortWithinPartitions("range"), _repeated(bits), "print long")
    wanted = stored(prints.join(repeated, "print", "left_semi").select(F.col("doc_id").alias("wanted")).distinct())
    groups = (
        docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
        .groupBy(normalised("text").alias("normalised"))
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("normalised", 256).alias("sha"), "keep_id", "group_size")
    )
    rows = prints.select("doc_id", F.lower(F.hex("digest")).alias("text_sha256"))
    alone = F.col("group_size").isNull()
    # null-safe equality gives the join shuffles of its own, of which Spark can split a hot text's
    return rows.join(groups, rows.text_sha256.eqNullSafe(groups.sha), "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def without_copies(documents: DataFrame) -> DataFrame:
    """The rows that stay, all their columns unchanged."""
    gone = exact_copies(documents).where("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    sha = F.sha2(normalised(F.coalesce(documents["text"], F.lit(""))), 256)
    return documents.join(gone, (sha == gone["__sha"]) & documents["doc_id"].eqNullSafe(gone["__id"]), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g USING (t)
"""
