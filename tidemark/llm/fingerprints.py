"""Fingerprints of whole texts by context-triggered piecewise hashing.

A rolling hash of the last ``WINDOW`` bytes ends a chunk wherever its low bits are zero; the number of
bits (the block size is two to its power) is the least that leaves at most ``CHUNKS`` ends. A fingerprint
is ``block size:signature:signature at twice the block size``, a signature one letter for each chunk.
Fingerprints are likened by edit distance at a block size that both have; others are not alike (0).

``edited_neighbours`` compares each text with its edited form and with the next document by ``doc_id``
(nulls first, ties by text; after the last comes the first). Documents are dealt by ranges of ``doc_id``;
the first document of each range also goes to the range before, so no task sees more than a document at
a time and texts are shuffled once.

Null counts as empty; an empty text's fingerprint is ``1::``. Equal fingerprints are alike by 1. One row
comes out for each row in; extra columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, map_arrow, portions, table

WINDOW = 7
CHUNKS = 64
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_FIRST = -(1 << 63)


def _rolled(raw: np.ndarray) -> np.ndarray:
    """A mixed 32-bit hash of the last WINDOW bytes at each byte."""
    rolled = np.zeros(len(raw), np.uint32)
    wide = raw.astype(np.uint32) + np.uint32(1)
    weight = 1
    for back in range(min(WINDOW, len(raw))):
        rolled[back:] += wide[: len(raw) - back] * np.uint32(weight)
        weight = weight * 0x01000193 & 0xFFFFFFFF
    for factor, shift in ((0x7FEB352D, 15), (0x846CA68B, 16)):
        rolled ^= rolled >> np.uint32(shift)
        rolled *= np.uint32(factor)
    return rolled ^ rolled >> np.uint32(15)


def _signature(sums: np.ndarray, ends: np.ndarray, n: int) -> str:
    """A letter for each chunk; ``sums``: the hashes' running sums."""
    cuts = np.concatenate(([0], ends + 1, [n] if not len(ends) or ends[-1] + 1 < n else [])).astype(np.int64)
    chunks = sums[cuts[1:]] - sums[cuts[:-1]]
    chunks = (chunks ^ chunks >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return _LETTERS[(chunks >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str) -> str:
    raw = np.frombuffer(text.encode(), np.uint8)
    n = len(raw)
    if not n:
        return "1::"
    rolled = _rolled(raw)
    bits = max(0, (n // CHUNKS).bit_length() - 1)
    ends = _ends(rolled, bits)
    while bits and len(ends) <= CHUNKS:
        bits -= 1
        ends = _ends(rolled, bits)
    while len(ends) > CHUNKS:
        bits += 1
        ends = ends[(rolled[ends] & np.uint32((1 << bits) - 1)) == 0]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(rolled, out=sums[1:], dtype=np.uint64)
    twice = ends[(rolled[ends] & np.uint32((2 << bits) - 1)) == 0]
    return f"{1 << bits}:{_signature(sums, ends, n)}:{_signature(sums, twice, n)}"


def _ends(rolled: np.ndarray, bits: int) -> np.ndarray:
    return np.flatnonzero((rolled & np.uint32((1 << bits) - 1)) == 0)


def likeness(a: str, b: str) -> F.Column:
    """Between 0 and 1, of two fingerprint columns."""
    left, right = F.split(a, ":"), F.split(b, ":")
    size_a, size_b = left[0].cast("long"), right[0].cast("long")

    def alike(x: F.Column, y: F.Column) -> F.Column:
        longer = F.greatest(F.length(x), F.length(y))
        return F.when(longer == 0, F.lit(0.0)).otherwise(1 - F.levenshtein(x, y) / longer)

    return (
        F.when(F.col(a) == F.col(b), F.lit(1.0))
        .when(size_a == size_b, F.greatest(alike(left[1], right[1]), alike(left[2], right[2])))
        .when(size_a == 2 * size_b, alike(left[1], right[2]))
        .when(2 * size_a == size_b, alike(left[2], right[1]))
        .otherwise(F.lit(0.0))
    )


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many (or all) of the following text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """``place, ahead, doc_id, text``: rows by range of ``doc_id``; ``ahead`` rows repeat the next range's first."""
    docs = id_and_text(documents)
    key = F.coalesce("doc_id", F.lit(_FIRST))
    ranges = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.min(key).alias("first"), F.percentile_approx(key, shares, max(10_000, 4 * ranges)).alias("cuts")).first()
    first = found["first"]
    cuts = np.array(sorted({c for c in found["cuts"] or [] if c > first}), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("doc_id").fill_null(_FIRST).to_numpy(zero_copy_only=False)
            place = np.searchsorted(cuts, keys, "right")
            extra = np.flatnonzero(np.isin(keys, cuts) | (keys == first))
            before = np.where(keys[extra] == first, len(cuts), place[extra] - 1)
            rows = np.concatenate((np.arange(len(keys)), extra))
            picked = batch.take(pa.array(rows))
            ahead = np.arange(len(rows)) >= len(keys)
            places = np.concatenate((place, before)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(ahead), *picked.columns], names=["place", "ahead", "doc_id", "text"])

    return map_arrow(docs, run, "place long, ahead boolean, doc_id long, text string")


def edited_neighbours(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # place, doc_id, text, fingerprint
        for batch in portions(batches):
            rows = []
            for place, ahead, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = fingerprint(text)
                if held is not None and held[0] == place:
                    other = edited(held[2], text)
                    rows.append((held[1], len(held[2]), hashlib.sha256(other.encode()).hexdigest(), held[3], fingerprint(other), own))
                held = None if ahead else (place, doc_id, text, own)
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 4]
            yield table({name: ([r[i] for r in rows], kinds[i]) for i, name in enumerate(_NAMES)})

    dealt = with_next(documents, ranges).repartition("place").sortWithinPartitions("place", "ahead", "doc_id", "text")
    found = map_arrow(dealt, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string")
    return found.select(
        *_NAMES[:5], likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next")
    )


_NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint")
