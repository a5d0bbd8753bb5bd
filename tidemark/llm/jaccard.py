"""Similarity join of word n-grams: MinHash candidates, pruned by posterior, verified exactly.

A text's set holds the hashes of its runs of ``WORDS`` words (parted by ASCII white space, unchanged); a shorter text
is one run, a text without words has no links. Texts with equal sets are one class from the start.

1. ``BANDS`` bands of ``ROWS`` MinHash values put sets into buckets; sets that agree in no band are never
   compared (at a similarity of 0.8 all bands differ for 3 pairs in a million).
2. Within a bucket MinHash values are compared a few at a time. A pair is dropped once the posterior probability
   that its similarity reaches the threshold (uniform prior) falls below ``TOLERANCE``, at a similarity of 0.8
   once in a million pairs. Every bucket compares the same sketches, so such a pair gets no second chance. The bucket
   reports which sets hang together, a row for each set and never a row for each pair.
3. The clusters that follow get their sets, and all pairs within a cluster are verified exactly: the sets'
   incidence matrix times its transpose gives all intersections. Large buckets and clusters are
   cut into blocks, and pairs of blocks are tasks of their own.

Every document gets its class (the least ``doc_id`` of those it is connected with) and the number of other
documents that its text is similar to, copies included. Null ids come first, null texts are empty; rows that repeat an id and text are
counted each; extra columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import _powers
from tidemark.llm.common import as_bytes, map_arrow, portions, stored
from tidemark.llm.components import components
from tidemark.llm.windows import _FIRST, Shape, compressed, rows_of, unpacked, written

WORDS = 5
THRESHOLD = (4, 5)  # 0.8 as a fraction, so that it is compared in whole numbers
BANDS, ROWS = 32, 5
STEP = 16
TOLERANCE = 1e-7
#: Sets of a bucket, and of a cluster, that one task compares with as many others.
BUCKET_BLOCK, CLUSTER_BLOCK = 2000, 256
_COLUMNS = 8192
_UNITS = Shape(size=WORDS, gram=WORDS, words=True)


def shingles(text: bytes) -> np.ndarray:
    """The distinct hashes of the text's runs of words, ascending."""
    values = _UNITS.units(np.frombuffer(text, np.uint8))[2]
    if not len(values):
        return values
    n = len(values) - WORDS + 1 if len(values) >= WORDS else 1
    run = min(WORDS, len(values))
    weights = _powers(WORDS)[0]
    grams = np.zeros(n, np.uint64)
    for k in range(run):
        grams += values[k : n + k] * weights[k]
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(0x94D049BB133111EB)
    return np.unique(grams ^ grams >> np.uint64(30))


@cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(5)
    n = BANDS * ROWS
    return random.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), random.integers(0, 1 << 32, n, np.uint32)


def minima(grams: np.ndarray) -> np.ndarray:
    """The MinHash values, 32 bits each."""
    factors, masks = _functions()
    low = (grams >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 1024):
        part = (low[at : at + 1024] ^ masks[:, None]) * factors[:, None]
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(best, part.min(axis=1), out=best)
    return best


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights = _powers(ROWS + 1)[0][1 : ROWS + 1]
    bands = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for batch in portions(batches):
        columns: list[list] = [[], [], [], []]
        for text in as_bytes(batch.column("text")):
            grams = shingles(text)
            if not len(grams):
                for column in columns:
                    column.append(None)
                continue
            least = minima(grams)
            keys = (least.reshape(BANDS, ROWS).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64) + bands
            keys = (keys ^ keys >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            columns[0].append(int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True))
            columns[1].append(len(grams))
            columns[2].append((keys ^ keys >> np.uint64(32)).view(np.int64).tolist())
            columns[3].append((least * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes())
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("row"), *arrays], names=["doc", "row", "sid", "size", "keys", "sketch"])


@cache
def least_matches() -> np.ndarray:
    """After 16, 32, ... values: the matches below which a pair is dropped.

    Sketch values have eight bits, so sets of similarity s match with probability s + (1 - s) / 256.
    """
    similarity = (np.arange(4000) + 0.5) / 4000
    match = similarity + (1 - similarity) / 256
    reach = similarity >= THRESHOLD[0] / THRESHOLD[1]
    found = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(match) + (n - m) * np.log1p(-match + 1e-12)
            weight = np.exp(log - log.max())
            if weight[reach].sum() >= TOLERANCE * weight.sum():
                break
        found.append(m)
    return np.array(found)


def similar(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Indices of the sketches that may be similar to one of them, compared step by step."""
    left, matches = np.arange(len(others)), np.zeros(len(others), np.int64)
    for at, least in zip(range(0, BANDS * ROWS, STEP), least_matches()):
        matches = matches + (others[left, at : at + STEP] == one[at : at + STEP]).sum(axis=1)
        stay = matches >= least
        left, matches = left[stay], matches[stay]
        if not len(left):
            break
    return left


def hanging_together(sketches: np.ndarray) -> np.ndarray:
    """For each sketch the first of those it is connected with by pairs that were not dropped."""
    root = np.full(len(sketches), -1)
    left = np.arange(len(sketches))
    while len(left):
        first, queue, left = left[0], [left[0]], left[1:]
        root[first] = first
        while queue and len(left):
            near = similar(sketches[queue.pop()], sketches[left])
            if len(near):
                root[left[near]] = first
                queue += left[near].tolist()
                left = np.delete(left, near)
    return root


def _grouped(keys: int, solve: Callable[[list[tuple]], list[tuple]], kinds: tuple, names: list[str]):
    """Runs ``solve`` on the rows of each key in turn (rows come sorted by their first ``keys`` columns)."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        found: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if group and row[:keys] != group[0][:keys]:
                    found += solve(group)
                    group = []
                    if len(found) >= 10_000:
                        yield out(found)
                        found = []
                group.append(row)
        if group:
            found += solve(group)
        if found:
            yield out(found)

    return run


def _bucket_links(group: list[tuple]) -> list[tuple]:
    sids = [r[3] for r in group]
    root = hanging_together(np.frombuffer(b"".join(r[4] for r in group), np.uint8).reshape(len(group), -1))
    return [(sids[i], sids[r]) for i, r in enumerate(root.tolist()) if sids[i] != sids[r]]


def _block_pairs(frame: DataFrame, total: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks that its own block is part of; ``x <= y`` number the blocks."""
    blocks = F.ceil(F.col(total) / block).cast("int")
    own = F.pmod(F.xxhash64("sid", F.lit(3)), blocks).cast("int")
    paired = frame.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return paired.withColumn("x", F.least("__own", "__other")).withColumn("y", F.greatest("__own", "__other")).drop("__own", "__other")


def verified(sids: list[int], sets: list[np.ndarray], weights: np.ndarray, sides: np.ndarray | None) -> list[tuple]:
    """``sid, links, documents, root`` for each set, over exactly verified pairs.

    ``sides``: with two blocks, which of them each set is of; only pairs across are counted then.
    """
    n = len(sids)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], (np.cumsum(count > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, (at, at + _COLUMNS))
        matrix = np.zeros((n, min(_COLUMNS, int(column[b - 1]) - at + 1)), np.float32)
        matrix[owner[a:b], column[a:b] - at] = 1
        common += matrix @ matrix.T
    whole = common.astype(np.int64)
    linked = THRESHOLD[1] * whole >= THRESHOLD[0] * (sizes[:, None] + sizes - whole)
    np.fill_diagonal(linked, False)
    if sides is not None:
        linked &= sides[:, None] != sides
    out = []
    root = np.full(n, -1)
    for first in range(n):
        if root[first] < 0:
            root[first], queue = first, [first]
            while queue:
                near = np.flatnonzero(linked[queue.pop()] & (root < 0))
                root[near] = first
                queue += near.tolist()
    for i in range(n):
        out.append((sids[i], int(linked[i].sum()), int(weights[linked[i]].sum()), sids[root[i]]))
    return out


def _cluster_links(group: list[tuple]) -> list[tuple]:
    sides = np.array([r[6] for r in group]) if group[0][1] != group[0][2] else None
    return verified([r[3] for r in group], [np.frombuffer(r[5], np.uint64) for r in group], np.array([r[4] for r in group], np.int64), sides)


def _cluster_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, "packed", 1 << 20):
        sets = [shingles(unpacked(x)).tobytes() for x in batch.column("packed").to_pylist()]
        at = batch.schema.get_field_index("packed")
        yield batch.set_column(at, "grams", pa.array(sets, pa.binary()))


def candidate_clusters(sets: DataFrame, bucket_block: int = BUCKET_BLOCK) -> DataFrame:
    """``a, b``: sets that hang together by pairs that were not dropped; ``sets`` has ``sid, keys, sketch``."""
    members = sets.select("sid", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select(F.col("key").alias("bucket"), "members")
    found = members.join(shared, F.col("key").eqNullSafe(F.col("bucket"))).select("sid", "bucket", "members")
    with_sketch = _block_pairs(found.join(sets.select("sid", "sketch"), "sid"), "members", bucket_block)
    dealt = with_sketch.select("bucket", "x", "y", "sid", "sketch").repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    links = map_arrow(dealt, _grouped(3, _bucket_links, (pa.int64(), pa.int64()), ["a", "b"]), "a long, b long")
    return components(links)


def similar_documents(documents: DataFrame, bucket_block: int = BUCKET_BLOCK, cluster_block: int = CLUSTER_BLOCK) -> DataFrame:
    """``doc_id, class_id, class_size, n_links, kept, row``; of each class the document with the least id stays."""
    rows = rows_of(documents)
    with written(map_arrow(rows, _sketches, "doc long, row long, sid long, size long, keys array<long>, sketch binary")) as sketched:
        held = stored(sketched.select("doc", "row", "sid"))
        sets = sketched.where("sid IS NOT NULL").groupBy("sid").agg(F.first("keys").alias("keys"), F.first("sketch").alias("sketch"), F.min(F.struct("doc", "row")).alias("of"), F.count("*").alias("documents"))
        with written(sets) as distinct:
            stars = candidate_clusters(distinct, bucket_block)
            roots = stars.select("b").distinct().select(F.col("b").alias("sid"), F.col("b").alias("cluster"))
            clusters = roots.unionByName(stars.select(F.col("a").alias("sid"), F.col("b").alias("cluster")))
            totals = clusters.groupBy("cluster").agg(F.count("*").alias("total")).select(F.col("cluster").alias("c"), "total")
            placed = clusters.join(totals, F.col("cluster").eqNullSafe(F.col("c"))).join(distinct.select("sid", "of.doc", "of.row", "documents"), "sid")
            fetched = compressed(rows).join(placed.select("sid", "cluster", "total", "doc", "row", "documents"), ["doc", "row"])
            unique = map_arrow(fetched.select("sid", "cluster", "total", "documents", "packed"), _cluster_sets, "sid long, cluster long, total long, documents long, grams binary")
            own = F.pmod(F.xxhash64("sid", F.lit(3)), F.ceil(F.col("total") / cluster_block).cast("int")).cast("int")
            dealt = _block_pairs(unique.withColumn("side", own), "total", cluster_block).select("cluster", "x", "y", "sid", "documents", "grams", "side")
            dealt = dealt.repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "sid")
            links = stored(map_arrow(dealt, _grouped(3, _once, (pa.int64(),) * 4, ["sid", "links", "documents", "root"]), "sid long, links long, documents long, root long"))
    counted = links.groupBy("sid").agg(F.sum("documents").alias("linked")).where("linked > 0").select(F.col("sid").alias("s"), "linked")
    joined = components(links.select(F.col("sid").alias("a"), F.col("root").alias("b"))).select(F.col("a").alias("n"), F.col("b").alias("root"))
    copies = held.where("sid IS NOT NULL").groupBy("sid").agg(F.count("*").alias("copies"), F.min(F.struct("doc", "row")).alias("least"))
    classed = (
        copies.join(joined, F.col("sid").eqNullSafe(F.col("n")), "left")
        .join(counted, F.col("sid").eqNullSafe(F.col("s")), "left")
        .select("sid", "copies", "least", F.coalesce("root", "sid").alias("class"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    classed = stored(classed)
    classes = classed.groupBy("class").agg(F.min("least").alias("first"), F.sum("copies").alias("class_size")).select(F.col("class").alias("c"), "first", "class_size")
    told = classed.join(classes, F.col("class").eqNullSafe(F.col("c"))).select(F.col("sid").alias("s"), "first", "class_size", "n_links")
    alone = F.col("s").isNull()
    plain = F.when(F.col("doc") == _FIRST, F.lit(None)).otherwise(F.col("doc"))
    first = F.when(F.col("first.doc") == _FIRST, F.lit(None)).otherwise(F.col("first.doc"))
    return held.join(told, F.col("sid").eqNullSafe(F.col("s")) & F.col("sid").isNotNull(), "left").select(
        plain.alias("doc_id"),
        F.when(alone, plain).otherwise(first).alias("class_id"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("class_size")).alias("class_size"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        (alone | (F.struct("doc", "row") == F.col("first"))).alias("kept"),
        "row",
    )


def _once(group: list[tuple]) -> list[tuple]:
    """Rows that repeat an id and text bring a set more than once; it is compared once."""
    return _cluster_links(list({r[3]: r for r in group}.values()))


def without_similar(documents: DataFrame) -> DataFrame:
    """One document of each class (rows that repeat it stay with it), all columns unchanged."""
    gone = similar_documents(documents).where("NOT kept").select(F.col("row").alias("__row"), F.coalesce("doc_id", F.lit(_FIRST)).alias("__doc")).distinct()
    doc = F.coalesce(documents["doc_id"].cast("long"), F.lit(_FIRST))
    row = F.xxhash64(doc, F.coalesce(documents["text"].cast("string"), F.lit("")))
    return documents.join(gone, (doc == gone["__doc"]) & (row == gone["__row"]), "left_anti")
