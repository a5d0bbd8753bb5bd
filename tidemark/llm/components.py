"""Connected components of links: forests in each task, then in one task, or by alternating large and small stars.

Each task first reduces its links to a forest, by union-find. Few links that are left (``FEW`` ids take some
ten megabytes) are joined in one task; more of them by rounds of stars, whose work stays distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, stored

ROUNDS = 60
FEW = 1 << 18


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b``: every node but the least of its tree in this task's links, with that least one."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while parent.get(top, top) != top:
            top = parent[top]
        while node != top:
            parent[node], node = top, parent.get(node, node)
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for at in range(0, len(nodes), 100_000):
        some = nodes[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(map(root, some), pa.int64())], names=["a", "b"])


def _nearest(edges: DataFrame) -> DataFrame:
    """``a, b`` with the least neighbour of ``a`` (or ``a`` itself) beside; the join's shuffles can be split."""
    least = edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("of"), F.least("least", "a").alias("least"))
    return edges.join(least, F.col("a").eqNullSafe(F.col("of"))).select("a", "b", "least")


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: every node but the least of its component, with that least one; ``edges`` has longs ``a, b``."""
    edges = stored(map_arrow(edges.where("a <> b").select("a", "b"), _forest, "a long, b long"))
    if edges.count() <= FEW:
        return stored(map_arrow(edges.repartition(1), _forest, "a long, b long"))
    edges = stored(edges.distinct())
    before = None
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _nearest(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        near = _nearest(large)
        small = near.select("a", F.col("least").alias("b")).unionByName(near.select(F.col("b").alias("a"), F.col("least").alias("b")))
        edges = stored(small.where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now
    raise ValueError(f"components are not found after {ROUNDS} rounds")
