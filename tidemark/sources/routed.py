"""Records routed to folders in one pass: a folder for each batch, and some for what belongs to none.

    <root>/<route>/<file>/part-...      the records of a route
    <root>/_manifest.json               routes, records and digests; written last

Routes that begin with an underscore hold what was set apart; readers of batches skip them. While a folder
is being written there is no manifest, so whoever waits for one sees all routes or none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.batches import BatchPlan, replay_children
from tidemark.operators.skew import join_on_keys, lookup_join
from tidemark.sources.scratch import written_table
from tidemark.sources.versions import FileStore

MANIFEST = "_manifest.json"
#: Children that come after another of their key, have no parent, or lie after the cutoff.
REPEATED, ORPHANS, EXCLUDED = "_repeated", "_orphans", "_excluded"
#: A key with more children than this is compared by parts in several tasks.
HOT_ROWS, HOT_PARTS = 100_000, 64


@dataclass(frozen=True)
class RouteTotals:
    n_records: int
    digest: int


def first_and_repeated(children: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The first child of each key, and all others; copies of the first are others.

    Children are shuffled once, numbered by key, and written. A key with more than ``HOT_ROWS`` is numbered in
    ``HOT_PARTS`` parts, and the first rows of its parts are numbered again.
    """
    columns = children.columns
    ranked = [*order, *[c for c in columns if c not in order and c not in keys]]
    sizes = children.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    hot = sizes.where(F.col("__rows") > HOT_ROWS).select(*keys, F.lit(True).alias("__hot"))
    # at most one row for HOT_ROWS children
    part = F.when(F.col("__hot"), F.pmod(F.spark_partition_id(), F.lit(HOT_PARTS)))
    dealt = join_on_keys(children, F.broadcast(hot), keys, "left").withColumn("__part", part)
    by_part = Window.partitionBy(*keys, "__part").orderBy(*ranked)
    numbered = dealt.withColumn("__at", F.row_number().over(by_part)).drop("__hot")
    placed = written_table(numbered, "placed_children")
    heads = placed.where("__part IS NOT NULL AND __at = 1")
    again = heads.withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked)))
    settled = placed.where("__part IS NULL OR __at > 1").unionByName(again)
    return settled.where("__at = 1").select(*columns), settled.where("__at > 1").select(*columns)


def route_family(
    parents: DataFrame, children: DataFrame, key: str, parent_time: str, child_time: str, child_name: str,
    child_order: Sequence[str], plan: BatchPlan,
) -> tuple[DataFrame, DataFrame]:
    """Parents nested with their child for each batch (as ``replay_children``), and all other children.

    The second frame has the children's columns and ``route``: every child is in exactly one place.
    """
    first, repeated = first_and_repeated(children, [key], child_order)
    known = parents.select(key, F.lit(True).alias("__known"))
    judged = lookup_join(first, known, [key], "left")
    at = F.col(child_time).try_cast("timestamp_ntz")
    route = F.when(F.col("__known").isNull(), ORPHANS).when(plan.batch_of(at).isNull(), EXCLUDED)
    apart = judged.withColumn("route", route).where(F.col("route").isNotNull()).drop("__known")
    nested = replay_children(parents, first, key, parent_time, child_time, child_name, [F.asc(c) for c in child_order], plan)
    return nested, apart.unionByName(repeated.withColumn("route", F.lit(REPEATED)))


def _digest() -> Column:
    return F.sum(F.xxhash64("value").cast("decimal(28,0)"))


def write_routed(records: DataFrame, root: str, file_name: str) -> dict[str, RouteTotals]:
    """``route, value`` as lines of compressed text below each route, all in one pass; the manifest's content.

    Writing again replaces every route, also those that have no records any more.
    """
    spark, root = records.sparkSession, root.rstrip("/")
    store, staged = FileStore(spark, root), f"{root}/.staged-{uuid.uuid4().hex}"
    # even files, and a route that holds most of the records is split
    records.select("route", "value").hint("rebalance", F.col("route")).write.partitionBy("route").text(staged, compression="gzip")
    totals = route_totals(spark.read.schema("value string, route string").text(staged))
    for old in store.names(root):
        if not old.startswith(".") and old != MANIFEST and file_name in store.names(f"{root}/{old}"):
            store.delete(f"{root}/{MANIFEST}")
            store.delete(f"{root}/{old}/{file_name}")
    for folder in store.names(staged):
        if folder.startswith("route="):
            store.move(f"{staged}/{folder}", f"{root}/{unquote(folder.removeprefix('route='))}/{file_name}")
    store.delete(staged)
    text = {route: {"n_records": t.n_records, "digest": t.digest} for route, t in sorted(totals.items())}
    if not store.create(f"{root}/{MANIFEST}", json.dumps(text, indent=1)):
        raise FileExistsError(f"{root} was written by another job")
    return totals


def route_totals(records: DataFrame) -> dict[str, RouteTotals]:
    """Records and an order-free digest of each route: a row for each comes here."""
    rows = records.groupBy("route").agg(F.count(F.lit(1)).alias("n"), _digest().alias("digest")).collect()
    return {r.route: RouteTotals(r.n, int(r.digest)) for r in rows}


def read_routed(spark: SparkSession, root: str, file_name: str) -> DataFrame:
    """``route, value`` of all routes that the manifest names."""
    parts = [
        spark.read.text(f"{root.rstrip('/')}/{route}/{file_name}").select(F.lit(route).alias("route"), "value")
        for route in manifest(spark, root) or {}
    ]
    empty = spark.createDataFrame([], "route string, value string")
    for part in parts:
        empty = empty.unionByName(part)
    return empty


def manifest(spark: SparkSession, root: str) -> dict[str, RouteTotals] | None:
    """What the folder should hold; None while it is not there yet."""
    store, root = FileStore(spark, root), root.rstrip("/")
    if MANIFEST not in store.names(root):
        return None
    return {route: RouteTotals(**t) for route, t in json.loads(store.text(f"{root}/{MANIFEST}")).items()}


def differing_routes(spark: SparkSession, root: str, file_name: str) -> list[str]:
    """Routes whose files do not hold what the manifest says."""
    named, there = manifest(spark, root) or {}, route_totals(read_routed(spark, root, file_name))
    return sorted(route for route in {*named, *there} if named.get(route) != there.get(route))
