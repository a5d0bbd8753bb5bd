"""Winning rows per key, kept as a bucketed table that a batch changes only where its keys are.

A state holds, for every key, the rows of the batch that wins: the newest one that has the key (a snapshot),
or the first one (lines sent again). Its table is partitioned by a hash of the key and bucketed by the key,
in a layer of versions:

* a batch reads its own rows, finds the parts its keys fall into, and writes new versions of those parts;
  other parts stay as the files they are;
* the kept rows of a part are found by an anti-join with the batch's keys on the column the table is
  bucketed by, so the state is read bucket by bucket and not shuffled;
* a batch that was loaded before is loaded again the same way. Keys it has no more fall back to the next
  best batch, which is looked up in the rows of those batches, for these keys alone. No other load reads
  older rows.

A key with a large share of all rows is spread: the bucketed column begins with a salt taken from the rest
of the row, and the narrow side of the join (one row per key) carries all salts. Null keys are one key.
Rows of one batch that share a key all stay, or the first of a given order does.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.batches import BatchPlan
from tidemark.operators.latest import first_per_key, latest_rows
from tidemark.sources.versions import PART, Draft, Layer

KEY, SEQUENCE, VERSION = "__key", "__sequence", "version"
#: A join on more columns than the bucketed one may use the buckets all the same.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Shape:
    """What competes and how it is stored.

    Rows with equal ``keys`` compete; rows with equal ``within`` (some of the keys, all by default) share
    a part. ``order`` decides among rows of one batch; without one all of them stay. Unless a number of
    ``buckets`` is given, a new table gets as many as the session has shuffle partitions, and keeps them.
    """

    name: str
    keys: tuple[str, ...]
    within: tuple[str, ...] = ()
    newest: bool = True
    order: tuple[str, ...] = ()
    parts: int = 8
    buckets: int | None = None
    spread: int = 4

    @property
    def place(self) -> tuple[str, ...]:
        return self.within or self.keys

    @property
    def beyond(self) -> tuple[str, ...]:
        """Keys that the bucketed column does not hold."""
        return tuple(k for k in self.keys if k not in self.place)

    def key_text(self) -> Column:
        def cell(name: str) -> Column:
            text = F.col(name).cast("string")
            return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

        return F.concat_ws(",", *[cell(k) for k in self.place])

    def part(self) -> Column:
        return F.pmod(F.hash(self.key_text()), F.lit(self.parts)).cast("int")

    def keyed(self, rows: DataFrame) -> DataFrame:
        """The rows with their part and salted key."""
        salt = F.pmod(F.xxhash64(*(self.beyond or rows.columns)), F.lit(self.spread))
        return rows.withColumns({KEY: F.concat(salt.cast("string"), F.lit("|"), self.key_text()), PART: self.part()})

    def keys_of(self, rows: DataFrame) -> DataFrame:
        """One narrow row for each key of keyed rows and each salt its rows may have."""
        if self.beyond:
            return rows.select(KEY, *self.beyond).distinct()
        plain = rows.select(F.expr(f"substring({KEY}, instr({KEY}, '|') + 1)").alias(KEY)).distinct()
        salts = F.explode(F.sequence(F.lit(0), F.lit(self.spread - 1)))
        return plain.select(KEY, salts.alias("salt")).select(F.concat(F.col("salt").cast("string"), F.lit("|"), KEY).alias(KEY))

    def matched(self, rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        """Semi- or anti-join of keyed rows with narrow keys."""
        own = keys.select(F.col(KEY).alias("__other"), *[F.col(k).alias(f"__other_{k}") for k in self.beyond])
        same = [F.col(KEY) == F.col("__other"), *[F.col(k).eqNullSafe(F.col(f"__other_{k}")) for k in self.beyond]]
        return rows.join(own, reduce(and_, same), how)

    def winners(self, rows: DataFrame) -> DataFrame:
        """Of rows with a sequence, those that win."""
        if self.newest:
            return latest_rows(rows, self.keys, SEQUENCE)
        return first_per_key(rows, self.keys, [F.asc(SEQUENCE), *map(F.asc, self.order)])


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class KeyedState:
    """One state of a layer; changes go into a draft of that layer."""

    def __init__(self, layer: Layer, shape: Shape, plan: BatchPlan) -> None:
        self.layer, self.shape, self.plan = layer, shape, plan
        self.spark = layer.spark
        self.folder = f"{layer.path}/{shape.name}"
        self.table = f"keyed_state_{hashlib.sha256(self.folder.encode()).hexdigest()[:24]}"

    def batches(self, draft: Draft) -> list[str]:
        """The batches the state was built from."""
        return draft.notes.get(self.shape.name, [])

    def _buckets(self, draft: Draft) -> int:
        wanted = self.shape.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return draft.notes.setdefault(f"{self.shape.name} buckets", wanted)

    def current(self, draft: Draft, parts: Iterable[int] | None = None) -> DataFrame | None:
        """The rows of the state or of some of its parts, with part, salted key and sequence; None while it has no table."""
        if self.shape.name not in draft.tables:
            return None
        known = draft.tables[self.shape.name]["folders"]
        if not self.spark.catalog.tableExists(self.table):
            self._create(T.StructType.fromJson(json.loads(draft.tables[self.shape.name]["schema"])), self._buckets(draft))
        places = {int(part): folder.split("/")[1].removeprefix(f"{VERSION}=") for part, folder in known.items()}
        if places:
            named = " ".join(f"PARTITION ({VERSION}='{v}', {PART}={p})" for p, v in places.items())
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {named}")
        wanted = [p for p in places if parts is None or p in set(parts)]
        by_version: dict[str, list[int]] = {}
        for part in wanted:
            by_version.setdefault(places[part], []).append(part)
        there = [(F.col(VERSION) == v) & F.col(PART).isin(p) for v, p in by_version.items()]
        rows = self.spark.table(self.table)
        return rows.where(reduce(or_, there) if there else F.lit(False)).drop(VERSION)

    def _create(self, columns: T.StructType, buckets: int) -> None:
        """Another session wrote the files: this one's catalog learns of them."""
        self.spark.sql(
            f"CREATE TABLE {self.table} ({columns.toDDL()}, {VERSION} STRING, {PART} INT) USING parquet PARTITIONED BY ({VERSION}, {PART}) "
            f"CLUSTERED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{self.folder}'"
        )

    def _parts(self, rows: DataFrame) -> set[int]:
        return {r[PART] for r in rows.select(PART).distinct().collect()}

    def _write(self, draft: Draft, rows: DataFrame, touched: Iterable[int]) -> None:
        data = [c for c in rows.columns if c not in (PART, VERSION)]
        versioned = rows.select(*data, F.lit(draft.name).alias(VERSION), PART)
        writer = versioned.write.mode("append").format("parquet").partitionBy(VERSION, PART)
        with _setting(self.spark, CO_PARTITION, "false"):
            writer.bucketBy(self._buckets(draft), KEY).option("path", self.folder).saveAsTable(self.table)
        draft.point_parts(self.shape.name, rows.select(*data), f"{self.shape.name}/{VERSION}={draft.name}", touched)

    def rebuild(self, draft: Draft, rows: DataFrame, batches: Sequence[str]) -> list[int]:
        """The state from the rows of all batches, which have a ``batch_id``; all parts are written."""
        shape, position = self.shape, self.plan.position_of(F.col("batch_id"))
        if not shape.newest:
            position = F.coalesce(position, F.lit(len(self.plan.ids)))  # batches that are not planned rank last
        winners = shape.winners(rows.withColumn(SEQUENCE, position))
        every = list(range(shape.parts))
        self._write(draft, shape.keyed(winners).repartition(self._buckets(draft), KEY), every)
        draft.notes[shape.name] = list(batches)
        return every

    def load(self, draft: Draft, batch_id: str, rows: DataFrame, others: Callable[[list[str]], DataFrame]) -> list[int]:
        """Takes in the rows of one batch, for the first time or again; the parts that were written.

        ``others`` gives the rows of other batches, of which only those a repeated load needs are asked for.
        """
        shape, plan = self.shape, self.plan
        sequence, loaded = plan.sequence_of(batch_id), self.batches(draft)
        again = batch_id in loaded
        weaker = [b for b in loaded if (plan.sequence_of(b) < sequence) == shape.newest and b != batch_id]
        stronger = [b for b in loaded if b != batch_id and b not in weaker]
        chosen = first_per_key(rows, shape.keys, [F.asc(c) for c in shape.order]) if shape.order else rows
        new = self._set_aside(draft, shape.keyed(chosen.withColumn(SEQUENCE, F.lit(sequence))))
        keys, touched = shape.keys_of(new), self._parts(new)
        before = self.current(draft)
        gone = None
        if again:
            old = before.where(F.col(SEQUENCE) == sequence)
            touched |= self._parts(old)
            gone = shape.matched(shape.keys_of(old), keys, "left_anti")
        pieces = []
        if before is not None:
            before = self.current(draft, touched)
            beats = F.col(SEQUENCE) > sequence if shape.newest else F.col(SEQUENCE) < sequence
            yields = F.col(SEQUENCE) < sequence if shape.newest else F.col(SEQUENCE) > sequence
            if weaker:
                pieces.append(shape.matched(before.where(yields), keys, "left_anti"))
            if stronger:
                pieces.append(before.where(beats))
                new = shape.matched(new, shape.keys_of(before.where(beats)), "left_anti")
        pieces.append(new.repartition(self._buckets(draft), KEY))
        if gone is not None and weaker and not gone.isEmpty():
            candidates = others(weaker).withColumn(SEQUENCE, plan.position_of(F.col("batch_id")))
            back = shape.winners(shape.matched(shape.keyed(candidates), gone, "left_semi"))
            pieces.append(back.repartition(self._buckets(draft), KEY))
        self._write(draft, reduce(DataFrame.unionByName, pieces), sorted(touched))
        draft.notes[shape.name] = sorted({*loaded, batch_id}, key=plan.sequence_of)
        return sorted(touched)

    def _set_aside(self, draft: Draft, rows: DataFrame) -> DataFrame:
        """The batch's rows as files: they are read for their keys, their parts and themselves."""
        place = f"{self.layer.path}/{self.shape.name}_incoming/{draft.name}"
        rows.write.parquet(place)
        return self.spark.read.schema(rows.schema).parquet(place)
