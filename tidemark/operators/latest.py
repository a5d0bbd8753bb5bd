"""One row per key, or the latest rows per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import join_on_keys, with_group_values

RANK = "__rank"
LATEST = "__latest"
POSITION = "__position"
HASH = "__hash"
#: Bits of the marks that are broadcast: at most a row for each 64 of them, however many keys are marked.
MARK_BITS = 1 << 26
#: Hashes of keys are counted as numbers below this: five bytes of each row are shuffled.
HASHES = 1 << 40


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given total order.

    Spark keeps the first row per key within each task before the shuffle
    (WindowGroupLimit), so a key with many copies arrives as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)
    )


def latest_rows(
    rows: DataFrame,
    keys: Sequence[str],
    sequence: str,
    lowest: int | None = None,
) -> DataFrame:
    """All rows whose sequence is the highest of their key; ties are kept.

    NULL keys form one group, rows without a sequence are dropped. No sequence may be below ``lowest``:
    a row is then older than others only if its key has a row above it, and only rows that share
    their mark with such a key are shuffled.
    """
    known = rows.filter(F.col(sequence).isNotNull())
    if lowest is not None:
        later = known.filter(F.col(sequence) > lowest).groupBy(*keys).agg(F.max(sequence).alias(LATEST))
        sure, unsure = _parted(known, keys, later.select(_hash_of(keys).alias(HASH)))
        newer = F.col(sequence) < F.col(LATEST)
        return sure.unionByName(join_on_keys(unsure, later, keys, "left_anti", also=newer))
    marked = with_group_values(known, keys, {LATEST: F.max(sequence)})
    return marked.filter(F.col(sequence) == F.col(LATEST)).drop(LATEST)


def _hash_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(HASHES))


def _parted(rows: DataFrame, keys: Sequence[str], hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key's hash is surely not among ``hashes``, and the others; neither is shuffled.

    A bit stands for each hash, so the second part has rows of other hashes with the same bit too.
    """

    def place(hashed: Column) -> tuple[Column, Column]:
        at = F.pmod(hashed, F.lit(MARK_BITS))
        return F.shiftright(at, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))

    word, bit = place(F.col(HASH))
    marks = hashes.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    word, bit = place(_hash_of(keys))
    found = rows.join(F.broadcast(marks), word == F.col("__word"), "left")
    maybe = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return found.filter(~maybe).select(*rows.columns), found.filter(maybe).select(*rows.columns)


def parted_by_repeat(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key no other row has, and the rest, with every row of a key that has several.

    Only hashes of keys are shuffled to tell them apart.
    """
    counted = rows.groupBy(_hash_of(keys).alias(HASH)).agg(F.count(F.lit(1)).alias("n"))
    return _parted(rows, keys, counted.filter(F.col("n") > 1).select(HASH))


def latest_row(
    rows: DataFrame, keys: Sequence[str], sequence: str, tie_order: Sequence[Column]
) -> DataFrame:
    """One row per key: highest sequence, then first in ``tie_order``."""
    known = rows.filter(F.col(sequence).isNotNull())
    return first_per_key(known, keys, [F.desc(sequence), *tie_order])


def newest_version(rows: DataFrame, keys: Sequence[str], position: Column) -> DataFrame:
    """One row per key: the highest position, rows without one last.

    Equal positions are decided by the row itself, the greatest in column order. Rows
    with a NULL key are no versions of each other: all of them stay.
    """
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    order = [F.desc_nulls_last(POSITION), *[F.desc_nulls_last(c) for c in rows.columns if c not in keys]]
    keyed = rows.filter(~no_key).withColumn(POSITION, position)
    return first_per_key(keyed, keys, order).drop(POSITION).unionByName(rows.filter(no_key))


def distinct_lines(
    rows: DataFrame, line: str, order: Sequence[Column]
) -> DataFrame:
    """Rows with identical text collapse into the earliest one."""
    return first_per_key(rows, [line], order)


def upsert(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], change_order: Sequence[Column] = ()
) -> DataFrame:
    """``changes`` replace the rows of ``current`` that have the same key."""
    both = current.withColumn("__is_change", F.lit(0)).unionByName(
        changes.withColumn("__is_change", F.lit(1))
    )
    return first_per_key(both, keys, [F.desc("__is_change"), *change_order]).drop("__is_change")
