"""Batches: their order, their time bounds and routing rows to them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import first_per_key
from tidemark.sources.scratch import small_table


#: Position of a plan's first batch.
FIRST_SEQ = 0


@dataclass(frozen=True)
class Batch:
    batch_id: str
    last_instant: str  # inclusive, "yyyy-MM-dd HH:mm:ss.ffffff"


@dataclass(frozen=True)
class BatchPlan:
    """Batches in load order; their ids do not sort in that order.

    The last batch ends at the cutoff: what happens later counts as not
    having happened.
    """

    batches: tuple[Batch, ...]

    @property
    def ids(self) -> list[str]:
        return [b.batch_id for b in self.batches]

    @property
    def cutoff_timestamp(self) -> str:
        return self.batches[-1].last_instant

    @property
    def cutoff_date(self) -> str:
        return self.cutoff_timestamp[:10]

    @property
    def final_batch(self) -> str:
        return self.ids[-1]

    def is_final(self, batch_id: str) -> bool:
        return batch_id.strip() == self.final_batch

    def is_middle(self, batch_id: str) -> bool:
        """Before the final batch, when parents of some rows may still be missing."""
        return not self.is_final(batch_id)

    def sequence_of(self, batch_id: str) -> int:
        if batch_id not in self.ids:
            raise ValueError(f"unknown batch {batch_id!r}; known: {self.ids}")
        return self.ids.index(batch_id)

    def previous(self, batch_id: str) -> str | None:
        position = self.sequence_of(batch_id)
        return self.ids[position - 1] if position else None

    def resolve(self, wanted: str) -> list[str]:
        """``all`` gives every batch in order, anything else must be one batch id."""
        wanted = (wanted or "").strip()
        if wanted.lower() == "all":
            return self.ids
        self.sequence_of(wanted)
        return [wanted]

    def sequence_frame(self, spark: SparkSession) -> DataFrame:
        """batch_id, batch_seq, previous_batch: one row per batch."""
        rows = [(b, i, self.ids[i - 1] if i else None) for i, b in enumerate(self.ids)]
        return small_table(spark, rows, "batch_id string, batch_seq int, previous_batch string")

    def bounds_frame(self, spark: SparkSession, first_instant: str) -> DataFrame:
        """batch_id and its half-open time range [starts_at, ends_at)."""
        tick = timedelta(microseconds=1)
        rows = []
        starts_at = first_instant
        for batch in self.batches:
            ends_at = str(datetime.fromisoformat(batch.last_instant) + tick)
            rows.append((batch.batch_id, starts_at, ends_at))
            starts_at = ends_at
        return small_table(
            spark, rows, "batch_id string, starts_at timestamp_ntz, ends_at timestamp_ntz"
        )

    def position_of(self, batch_id: Column) -> Column:
        """Position in load order; NULL for a batch that is not planned."""
        position = F.lit(None).cast("int")
        for number, known in reversed(list(enumerate(self.ids))):
            position = F.when(batch_id == known, F.lit(number)).otherwise(position)
        return position

    def after_cutoff_date(self, value: Column) -> Column:
        return value.cast("date") > F.lit(self.cutoff_date).cast("date")

    def after_cutoff(self, value: Column) -> Column:
        return value > F.lit(self.cutoff_timestamp).cast("timestamp_ntz")

    def batch_of(self, instant: Column) -> Column:
        """Batch id for an event time; NULL after the cutoff or without a time."""
        routed = None
        for batch in self.batches:
            fits = instant <= F.lit(batch.last_instant).cast("timestamp_ntz")
            routed = (
                F.when(fits, F.lit(batch.batch_id))
                if routed is None
                else routed.when(fits, F.lit(batch.batch_id))
            )
        return routed


# The published batches and their bounds.
MARKETPLACE_BATCHES = BatchPlan(
    (
        Batch("bulk_2016-09_2018-05", "2018-05-31 23:59:59.999999"),
        Batch("2018-06", "2018-06-30 23:59:59.999999"),
        Batch("2018-07", "2018-07-31 23:59:59.999999"),
        Batch("2018-08", "2018-08-31 23:59:59.999999"),
    )
)


def with_batch_seq(rows: DataFrame, plan: BatchPlan) -> DataFrame:
    """Rows of planned batches with their position; others drop out.

    The plan is part of the job's code, so the lookup is an expression: the
    rows are not joined, and the filter prunes partitions.
    """
    planned = rows.filter(F.col("batch_id").isin(*plan.ids))
    return planned.withColumn("batch_seq", plan.position_of(F.col("batch_id")))


def route_to_batches(rows: DataFrame, instant: str, plan: BatchPlan) -> DataFrame:
    """Every row with its batch; NULL after the cutoff or without a time."""
    return rows.withColumn("batch_id", plan.batch_of(F.col(instant).cast("timestamp_ntz")))


def in_scope(rows: DataFrame, instant: str, plan: BatchPlan) -> DataFrame:
    """Rows up to the cutoff with their batch. The bound is plain, so it reaches the scan."""
    at = F.col(instant).cast("timestamp_ntz")
    kept = rows.filter(at <= F.lit(plan.cutoff_timestamp).cast("timestamp_ntz"))
    return route_to_batches(kept, instant, plan)


def quarantined(rows: DataFrame, instant: str, plan: BatchPlan) -> DataFrame:
    """Rows after the cutoff or without a time, kept apart for reconciliation."""
    at = F.col(instant).cast("timestamp_ntz")
    return rows.filter(at.isNull() | plan.after_cutoff(at))


def join_batch_ranges(
    rows: DataFrame, instant: str, plan: BatchPlan, first_instant: str
) -> DataFrame:
    """Rows with the batch whose time range [starts_at, ends_at) holds their instant.

    The ranges are cut into calendar months, so the join is an equality on the
    month and the exact bounds filter what matched: no nested loop. The lookup
    has one row per batch and month, which the plan bounds, so it is broadcast.
    """
    month = "__month"
    months = F.sequence(
        F.trunc("starts_at", "month"), F.trunc("ends_at", "month"), F.expr("interval 1 month")
    )
    ranges = plan.bounds_frame(rows.sparkSession, first_instant).withColumn(
        month, F.explode(months)
    )
    at = F.col(instant)
    return (
        rows.withColumn(month, F.trunc(instant, "month"))
        .join(F.broadcast(ranges), month, "inner")
        .filter((at >= F.col("starts_at")) & (at < F.col("ends_at")))
        .drop(month)
    )


def batch_order_problems(latest_runs: DataFrame, plan: BatchPlan, success: str) -> DataFrame:
    """Batches that may not run: the latest run before them is missing or failed."""
    sequence = plan.sequence_frame(latest_runs.sparkSession)
    previous = latest_runs.select(
        F.col("batch_id").alias("previous_batch"), F.col("status").alias("previous_status")
    )
    return (
        sequence.filter(F.col("previous_batch").isNotNull())
        .join(previous, "previous_batch", "left")
        .filter(F.coalesce(F.col("previous_status") != success, F.lit(True)))
        .select("batch_id", "batch_seq", "previous_batch", "previous_status")
    )


def replay_children(
    parents: DataFrame,
    children: DataFrame,
    key: str,
    parent_time: str,
    child_time: str,
    child_name: str,
    child_order: Sequence[Column],
    plan: BatchPlan,
) -> DataFrame:
    """Parents nested with their child, once per batch in which something is known.

    A parent appears in the batch of its own time; when its child falls into a
    later batch, the parent is emitted again there, this time with the child.
    The first child per key wins, children without a parent and children after
    the cutoff are left out. ``key`` is unique in ``parents``.
    """
    child_fields = [c for c in children.columns if c != key]
    child_type = T.StructType([children.schema[c] for c in child_fields])
    first_child = first_per_key(children, [key], child_order).select(
        key,
        plan.batch_of(F.col(child_time).try_cast("timestamp_ntz")).alias("__child_batch"),
        F.struct(*child_fields).alias(child_name),
    )
    own_batch = plan.batch_of(F.col(parent_time).try_cast("timestamp_ntz"))
    joined = parents.withColumn("__own_batch", own_batch).join(first_child, key, "left")
    alone = F.when(
        F.col("__own_batch").isNotNull()
        & ~F.col("__own_batch").eqNullSafe(F.col("__child_batch")),
        F.struct(
            F.col("__own_batch").alias("batch_id"), F.lit(None).cast(child_type).alias(child_name)
        ),
    )
    with_child = F.when(
        F.col("__child_batch").isNotNull(),
        F.struct(F.col("__child_batch").alias("batch_id"), F.col(child_name)),
    )
    return joined.withColumn(
        "__emitted", F.explode(F.array_compact(F.array(alone, with_child)))
    ).select(
        *parents.columns,
        F.col(f"__emitted.{child_name}").alias(child_name),
        F.col("__emitted.batch_id").alias("batch_id"),
    )
