"""Run ledger: one logical row per batch run, kept as an append-only table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import first_per_key, upsert

SUCCESS = "success"
FAILED = "failed"
STATUSES = (SUCCESS, FAILED)

RUN_COLUMNS = (
    "run_id",
    "batch_id",
    "status",
    "failed_model",
    "rows_in",
    "rows_out",
    "started_at",
    "ended_at",
)
LEDGER_SCHEMA = (
    "run_id string, batch_id string, status string, failed_model string, rows_in bigint, "
    "rows_out bigint, started_at timestamp, ended_at timestamp, recorded_at timestamp"
)


def record_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    batch_id: str,
    status: str,
    started_at: datetime,
    ended_at: datetime,
    failed_model: str | None = None,
    rows_in: int | None = None,
    rows_out: int | None = None,
) -> None:
    """Append one record; a later record of the same run replaces it on reading."""
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}; use one of {STATUSES}")
    record = (
        run_id, batch_id, status, failed_model, rows_in, rows_out,
        started_at, ended_at, datetime.now(timezone.utc),
    )
    spark.createDataFrame([record], LEDGER_SCHEMA).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The current state of every run."""
    records = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return first_per_key(records, ["run_id"], [F.desc("recorded_at")]).select(*RUN_COLUMNS)


def upsert_runs(current: DataFrame, changes: DataFrame) -> DataFrame:
    return upsert(current, changes, ["run_id"], [F.desc("ended_at"), F.desc("started_at")])


def latest_status_per_batch(runs: DataFrame) -> DataFrame:
    """The latest run of each batch; run_id settles equal times."""
    order = [F.desc("ended_at"), F.desc("started_at"), F.desc("run_id")]
    return first_per_key(runs, ["batch_id"], order)


def newest_runs(runs: DataFrame, limit: int = 50, batch_id: str | None = None) -> DataFrame:
    chosen = runs if batch_id is None else runs.filter(F.col("batch_id") == batch_id)
    return chosen.orderBy(F.desc("ended_at"), F.desc("started_at"), F.desc("run_id")).limit(limit)
