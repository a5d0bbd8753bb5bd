"""Helpers shared by the tests and the comparison tool."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _canonical(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows as text with their type, sorted."""
    order = sorted(range(len(names)), key=lambda n: names[n])
    texts = [tuple(f"{type(r[n]).__name__}:{r[n]}" for n in order) for r in rows]
    return [names[n] for n in order], sorted(texts)


def rows_of_spark(frame: DataFrame) -> tuple[list[str], list[tuple]]:
    return _canonical(frame.columns, [tuple(r) for r in frame.collect()])


def rows_of_duckdb(cursor) -> tuple[list[str], list[tuple]]:
    names = [d[0] for d in cursor.description]
    return _canonical(names, cursor.fetchall())
