"""Scans of catalog tables and Parquet folders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tableloom.functions.names import col, quoted
from tableloom.functions.timing import bound_for


def relation_name(name: str, schema: str | None = None, database: str | None = None) -> str:
    """A quoted two-level name. Where both are given and differ, the table is read from ``database``."""
    namespace = database if database else schema
    return f"{quoted(namespace)}.{quoted(name)}" if namespace else quoted(name)


def scan_table(
    spark: SparkSession, name: str, schema: str | None = None, database: str | None = None
) -> DataFrame:
    return spark.table(relation_name(name, schema, database))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def event_time_scan(source: DataFrame, event_time: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows with ``start <= event_time < end``; bounds are moved to naive UTC, either may be open.

    The comparison is on the bare column, so it reaches the Parquet reader.
    """
    kind = source.select(col(event_time)).schema[0].dataType
    if start is not None:
        source = source.where(col(event_time) >= bound_for(start, kind))
    return source if end is None else source.where(col(event_time) < bound_for(end, kind))


