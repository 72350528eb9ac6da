"""Source freshness: how old the newest row is."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.names import col
from tableloom.functions.timing import ntz, utc_of


def _grade(newest: DataFrame, as_of: datetime | str, warn_after: timedelta | None, error_after: timedelta | None):
    micros = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), F.col("as_of"))
    status = F.when(F.col("max_loaded_at").isNull(), "error")
    for limit, grade in ((error_after, "error"), (warn_after, "warn")):
        if limit is not None:
            status = status.when(micros > int(limit.total_seconds() * 1_000_000), grade)
    return newest.withColumn("as_of", ntz(as_of)).select(
        "max_loaded_at",
        "as_of",
        F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("as_of")).alias("age_seconds"),
        status.otherwise("pass").alias("status"),
    )


def freshness(
    source: DataFrame,
    loaded_at: str,
    as_of: datetime | str,
    warn_after: timedelta | None = None,
    error_after: timedelta | None = None,
    where: Column | None = None,
) -> DataFrame:
    """One row: newest load time, its age at ``as_of`` (UTC) and pass, warn or error.

    A source with no rows has no load time and counts as an error.
    """
    if where is not None:
        source = source.where(where)
    newest = source.agg(F.max(col(loaded_at)).alias("max_loaded_at"))
    newest = newest.select(utc_of(F.col("max_loaded_at"), newest.schema["max_loaded_at"].dataType).alias("max_loaded_at"))
    return _grade(newest, as_of, warn_after, error_after)


def freshness_of(
    newest: DataFrame,
    as_of: datetime | str,
    warn_after: timedelta | None = None,
    error_after: timedelta | None = None,
) -> DataFrame:
    """The same from a caller's own one-row, one-column query."""
    (name,) = newest.columns
    loaded = utc_of(col(name), newest.schema[name].dataType).alias("max_loaded_at")
    return _grade(newest.select(loaded), as_of, warn_after, error_after)
