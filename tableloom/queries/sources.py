"""Scans, seeds and typed loads."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tableloom.queries.inputs import table
from tableloom.queries.registry import query
from tableloom.session import scratch_database, scratch_path
from tableloom.sources import files, tables


def _registered(spark, sf, name):
    """A database in which ``name`` is a view over the Parquet file."""
    db = scratch_database(spark)
    spark.sql(f"CREATE VIEW {db}.{name} AS SELECT * FROM parquet.`{sf}/{name}.parquet`")
    return db


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def scan_table(spark, sf):
    return tables.scan_table(spark, "orders", schema=_registered(spark, sf, "orders"))


@query("SELECT * FROM lineitem")
def cross_database_scan(spark, sf):
    return tables.scan_table(spark, "lineitem", schema="default", database=_registered(spark, sf, "lineitem"))


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'")
def event_time_scan(spark, sf):
    east = timezone(timedelta(hours=8))
    start, end = datetime(2024, 1, 10, 8, tzinfo=east), datetime(2024, 1, 11, 8, tzinfo=east)
    return tables.event_time_scan(table(spark, sf, "events"), "ts", start, end)


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def seed_csv_load(spark, sf):
    path = scratch_path(spark, "seed")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return files.seed_csv(spark, path, {"C_CUSTKEY": "bigint", "c_nationkey": "bigint", "c_name": "string"})


def _untyped_events(spark, sf):
    """Events as text, with values that do not parse in errors and in dear clicks."""
    e = table(spark, sf, "events")
    kind, value = F.col("event_type"), F.col("value")
    return e.select(
        F.col("event_id").cast("string").alias("EVENT_ID"),
        F.when((kind == "click") & (value > 100), "soon").otherwise(F.col("ts").cast("string")).alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        kind.alias("event_type"),
        F.when(kind == "error", "n/a").otherwise(value.cast("string")).alias("value"),
        F.col("props"),
    )


_EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "varchar(3)",
                "value": "double", "props": "string"}
_UNCASTABLE = "(event_type = 'error' OR (event_type = 'click' AND value > 100))"


@query(f"SELECT * FROM events WHERE NOT {_UNCASTABLE}")
def typed_load(spark, sf):
    typed, _ = files.typed_load(_untyped_events(spark, sf), _EVENT_TYPES)
    return typed.withColumnRenamed("EVENT_ID", "event_id")


@query(f"SELECT event_id, event_type, props FROM events WHERE {_UNCASTABLE}")
def typed_load_rejects(spark, sf):
    _, rejects = files.typed_load(_untyped_events(spark, sf), _EVENT_TYPES)
    return rejects.select(F.col("EVENT_ID").cast("bigint").alias("event_id"), "event_type", "props")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def ephemeral_inline(spark, sf):
    dear = table(spark, sf, "orders").where("o_totalprice > 100000")
    return dear.where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_totalprice")
