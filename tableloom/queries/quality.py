"""Data tests, freshness and comparisons."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tableloom.operators import freshness, incremental, quality
from tableloom.queries.inputs import ORDERS_MERGED, orders_arriving, orders_loaded, table
from tableloom.queries.registry import query

AS_OF = "2024-01-31 00:00:00"


@query("SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, sf):
    return quality.unique(table(spark, sf, "lineitem"), "l_orderkey")


@query("""SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_orderpriority, o_totalprice FROM orders
WHERE o_orderpriority = '4-NOT SPECIFIED'""")
def dq_not_null(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"), "o_totalprice")
    return quality.not_null(orders, "o_orderpriority")


@query("SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 1")
def dq_accepted_values(spark, sf):
    return quality.accepted_values(table(spark, sf, "events"), "event_type", ["view", "click", "purchase"])


@query("SELECT o_custkey AS from_field FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')")
def dq_relationships(spark, sf):
    parents = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'")
    return quality.relationships(table(spark, sf, "orders"), "o_custkey", parents, "c_custkey")


@query("""SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate < o_orderdate""")
def dq_singular(spark, sf):
    """Any query will do: its rows are the failures."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    early = lines.join(orders, lines.l_orderkey == orders.o_orderkey).where("l_shipdate < o_orderdate")
    return early.select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate")


def _freshness_sql(newest: str, warn: int, error: int) -> str:
    return f"""
WITH newest AS ({newest})
SELECT max_loaded_at, TIMESTAMP '{AS_OF}' AS as_of, date_sub('second', max_loaded_at, TIMESTAMP '{AS_OF}') AS age_seconds,
       CASE WHEN TIMESTAMP '{AS_OF}' - max_loaded_at > INTERVAL {error} SECOND THEN 'error'
            WHEN TIMESTAMP '{AS_OF}' - max_loaded_at > INTERVAL {warn} SECOND THEN 'warn' ELSE 'pass' END AS status
FROM newest"""


@query(_freshness_sql("SELECT max(ts) AS max_loaded_at FROM events", 3600, 7200))
def source_freshness(spark, sf):
    return freshness.freshness(table(spark, sf, "events"), "ts", AS_OF, timedelta(hours=1), timedelta(hours=2))


@query(_freshness_sql("SELECT max(ts) AS max_loaded_at FROM events WHERE event_type = 'purchase'", 300, 86400))
def source_freshness_filtered(spark, sf):
    return freshness.freshness(table(spark, sf, "events"), "ts", AS_OF, timedelta(minutes=5), timedelta(days=1),
                               where=F.col("event_type") == "purchase")


@query(_freshness_sql("SELECT max(ts) AS max_loaded_at FROM events WHERE value > 200", 60, 300))
def source_freshness_query(spark, sf):
    newest = table(spark, sf, "events").where("value > 200").agg(F.max("ts").alias("newest"))
    return freshness.freshness_of(newest, AS_OF, timedelta(minutes=1), timedelta(minutes=5))


def _before_and_after(spark, sf):
    loaded = orders_loaded(spark, sf)
    return loaded, incremental.upsert(loaded, orders_arriving(spark, sf), "o_orderkey")


@query(f"""{ORDERS_MERGED}
SELECT *, 'a' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM loaded EXCEPT ALL SELECT * FROM merged)
UNION ALL
SELECT *, 'b', 1 FROM (SELECT * FROM merged EXCEPT ALL SELECT * FROM loaded)""")
def relation_equality(spark, sf):
    return quality.bag_difference(*_before_and_after(spark, sf))


@query(f"""{ORDERS_MERGED}
SELECT o_orderkey, CASE WHEN l.o_custkey IS NULL THEN 'only_b' ELSE 'changed' END AS change,
       CASE WHEN l.o_custkey IS NOT NULL THEN 'o_orderstatus,o_totalprice' END AS columns_changed
FROM merged m LEFT JOIN loaded l USING (o_orderkey)
WHERE l.o_custkey IS NULL OR l.o_totalprice <> m.o_totalprice""")
def model_output_diff(spark, sf):
    return quality.keyed_difference(*_before_and_after(spark, sf), "o_orderkey")
