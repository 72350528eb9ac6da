"""Queries that write, publish and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tableloom.functions.timing import add_interval
from tableloom.operators import quality
from tableloom.operators.history import HistorySpec
from tableloom.plans.history_run import run_history
from tableloom.plans.incremental_run import IncrementalConfig, run_backfill, run_incremental
from tableloom.plans.merge_log import compact
from tableloom.queries.history import scd_sql
from tableloom.queries.inputs import (
    ORDERS, ORDERS_MERGED, T0, T1, customers_t0, customers_t1, orders_arriving, orders_loaded, publisher, table,
)
from tableloom.queries.registry import query
from tableloom.session import scratch_path
from tableloom.streaming.microbatch import replace_windows_on_commit


@query("SELECT * FROM orders")
def table_build(spark, sf):
    return publisher(spark).replace("orders", table(spark, sf, "orders"))


@query(f"{ORDERS_MERGED} SELECT * FROM merged")
def table_atomic_replace(spark, sf):
    """A build that fails keeps the old rows; the next one replaces them."""
    pub, config = publisher(spark), IncrementalConfig(unique_key="o_orderkey")
    run_incremental(pub, "orders", lambda: orders_loaded(spark, sf), config)
    broken = orders_arriving(spark, sf).withColumn("o_orderstatus", F.raise_error(F.lit("broken model")).cast("string"))
    try:
        pub.replace("orders", broken)
    except Exception as error:
        if "broken model" not in str(error):
            raise
    return run_incremental(pub, "orders", lambda: orders_arriving(spark, sf), config)


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def view_build(spark, sf):
    pub = publisher(spark)
    return _reread(pub, "v", f"SELECT o_orderkey, o_totalprice, o_orderdate FROM parquet.`{sf}/orders.parquet`")


@query("SELECT * FROM orders WHERE o_totalprice >= 200000")
def view_filtered(spark, sf):
    pub = publisher(spark)
    return _reread(pub, "dear_orders", f"SELECT * FROM parquet.`{sf}/orders.parquet` WHERE o_totalprice >= 200000")


def _reread(pub, name, text):
    pub.create_view(name, text)
    return pub.read(name)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def bucketed_build(spark, sf):
    """Stored by hash of the customer, so grouping by customer needs no shuffle."""
    rows = publisher(spark).replace("orders", table(spark, sf, "orders"), bucket_by=(10, "o_custkey"))
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 8 AS n_files, count(*) AS n_rows, true AS even FROM lineitem")
def random_distribution(spark, sf):
    """Stored in eight files of equal size, though no column decides where a row goes."""
    pub = publisher(spark)
    pub.replace("lineitem", table(spark, sf, "lineitem"), bucket_by=(8, ()))
    files = pub.read("lineitem").groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.count(F.lit(1)).cast("int").alias("n_files"), F.sum("n").alias("n_rows"), (F.max("n") - F.min("n") <= F.count(F.lit(1)) * 16).alias("even"))


@query("SELECT o_custkey, 2 * count(*) AS n FROM orders GROUP BY 1")
def bucketed_append(spark, sf):
    """Appended rows go to the bucket they belong to, a file for each, so grouping by customer still needs no shuffle."""
    pub, orders = publisher(spark), table(spark, sf, "orders")
    pub.replace("orders", orders, bucket_by=(8, "o_custkey"))
    return pub.append("orders", orders).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def view_to_table_freeze(spark, sf):
    pub = publisher(spark)
    pub.create_view("finished", f"SELECT * FROM parquet.`{sf}/orders.parquet` WHERE o_orderstatus = 'F'")
    return pub.freeze_view("finished", "finished_copy")


@query(f"{ORDERS} SELECT * FROM arriving")
def full_refresh(spark, sf):
    pub = publisher(spark)
    config = IncrementalConfig(unique_key="o_orderkey")
    run_incremental(pub, "orders", lambda: orders_loaded(spark, sf), config)
    return run_incremental(pub, "orders", lambda: orders_arriving(spark, sf), config, full_refresh=True)


@query("SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def store_failures_table(spark, sf):
    failures = quality.accepted_values(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return publisher(spark).store_failures("priority_accepted_values", failures)


@query("SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 25")
def store_failures_limit(spark, sf):
    failures = quality.unique(table(spark, sf, "orders"), "o_custkey")
    return publisher(spark).store_failures("customer_unique", failures, limit=25, order_by="unique_field")


@query("SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1")
def store_failures_view(spark, sf):
    """The failing rows as a view over those stored under another name."""
    pub = publisher(spark)
    pub.view_failures("customer_unique", quality.unique(table(spark, sf, "orders"), "o_custkey"))
    return pub.read("customer_unique")


@query(f"""{ORDERS_MERGED}
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM merged""")
def merge_within_partitions(spark, sf):
    """The key holds the partition column, so only the years in the batch are rewritten."""
    pub, year = publisher(spark), F.year("o_orderdate").alias("o_year")
    config = IncrementalConfig(unique_key=("o_year", "o_orderkey"), partition_by="o_year")
    run_incremental(pub, "orders", lambda: orders_loaded(spark, sf).select("*", year), config)
    return run_incremental(pub, "orders", lambda: orders_arriving(spark, sf).select("*", year), config)


@query(f"""{ORDERS_MERGED} SELECT * FROM merged""")
def merge_on_read_stored(spark, sf):
    """Two logged batches, a compaction, and the first one again."""
    pub, config = publisher(spark), IncrementalConfig(unique_key="o_orderkey", merge_on_read=True)
    run_incremental(pub, "orders", lambda: orders_loaded(spark, sf), config)
    run_incremental(pub, "orders", lambda: orders_arriving(spark, sf), config)
    compact(pub, "orders")
    return run_incremental(pub, "orders", lambda: orders_arriving(spark, sf), config)


@query("SELECT * FROM orders WHERE NOT (year(o_orderdate) = 1997 AND o_orderstatus = 'P')")
def microbatch_stored_windows(spark, sf):
    """Every year filled, then one re-run after some of its rows left the source."""
    pub = publisher(spark)
    config = IncrementalConfig(strategy="microbatch", event_time="o_orderdate", batch_size="year")
    orders = table(spark, sf, "orders")
    run_backfill(pub, "orders", lambda: orders, config, datetime(1995, 1, 1), datetime(2002, 1, 1))
    settled = orders.where("o_orderstatus <> 'P'")
    window = (datetime(1997, 1, 1), datetime(1998, 1, 1))
    return run_incremental(pub, "orders", lambda: settled, config, window=window)


@query("SELECT * FROM events")
def microbatch_on_commit(spark, sf):
    """Two commits of event files, the second with events of days the first had; each run replaces the days it has events of."""
    pub, base, checkpoint = publisher(spark), scratch_path(spark, "events"), scratch_path(spark, "offsets")
    config = IncrementalConfig(strategy="microbatch", event_time="ts", batch_size="day")
    events = table(spark, sf, "events")
    late = F.pmod(F.hash("event_id"), F.lit(3)) == 0
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(base)
        replace_windows_on_commit(pub, "events", base, events.schema, config, checkpoint, lookback=1).awaitTermination()
    return pub.read("events")


@query(scd_sql("invalidate", "s.c_mktsegment <> h.c_mktsegment OR s.c_nationkey <> h.c_nationkey"))
def snapshot_stored(spark, sf):
    """Two runs through the stored history; past versions are not rewritten."""
    pub = publisher(spark)
    spec = HistorySpec(keys="c_custkey", hard_deletes="invalidate")
    run_history(pub, "customers", customers_t0(spark, sf), spec, T0)
    return run_history(pub, "customers", customers_t1(spark, sf), spec, T1)


@query("""
WITH t1 AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS at FROM orders)
SELECT *, valid_from AS updated_at FROM (
SELECT o.*, md5(o.o_orderkey || '|' || CAST(o.o_orderdate AS VARCHAR)) AS scd_id, o.o_orderdate AS valid_from, CASE WHEN t1.at > o.o_orderdate THEN t1.at END AS valid_to
FROM orders o JOIN t1 ON t1.o_orderkey = o.o_orderkey
UNION ALL
SELECT o.* REPLACE (t1.at AS o_orderdate), md5(o.o_orderkey || '|' || CAST(t1.at AS VARCHAR)), t1.at, NULL
FROM orders o JOIN t1 ON t1.o_orderkey = o.o_orderkey WHERE t1.at > o.o_orderdate)""")
def snapshot_stored_timestamp(spark, sf):
    """Two stored runs that find changed keys from the key and the time alone, and look up the rest for those."""
    pub = publisher(spark)
    spec = HistorySpec("o_orderkey", strategy="timestamp", updated_at="o_orderdate")
    orders = table(spark, sf, "orders")
    later = F.when(F.col("o_orderstatus") == "P", add_interval(F.col("o_orderdate"), 1, "day")).otherwise(F.col("o_orderdate"))
    run_history(pub, "orders", orders, spec, T0)
    return run_history(pub, "orders", orders.withColumn("o_orderdate", later), spec, T1)
