"""The relational and scalar building blocks the maintenance work is made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.functions import hashing, text, timing
from tableloom.operators import guards, quality
from tableloom.queries.inputs import CENTS, ORDERS, cents, orders_arriving, orders_loaded, table
from tableloom.queries.registry import query


@query("SELECT o_orderkey AS \"order\", o_custkey AS customer, o_orderdate FROM orders")
def project_columns(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order"), F.col("o_custkey").alias("customer"), "o_orderdate")


@query("SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")


@query("""SELECT a.conv_id, a.turn, a.role, CAST(length(a.text) AS BIGINT) AS before_length, CAST(length(b.text || '!') AS BIGINT) AS after_length
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn""")
def join_composite(spark, sf):
    turns = table(spark, sf, "conversations")
    before = turns.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("before_length"))
    after = turns.select("conv_id", "turn", F.length(F.concat("text", F.lit("!"))).cast("bigint").alias("after_length"))
    return before.join(after, ["conv_id", "turn"])


@query("""
WITH t1 AS (
  SELECT o_orderkey, o_orderdate + CASE WHEN o_orderstatus = 'F' THEN INTERVAL '-1' DAY WHEN o_orderstatus = 'P' THEN INTERVAL 1 DAY
                                        ELSE INTERVAL 0 DAY END AS new_date FROM orders)
SELECT o.o_orderkey, o.o_orderdate AS old_date, new_date FROM orders o JOIN t1 ON o.o_orderkey = t1.o_orderkey
WHERE new_date < o.o_orderdate""")
def join_residual_lt(spark, sf):
    orders = table(spark, sf, "orders")
    at, status = F.col("o_orderdate"), F.col("o_orderstatus")
    moved = (F.when(status == "F", timing.add_interval(at, -1, "day"))
             .when(status == "P", timing.add_interval(at, 1, "day")).otherwise(at))
    stored = orders.select("o_orderkey", at.alias("old_date"))
    incoming = orders.select(F.col("o_orderkey").alias("key"), moved.alias("new_date"))
    on = (F.col("o_orderkey") == F.col("key")) & (F.col("new_date") < F.col("old_date"))
    return stored.join(incoming, on).drop("key")


@query("""
SELECT c_custkey, CASE WHEN k IS NULL THEN 'none' WHEN newest >= TIMESTAMP '2000-01-01' THEN 'active' ELSE 'idle' END AS state
FROM customer LEFT JOIN (SELECT o_custkey AS k, max(o_orderdate) AS newest FROM orders GROUP BY 1) o ON o.k = c_custkey""")
def join_left_classify(spark, sf):
    buyers = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderdate").alias("newest"))
    customers = table(spark, sf, "customer").select("c_custkey")
    state = F.when(F.col("k").isNull(), "none").when(F.col("newest") >= timing.ntz("2000-01-01"), "active").otherwise("idle")
    return customers.join(buyers, F.col("k") == F.col("c_custkey"), "left").select("c_custkey", state.alias("state"))


@query("""SELECT c_nationkey AS nationkey, n_regionkey AS regionkey, c_custkey, n_name, r_name
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def join_using(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"))
    nations = table(spark, sf, "nation").withColumnsRenamed({"n_nationkey": "nationkey", "n_regionkey": "regionkey"})
    regions = table(spark, sf, "region").withColumnRenamed("r_regionkey", "regionkey")
    return customers.join(nations, ["nationkey"]).join(regions, ["regionkey"])


@query("""SELECT * FROM customer c WHERE NOT EXISTS (
SELECT 1 FROM orders o WHERE o.o_custkey = nullif(c.c_custkey, 7))""")
def join_anti(spark, sf):
    """A null key matches nothing, so its row stays."""
    customers = table(spark, sf, "customer")
    buyers = table(spark, sf, "orders")
    return customers.join(buyers, F.nullif(F.col("c_custkey"), F.lit(7)) == F.col("o_custkey"), "left_anti")


@query(f"SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(sum({CENTS}) AS BIGINT) AS total_cents FROM orders GROUP BY 1")
def agg_group_sum(spark, sf):
    return table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("order_year")).agg(
        F.sum(cents()).alias("total_cents"))


@query("SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def agg_having_duplicates(spark, sf):
    return guards.duplicate_keys(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query("""SELECT count(*) FILTER (o_orderstatus = 'P') AS pending, count(*) FILTER (o_totalprice < 1000) AS tiny,
count(*) FILTER (o_orderdate < TIMESTAMP '1995-02-01') AS early, count(*) FILTER (o_custkey IS NULL) AS no_customer FROM orders""")
def agg_multi_counts(spark, sf):
    return quality.multi_counts(table(spark, sf, "orders"), {
        "pending": F.col("o_orderstatus") == "P",
        "tiny": F.col("o_totalprice") < 1000,
        "early": F.col("o_orderdate") < timing.ntz("1995-02-01"),
        "no_customer": F.col("o_custkey").isNull()})


@query(f"SELECT count(*) AS n, CAST(sum({CENTS}) AS BIGINT) AS total_cents FROM orders")
def agg_global(spark, sf):
    return table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n"), F.sum(cents()).alias("total_cents"))


@query(f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {CENTS} ELSE 0 END) AS BIGINT) AS finished_cents FROM orders GROUP BY 1""")
def agg_conditional_sum(spark, sf):
    finished = F.when(F.col("o_orderstatus") == "F", cents()).otherwise(0)
    return table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("order_year")).agg(
        F.sum(finished).alias("finished_cents"))


@query("SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_values(spark, sf):
    return table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus").distinct()


@query("""SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem""")
def window_count_per_key(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return guards.with_key_count(lines, ["l_orderkey", "l_linenumber"])


@query("SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def top_1_latest(spark, sf):
    return table(spark, sf, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(1)


@query(f"{ORDERS} SELECT * FROM loaded UNION ALL SELECT * FROM arriving")
def union_all(spark, sf):
    return orders_loaded(spark, sf).unionByName(orders_arriving(spark, sf))


@query("""SELECT o_orderkey, md5(o_orderkey || '|' || o_orderpriority) AS row_id,
md5(length(o_orderpriority) || ':' || o_orderpriority || length(o_orderstatus) || ':' || o_orderstatus) AS definition_id FROM orders""")
def scalar_hash_key(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        hashing.version_id("o_orderkey", "o_orderpriority").alias("row_id"),
        hashing.prefixed_md5("o_orderpriority", "o_orderstatus").alias("definition_id"))


@query("""SELECT c_custkey, lower(c_mktsegment) || ' ' || lower(c_name) AS label, c_mktsegment = 'FURNITURE' AS is_furniture FROM customer""")
def scalar_text_normalise(spark, sf):
    written = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" \t "), F.col("c_name"), F.lit("\n"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        text.squeezed(written).alias("label"),
        text.same_name(F.lower("c_mktsegment"), F.lit("Furniture")).alias("is_furniture"))


@query("""SELECT event_id,
CASE WHEN event_type <> 'error' THEN date_trunc('second', ts)::TIMESTAMP END AS parsed,
ts + INTERVAL 3 HOUR AS plus_hours, ts + INTERVAL 2 MONTH AS plus_months,
date_trunc('hour', ts)::TIMESTAMP AS hour_start, date_trunc('month', ts)::TIMESTAMP AS month_start,
strftime(ts, '%Y-%m-%d 00:00:00') AS bound, 'mb_' || strftime(ts, '%Y%m%d%H') AS partition_name FROM events""")
def scalar_time_parse(spark, sf):
    ts = F.col("ts")
    written = F.substring(ts.cast("string"), 1, 19)
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("at "), written)).otherwise(written)
    bound = F.when(F.col("event_type") == "view", F.concat(ts.cast("date").cast("string"), F.lit("T00:00:00.000"))).otherwise(
        ts.cast("date").cast("string"))
    return table(spark, sf, "events").select(
        "event_id",
        timing.parse_datetime(broken).alias("parsed"),
        timing.add_interval(ts, 3, "hour").alias("plus_hours"),
        timing.add_interval(ts, 2, "month").alias("plus_months"),
        timing.window_start(ts, "hour").alias("hour_start"),
        timing.window_start(ts, "month").alias("month_start"),
        text.bound_text(bound).alias("bound"),
        timing.partition_name(ts, "hour").alias("partition_name"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 2 ELSE 1 END AS flag,
CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'open' END AS state,
nullif(o_orderpriority, '5-LOW') AS priority, coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS shown FROM orders""")
def scalar_conditional(spark, sf):
    status, priority = F.col("o_orderstatus"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 250000, 2).otherwise(1).alias("flag"),
        F.when(status == "P", "pending").when(status == "F", "finished").otherwise("open").alias("state"),
        priority.alias("priority"),
        F.coalesce(priority, F.lit("none")).alias("shown"))
