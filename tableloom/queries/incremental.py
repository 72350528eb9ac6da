"""Appends, upserts, overwrites, microbatches, layout and schema changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.timing import NTZ, batch_id, ntz, window_start
from tableloom.operators import guards, layout, schema, windows
from tableloom.operators import incremental as inc
from tableloom.queries.inputs import ORDERS, ORDERS_MERGED, orders_arriving, orders_loaded, publisher, table
from tableloom.queries.registry import query
from tableloom.session import freeze


@query(f"{ORDERS} SELECT * FROM loaded UNION ALL SELECT * FROM arriving")
def incremental_append(spark, sf):
    return inc.append(orders_loaded(spark, sf), orders_arriving(spark, sf))


@query(f"{ORDERS_MERGED} SELECT * FROM merged")
def incremental_merge(spark, sf):
    return inc.upsert(orders_loaded(spark, sf), orders_arriving(spark, sf), "o_orderkey")


@query("""
WITH batch AS (
  SELECT conv_id, turn, role, text || ' (edited)' AS text FROM conversations WHERE role = 'assistant'
  UNION ALL
  SELECT conv_id, turn + 1000, role, text FROM conversations WHERE role = 'system')
SELECT * FROM batch
UNION ALL
SELECT c.* FROM conversations c
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.conv_id = c.conv_id AND b.turn = c.turn)""")
def incremental_merge_composite(spark, sf):
    stored = table(spark, sf, "conversations")
    edited = stored.where("role = 'assistant'").withColumn("text", F.concat("text", F.lit(" (edited)")))
    added = stored.where("role = 'system'").withColumn("turn", F.col("turn") + 1000)
    return inc.upsert(stored, edited.unionByName(added), ["conv_id", "turn"])


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def merge_on_read_latest(spark, sf):
    return inc.latest_by_key(table(spark, sf, "events"), "user_id", ["ts", "event_id"])


@query("""
WITH target AS (
  SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
batch AS (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) = 1)
SELECT b.* FROM batch b LEFT JOIN target t ON t.user_id = b.user_id WHERE t.user_id IS NULL OR b.ts >= t.ts
UNION ALL
SELECT t.* FROM target t LEFT JOIN batch b ON t.user_id = b.user_id WHERE b.user_id IS NULL OR b.ts < t.ts""")
def merge_sequence_guarded(spark, sf):
    events = table(spark, sf, "events")
    target = inc.latest_by_key(events.where(F.col("ts") < ntz("2024-01-20")), "user_id", ["ts", "event_id"])
    batch = inc.latest_by_key(events, "user_id", ["value", "event_id"])
    return inc.upsert_sequenced(freeze(target), freeze(batch), "user_id", "ts")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_key_guard(spark, sf):
    return guards.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
WITH batch AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 100 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
    AND o_totalprice >= 200000)
SELECT * FROM batch
UNION ALL
SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'""")
def overwrite_static_partitions(spark, sf):
    year = F.year("o_orderdate")
    batch = orders_arriving(spark, sf).where((year == 1999) & (F.col("o_totalprice") >= 200100))
    return inc.overwrite_partitions(orders_loaded(spark, sf), batch, year, [1999])


@query(f"""{ORDERS}
SELECT * FROM arriving WHERE o_totalprice >= 200000
UNION ALL
SELECT * FROM loaded WHERE year(o_orderdate) NOT IN (SELECT year(o_orderdate) FROM arriving WHERE o_totalprice >= 200000)""")
def overwrite_dynamic_partitions(spark, sf):
    batch = orders_arriving(spark, sf).where("o_totalprice >= 200000")
    return inc.overwrite_dynamic(orders_loaded(spark, sf), batch, F.year("o_orderdate"))


# -- microbatch: stored events end on the 20th; the source restates every value ------------------


def _events_stored(spark, sf):
    return table(spark, sf, "events").where(F.col("ts") < ntz("2024-01-20"))


def _events_source(spark, sf):
    return table(spark, sf, "events").withColumn("value", F.col("value") + 1)


def _restated(spark, sf, start, end):
    source = _events_source(spark, sf)
    return inc.replace_window(_events_stored(spark, sf), source.where(inc.in_window(F.col("ts"), start, end)), "ts", start, end)


def _window_sql(lo, hi, unit, fmt):
    return f"""
SELECT event_id, ts, user_id, event_type, value, props,
       CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS window_start, strftime(ts, '{fmt}') AS batch_id
FROM (
  SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20' AND NOT (ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}')
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value + 1, props FROM events
  WHERE ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}')"""


def _labelled(df, unit, ts="ts"):
    return df.withColumn("window_start", window_start(F.col(ts), unit)).withColumn("batch_id", batch_id(F.col(ts), unit))


@query(_window_sql("2024-01-10", "2024-01-11", "day", "%Y%m%d"))
def microbatch_day(spark, sf):
    return _labelled(_restated(spark, sf, datetime(2024, 1, 10), datetime(2024, 1, 11)), "day")


@query(_window_sql("2024-01-25 07:00:00", "2024-01-25 08:00:00", "hour", "%Y%m%dT%H"))
def microbatch_hour(spark, sf):
    return _labelled(_restated(spark, sf, datetime(2024, 1, 25, 7), datetime(2024, 1, 25, 8)), "hour")


def _orders_window(spark, sf, start, end, unit):
    inside = inc.in_window(F.col("o_orderdate"), start, end)
    stored, source = table(spark, sf, "orders"), table(spark, sf, "orders").withColumn("o_orderstatus", F.lit("R"))
    return _labelled(inc.replace_window(stored, source.where(inside), "o_orderdate", start, end), unit, "o_orderdate")


def _orders_window_sql(lo, hi, unit, fmt):
    return f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN o_orderdate >= TIMESTAMP '{lo}' AND o_orderdate < TIMESTAMP '{hi}' THEN 'R' ELSE o_orderstatus END
         AS o_orderstatus,
       CAST(date_trunc('{unit}', o_orderdate) AS TIMESTAMP) AS window_start, strftime(o_orderdate, '{fmt}') AS batch_id
FROM orders"""


@query(_orders_window_sql("1997-03-01", "1997-04-01", "month", "%Y%m"))
def microbatch_month(spark, sf):
    return _orders_window(spark, sf, datetime(1997, 3, 1), datetime(1997, 4, 1), "month")


@query(_orders_window_sql("1997-01-01", "1998-01-01", "year", "%Y"))
def microbatch_year(spark, sf):
    return _orders_window(spark, sf, datetime(1997, 1, 1), datetime(1998, 1, 1), "year")


@query("""SELECT * FROM events
WHERE ts < TIMESTAMP '2024-01-20' AND NOT (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11')""")
def microbatch_empty_window(spark, sf):
    nothing = _events_source(spark, sf).where(F.lit(False))
    return inc.replace_window(_events_stored(spark, sf), nothing, "ts", datetime(2024, 1, 10), datetime(2024, 1, 11))


@query("""
SELECT CAST(ts AS DATE) AS event_day, count(*) AS n,
       CAST(sum(CAST(round((value + CASE WHEN ts >= TIMESTAMP '2024-01-18' AND ts < TIMESTAMP '2024-01-22' THEN 1 ELSE 0 END)
                * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events WHERE ts < TIMESTAMP '2024-01-22' GROUP BY 1""")
def microbatch_backfill(spark, sf):
    filled = inc.backfill(_events_stored(spark, sf), _events_source(spark, sf), "ts",
                          datetime(2024, 1, 18, 5), datetime(2024, 1, 21, 1), "day")
    return filled.groupBy(F.col("ts").cast("date").alias("event_day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))


@query("""
WITH days AS (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS d FROM events),
windows AS (SELECT d AS window_start, d + INTERVAL 1 DAY AS window_end FROM days),
parts AS (
  SELECT 'd' || strftime(d, '%Y%m%d') AS partition_name, d AS lower, d + INTERVAL 1 DAY AS upper
  FROM days WHERE d < TIMESTAMP '2024-01-11'
  UNION ALL
  SELECT DISTINCT 'w' || strftime(date_trunc('week', d), '%Y%m%d'), date_trunc('week', d)::TIMESTAMP,
         date_trunc('week', d)::TIMESTAMP + INTERVAL 7 DAY
  FROM days WHERE d >= TIMESTAMP '2024-01-11' AND d < TIMESTAMP '2024-01-22'
  UNION ALL SELECT 'future', TIMESTAMP '2024-01-28', TIMESTAMP '9999-01-01'
  UNION ALL SELECT 'turned', TIMESTAMP '2024-01-25', TIMESTAMP '2024-01-23'
  UNION ALL SELECT 'unknown', TIMESTAMP '2024-01-24', NULL),
counted AS (
  SELECT w.window_start, w.window_end,
         (SELECT count(*) FROM parts p WHERE p.lower = w.window_start AND p.upper = w.window_end) AS exact_count,
         (SELECT count(*) FROM parts p WHERE p.lower < w.window_end AND p.upper > w.window_start AND p.lower < p.upper) AS touching,
         (SELECT min(partition_name) FROM parts p WHERE p.lower = w.window_start AND p.upper = w.window_end) AS nm
  FROM windows w)
SELECT window_start, window_end,
       CASE WHEN exact_count = 1 THEN 'exact' WHEN exact_count > 1 THEN 'ambiguous'
            WHEN touching > 0 THEN 'overlap'
            WHEN (SELECT count(*) FROM parts p WHERE NOT coalesce(p.lower < p.upper, false)) > 0 THEN 'unparsable' ELSE 'missing' END AS status,
       CASE WHEN exact_count = 1 THEN nm END AS partition_name,
       exact_count, touching - exact_count AS overlap_count
FROM counted""")
def microbatch_partition_resolve(spark, sf):
    days = table(spark, sf, "events").select(window_start(F.col("ts"), "day").alias("d")).distinct()
    day, week = F.expr("INTERVAL 1 DAY"), F.trunc(F.col("d").cast("date"), "week").cast(NTZ)
    wanted = days.select(F.col("d").alias("window_start"), (F.col("d") + day).alias("window_end"))
    daily = days.where(F.col("d") < ntz("2024-01-11")).select(
        F.concat(F.lit("d"), batch_id(F.col("d"), "day")).alias("partition_name"),
        F.col("d").alias("lower"), (F.col("d") + day).alias("upper"))
    weekly = days.where((F.col("d") >= ntz("2024-01-11")) & (F.col("d") < ntz("2024-01-22"))).select(
        F.concat(F.lit("w"), batch_id(week, "day")).alias("partition_name"),
        week.alias("lower"), (week + F.expr("INTERVAL 7 DAY")).alias("upper")).distinct()
    # an open-ended range, one the wrong way round, and one without an end
    special = spark.createDataFrame(
        [("future", datetime(2024, 1, 28), datetime(9999, 1, 1)), ("turned", datetime(2024, 1, 25), datetime(2024, 1, 23)), ("unknown", datetime(2024, 1, 24), None)],
        f"partition_name string, lower {NTZ}, upper {NTZ}")
    return windows.resolve_partitions(wanted, daily.unionByName(weekly).unionByName(special), "day")


@query(f"{ORDERS} SELECT * FROM loaded UNION ALL SELECT * FROM arriving WHERE o_totalprice >= 100000")
def custom_strategy_predicate(spark, sf):
    def append_matching(target, batch, keys, columns, predicates):
        return target.unionByName(batch.where(inc.all_of(predicates)))

    loaded, arriving = orders_loaded(spark, sf), orders_arriving(spark, sf)
    reordered = freeze(arriving.select(*reversed(arriving.columns)), "custom-batch")
    return inc.custom(loaded, reordered, append_matching, predicates=[F.col("o_totalprice") >= 100000])


# -- layout ---------------------------------------------------------------------------------------


@query("SELECT o_orderdate, o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def key_first_projection(spark, sf):
    return layout.key_first(table(spark, sf, "orders"), ["o_orderdate", "o_custkey"])


_YEARS = [(f"p{y}", datetime(y + 1, 1, 1)) for y in range(1995, 2000)]


@query("""SELECT o_orderkey, o_orderdate, 'p' || year(o_orderdate) AS partition_name FROM orders
WHERE o_orderdate < TIMESTAMP '2000-01-01'""")
def range_partition_assign(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return layout.assign_partition(rows, layout.range_label(F.col("o_orderdate"), _YEARS))


_LISTS = {"urgent": ["1-URGENT", "2-HIGH"], "normal": ["3-MEDIUM"], "low": ["5-LOW"]}


@query("""SELECT o_orderkey, o_orderpriority,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'urgent'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'normal' ELSE 'low' END AS partition_name
FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""")
def list_partition_assign(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return layout.assign_partition(rows, layout.list_label(F.col("o_orderpriority"), _LISTS))


@query("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def partition_reject_rows(spark, sf):
    return layout.partition_rejects(table(spark, sf, "orders"), layout.range_label(F.col("o_orderdate"), _YEARS))


@query("SELECT CAST(o_orderkey % 10 AS BIGINT) AS bucket, count(*) AS row_count FROM orders GROUP BY 1")
def bucket_skew(spark, sf):
    return layout.bucket_counts(table(spark, sf, "orders"), F.col("o_orderkey") % 10)


# -- schema changes -------------------------------------------------------------------------------


def _channel():
    return F.when(F.col("o_totalprice") > 250000, "store").otherwise("web").alias("o_channel")


_CHANNEL = "CASE WHEN o_totalprice > 250000 THEN 'store' ELSE 'web' END AS o_channel"


def _changed_batch(spark, sf):
    """The batch without a priority and with a channel."""
    return orders_arriving(spark, sf).select("*", _channel()).drop("o_orderpriority")


@query(f"""{ORDERS}
SELECT *, CAST(NULL AS VARCHAR) AS o_channel FROM loaded
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL, {_CHANNEL} FROM arriving""")
def schema_append_new(spark, sf):
    stored, batch = schema.align(orders_loaded(spark, sf), _changed_batch(spark, sf), "append_new_columns")
    return stored.unionByName(batch)


@query(f"""{ORDERS}
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_channel FROM loaded
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, o_totalprice, o_orderdate, {_CHANNEL} FROM arriving""")
def schema_sync_all(spark, sf):
    batch = _changed_batch(spark, sf).withColumn("o_custkey", F.col("o_custkey").cast("string"))
    stored, batch = schema.align(orders_loaded(spark, sf), batch, "sync_all_columns")
    return stored.unionByName(batch)


@query(f"{ORDERS} SELECT * FROM loaded UNION ALL SELECT * FROM arriving")
def schema_ignore(spark, sf):
    batch = orders_arriving(spark, sf).select("*", _channel()).withColumnRenamed("o_orderkey", "O_ORDERKEY")
    stored, batch = schema.align(orders_loaded(spark, sf), batch, "ignore")
    return stored.unionByName(batch)


@query(f"""{ORDERS} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, {_CHANNEL},
CAST(NULL AS VARCHAR) AS o_orderpriority, CAST(NULL AS DATE) AS o_paid_on FROM arriving""")
def null_fill_projection(spark, sf):
    return schema.null_fill(_changed_batch(spark, sf), {"o_orderpriority": "string", "o_paid_on": "date", "O_CHANNEL": "int"})


@query("""
WITH widths AS (
  SELECT 'p_name' AS column_name, CAST(10 AS BIGINT) AS declared_width, CAST(max(length(p_name)) AS BIGINT) AS max_length FROM part
  UNION ALL SELECT 'p_brand', 8, max(length(p_brand)) FROM part
  UNION ALL SELECT 'p_type', 6, max(length(p_type)) FROM part)
SELECT *, max_length > declared_width AS needs_widening FROM widths""")
def string_width_plan(spark, sf):
    return schema.string_width_plan(table(spark, sf, "part"), {"p_name": 10, "P_BRAND": 8, "p_type": 6})


@query("""
SELECT 'o_custkey' AS column_name, 'tinyint' AS target_type, count(*) AS rows_total,
       count(*) FILTER (o_custkey > 127) AS rows_lost FROM orders
UNION ALL SELECT 'o_totalprice', 'int', count(*), count(*) FILTER (o_totalprice <> floor(o_totalprice)) FROM orders
UNION ALL SELECT 'o_orderdate', 'date', count(*), count(*) FILTER (o_orderdate <> date_trunc('day', o_orderdate)) FROM orders
UNION ALL SELECT 'o_orderpriority', 'int', count(*), count(*) FROM orders""")
def cast_loss_profile(spark, sf):
    return schema.cast_loss_profile(
        table(spark, sf, "orders"),
        {"o_custkey": "tinyint", "o_totalprice": "int", "o_orderdate": "date", "o_orderpriority": "int"})


@query("""SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey,
CAST(o_custkey AS INTEGER) AS o_custkey FROM orders""")
def contract_projection(spark, sf):
    contract = T.StructType([
        T.StructField("o_orderpriority", T.StringType()), T.StructField("o_orderdate", T.DateType()),
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.IntegerType())])
    model = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    return schema.apply_contract(model, contract)


# -- published forms ------------------------------------------------------------------------------


@query(f"{ORDERS} SELECT * FROM arriving")
def overwrite_table(spark, sf):
    pub = publisher(spark)
    pub.replace("orders", orders_loaded(spark, sf))
    return pub.replace("orders", orders_arriving(spark, sf))
