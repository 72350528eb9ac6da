"""Type-2 history over two or three runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.functions.hashing import version_id
from tableloom.functions.timing import add_interval, ntz
from tableloom.operators import history as h
from tableloom.operators.history import HistorySpec, MetaNames
from tableloom.queries.inputs import CUSTOMERS, T0, T1, T2, customers_t0, customers_t1, table
from tableloom.queries.registry import query
from tableloom.session import freeze

KEY = "c_custkey"


def scd_sql(deletes: str, changed: str, current_only: bool = False, extra: tuple[str, str] | None = None) -> str:
    """Expected history of the customers after two runs.

    ``changed`` compares s (the new row) with h (the stored one); ``extra`` is a column new in the
    second run, as (expression, type).
    """
    old_extra = f", CAST(NULL AS {extra[1]}) AS c_tier" if extra else ""
    new_extra = f", {extra[0]} AS c_tier" if extra else ""
    flag = ", 'False' AS is_deleted" if deletes == "new_record" else ""
    closes = f"({changed})" + ("" if deletes == "ignore" else " OR s.c_custkey IS NULL")
    tombstones = f"""
  UNION ALL
  SELECT h.c_custkey, h.c_name, h.c_nationkey, h.c_acctbal, h.c_mktsegment{old_extra}, md5(h.scd_id || '|{T1}'), TIMESTAMP '{T1}', NULL, 'True'
  FROM h LEFT JOIN t1 s ON s.c_custkey = h.c_custkey WHERE s.c_custkey IS NULL""" if deletes == "new_record" else ""
    where = "WHERE valid_to IS NULL" if current_only else ""
    return f"""
WITH {CUSTOMERS},
h AS (SELECT *, md5(CAST(c_custkey AS VARCHAR) || '|{T0}') AS scd_id FROM t0),
versions AS (
  SELECT h.c_custkey, h.c_name, h.c_nationkey, h.c_acctbal, h.c_mktsegment{old_extra}, h.scd_id, TIMESTAMP '{T0}' AS valid_from,
         CASE WHEN {closes} THEN TIMESTAMP '{T1}' END AS valid_to{flag}
  FROM h LEFT JOIN t1 s ON s.c_custkey = h.c_custkey
  UNION ALL
  SELECT s.c_custkey, s.c_name, s.c_nationkey, s.c_acctbal, s.c_mktsegment{new_extra}, md5(CAST(s.c_custkey AS VARCHAR) || '|{T1}'),
         TIMESTAMP '{T1}', NULL{flag}
  FROM t1 s LEFT JOIN h ON s.c_custkey = h.c_custkey WHERE h.c_custkey IS NULL OR {changed}{tombstones})
SELECT *, valid_from AS updated_at FROM versions {where}"""


ONE = "s.c_mktsegment <> h.c_mktsegment"
ALL = "s.c_mktsegment <> h.c_mktsegment OR s.c_nationkey <> h.c_nationkey"


def _two_runs(spark, sf, spec):
    first = freeze(h.initial_history(customers_t0(spark, sf), spec, T0), "history")
    return h.advance(first, customers_t1(spark, sf), spec, T1)


@query(f"""WITH {CUSTOMERS}
SELECT *, md5(CAST(c_custkey AS VARCHAR) || '|{T0}') AS scd_id, TIMESTAMP '{T0}' AS updated_at,
       TIMESTAMP '{T0}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM t0""")
def snapshot_initial(spark, sf):
    return h.initial_history(customers_t0(spark, sf), HistorySpec(KEY), T0)


@query(scd_sql("ignore", ONE))
def snapshot_check(spark, sf):
    return _two_runs(spark, sf, HistorySpec(KEY, check_cols=("c_mktsegment",)))


@query(scd_sql("ignore", ALL))
def snapshot_check_all(spark, sf):
    return _two_runs(spark, sf, HistorySpec(KEY))


@query(scd_sql("ignore", ALL))
def snapshot_deletes_ignore(spark, sf):
    return _two_runs(spark, sf, HistorySpec(KEY, hard_deletes="ignore"))


@query(scd_sql("invalidate", ALL))
def snapshot_deletes_invalidate(spark, sf):
    return _two_runs(spark, sf, HistorySpec(KEY, hard_deletes="invalidate"))


@query(scd_sql("new_record", ALL))
def snapshot_deletes_new_record(spark, sf):
    """A third run over the same source must add nothing."""
    spec, source = HistorySpec(KEY, hard_deletes="new_record"), customers_t1(spark, sf)
    first = freeze(h.initial_history(customers_t0(spark, sf), spec, T0), "history")
    second = freeze(h.advance(first, source, spec, T1), "history")
    return h.advance(second, source, spec, T2)


@query(scd_sql("invalidate", ALL))
def snapshot_apply_changes(spark, sf):
    """The same in two steps: a stored change set, then its application by version id."""
    spec = HistorySpec(KEY, hard_deletes="invalidate")
    first = freeze(h.initial_history(customers_t0(spark, sf), spec, T0), "history")
    changes = freeze(h.change_set(first, customers_t1(spark, sf), spec, T1), "changes")
    return h.apply_changes(first, changes, spec)


@query(scd_sql("invalidate", ALL, current_only=True))
def snapshot_current_view(spark, sf):
    spec = HistorySpec(KEY, hard_deletes="invalidate")
    return h.current_rows(_two_runs(spark, sf, spec), spec)


@query(scd_sql("ignore", "s.c_custkey IS NOT NULL", extra=("CASE WHEN s.c_nationkey > 100 THEN 'b' ELSE 'a' END", "VARCHAR")))
def snapshot_add_column(spark, sf):
    """A new column opens a new version of every row that is still in the source."""
    spec = HistorySpec(KEY)
    first = freeze(h.initial_history(customers_t0(spark, sf), spec, T0), "history")
    tier = F.when(F.col("c_nationkey") > 100, "b").otherwise("a")
    return h.advance(first, customers_t1(spark, sf).withColumn("c_tier", tier), spec, T1)


@query("""
WITH t1 AS (SELECT o_orderkey, o_orderdate + CASE WHEN o_orderstatus = 'P' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS at FROM orders)
SELECT *, valid_from AS updated_at FROM (
SELECT o.*, md5(o.o_orderkey || '|' || CAST(o.o_orderdate AS VARCHAR)) AS scd_id,
       o.o_orderdate AS valid_from, CASE WHEN t1.at > o.o_orderdate THEN t1.at END AS valid_to
FROM orders o JOIN t1 ON t1.o_orderkey = o.o_orderkey
UNION ALL
SELECT o.* REPLACE (t1.at AS o_orderdate), md5(o.o_orderkey || '|' || CAST(t1.at AS VARCHAR)), t1.at, NULL
FROM orders o JOIN t1 ON t1.o_orderkey = o.o_orderkey WHERE t1.at > o.o_orderdate)""")
def snapshot_timestamp(spark, sf):
    spec = HistorySpec("o_orderkey", strategy="timestamp", updated_at="o_orderdate")
    orders = table(spark, sf, "orders")
    later = F.when(F.col("o_orderstatus") == "P", add_interval(F.col("o_orderdate"), 1, "day")).otherwise(F.col("o_orderdate"))
    first = freeze(h.initial_history(orders, spec, T0), "history")
    return h.advance(first, orders.withColumn("o_orderdate", later), spec, T1)


@query(f"""
SELECT conv_id, turn, text, md5(conv_id || '|' || turn || '|{T0}') AS version_key, TIMESTAMP '{T0}' AS changed_at,
       TIMESTAMP '{T0}' AS effective_from,
       CASE WHEN role = 'assistant' THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '2099-12-31' END AS effective_to
FROM conversations
UNION ALL
SELECT conv_id, turn, text || ' (edited)', md5(conv_id || '|' || turn || '|{T1}'), TIMESTAMP '{T1}', TIMESTAMP '{T1}',
       TIMESTAMP '2099-12-31'
FROM conversations WHERE role = 'assistant'""")
def snapshot_custom_meta(spark, sf):
    names = MetaNames("version_key", "changed_at", "effective_from", "effective_to")
    spec = HistorySpec(("conv_id", "turn"), current_sentinel="2099-12-31 00:00:00", names=names)
    turns = table(spark, sf, "conversations")
    edited = F.when(F.col("role") == "assistant", F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text"))
    first = freeze(h.initial_history(turns.drop("role"), spec, T0), "history")
    return h.advance(first, turns.withColumn("text", edited).drop("role"), spec, T1)


@query("""SELECT o_orderkey, md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), o_orderpriority,
coalesce(CAST(nullif(o_custkey, 7) AS VARCHAR), ''), CAST(o_orderdate AS VARCHAR))) AS scd_id FROM orders""")
def scd_version_id(spark, sf):
    sometimes_null = F.nullif(F.col("o_custkey"), F.lit(7))
    return table(spark, sf, "orders").select(
        "o_orderkey", version_id("o_orderkey", "o_orderpriority", sometimes_null, "o_orderdate").alias("scd_id"))


@query("""
WITH src AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN NULL
              WHEN o_orderstatus = 'P' THEN o_custkey ELSE o_orderkey END AS k,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL
              WHEN o_orderstatus = 'F' THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END AS upd
  FROM orders)
SELECT (SELECT count(*) FROM src WHERE k IS NULL) AS null_keys,
       (SELECT count(*) FROM (SELECT k FROM src GROUP BY k HAVING count(*) > 1)) AS duplicate_keys,
       (SELECT count(*) FROM src WHERE upd IS NULL) AS null_updated_at,
       (SELECT count(*) FROM src JOIN orders o ON o.o_orderkey = src.k WHERE src.upd < o.o_orderdate) AS regressed_updated_at""")
def snapshot_source_checks(spark, sf):
    spec = HistorySpec("o_orderkey", strategy="timestamp", updated_at="o_orderdate")
    orders = table(spark, sf, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    faulty = orders.withColumn(
        "o_orderkey",
        F.when((priority == "1-URGENT") & (status == "O"), None)
        .when(status == "P", F.col("o_custkey")).otherwise(F.col("o_orderkey")),
    ).withColumn(
        "o_orderdate",
        F.when(priority == "5-LOW", None)
        .when(status == "F", add_interval(F.col("o_orderdate"), -1, "day")).otherwise(F.col("o_orderdate")),
    )
    return h.source_violations(faulty, spec, h.initial_history(orders, spec, T0))


@query(f"""
WITH base AS (
  SELECT c_custkey, c_mktsegment, c_acctbal,
         CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 9000 THEN NULL ELSE md5(c_custkey || '|{T0}') END AS id,
         CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 9000 THEN NULL ELSE TIMESTAMP '{T0}' END AS f,
         CASE WHEN c_acctbal < 0 THEN TIMESTAMP '{T0}' - INTERVAL 1 DAY
              WHEN c_acctbal < 100 THEN TIMESTAMP '{T0}' END AS t
  FROM customer),
faulty AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE c_mktsegment = 'FURNITURE')
SELECT (SELECT count(*) FROM faulty WHERE id IS NULL) AS null_ids,
       (SELECT count(*) FROM faulty WHERE f IS NULL) AS null_valid_from,
       (SELECT count(*) FROM faulty WHERE f > t) AS invalid_windows,
       (SELECT count(*) FROM (SELECT id FROM faulty GROUP BY id HAVING count(*) > 1)) AS duplicate_ids,
       (SELECT count(*) FROM (SELECT c_custkey FROM faulty WHERE t IS NULL GROUP BY 1 HAVING count(*) > 1)) AS duplicate_current""")
def snapshot_result_checks(spark, sf):
    spec = HistorySpec(KEY)
    balance, segment, start = F.col("c_acctbal"), F.col("c_mktsegment"), ntz(T0)
    base = h.initial_history(table(spark, sf, "customer"), spec, T0)
    base = (
        base.withColumn("scd_id", F.when((segment == "BUILDING") & (balance > 9000), None).otherwise(F.col("scd_id")))
        .withColumn("valid_from", F.when((segment == "MACHINERY") & (balance > 9000), None).otherwise(start))
        .withColumn("valid_to", F.when(balance < 0, add_interval(start, -1, "day")).when(balance < 100, start))
    )
    return h.history_violations(base.unionByName(base.where(segment == "FURNITURE")), spec)
