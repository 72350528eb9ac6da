"""Stored aggregates: builds and refreshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.functions.timing import Calendar
from tableloom.operators import incremental, rollup
from tableloom.plans.rollup_run import RollupConfig, build_rollup, refresh_rollup
from tableloom.queries.inputs import CENTS, ORDERS, ORDERS_MERGED, cents, orders_arriving, orders_loaded, publisher, table
from tableloom.queries.registry import query
from tableloom.session import scratch_path
from tableloom.streaming.refresh import merge_on_commit, refresh_on_commit


def _mergeable() -> rollup.Mergeable:
    """Orders and cents per day, with the year they are stored by."""
    return rollup.Mergeable(
        {"order_day": F.col("o_orderdate").cast("date"), "order_year": F.year("o_orderdate")},
        {"n_orders": ("count", F.lit(1)), "total_cents": ("sum", cents())},
    )


def _by_day(orders):
    return _mergeable()(orders)


def _by_year(**options) -> RollupConfig:
    return RollupConfig(partition={"order_year": Calendar("o_orderdate", "year")}, **options)


def _day_sql(rows: str) -> str:
    return f"""SELECT CAST(o_orderdate AS DATE) AS order_day, CAST(year(o_orderdate) AS INTEGER) AS order_year,
count(*) AS n_orders, CAST(sum({CENTS}) AS BIGINT) AS total_cents FROM {rows} GROUP BY 1, 2"""


def _merged(spark, sf):
    return incremental.upsert(orders_loaded(spark, sf), orders_arriving(spark, sf), "o_orderkey")


@query(_day_sql("orders"))
def mv_build_immediate(spark, sf):
    return build_rollup(publisher(spark), "orders_by_day", table(spark, sf, "orders"), _by_day, RollupConfig())


@query(f"SELECT *, CAST(0 AS BIGINT) AS rows_before FROM ({_day_sql('orders')})")
def mv_build_deferred(spark, sf):
    """Built with its schema only, counted, then filled by its first refresh."""
    pub, orders, config = publisher(spark), table(spark, sf, "orders"), RollupConfig(build="deferred")
    before = build_rollup(pub, "orders_by_day", orders, _by_day, config).count()
    return refresh_rollup(pub, "orders_by_day", orders, _by_day, config).withColumn("rows_before", F.lit(before).cast("long"))


@query(f"{ORDERS_MERGED} {_day_sql('merged')}")
def mv_refresh_complete(spark, sf):
    pub, config = publisher(spark), RollupConfig(refresh="complete")
    build_rollup(pub, "orders_by_day", orders_loaded(spark, sf), _by_day, config)
    return refresh_rollup(pub, "orders_by_day", _merged(spark, sf), _by_day, config)


@query(f"{ORDERS_MERGED} {_day_sql('merged')}")
def mv_refresh_partitions(spark, sf):
    """Only the years whose base rows changed are computed again."""
    pub = publisher(spark)
    build_rollup(pub, "orders_by_day", orders_loaded(spark, sf), _by_day, _by_year())
    return refresh_rollup(pub, "orders_by_day", _merged(spark, sf), _by_day, _by_year())


@query(f"{ORDERS}, both_sources AS (SELECT * FROM loaded UNION ALL SELECT * FROM arriving) {_day_sql('both_sources')}")
def mv_union_sources(spark, sf):
    base = rollup.union_sources(orders_loaded(spark, sf), orders_arriving(spark, sf))
    return build_rollup(publisher(spark), "orders_by_day", base, _by_day, RollupConfig())


def _in_commits(spark, sf, stream):
    """Two commits of files into a base folder, each followed by a run of the stream."""
    pub, base, checkpoint = publisher(spark), scratch_path(spark, "base"), scratch_path(spark, "offsets")
    orders = table(spark, sf, "orders")
    # Half of each year's orders arrive late, so the second commit touches stored partitions again.
    for part in (orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'")):
        part.write.mode("append").parquet(base)
        if not pub.exists("orders_by_day"):
            build_rollup(pub, "orders_by_day", spark.read.parquet(base), _mergeable(), _by_year(build="deferred"))
        stream(pub, "orders_by_day", base, orders.schema, _mergeable(), _by_year().partition, checkpoint).awaitTermination()
    return pub.read("orders_by_day")


@query(_day_sql("orders"))
def mv_refresh_on_commit(spark, sf):
    """Each commit's own sums are merged into the stored ones; nothing else of the base is read."""
    return _in_commits(spark, sf, merge_on_commit)


@query(_day_sql("orders"))
def mv_recompute_on_commit(spark, sf):
    """Each commit's partitions are computed again from the whole base, as an aggregate that cannot be merged needs."""
    return _in_commits(spark, sf, refresh_on_commit)


@query(f"{ORDERS}, both_sources AS (SELECT * FROM loaded UNION ALL SELECT * FROM arriving) {_day_sql('both_sources')}")
def mv_refresh_changed_files(spark, sf):
    """A base folder gets new files; files without rows of the years they touch are never opened again."""
    pub, base = publisher(spark), scratch_path(spark, "base")
    orders_loaded(spark, sf).repartitionByRange(8, "o_orderdate").write.parquet(base)
    build_rollup(pub, "orders_by_day", spark.read.parquet(base), _by_day, _by_year(fingerprint="files"))
    orders_arriving(spark, sf).coalesce(1).write.mode("append").parquet(base)
    return refresh_rollup(pub, "orders_by_day", spark.read.parquet(base), _by_day, _by_year(fingerprint="files"))


@query(f"""SELECT order_day, order_year, 2 * n_orders AS n_orders, total_cents FROM ({_day_sql('orders')})""")
def mv_definition_change(spark, sf):
    """A model that counts twice under the same names and types is told from the stored one by its plan, and everything is rebuilt."""
    pub, orders = publisher(spark), table(spark, sf, "orders")
    build_rollup(pub, "orders_by_day", orders, _by_day, _by_year())
    return refresh_rollup(pub, "orders_by_day", orders, lambda rows: _by_day(rows).withColumn("n_orders", F.col("n_orders") * 2), _by_year())


@query("""SELECT o_orderdate AS order_date, o_orderpriority AS priority, count(*) AS n_orders FROM (
SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS o_orderdate, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders) GROUP BY 1, 2""")
def mv_refresh_null_moves(spark, sf):
    """Values that become null, or cease to be, move rows between partitions, of which null is one."""
    pub, orders = publisher(spark), table(spark, sf, "orders")

    def shifted(date_lost, priority_lost):
        return orders.select("o_orderkey", F.when(F.col("o_orderstatus") != date_lost, F.col("o_orderdate")).alias("o_orderdate"),
                             F.when(F.col("o_orderstatus") != priority_lost, F.col("o_orderpriority")).alias("o_orderpriority"))

    def by_date(rows):
        return rollup.aggregate(rows, {"order_date": "o_orderdate", "priority": "o_orderpriority"}, {"n_orders": F.count(F.lit(1))})

    config = RollupConfig(partition={"priority": "o_orderpriority"})
    build_rollup(pub, "orders_by_date", shifted("O", "P"), by_date, config)
    return refresh_rollup(pub, "orders_by_date", shifted("P", "F"), by_date, config)


@query(_day_sql("orders"))
def mv_failed_build_keeps_old(spark, sf):
    pub, orders = publisher(spark), table(spark, sf, "orders")
    build_rollup(pub, "orders_by_day", orders, _by_day, RollupConfig())

    def broken(base):
        return _by_day(base).withColumn("n_orders", F.raise_error(F.lit("broken model")).cast("bigint"))

    try:
        refresh_rollup(pub, "orders_by_day", orders_loaded(spark, sf), broken, RollupConfig(refresh="complete"))
    except Exception as error:
        if "broken model" not in str(error):
            raise
    return pub.read("orders_by_day")
