"""The plans hold what the operators promise at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tableloom.queries.registry import QUERIES
from tableloom.operators import guards, history, quality
from tableloom.operators import incremental as inc
from tableloom.operators.history import HistorySpec

SF = "/root/testdata/sf0.001"
WRITES = {  # these publish before they return, so building their plan runs them
    "mv_", "table_", "view_", "overwrite_table", "full_refresh", "store_", "merge_within", "merge_on_read_stored",
    "microbatch_stored", "snapshot_", "bucketed", "cross_", "scan_table", "seed_", "merge_sequence", "custom_"}
LAZY = sorted(n for n in QUERIES if not n.startswith(tuple(WRITES)))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_pairs_everything_or_gathers_groups(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, REPARTITION", "Window [", "Python"):
        assert bad not in text


def test_small_batch_leaves_the_target_unshuffled(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    merged = inc.upsert(orders, orders.where("o_orderstatus = 'F'"), "o_orderkey")
    text = plan(merged)
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    target = text.split("BroadcastExchange")[0]
    assert "Exchange" not in target


def test_large_batch_is_not_broadcast(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        text = plan(inc.upsert(orders, orders.where("o_orderstatus = 'F'"), "o_orderkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and "LeftAnti" in text


def test_window_bounds_reach_the_scan(spark):
    from datetime import datetime

    events = spark.read.parquet(f"{SF}/events.parquet")
    out = inc.replace_window(events, events.where("ts < '2024-01-02'"), "ts", datetime(2024, 1, 1), datetime(2024, 1, 2))
    text = out._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(Or(LessThan(ts," in text


def test_guard_counts_are_folded_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    for df in (guards.duplicate_keys(lines, "l_orderkey"), guards.require_unique(lines, "l_orderkey"),
               guards.with_key_count(lines, "l_orderkey"), inc.latest_by_key(lines, "l_orderkey", "l_shipdate"),
               quality.bag_difference(lines, lines)):
        assert "partial_" in plan(df)


def test_closed_versions_are_not_shuffled(spark):
    spec = HistorySpec("c_custkey")
    customers = spark.read.parquet(f"{SF}/customer.parquet")
    first = history.initial_history(customers, spec, "2024-01-01 00:00:00")
    text = plan(history.advance(first, customers, spec, "2024-02-01 00:00:00"))
    assert text.count("Join") == 1


def test_bucketed_table_groups_without_a_shuffle(spark, pub):
    out = pub.replace("o", spark.read.parquet(f"{SF}/orders.parquet"), bucket_by=(4, "o_custkey"))
    assert "Exchange" not in plan(out.groupBy("o_custkey").count())


def test_merge_log_reads_only_needed_columns(spark, pub):
    from tableloom.plans.incremental_run import IncrementalConfig, run_incremental

    config = IncrementalConfig(unique_key="o_orderkey", merge_on_read=True)
    out = run_incremental(pub, "o", lambda: spark.read.parquet(f"{SF}/orders.parquet"), config)
    text = out.where("o_orderkey = 5").select("o_orderkey", "o_totalprice")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    assert "EqualTo(o_orderkey,5)" in text


def test_hot_keys_give_whole_results(spark, pub):
    """One key, partition and bucket hold a third of all rows, and adaptive execution is made to split them."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"))
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = n // 3 + 1  # the id 7 itself is not a multiple of three
        counted = guards.with_key_count(df, "k")
        assert counted.count() == n and counted.where("k = 7").agg(F.min("n"), F.count("*")).first() == (hot, hot)
        assert tuple(guards.duplicate_keys(df, "k").first()) == (7, hot)
        latest = inc.latest_by_key(df, "k", "seq")
        assert latest.count() == n - hot + 1 and latest.where("k = 7").first().seq == n - 3
        parents = df.where("k <> 7").select("k").distinct()
        assert quality.relationships(df, "k", parents, "k").count() == hot
        assert inc.anti_by_keys(df, parents, ["k"]).count() == hot
        labelled = df.withColumn("p", F.when(F.col("k") == 7, "hot").otherwise(F.concat(F.lit("p"), F.col("k") % 5)))
        stored = pub.replace("hot", labelled, partition_by="p")
        assert stored.count() == n
        assert pub.stored("hot").where("p = 'hot'").select(F.col("_metadata.file_path")).distinct().count() > 1
        assert pub.replace("buckets", df, bucket_by=(4, "k")).groupBy("k").count().where("k = 7").first()[1] == hot
        with pytest.raises(Exception, match="duplicate key in batch"):
            guards.require_unique(df, "k").count()
    finally:
        for k in settings:
            spark.conf.unset(k)
