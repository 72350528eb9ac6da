from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tableloom.operators import freshness, quality, rollup
from tableloom.plans.rollup_run import RollupConfig, build_rollup, refresh_rollup
from tableloom.session import scratch_path
from tableloom.sources import files
from tableloom.streaming.refresh import refresh_on_commit

ORDERS = "order_id int, order_date date, amount int"
BY_DAY = RollupConfig(partition={"order_date": "order_date"})


def daily(base):
    return rollup.aggregate(base, {"order_date": F.col("order_date")}, {"sales": F.sum("amount")})


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [(1, date(2024, 7, 1), 100), (2, date(2024, 7, 1), 200), (3, date(2024, 7, 2), 50)], ORDERS)


def test_complete_refresh(spark, pub, orders):
    config = RollupConfig(refresh="complete")
    assert rows(build_rollup(pub, "mv", orders, daily, config).select("sales")) == [(300,), (50,)]
    more = orders.union(spark.createDataFrame([(4, date(2024, 7, 3), 75)], ORDERS))
    assert sorted(r.sales for r in refresh_rollup(pub, "mv", more, daily, config).collect()) == [50, 75, 300]


def test_deferred_build_is_empty_until_refreshed(pub, orders):
    config = RollupConfig(build="deferred", partition=BY_DAY.partition)
    assert build_rollup(pub, "mv", orders, daily, config).count() == 0
    assert refresh_rollup(pub, "mv", orders, daily, config).count() == 2


def test_refresh_of_stale_partitions_only(spark, pub, orders):
    build_rollup(pub, "mv", orders, daily, BY_DAY)
    file_of = {r.order_date: r.f for r in pub.spark.table(pub.name(pub.current_version("mv"))).select("order_date", F.col("_metadata.file_path").alias("f")).collect()}
    changed = spark.createDataFrame([(1, date(2024, 7, 1), 100), (2, date(2024, 7, 1), 201), (5, date(2024, 7, 4), 7)], ORDERS)
    after = changed.union(orders.where("order_id = 3"))
    out = refresh_rollup(pub, "mv", after, daily, BY_DAY)
    assert rows(out.select("order_date", "sales")) == [(date(2024, 7, 1), 301), (date(2024, 7, 2), 50), (date(2024, 7, 4), 7)]
    now = {r.order_date: r.f for r in pub.spark.table(pub.name(pub.current_version("mv"))).select("order_date", F.col("_metadata.file_path").alias("f")).collect()}
    assert now[date(2024, 7, 2)] == file_of[date(2024, 7, 2)]
    gone = refresh_rollup(pub, "mv", after.where("order_id <> 5"), daily, BY_DAY)
    assert gone.count() == 2
    same = refresh_rollup(pub, "mv", after.where("order_id <> 5"), daily, BY_DAY)
    assert rows(same) == rows(gone)


def test_null_partition_is_refreshed(spark, pub):
    a = spark.createDataFrame([(1, None, 5), (2, date(2024, 1, 1), 1)], ORDERS)
    build_rollup(pub, "mv", a, daily, BY_DAY)
    b = a.withColumn("amount", F.col("amount") * 2)
    assert sorted(r.sales for r in refresh_rollup(pub, "mv", b, daily, BY_DAY).collect()) == [2, 10]
    c = b.where("order_date IS NOT NULL")
    assert sorted(r.sales for r in refresh_rollup(pub, "mv", c, daily, BY_DAY).collect()) == [2]


def test_fingerprints_see_multiplicity(spark):
    part = {"p": F.col("p")}
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y")], "p int, v string")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y")], "p int, v string")
    fa, fb = rollup.fingerprints(a, part), rollup.fingerprints(b, part)
    assert rollup.stale_partitions(fa, fb, "p").count() == 1
    assert rollup.stale_partitions(fa, rollup.fingerprints(a.repartition(3), part), "p").count() == 0


def test_changed_files_name_their_partitions(spark):
    path = scratch_path(spark, "files")
    part = {"p": F.col("p")}
    spark.createDataFrame([(1, 1), (2, 2)], "p int, v int").write.partitionBy("p").parquet(path)
    before = spark.createDataFrame(rollup.file_partitions(spark.read.parquet(path), part).collect())
    new, gone = rollup.changed_files(before, spark.read.parquet(path), part)
    assert new.isEmpty() and gone.isEmpty()
    spark.createDataFrame([(2, 3)], "p int, v int").write.mode("append").partitionBy("p").parquet(path)
    new, gone = rollup.changed_files(before, spark.read.parquet(path), part)
    assert rows(new.select("p")) == [(2,)] and gone.isEmpty()


def test_pure_partition_refresh(spark, orders):
    stored = daily(orders)
    changed = orders.withColumn("amount", F.col("amount") + 1)
    stale = spark.createDataFrame([(date(2024, 7, 1),)], "order_date date")
    out = rollup.refresh_partitions(stored, changed, daily, stale, BY_DAY.partition)
    assert sorted(r.sales for r in out.collect()) == [50, 302]


def test_failed_refresh_keeps_rows_and_retry_works(pub, orders):
    build_rollup(pub, "mv", orders, daily, BY_DAY)
    changed = orders.withColumn("amount", F.col("amount") + 1)

    def broken(base):
        return daily(base).withColumn("sales", F.raise_error(F.lit("broken")).cast("bigint"))

    with pytest.raises(Exception, match="broken"):
        refresh_rollup(pub, "mv", changed, broken, BY_DAY)
    assert sorted(r.sales for r in pub.read("mv").collect()) == [50, 300]
    assert sorted(r.sales for r in refresh_rollup(pub, "mv", changed, daily, BY_DAY).collect()) == [51, 302]


def test_bad_rollup_configs():
    for bad in (dict(build="later"), dict(refresh="never"), dict(fingerprint="guess")):
        with pytest.raises(ValueError):
            RollupConfig(**bad).validate()


def test_refresh_on_commit(spark, pub, orders):
    base, offsets = scratch_path(spark, "base"), scratch_path(spark, "offsets")
    orders.write.parquet(base)
    build_rollup(pub, "mv", spark.read.parquet(base), daily, RollupConfig(build="deferred", partition=BY_DAY.partition))

    def run():
        query = refresh_on_commit(pub, "mv", base, orders.schema, daily, BY_DAY.partition, offsets)
        query.awaitTermination()
        return query.lastProgress

    run()
    assert sorted(r.sales for r in pub.read("mv").collect()) == [50, 300]
    version = pub.current_version("mv")
    late = spark.createDataFrame([(4, date(2024, 7, 2), 25), (5, date(2024, 7, 9), 1)], ORDERS)
    late.write.mode("append").parquet(base)
    run()
    assert sorted(r.sales for r in pub.read("mv").collect()) == [1, 75, 300]
    run()
    assert pub.current_version("mv") == version
    assert sorted(r.sales for r in pub.read("mv").collect()) == [1, 75, 300]


def test_tests_ignore_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None)], "k int, v string")
    assert rows(quality.unique(df, "k")) == [(1, 2)]
    assert quality.not_null(df, "v").count() == 1
    assert rows(quality.accepted_values(df, "v", ["a"])) == [("b", 1), ("c", 1)]
    parents = spark.createDataFrame([(2,), (None,)], "id int")
    assert rows(quality.relationships(df, "k", parents, "id")) == [(1,), (1,)]


def test_differences(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "w")], "k int, v string")
    assert rows(quality.bag_difference(a, b)) == [
        (1, "x", "a", 1), (2, "y", "b", 1), (2, None, "a", 1), (3, "z", "a", 1), (4, "w", "b", 1)]
    assert quality.bag_difference(a, a.repartition(3)).count() == 0
    assert rows(quality.keyed_difference(a.distinct(), b, "k")) == [
        (2, "changed", "v"), (3, "only_a", None), (4, "only_b", None)]


@pytest.mark.parametrize("minutes, status", [(30, "pass"), (60, "pass"), (90, "warn"), (120, "warn"), (180, "error")])
def test_freshness_grades(spark, minutes, status):
    now = datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(1, now - timedelta(minutes=minutes), True), (2, now - timedelta(minutes=5), False)],
                               "id int, loaded_at timestamp_ntz, is_valid boolean")
    row = freshness.freshness(df, "loaded_at", now, timedelta(hours=1), timedelta(hours=2), where=F.col("is_valid")).first()
    assert (row.age_seconds, row.status) == (minutes * 60, status)
    assert freshness.freshness(df, "loaded_at", now, timedelta(hours=1)).first().status == "pass"
    custom = df.where("is_valid").agg(F.max("loaded_at"))
    assert freshness.freshness_of(custom, now, timedelta(hours=1), timedelta(hours=2)).first().status == status
    assert freshness.freshness(df.limit(0), "loaded_at", now).first().status == "error"
    just_over = df.withColumn("loaded_at", F.lit(now - timedelta(hours=1, microseconds=1)).cast("timestamp_ntz"))
    assert freshness.freshness(just_over, "loaded_at", now, timedelta(hours=1)).first().status == "warn"


def test_seed_types(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text('id,name,score,active,at,ratio\n1,"a, ""b""",100,true,2024-01-01 00:00:00,2.5\n2,bob,200,false,2024-01-02 01:00:00,3\n')
    inferred = files.seed_csv(spark, str(path))
    assert inferred.schema.simpleString() == (
        "struct<id:int,name:string,score:int,active:boolean,at:timestamp_ntz,ratio:double>")
    typed = files.seed_csv(spark, str(path), {"SCORE": "bigint", "id": "string"})
    assert typed.schema["score"].dataType.simpleString() == "bigint"
    assert typed.first().name == 'a, "b"'
    assert typed.agg(F.count("*"), F.sum("score")).first() == (2, 300)
    with pytest.raises(ValueError, match="does not have"):
        files.seed_csv(spark, str(path), {"nope": "int"})


def test_typed_load(spark):
    df = spark.createDataFrame([("1", "longer_string_value"), ("x", "b"), (None, None)], "ID string, name string")
    typed, rejects = files.typed_load(df, {"id": "int", "Name": "varchar(5)"})
    assert rows(typed) == [(1, "longer_string_value"), (None, None)]
    assert rows(rejects) == [("x", "b")]
    with pytest.raises(ValueError, match="accepted columns"):
        files.typed_load(df, {"id": "int"})
