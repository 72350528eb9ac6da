"""What a name is stored as, digests, definitions, strict casts and seeds."""

from __future__ import annotations

from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
import pytest

from tableloom.functions.hashing import multiset_digest
from tableloom.operators import freshness, quality
from tableloom.operators.history import HistorySpec, advance, initial_history
from tableloom.operators.rollup import fingerprints
from tableloom.operators.schema import conform, string_width_plan
from tableloom.plans.history_run import run_history
from tableloom.plans.incremental_run import ConfigError, IncrementalConfig, run_backfill, run_incremental
from tableloom.plans.publish import StorageModelError
from tableloom.plans.rollup_run import DefinitionChanged, RollupConfig, build_rollup, refresh_rollup
from tableloom.sources.files import seed_csv
from tableloom.sources.tables import event_time_scan


@pytest.fixture
def stock(spark):
    return spark.createDataFrame([(10, "bolt", 4), (11, "gear", 9)], "part int, label string, pieces int")


RUNS = {
    "append": lambda pub, df: run_incremental(pub, "s", lambda: df, IncrementalConfig()),
    "merge": lambda pub, df: run_incremental(pub, "s", lambda: df, IncrementalConfig(unique_key="part")),
    "log": lambda pub, df: run_incremental(pub, "s", lambda: df, IncrementalConfig(unique_key="part", merge_on_read=True)),
    "history": lambda pub, df: run_history(pub, "s", df, HistorySpec(keys="part"), "2024-01-01 00:00:00"),
    "rollup": lambda pub, df: build_rollup(pub, "s", df, lambda b: b.groupBy("label").count(), RollupConfig()),
}


@pytest.mark.parametrize("first", sorted(RUNS))
def test_other_models_are_refused_and_nothing_changes(pub, stock, first):
    before = rows(RUNS[first](pub, stock))
    tables = {r["tableName"] for r in pub.spark.sql(f"SHOW TABLES IN {pub.database}").collect()}
    for other in set(RUNS) - {first}:
        with pytest.raises(StorageModelError):
            RUNS[other](pub, stock.limit(1))
    assert rows(pub.read("s")) == before
    assert {r["tableName"] for r in pub.spark.sql(f"SHOW TABLES IN {pub.database}").collect()} == tables


def test_a_history_is_not_rebuilt_by_an_incremental_run(pub, stock):
    RUNS["history"](pub, stock)
    with pytest.raises(StorageModelError):
        run_incremental(pub, "s", lambda: stock, IncrementalConfig(unique_key="part"), full_refresh=True)


def test_full_refresh_turns_a_merge_into_a_log_and_back(pub, stock):
    RUNS["merge"](pub, stock)
    logged = IncrementalConfig(unique_key="part", merge_on_read=True)
    run_incremental(pub, "s", lambda: stock, logged, full_refresh=True)
    assert rows(run_incremental(pub, "s", lambda: stock.where("part = 10").withColumn("pieces", F.lit(5)), logged)) == [(10, "bolt", 5), (11, "gear", 9)]
    assert rows(run_incremental(pub, "s", lambda: stock, IncrementalConfig(unique_key="part"), full_refresh=True)) == [(10, "bolt", 4), (11, "gear", 9)]


def test_a_plain_rebuild_is_no_target_of_a_merge(pub, stock):
    pub.replace("s", stock.union(stock))
    with pytest.raises(StorageModelError):
        RUNS["merge"](pub, stock)
    assert pub.append("s", stock).count() == 6


def test_one_window_is_no_full_refresh(pub, spark):
    events = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "n int, at timestamp_ntz")
    config = IncrementalConfig(strategy="microbatch", event_time="at", batch_size="day")
    run_backfill(pub, "w", lambda: events, config, datetime(2024, 1, 1), datetime(2024, 1, 3))
    with pytest.raises(ConfigError, match="run_backfill"):
        run_incremental(pub, "w", lambda: events, config, full_refresh=True, window=(datetime(2024, 1, 1), datetime(2024, 1, 2)))
    assert pub.read("w").count() == 2


def test_plain_tables_are_left_alone(pub, stock):
    stock.write.saveAsTable(pub.name("plain"))
    with pytest.raises(StorageModelError, match="plain table"):
        pub.replace("plain", stock)
    assert [r["tableName"] for r in pub.spark.sql(f"SHOW TABLES IN {pub.database}").collect()] == ["plain"]


def test_a_view_takes_over_a_published_name(pub, stock):
    pub.replace("s", stock)
    pub.create_view("s", "SELECT 1 AS one")
    assert [r["tableName"] for r in pub.spark.sql(f"SHOW TABLES IN {pub.database}").collect()] == ["s"]
    assert rows(pub.replace("s", stock.limit(1))) == [(10, "bolt", 4)]


def test_failing_rows_as_a_view(pub, stock):
    assert rows(pub.view_failures("bad", stock.where("pieces > 5"))) == [(11, "gear", 9)]
    assert pub.spark.catalog.getTable(pub.name("bad")).tableType == "VIEW"


def test_options_a_layout_cannot_hold_are_refused(pub, stock):
    for config in (IncrementalConfig(unique_key="part", merge_on_read=True, partition_by="label"),
                   IncrementalConfig(strategy="microbatch", event_time="t", batch_size="day", bucket_by=(2, "part"))):
        with pytest.raises(ConfigError, match="stores by"):
            config.validate()


def test_digests_tell_where_nulls_are(spark):
    digest = lambda *r: spark.createDataFrame(r, "a int, b int").agg(*[c.alias(n) for n, c in multiset_digest("a", "b").items()]).first()
    assert digest((7, None)) != digest((None, 7))
    shape = "k int, m map<string,int>, l array<int>, s struct<x:int,y:int>"
    nested = lambda *r: rows(fingerprints(spark.createDataFrame([(1, *r)], shape), {"k": "k"}))
    assert nested({"a": 1, "b": 2}, [1], (1, None)) == nested({"b": 2, "a": 1}, [1], (1, None))
    assert len({str(nested(*r)) for r in [({}, [None, 1], (1, None)), ({}, [1, None], (1, None)), ({}, [1], (None, 1)), (None, [1], (None, 1))]}) == 4


def test_a_changed_definition(pub, stock):
    part = {"label": F.col("label")}
    totals = lambda factor: lambda b: b.groupBy("label").agg((F.sum("pieces") * factor).alias("n"))
    config = lambda text, **o: RollupConfig(partition=part, definition=text, **o)
    build_rollup(pub, "r", stock, totals(1), config("x1"))
    grown = stock.union(stock.where("part = 10"))
    with pytest.raises(DefinitionChanged):
        refresh_rollup(pub, "r", grown, totals(100), config("x100", on_definition_change="fail"))
    assert rows(refresh_rollup(pub, "r", grown, totals(100), config("x100", on_definition_change="continue"))) == [(4, "bolt"), (9, "gear")]
    assert rows(refresh_rollup(pub, "r", grown, totals(100), config("x100"))) == [(800, "bolt"), (900, "gear")]


def test_rows_that_swap_a_null_are_stale(pub, spark):
    shape = "day int, a int, b int"
    model = lambda base: base.groupBy("day").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    config = RollupConfig(partition={"day": F.col("day")})
    build_rollup(pub, "r", spark.createDataFrame([(1, 7, None)], shape), model, config)
    assert rows(refresh_rollup(pub, "r", spark.createDataFrame([(1, None, 7)], shape), model, config)) == [(None, 7, 1)]


def test_casts_that_do_not_fit_stop_the_job(spark):
    wide = spark.createDataFrame([(5_000_000_000,)], "n long")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="does not fit int"):
                conform(wide, T.StructType([T.StructField("n", T.IntegerType())])).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_no_text_column_needs_no_width(spark):
    assert string_width_plan(spark.range(3), {"name": 5}).collect() == []


def test_seeds_are_strict(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text('id,note\n1,"two\nlines"\n2,b\n')
    assert rows(seed_csv(spark, str(path), multi_line=True)) == [(1, "two\nlines"), (2, "b")]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        seed_csv(spark, str(path), {"id": "int"}).collect()
    path.write_text("id,note\nx7,a\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        seed_csv(spark, str(path), {"id": "int"}).collect()


def test_instants_are_read_in_utc_whatever_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        source = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00+00:00' AS at")
        found = freshness.freshness(source, "at", "2024-01-01 00:30:00", error_after=timedelta(minutes=20)).first()
        assert (found["age_seconds"], found["status"]) == (1800, "error")
        at = datetime(2024, 1, 1)
        assert event_time_scan(source, "at", at, at + timedelta(hours=1)).count() == 1
        assert event_time_scan(source, "at", at + timedelta(hours=1), None).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_versions_with_other_columns_or_repeated_keys_are_refused(spark, stock):
    with pytest.raises(ValueError, match="one version only"):
        quality.keyed_difference(stock, stock.withColumn("more", F.lit(1)), "part")
    with pytest.raises(Exception, match="several rows in version b"):
        quality.keyed_difference(stock, stock.union(stock), "part").collect()
    clash = stock.withColumn("version_row", F.lit(1)).withColumn("in_a", F.lit(2))
    assert rows(quality.keyed_difference(clash, clash.withColumn("in_a", F.col("part")), "part")) == [(10, "changed", "in_a"), (11, "changed", "in_a")]


def test_sources_may_have_the_names_of_helpers(spark, pub):
    shape = "part int, change_type string, closed_id int"
    spec = HistorySpec(keys="part", hard_deletes="new_record")
    first, then = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], shape), spark.createDataFrame([(1, "c", 1)], shape)
    history = advance(initial_history(first, spec, "2024-01-01 00:00:00"), then, spec, "2024-02-01 00:00:00")
    assert history.where("part = 1").count() == 2 and "change_type" in history.columns
    run_history(pub, "h", first, spec, "2024-01-01 00:00:00")
    assert run_history(pub, "h", then, spec, "2024-02-01 00:00:00").count() == history.count()


def test_a_view_takes_over_neither_histories_nor_aggregates(spark, pub):
    from datetime import datetime

    from tableloom.operators.history import HistorySpec
    from tableloom.plans.history_run import run_history

    spec = HistorySpec(keys="crate", check_cols=("weight",))
    for day, weight in enumerate((10, 11, 12), start=1):
        run_history(pub, "crates", spark.createDataFrame([(1, weight)], "crate int, weight int"), spec, datetime(2024, 5, day))
    with pytest.raises(StorageModelError):
        pub.create_view("crates", "SELECT 1 AS crate")
    assert pub.read("crates").count() == 3
    spark.sql(f"DROP VIEW {pub.name('crates')}")
    with pytest.raises(StorageModelError, match="view crates is gone"):
        run_history(pub, "crates", spark.createDataFrame([(1, 13)], "crate int, weight int"), spec, datetime(2024, 5, 9))
    assert spark.table(pub.name("crates__versions")).count() > 3


def test_a_failed_history_run_leaves_nothing_behind_for_the_next(spark, pub):
    spec = HistorySpec(keys="crate", check_cols=("weight",))

    def crates(*weights):
        return spark.createDataFrame(list(enumerate(weights)), "crate int, weight int")

    def killed():
        raise RuntimeError("killed")

    run_history(pub, "crates", crates(5, 6), spec, datetime(2024, 5, 1))
    with pytest.raises(RuntimeError, match="killed"):
        run_history(pub, "crates", crates(7, 6), spec, datetime(2024, 5, 2), before_publish=killed)
    assert pub.read("crates").count() == 2
    out = run_history(pub, "crates", crates(5, 9), spec, datetime(2024, 5, 2))
    assert sorted((r.crate, r.weight, r.valid_to is None) for r in out.collect()) == [(0, 5, True), (1, 6, False), (1, 9, True)]


def test_a_stored_history_is_joined_where_it_lies(spark, pub):
    from tableloom.operators.history import advance_current

    spec = HistorySpec(keys="crate", hard_deletes="invalidate")
    first = spark.range(2_000).selectExpr("id AS crate", "id % 7 AS weight")
    run_history(pub, "crates", first, spec, datetime(2024, 5, 1), buckets=8)
    current = spark.table(pub.name("crates__versions")).where("NOT history_closed AND history_run = 0").drop("history_run", "history_closed")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = advance_current(current, first.where("crate > 9"), spec, datetime(2024, 5, 2))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1  # the source's alone
    gone = run_history(pub, "crates", first.where("crate > 9"), spec, datetime(2024, 5, 2))
    assert gone.where("valid_to IS NULL").count() == 1_990
    back = run_history(pub, "crates", first, spec, datetime(2024, 5, 3))
    assert back.count() == 2_010 and back.where("valid_to IS NULL").count() == 2_000


def test_a_returning_key_must_not_repeat_an_id(spark, pub):
    from tableloom.operators.history import ViolationError

    spec = HistorySpec(keys="crate", strategy="timestamp", updated_at="at", hard_deletes="invalidate")
    both = spark.createDataFrame([(1, datetime(2024, 5, 1)), (2, datetime(2024, 5, 1))], "crate int, at timestamp_ntz")
    run_history(pub, "crates", both, spec, datetime(2024, 5, 1))
    run_history(pub, "crates", both.where("crate = 1"), spec, datetime(2024, 5, 2))
    with pytest.raises(ViolationError, match="reused_ids"):
        run_history(pub, "crates", both, spec, datetime(2024, 5, 3))
    assert pub.read("crates").count() == 2
