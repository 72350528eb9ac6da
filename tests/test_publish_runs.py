from __future__ import annotations

from datetime import datetime
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tableloom.operators.guards import DuplicateKeyError
from tableloom.operators.schema import ContractError, SchemaChangeError, declared_widths
from tableloom.plans.incremental_run import ConfigError, IncrementalConfig, run_backfill, run_incremental
from tableloom.plans.merge_log import compact


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "kettle", 24), (2, "ladle", 57), (3, "tongs", 83)], "id int, name string, score int")


def tables(pub):
    return sorted(r.tableName for r in pub.spark.sql(f"SHOW TABLES IN {pub.database}").collect())


def test_replace_and_leftovers(pub, base):
    out = pub.replace("t", base)
    assert out.agg(F.count("*"), F.sum("score")).first() == (3, 164)
    first = pub.current_version("t")
    pub.write_version("t", base)  # as a killed run would leave it
    pub.replace("t", base.limit(1))
    assert pub.read("t").count() == 1
    assert pub.property("t", "previous_table") == first
    pub.replace("t", base.limit(2))
    assert len([n for n in tables(pub) if n.startswith("t__v_")]) == 2


def test_failed_build_and_failed_check_keep_old_rows(pub, base):
    pub.replace("t", base)
    before = tables(pub)

    def refuse(df):
        raise ValueError(f"refused {df.count()} rows")

    with pytest.raises(ValueError, match="refused 3 rows"):
        pub.replace("t", base, check=refuse)
    with pytest.raises(Exception, match="no good"):
        pub.replace("t", base.withColumn("name", F.raise_error(F.lit("no good")).cast("string")))
    with pytest.raises(ContractError):
        pub.replace("t", base, contract=T._parse_datatype_string("id int"))
    assert rows(pub.read("t")) == rows(base)
    assert tables(pub) == before
    with pytest.raises(ValueError):
        pub.replace("new", base, check=refuse)
    assert not pub.exists("new")


def test_old_version_stays_readable_for_running_queries(pub, base):
    pub.replace("t", base)
    running = pub.read("t")
    pub.replace("t", base.limit(1))
    assert running.count() == 3


def test_failing_append_changes_nothing(pub, base):
    pub.replace("t", base)
    half = base.withColumn("name", F.when(F.col("id") == 3, F.raise_error(F.lit("boom")).cast("string")).otherwise("ok"))
    with pytest.raises(Exception, match="boom"):
        pub.append("t", half)
    assert pub.read("t").count() == 3
    pub.append("t", base.select("score", "name", "id"))
    assert pub.read("t").where("id = 1").count() == 2


def test_partition_overwrite_and_pruning(pub, spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "part_id int, value string")
    pub.replace("t", t, partition_by="part_id")
    pub.overwrite_partitions("t", spark.createDataFrame([("new", 1)], "value string, part_id int"))
    assert rows(pub.read("t").select("part_id", "value")) == [(1, "new"), (2, "b")]
    pub.overwrite_partitions("t", t.limit(0))
    assert pub.read("t").count() == 2
    bad = t.withColumn("value", F.when(F.col("part_id") == 2, F.raise_error(F.lit("boom")).cast("string")).otherwise("x"))
    with pytest.raises(Exception, match="boom"):
        pub.overwrite_partitions("t", bad)
    assert rows(pub.read("t").select("part_id", "value")) == [(1, "new"), (2, "b")]
    plan = pub.read("t").where("part_id = 1")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*\(part_id#\d+ = 1\)", plan)


def test_view_contract_keeps_old_view(pub, base):
    pub.replace("t", base)
    name = pub.name("t")
    pub.create_view("v", f"SELECT id, name FROM {name} WHERE score >= 50")
    assert rows(pub.read("v")) == [(2, "ladle"), (3, "tongs")]
    contract = T._parse_datatype_string("name string, id bigint")
    with pytest.raises(ContractError):
        pub.create_view("v", f"SELECT id FROM {name}", contract)
    assert pub.read("v").count() == 2
    pub.create_view("v", f"SELECT id, name FROM {name}", contract)
    assert pub.read("v").schema.simpleString() == "struct<name:string,id:bigint>"


def test_freeze_view_preconditions(pub, base):
    pub.replace("t", base)
    pub.create_view("v", f"SELECT * FROM {pub.name('t')}")
    assert pub.freeze_view("v", "copy").count() == 3
    with pytest.raises(ValueError, match="already exists"):
        pub.freeze_view("v", "copy")
    with pytest.raises(ValueError, match="must differ"):
        pub.freeze_view("v", "V")
    with pytest.raises(ValueError, match="not a view"):
        pub.freeze_view("copy", "other")


def test_store_failures_with_limit(pub, base):
    assert rows(pub.store_failures("f", base, limit=2, order_by="score")) == rows(base)[:2]
    assert pub.store_failures("f", base).count() == 3


@pytest.mark.parametrize("config, message", [
    (dict(strategy="delete+insert"), "not one of"),
    (dict(strategy="merge"), "needs a unique_key"),
    (dict(unique_key=("id", "ID")), "repeats"),
    (dict(unique_key="a b"), "plain names"),
    (dict(strategy="insert_overwrite", unique_key="id"), "could drop rows"),
    (dict(strategy="append", sequence="s"), "only works with merge"),
    (dict(unique_key="id", predicates=(1,)), "predicates"),
    (dict(overwrite_partitions=("p",)), "only works with insert_overwrite"),
    (dict(strategy="insert_overwrite", overwrite_partitions=()), "empty"),
    (dict(strategy="insert_overwrite", overwrite_partitions=("*", "p"), partition_by="p"), "combined"),
    (dict(strategy="insert_overwrite", overwrite_partitions=("p",)), "needs partition_by"),
    (dict(strategy="microbatch"), "event_time"),
    (dict(on_schema_change="replace"), "on_schema_change"),
    (dict(strategy="append", merge_on_read=True), "merge_on_read"),
])
def test_bad_configs_have_no_effect(pub, base, config, message):
    with pytest.raises(ConfigError, match=message):
        run_incremental(pub, "t", lambda: base, IncrementalConfig(**config))
    assert tables(pub) == []


def test_default_strategy():
    assert IncrementalConfig().effective == "append"
    assert IncrementalConfig(unique_key="id").effective == "merge"


@pytest.mark.parametrize("on_read", [False, True])
def test_merge_run(pub, spark, base, on_read):
    config = IncrementalConfig(unique_key="id", merge_on_read=on_read)
    run_incremental(pub, "t", lambda: base.select("name", "id", "score"), config)
    if not on_read:
        assert pub.read("t").columns == ["id", "name", "score"]
    batch = spark.createDataFrame([(1, "kettle", 31), (4, "sieve", None)], "id int, name string, score int")
    for _ in range(2):  # a repeated run gives the same rows
        out = run_incremental(pub, "t", lambda: batch, config)
        assert rows(out.select("id", "score")) == [(1, 31), (2, 57), (3, 83), (4, None)]
    with pytest.raises(DuplicateKeyError):
        run_incremental(pub, "t", lambda: batch.union(batch), config)
    assert rows(pub.read("t").select("id", "score")) == [(1, 31), (2, 57), (3, 83), (4, None)]
    with pytest.raises((ConfigError, SchemaChangeError), match="rebuild"):
        run_incremental(pub, "t", lambda: batch, IncrementalConfig(unique_key="name", merge_on_read=on_read))
    assert not [n for n in tables(pub) if "__stage_" in n]


def test_merge_on_read_with_sequence_and_compaction(pub, spark):
    shape = "id int, seq int, value string"
    config = IncrementalConfig(unique_key="id", sequence="seq", merge_on_read=True)
    run_incremental(pub, "t", lambda: spark.createDataFrame([(1, 44, "crate"), (2, 1, "barrel")], shape), config)
    run_incremental(pub, "t", lambda: spark.createDataFrame([(1, 43, "behind"), (2, 1, None)], shape), config)
    want = [(1, 44, "crate"), (2, 1, None)]
    assert rows(pub.read("t")) == want
    assert rows(compact(pub, "t")) == want
    run_incremental(pub, "t", lambda: spark.createDataFrame([(1, 42, "further behind"), (3, 0, "x")], shape), config)
    assert rows(pub.read("t")) == [*want, (3, 0, "x")]
    wider = IncrementalConfig(unique_key="id", sequence="seq", merge_on_read=True, on_schema_change="append_new_columns")
    run_incremental(pub, "t", lambda: spark.createDataFrame([(3, 1, "y", True)], shape + ", flag boolean"), wider)
    assert rows(pub.read("t")) == [(1, 44, "crate", None), (2, 1, None, None), (3, 1, "y", True)]


def test_merge_is_confined_to_touched_partitions(pub, spark):
    config = IncrementalConfig(unique_key=("p", "id"), partition_by="p", sequence="seq")
    shape = "id int, seq int, p int"
    run_incremental(pub, "t", lambda: spark.createDataFrame([(1, 5, 1), (2, 5, 2), (3, 5, None)], shape), config)
    files = {r[0] for r in pub.spark.table(pub.name(pub.current_version("t"))).where("p = 2").select(F.col("_metadata.file_path")).collect()}
    batch = spark.createDataFrame([(1, 4, 1), (9, 1, 1), (3, 6, None)], shape)
    out = run_incremental(pub, "t", lambda: batch, config)
    assert rows(out.select("p", "id", "seq")) == [(1, 1, 5), (1, 9, 1), (2, 2, 5), (None, 3, 6)]
    assert {r[0] for r in pub.spark.table(pub.name(pub.current_version("t"))).where("p = 2").select(F.col("_metadata.file_path")).collect()} == files


def test_several_partition_columns_and_buckets(pub, spark):
    shape = "id int, v string, p int, q string"
    config = IncrementalConfig(unique_key=("p", "q", "id"), partition_by=("p", "q"), bucket_by=(2, "id"))
    run_incremental(pub, "Mixed", lambda: spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 1, None), (3, "c", 2, "x")], shape), config)
    batch = spark.createDataFrame([(1, "A", 1, "x"), (2, "B", 1, None), (9, "n", 3, "y")], shape)
    out = run_incremental(pub, "Mixed", lambda: batch, config)
    assert rows(out.select("id", "v")) == [(1, "A"), (2, "B"), (3, "c"), (9, "n")]
    star = IncrementalConfig(strategy="insert_overwrite", partition_by=("p", "q"), overwrite_partitions="*")
    run_incremental(pub, "d", lambda: batch, star)
    out = run_incremental(pub, "d", lambda: batch.where("id = 1").withColumn("v", F.lit("z")), star)
    assert rows(out.select("id", "v")) == [(1, "z"), (2, "B"), (9, "n")]
    with pytest.raises(ConfigError, match="single partition column"):
        IncrementalConfig(strategy="insert_overwrite", partition_by=("p", "q"), overwrite_partitions=("1",)).validate()


def test_schema_change_runs(pub, spark, base):
    wider = base.selectExpr("id", "name", "score + 1 AS score", "true AS flag")
    for policy, columns in [("ignore", 3), ("append_new_columns", 4), ("sync_all_columns", 4)]:
        config = IncrementalConfig(unique_key="id", on_schema_change=policy)
        run_incremental(pub, policy, lambda: base, config)
        out = run_incremental(pub, policy, lambda: wider.where("id = 1"), config)
        assert (out.count(), len(out.columns)) == (3, columns)
    config = IncrementalConfig(unique_key="id", on_schema_change="fail")
    run_incremental(pub, "fails", lambda: base, config)
    with pytest.raises(SchemaChangeError):
        run_incremental(pub, "fails", lambda: wider, config)
    with pytest.raises(SchemaChangeError, match="change type"):
        run_incremental(pub, "fails", lambda: base.withColumn("id", F.col("id").cast("string")), config)
    assert rows(pub.read("fails")) == rows(base)


def test_overwrite_runs(pub, spark):
    shape = "value string, p int"
    t = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], shape)
    plain = IncrementalConfig(strategy="insert_overwrite", partition_by="p")
    named = IncrementalConfig(strategy="insert_overwrite", partition_by="p", overwrite_partitions=("1", "2"))
    star = IncrementalConfig(strategy="insert_overwrite", partition_by="p", overwrite_partitions="*")
    run_incremental(pub, "t", lambda: t, plain)
    assert rows(run_incremental(pub, "t", lambda: t.where("p = 1").withColumn("value", F.lit("new")), named)) == [("c", 3), ("new", 1)]
    with pytest.raises(Exception, match="outside the partitions"):
        run_incremental(pub, "t", lambda: t, named)
    assert rows(pub.read("t")) == [("c", 3), ("new", 1)]
    assert rows(run_incremental(pub, "t", lambda: t.where("p = 2"), star)) == [("b", 2), ("c", 3), ("new", 1)]
    assert rows(run_incremental(pub, "t", lambda: t.where("p = 1"), plain)) == [("a", 1)]
    assert run_incremental(pub, "t", lambda: t.limit(0), plain).count() == 0


def test_microbatch_days(pub, spark):
    shape = "id int, event_time timestamp_ntz, value string"
    events = spark.createDataFrame([(i, datetime(2024, 1, i, 5), "v") for i in (1, 2, 3)], shape)
    config = IncrementalConfig(strategy="microbatch", event_time="event_time", batch_size="day")
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 4)
    assert run_backfill(pub, "t", lambda: events, config, start, end).count() == 3
    assert pub.read("t").columns == ["id", "event_time", "value"]
    day3 = (datetime(2024, 1, 3), end)
    assert run_incremental(pub, "t", lambda: events.where("id < 3"), config, window=day3).count() == 2
    assert run_backfill(pub, "t", lambda: events, config, *day3).count() == 3
    with pytest.raises(ConfigError, match="not one day window"):
        run_incremental(pub, "t", lambda: events, config, window=(start, datetime(2024, 1, 1, 12)))
    hourly = IncrementalConfig(strategy="microbatch", event_time="event_time", batch_size="hour")
    with pytest.raises(ConfigError, match="batch_size"):
        run_incremental(pub, "t", lambda: events, hourly, window=(start, datetime(2024, 1, 1, 1)))
    wider = IncrementalConfig(strategy="microbatch", event_time="event_time", batch_size="day",
                              on_schema_change="append_new_columns")
    out = run_incremental(pub, "t", lambda: events.withColumn("extra", F.lit(1)), wider, window=day3)
    assert rows(out.select("id", "extra")) == [(1, None), (2, None), (3, 1)]
    assert run_incremental(pub, "t", lambda: events.withColumn("extra", F.lit(1)), wider, window=day3).count() == 3


def test_custom_strategy_run(pub, spark, base):
    def only_new(target, batch, keys, columns, predicates):
        return target.unionByName(batch.join(target.select(*keys), keys, "left_anti").select(*columns))

    config = IncrementalConfig(unique_key="id", custom=only_new)
    run_incremental(pub, "t", lambda: base.where("id = 1"), config)
    out = run_incremental(pub, "t", lambda: base.withColumn("name", F.lit("n")).select("score", "id", "name"), config)
    assert rows(out) == [(1, "kettle", 24), (2, "n", 57), (3, "n", 83)]


def _as_stored(config):
    return {"table_model": config.effective, "unique_key": ",".join(config.keys), "sequence": "", "batch_size": "", "partition_by": ""}


def test_text_columns_widen_unless_fixed(pub, spark):
    narrow = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.VarcharType(5))])
    short, long = [spark.createDataFrame([r], "id int, name string") for r in [(1, "a"), (2, "expanded")]]
    for name, config in [("t", IncrementalConfig()), ("m", IncrementalConfig(unique_key="id"))]:
        pub.replace(name, short, contract=narrow, properties=_as_stored(config))
        assert declared_widths(pub.stored(name).schema) == {"name": 5}
        out = run_incremental(pub, name, lambda: long, config)
        assert rows(out) == [(1, "a"), (2, "expanded")]
        assert declared_widths(pub.stored(name).schema)["name"] >= 8
    config = IncrementalConfig(unique_key="name")
    pub.replace("k", short, contract=narrow, properties=_as_stored(config))
    with pytest.raises(SchemaChangeError, match="would have to widen"):
        run_incremental(pub, "k", lambda: long, config)
    pub.replace("c", short, contract=narrow)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|LENGTH"):
        run_incremental(pub, "c", lambda: long, IncrementalConfig(contract=narrow))
    assert rows(pub.read("c")) == [(1, "a")]


def _stock(spark, *rows_):
    return spark.createDataFrame(list(rows_), "item string, pieces int, shelf string, level int")


def test_readers_planned_before_a_partial_overwrite_keep_their_rows(pub, spark):
    pub.replace("stock", _stock(spark, ("nut", 7, "A", 1), ("bolt", 8, "A", 2), ("cap", 9, None, 1)), partition_by=("shelf", "level"))
    planned, version = pub.read("stock"), pub.current_version("stock")
    want = rows(planned)
    seen = []
    for pieces in (70, 71, 72):
        now = pub.read("stock")
        before = rows(now)
        pub.overwrite_partitions("stock", _stock(spark, ("nut", pieces, "A", 1), ("cap", pieces, None, 1)))
        assert rows(now) == before  # the version before is there until the write after the next
        seen.append(rows(pub.read("stock")))
    assert seen[-1] == [("bolt", 8, "A", 2), ("cap", 72, None, 1), ("nut", 72, "A", 1)]
    assert pub.current_version("stock") == version and want != seen[-1]
    # the slots of the current version and of the one before are there, those of older ones are gone
    slots = {(r.write_slot.split("-")[0], r.shelf, r.level) for r in spark.table(pub.name(version)).select("write_slot", "shelf", "level").distinct().collect()}
    assert slots == {("0", "A", 2), *((w, *p) for w in "23" for p in (("A", 1), (None, 1)))}


def test_a_failure_between_write_and_switch_changes_nothing(pub, spark):
    pub.replace("stock", _stock(spark, ("nut", 7, "A", 1), ("bolt", 8, "B", 2)), partition_by="shelf")
    before = rows(pub.read("stock"))

    def killed():
        raise RuntimeError("killed before the switch")

    with pytest.raises(RuntimeError, match="killed"):
        pub.overwrite_partitions("stock", _stock(spark, ("lost", 0, "A", 1), ("lost", 0, "Z", 1)), before_publish=killed)
    assert rows(pub.read("stock")) == before
    pub.overwrite_partitions("stock", _stock(spark, ("pin", 5, "B", 2)))
    assert rows(pub.read("stock")) == [("nut", 7, 1, "A"), ("pin", 5, 2, "B")]


def test_several_partitions_change_in_one_step_and_named_ones_are_emptied(pub, spark):
    pub.replace("stock", _stock(spark, *((f"i{n}", n, f"S{n % 4}", n % 3) for n in range(24))), partition_by="shelf")
    named = spark.createDataFrame([("S1",), ("S2",), ("none",)], "shelf string")
    pub.overwrite_partitions("stock", _stock(spark, ("new", 1, "S2", 0)), named)
    out = pub.read("stock")
    assert sorted((r.shelf, r["count"]) for r in out.groupBy("shelf").count().collect()) == [("S0", 6), ("S2", 1), ("S3", 6)]
    pub.append("stock", _stock(spark, ("late", 1, "S1", 0), ("late", 1, "S0", 0)))
    assert pub.read("stock").where("shelf IN ('S0', 'S1')").count() == 8
    pub.overwrite_partitions("stock", _stock(spark).limit(0))
    assert pub.read("stock").count() == 15


def test_very_many_touched_partitions_stay_a_table(spark):
    from tableloom.operators.incremental import within_partitions

    stored = spark.range(40_000).selectExpr("CAST(id % 200 AS INT) AS a", "IF(id < 200, NULL, CAST(id DIV 200 AS STRING)) AS b", "id")
    touched = stored.where("id % 2 = 0").select("a", "b")
    assert touched.count() == 20_000
    assert within_partitions(stored, touched, ["a", "b"]).agg(F.count("*"), F.sum(F.col("id") % 2)).first() == (20_000, 0)


def test_a_partial_merge_reads_only_the_touched_partitions(pub, spark):
    from tableloom.operators.incremental import within_partitions

    pub.replace("stock", _stock(spark, *((f"i{n}", n, f"S{n % 50}", n) for n in range(100))), partition_by="shelf")
    with pub.stage("stock", spark.createDataFrame([("S3",), ("S7",)], "shelf string")) as touched:
        out = within_partitions(pub.stored("stock"), touched, ["shelf"])
        assert out.count() == 4
        assert "dynamicpruning" in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_a_backfill_that_replaces_all_must_cover_what_is_stored(pub, spark):
    events = spark.createDataFrame([(i, datetime(2024, 3, i, 7)) for i in range(1, 6)], "id int, at timestamp_ntz")
    config = IncrementalConfig(strategy="microbatch", event_time="at", batch_size="day")
    run_backfill(pub, "seen", lambda: events, config, datetime(2024, 3, 1), datetime(2024, 3, 6))
    with pytest.raises(ConfigError, match="outside it"):
        run_backfill(pub, "seen", lambda: events, config, datetime(2024, 3, 2), datetime(2024, 3, 3), full_refresh=True)
    assert pub.read("seen").count() == 5
    assert run_backfill(pub, "seen", lambda: events.where("id < 5"), config, datetime(2024, 2, 1), datetime(2024, 4, 1), full_refresh=True).count() == 4


def test_windows_of_another_size_may_follow_but_not_overlap(pub, spark):
    events = spark.createDataFrame([(i, datetime(2024, 3, 1 + i // 24, i % 24)) for i in range(72)], "id int, at timestamp_ntz")
    daily, hourly = (IncrementalConfig(strategy="microbatch", event_time="at", batch_size=size) for size in ("day", "hour"))
    run_backfill(pub, "seen", lambda: events, daily, datetime(2024, 3, 1), datetime(2024, 3, 3))
    with pytest.raises(ConfigError, match="another batch_size.*overlap"):
        run_backfill(pub, "seen", lambda: events, hourly, datetime(2024, 3, 2, 5), datetime(2024, 3, 2, 6))
    assert run_backfill(pub, "seen", lambda: events, hourly, datetime(2024, 3, 3), datetime(2024, 3, 4)).count() == 72
    less = events.where("id <> 50")
    assert run_incremental(pub, "seen", lambda: less, hourly, window=(datetime(2024, 3, 3, 2), datetime(2024, 3, 3, 3))).count() == 71
    with pytest.raises(ConfigError, match="another batch_size.*overlap"):
        run_incremental(pub, "seen", lambda: less, daily, window=(datetime(2024, 3, 3), datetime(2024, 3, 4)))


def test_late_events_replace_their_windows(pub, spark):
    from tableloom.session import scratch_path
    from tableloom.streaming.microbatch import replace_windows_on_commit

    base, offsets = scratch_path(spark, "seen"), scratch_path(spark, "offsets")
    config = IncrementalConfig(strategy="microbatch", event_time="at", batch_size="day")
    shape = "id int, at timestamp_ntz"

    def commit(*events, **options):
        spark.createDataFrame(list(events), shape).write.mode("append").parquet(base)
        replace_windows_on_commit(pub, "seen", base, T._parse_datatype_string(shape), config, offsets, **options).awaitTermination()
        return sorted(r.id for r in pub.read("seen").collect())

    assert commit((1, datetime(2024, 3, 1, 7)), (2, datetime(2024, 3, 2, 7)), (0, None)) == [1, 2]
    live = {r.event_window: r.write_slot for r in spark.table(pub.name(pub.current_version("seen"))).select("event_window", "write_slot").collect()}
    assert commit((3, datetime(2024, 3, 1, 9)), (4, datetime(2024, 2, 1))) == [1, 2, 3, 4]
    now = spark.table(pub.name(pub.property("seen", "live_table"))).collect()
    assert {r.write_slot for r in now if r.event_window.startswith("20240302")} == {live["20240302T00-day"]}  # the day without new events is as it was
    assert commit((5, datetime(2024, 3, 2, 1)), lookback=3) == [1, 2, 3, 4, 5]


def test_text_widths_are_measured_while_a_volatile_source_is_written_once(pub, spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(value):
        reads.add(1)
        return value

    narrow = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("note", T.VarcharType(4))])
    pub.replace("notes", spark.createDataFrame([(1, "ab")], "id int, note string"), contract=narrow, properties=_as_stored(IncrementalConfig()))
    source = spark.createDataFrame([(2, "longer text"), (3, "x")], "id int, note string").withColumn("note", F.udf(counted).asNondeterministic()("note"))
    for times, width in ((2, 11), (4, 11)):
        run_incremental(pub, "notes", lambda: source, IncrementalConfig())
        assert reads.value == times
        assert declared_widths(pub.stored("notes").schema) == {"note": width}
    assert pub.read("notes").count() == 5


def test_a_log_is_read_bucket_by_bucket_and_folds_itself(pub, spark, monkeypatch):
    from tableloom.plans import merge_log

    monkeypatch.setattr(merge_log, "FOLD_AFTER", 3)
    config = IncrementalConfig(unique_key="crate", merge_on_read=True)
    for n in range(5):
        batch = spark.range(40 * n, 40 * n + 60).selectExpr("id AS crate", f"{n} AS round")
        out = run_incremental(pub, "log", lambda b=batch: b, config)
        assert "Exchange hash" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.round, r["count"]) for r in out.groupBy("round").count().collect()) == [(0, 40), (1, 40), (2, 40), (3, 40), (4, 60)]
    assert pub.property("log", "last_batch") == "1"


def test_descriptions_outlive_rebuilds(pub, spark):
    pub.replace("stock", _stock(spark, ("nut", 7, "A", 1)), partition_by="shelf")
    pub.describe("stock", "What is on the shelves; it's counted weekly", {"Pieces": "whole packs", "item": "a 'name'"})

    def said():
        lines = spark.sql(f"DESCRIBE TABLE EXTENDED {pub.name('stock')}").collect()
        return {r.col_name: r.comment for r in lines if r.comment} | {r.col_name: r.data_type for r in lines if r.col_name == "Comment"}

    want = {"pieces": "whole packs", "item": "a 'name'", "Comment": "What is on the shelves; it's counted weekly"}
    assert said() == want
    pub.overwrite_partitions("stock", _stock(spark, ("pin", 5, "A", 2)))
    assert said() == want
    pub.replace("stock", _stock(spark, ("cap", 1, "B", 1)).drop("pieces"))
    assert said() == {k: v for k, v in want.items() if k != "pieces"}
    pub.describe("stock", "", {"item": ""})
    assert said() == {} and rows(pub.read("stock")) == [("cap", "B", 1)]
    with pytest.raises(ValueError, match="no columns"):
        pub.describe("stock", columns={"weight": "kg"})
