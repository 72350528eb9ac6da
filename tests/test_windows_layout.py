from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tableloom.functions import timing
from tableloom.operators import layout
from tableloom.operators.windows import calendar_cover, require_exact, resolve_partitions
from tableloom.plans import publish
from tableloom.sources.tables import event_time_scan, relation_name


def day(d, m=1, y=2024):
    return datetime(y, m, d)


def resolve(spark, windows, parts, unit="day"):
    w = spark.createDataFrame(windows, "window_start timestamp_ntz, window_end timestamp_ntz")
    p = spark.createDataFrame(parts, "partition_name string, lower timestamp_ntz, upper timestamp_ntz")
    return resolve_partitions(w, p, unit)


def test_resolution_of_each_kind(spark):
    parts = [("p1", day(1), day(2)), ("copy", day(3), day(4)), ("copy2", day(3), day(4)),
             ("week", day(8), day(15)), ("rest", day(1, 2), day(31, 12, 9998))]
    windows = [(day(1), day(2)), (day(2), day(3)), (day(3), day(4)), (day(9), day(10)), (day(15), day(16)),
               (day(5, 6), day(6, 6))]
    out = {r.window_start: (r.status, r.partition_name) for r in resolve(spark, windows, parts, "day").collect()}
    assert out == {
        day(1): ("exact", "p1"), day(2): ("missing", None), day(3): ("ambiguous", None),
        day(9): ("overlap", None), day(15): ("missing", None), day(5, 6): ("overlap", None)}


@pytest.mark.parametrize("unit", ["hour", "day", "month", "year"])
def test_resolution_against_brute_force(spark, unit):
    windows = timing.windows_between(datetime(2023, 11, 29), datetime(2024, 3, 2), unit)[-200:]
    parts, at = [], datetime(2023, 12, 30)
    for i in range(60):
        step = timedelta(hours=[1, 5, 24, 24, 31 * 24][i % 5])
        parts.append((f"p{i}", at, at + step))
        at += step if i % 4 else step + timedelta(hours=7)
    got = {r.window_start: (r.exact_count, r.overlap_count) for r in resolve(spark, windows, parts, unit).collect()}
    for lo, hi in windows:
        exact = sum((a, b) == (lo, hi) for _, a, b in parts)
        assert got[lo] == (exact, sum(a < hi and b > lo for _, a, b in parts) - exact)


def test_ranges_that_are_not_known_make_missing_windows_unparsable(spark):
    windows = [(day(1), day(2)), (day(3), day(4)), (day(8), day(9)), (day(6), day(5)), (None, day(7))]
    parts = [("p1", day(1), day(2)), ("wide", day(3), day(5)), ("turned", day(12), day(10)), ("open", day(20), None)]
    out = {(r.window_start, r.window_end): r.status for r in resolve(spark, windows, parts).collect()}
    assert list(out.values()).count("unparsable") == 3
    assert (out[day(1), day(2)], out[day(3), day(4)], out[day(8), day(9)]) == ("exact", "overlap", "unparsable")
    with pytest.raises(Exception, match="unparsable"):
        require_exact(resolve(spark, windows[2:3], parts), allow_missing=True).collect()


def test_wide_ranges_are_few_units(spark):
    wide = [(datetime(1, 1, 1), datetime(9999, 1, 1)), (datetime(1969, 7, 20, 20, 17), datetime(2024, 2, 29, 13, 1)), (day(1), day(2)), (datetime(2024, 1, 1, 5, 10), datetime(2024, 1, 1, 5, 20))]
    df = spark.createDataFrame(wide, "a timestamp_ntz, b timestamp_ntz")
    sizes = {r.a: (r.own, r.all) for r in calendar_cover(df, "a", "b").groupBy("a").agg(F.count_if("own").alias("own"), F.count(F.lit(1)).alias("all")).collect()}
    assert max(n for _, n in sizes.values()) < 150
    assert sizes[datetime(1, 1, 1)][0] < 70 and sizes[day(1)][0] == 1 and sizes[datetime(2024, 1, 1, 5, 10)][0] == 1


def test_overlaps_of_ranges_of_all_widths(spark):
    rng = random.Random(8)
    bounds = lambda: sorted(datetime(rng.choice([1, 1899, 1999, 2023, 2024, 9000]), rng.randint(1, 12), rng.randint(1, 28), rng.choice([0, 0, 7, 23]), rng.choice([0, 0, 30])) for _ in range(2))
    parts = [(f"p{i}", *b) for i, b in enumerate(b for b in (bounds() for _ in range(80)) if b[0] < b[1])] + [("all", datetime(1, 1, 1), datetime(9999, 12, 31))]
    windows = list({tuple(b) for b in (bounds() for _ in range(80)) if b[0] < b[1]})
    got = {(r.window_start, r.window_end): (r.exact_count, r.overlap_count) for r in resolve(spark, windows, parts).collect()}
    for lo, hi in windows:
        exact = sum((a, b) == (lo, hi) for _, a, b in parts)
        assert got[lo, hi] == (exact, sum(a < hi and b > lo for _, a, b in parts) - exact)


def test_unsafe_windows_fail(spark):
    missing = resolve(spark, [(day(1), day(2))], [("p", day(5), day(6))])
    assert require_exact(missing, allow_missing=True).count() == 1
    with pytest.raises(Exception, match="no exact partition"):
        require_exact(missing, allow_missing=False).collect()
    overlap = resolve(spark, [(day(1), day(2))], [("p", day(1), day(3))])
    with pytest.raises(Exception, match="no exact partition"):
        require_exact(overlap, allow_missing=True).collect()


def test_batch_ids_and_names(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 7, 30, 1, 5),)], "ts timestamp_ntz")
    ts = F.col("ts")
    ids = df.select(*[timing.batch_id(ts, u) for u in timing.BATCH_SIZES]).first()
    assert tuple(ids) == ("20240229T07", "20240229", "202402", "2024")
    assert df.select(timing.partition_name(ts, "hour")).first()[0] == "mb_2024022907"
    starts = df.select(*[timing.window_start(ts, u) for u in timing.BATCH_SIZES]).first()
    assert tuple(starts) == (datetime(2024, 2, 29, 7), day(29, 2), day(1, 2), day(1))
    ends = df.select(*[timing.window_end(ts, u) for u in timing.BATCH_SIZES]).first()
    assert tuple(ends) == (datetime(2024, 2, 29, 8), day(1, 3), day(1, 3), day(1, 1, 2025))
    with pytest.raises(ValueError, match="batch size"):
        timing.batch_id(ts, "week")


def test_truncation_ignores_the_session_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 31, 2, 30),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 does not exist there
    try:
        text = df.select(timing.window_start(F.col("ts"), "hour").cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert text == "2024-03-31 02:00:00"


def test_bounds_with_offsets_become_utc(spark):
    df = spark.createDataFrame([(1, day(10)), (2, day(11))], "id int, ts timestamp_ntz")
    east = timezone(timedelta(hours=8))
    out = event_time_scan(df, "ts", datetime(2024, 1, 10, 8, tzinfo=east), datetime(2024, 1, 11, 8, tzinfo=east))
    assert [r.id for r in out.collect()] == [1]
    assert [r.id for r in event_time_scan(df, "ts", day(11), None).collect()] == [2]
    assert [r.id for r in event_time_scan(df, "ts", None, day(11)).collect()] == [1]


def test_relation_names():
    assert relation_name("t", schema="s", database="d") == "`d`.`t`"
    assert relation_name("t", schema="s") == "`s`.`t`"
    assert relation_name("we`ird") == "`we``ird`"


def test_range_label(spark):
    df = spark.createDataFrame([(-5,), (9,), (10,), (19,), (20,), (None,)], "v int")
    label = layout.range_label(F.col("v"), [("a", 10), ("b", 20)])
    assert [r[0] for r in df.select(label).collect()] == ["a", "a", "b", "b", None, "a"]
    assert layout.partition_rejects(df, label).count() == 1
    assert layout.assign_partition(df, label).count() == 5


def test_range_label_with_many_bounds(spark):
    bounds = [(f"p{i}", i * 3 + 3) for i in range(300)]
    df = spark.range(0, 901)
    bad = df.where(layout.range_label(F.col("id"), bounds) != F.concat(F.lit("p"), F.floor(F.col("id") / 3).cast("string")))
    assert bad.count() == 0
    assert df.where(layout.range_label(F.col("id"), bounds).isNull()).count() == 1


def test_list_label(spark):
    df = spark.createDataFrame([(1, "CN"), (2, "US"), (3, "DE"), (4, None)], "id int, region string")
    label = layout.list_label(F.col("region"), {"p_cn": ["CN"], "p_us": ["US"]})
    assert rows(layout.assign_partition(df, label)) == [(1, "CN", "p_cn"), (2, "US", "p_us")]
    assert layout.partition_rejects(df, label).count() == 2


def test_key_first(spark):
    df = spark.createDataFrame([("v", 1, 2)], "value string, id int, tenant int")
    assert layout.key_first(df, ["ID", "tenant"]).columns == ["id", "tenant", "value"]


def test_bucket_expression_is_the_writers(spark, pub):
    df = spark.range(200).withColumn("v", F.col("id") * 7)
    pub.replace("b", df, bucket_by=(4, "id"))
    stored = pub.stored("b").select("id", F.input_file_name().alias("f"))
    with_bucket = stored.select(
        layout.bucket_of("id", 4).alias("want"), F.regexp_extract("f", r"_(\d{5})(?:\.c\d+)", 1).cast("int").alias("got"))
    assert with_bucket.where("want <> got OR got IS NULL").count() == 0


def test_appends_to_buckets_add_a_file_for_each(spark, pub):
    rows_ = spark.range(0, 4_000, 1, 16).withColumn("v", F.col("id") % 97)
    pub.replace("b", rows_, bucket_by=(8, "id"))
    before = set(pub.stored("b").inputFiles())
    pub.append("b", rows_)
    assert len(set(pub.stored("b").inputFiles()) - before) == 8
    grouped = pub.read("b").groupBy("id").count()
    assert grouped.where("count <> 2").isEmpty()
    assert "Exchange hash" not in grouped._jdf.queryExecution().executedPlan().toString()


def test_a_random_distribution_splits_equal_rows(spark, pub):
    pub.replace("r", spark.range(3_000).select(F.lit("same").alias("v")), bucket_by=(6, ()))
    sizes = [r["count"] for r in pub.read("r").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 6 and max(sizes) - min(sizes) <= 16


def test_a_random_distribution_moves_rows_by_file_and_not_by_shuffle(spark, pub):
    shares = publish.dealt(spark.range(0, 9_000, 1, 5), 6, "s")
    with pub.stage("dealt_rows", shares, "s") as stored, publish.tasks_kept(spark):
        out = publish.gathered(stored, 6, "s")
        assert out.rdd.getNumPartitions() == 6 and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert rows(out) == rows(spark.range(9_000))


def test_a_random_distribution_keeps_every_row_as_it_is(spark, pub):
    odd = spark.sql("""SELECT * FROM VALUES (1, 'a', array(1, null), map('k', 1.5D), timestamp_ntz'2020-01-01 00:00:01', 7),
        (null, null, null, null, null, null), (null, null, null, null, null, null), (2, '', array(), map(), null, 7) AS t(k, v, a, m, at, WRITE_share)""")
    stored = pub.replace("odd", odd, bucket_by=(8, ()))
    assert stored.schema.simpleString() == odd.schema.simpleString() and sorted(map(str, stored.collect())) == sorted(map(str, odd.collect()))
    assert pub.replace("odd", odd.where("k = 9"), bucket_by=(8, ())).count() == 0
    assert pub.replace("odd", spark.range(700), bucket_by=(publish.DEALT_ASIDE + 6, ())).groupBy(F.input_file_name()).count().count() == publish.DEALT_ASIDE + 6
    assert not [t for t in spark.catalog.listTables(pub.database) if "__stage_" in t.name]
