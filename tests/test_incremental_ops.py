from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tableloom.operators import guards
from tableloom.operators import incremental as inc


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(11, "kettle", 24), (12, "ladle", 7), (13, None, 0)], "part int, label string, stock int")


def test_append_matches_by_name(spark, base):
    batch = spark.createDataFrame([(3, "whisk", 21), (None, "sieve", 22)], "stock int, label string, part int")
    assert rows(inc.append(base, batch)) == rows(base) + [(21, "whisk", 3), (22, "sieve", None)]


def test_append_keeps_repeated_keys(spark):
    t = spark.range(5).selectExpr("id % 2 AS shelf", "id AS box")
    assert rows(inc.append(t, t.where("shelf = 1"))) == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 1), (1, 3), (1, 3)]


def test_upsert_replaces_whole_rows(spark, base):
    batch = spark.createDataFrame([(12, None, 9), (14, "sieve", 2)], "part int, label string, stock int")
    assert rows(inc.upsert(base, batch, "PART")) == [(11, "kettle", 24), (12, None, 9), (13, None, 0), (14, "sieve", 2)]


def test_upsert_composite_key(spark):
    grid = spark.range(9).selectExpr("id DIV 3 AS aisle", "id % 3 AS bay", "CAST(id AS STRING) AS crate")
    moved = grid.where("aisle = bay").withColumn("crate", F.lit("moved")).union(spark.sql("SELECT 3L, 0L, 'added'"))
    out = {(a, b): crate for a, b, crate in rows(inc.upsert(grid, moved, ["aisle", "bay"]))}
    assert out == {(a, b): "moved" if a == b else str(3 * a + b) for a in range(3) for b in range(3)} | {(3, 0): "added"}


def test_upsert_null_key_matches_null_key(spark):
    t = spark.createDataFrame([(None, "loose"), (7, "boxed")], "crate int, how string")
    b = spark.createDataFrame([(None, "wrapped")], "crate int, how string")
    assert rows(inc.upsert(t, b, "crate")) == [(7, "boxed"), (None, "wrapped")]


def test_upsert_reserved_word_key(spark):
    t = spark.createDataFrame([(1, "a")], "`order` int, value string")
    b = spark.createDataFrame([(1, "b")], "`order` int, value string")
    assert rows(inc.upsert(t, b, "order")) == [(1, "b")]


@pytest.mark.parametrize("target", ["full", "empty"])
def test_repeated_batch_key_fails(spark, base, target):
    batch = spark.createDataFrame([(13, "tongs", 1), (13, "tongs", 1), (30, None, 2)], "part int, label string, stock int")
    stored = base if target == "full" else base.limit(0)
    with pytest.raises(Exception, match="duplicate key in batch"):
        inc.upsert(stored, batch, "part").collect()


def test_two_null_keys_are_repeated(spark):
    t = spark.createDataFrame([(1, "a")], "id int, value string")
    b = spark.createDataFrame([(None, "x"), (None, "y")], "id int, value string")
    with pytest.raises(Exception, match="duplicate key in batch"):
        inc.upsert(t, b, "id").collect()


def test_guard_reads_source_once_and_keeps_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, None), (2, None, 2, "r")], "id int, key_count string, row_values int, `odd.name` string")
    guarded = guards.require_unique(df, "id")
    assert guarded.columns == df.columns
    assert rows(guarded) == rows(df)
    assert guarded._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    with pytest.raises(Exception, match="duplicate key in batch"):
        guards.require_unique(df.union(df), "id").collect()
    # The guard must fail even if only a count is asked for.
    with pytest.raises(Exception, match="duplicate key in batch"):
        guards.require_unique(df.union(df), "id").count()


def test_guard_without_other_columns(spark):
    df = spark.range(3)
    assert guards.require_unique(df, "id").count() == 3


def test_lower_sequence_does_not_replace(spark):
    shape = "lot int, revision int, note string"
    stored = spark.createDataFrame([(5, 70, "held"), (6, 3, "older"), (7, None, "unnumbered"), (8, 12, "even")], shape)
    arriving = spark.createDataFrame([(5, 69, "behind"), (6, 4, "ahead"), (7, -1, "numbered"), (8, 12, "wins the tie"), (9, None, "fresh")], shape)
    assert rows(inc.upsert_sequenced(stored, arriving, "lot", "revision")) == [
        (5, 70, "held"), (6, 4, "ahead"), (7, -1, "numbered"), (8, 12, "wins the tie"), (9, None, "fresh")]
    without = spark.createDataFrame([(5, None, "no number")], shape)
    assert (5, 70, "held") in rows(inc.upsert_sequenced(stored, without, "lot", "revision"))


def test_repeated_keys_are_refused_before_sequence(spark):
    t = spark.createDataFrame([(1, 10, "a")], "id int, seq int, name string")
    for stored in (t, t.limit(0)):
        for pair in ([(1, 20, "b"), (1, 30, "c")], [(1, 2, "b"), (1, 3, "c")]):
            b = spark.createDataFrame(pair, "id int, seq int, name string")
            with pytest.raises(Exception, match="duplicate key in batch"):
                inc.upsert_sequenced(stored, b, "id", "seq").collect()


def test_latest_by_key_keeps_null_values_and_breaks_ties(spark):
    log = spark.createDataFrame([(1, 1, 1, "a"), (1, 2, 1, None), (2, 5, 1, "x"), (2, 5, 2, "y")], "k int, s int, id int, v string")
    assert rows(inc.latest_by_key(log, "k", ["s", "id"])) == [(1, 2, 1, None), (2, 5, 2, "y")]


def test_overwrite_partitions(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "part_id int, value string")
    b = spark.createDataFrame([(1, "new")], "part_id int, value string")
    p = F.col("part_id")
    assert rows(inc.overwrite_partitions(t, b, p, [1])) == [(1, "new"), (2, "b"), (None, "n")]
    assert rows(inc.overwrite_partitions(t, b.limit(0), p, [1])) == [(2, "b"), (None, "n")]
    with pytest.raises(Exception, match="outside the partitions"):
        inc.overwrite_partitions(t, b, p, [2]).collect()
    assert rows(inc.overwrite_dynamic(t, b, p)) == [(1, "new"), (2, "b"), (None, "n")]
    assert rows(inc.overwrite_dynamic(t, b.limit(0), p)) == rows(t)


def test_replace_window_keeps_null_times(spark):
    t = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 3)), (4, None)],
        "id int, at timestamp_ntz")
    day = (datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert [r[0] for r in rows(inc.replace_window(t, t.limit(0), "at", *day))] == [1, 3, 4]
    with pytest.raises(Exception, match="outside its event-time window"):
        inc.replace_window(t, t, "at", *day).collect()


def test_backfill_covers_whole_windows(spark):
    s = spark.createDataFrame([(i, datetime(2024, 1, i)) for i in range(1, 6)], "id int, at timestamp_ntz")
    out = inc.backfill(s.limit(0), s, "at", datetime(2024, 1, 2, 12), datetime(2024, 1, 4, 1), "day")
    assert [r[0] for r in rows(out)] == [2, 3, 4]
    assert inc.backfill(s, s, "at", datetime(2024, 1, 2), datetime(2024, 1, 2), "day") is s


def test_custom_strategy_matches_by_name(spark):
    t = spark.createDataFrame([(1, 1.5, "a")], "id int, measure double, value string")
    b = spark.createDataFrame([("b", 2, 2.5), ("c", -1, 0.0)], "value string, id int, measure double")
    out = inc.custom(t, b, lambda tgt, batch, keys, cols, preds: tgt.unionByName(batch.where(inc.all_of(preds))),
                     predicates=[F.col("id") >= 0])
    assert rows(out) == [(1, 1.5, "a"), (2, 2.5, "b")]


def test_key_counts_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, v string")
    assert rows(guards.with_key_count(df, "k")) == [(1, "a", 2), (1, "b", 2), (2, "e", 1), (None, "c", 2), (None, "d", 2)]
    assert rows(guards.duplicate_keys(df, "k")) == [(1, 2), (None, 2)]
