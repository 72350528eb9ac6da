from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tableloom.operators import history as h
from tableloom.operators.history import HistorySpec, MetaNames, ViolationError
from tableloom.operators.schema import SchemaChangeError
from tableloom.plans.history_run import run_history

T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
SHAPE = "id int, name string, score int"


@pytest.fixture
def t0(spark):
    return spark.createDataFrame([(1, "alice", 100), (2, "bob", 200)], SHAPE)


@pytest.fixture
def t1(spark):
    return spark.createDataFrame([(1, "alice", 150), (3, "charlie", 300)], SHAPE)


def keys_and_scores(df, *more):
    return sorted((r.id, r.score, *[r[m] for m in more]) for r in df.collect())


def test_check_with_invalidated_deletes(pub, t0, t1):
    spec = HistorySpec("id", check_cols=("name", "score"), hard_deletes="invalidate")
    run_history(pub, "snap", t0, spec, T0)
    for at in (T1, T2):  # the second run over the same source changes nothing
        out = run_history(pub, "snap", t1, spec, at)
        assert out.count() == 4
        assert keys_and_scores(h.current_rows(out, spec)) == [(1, 150), (3, 300)]
        closed = out.where("valid_to IS NOT NULL")
        assert {r.valid_to for r in closed.collect()} == {datetime(2024, 2, 1)}


@pytest.mark.parametrize("mode, open_keys, total", [("ignore", [1, 2, 3], 4), ("invalidate", [1, 3], 4), ("new_record", [1, 2, 3], 5)])
def test_hard_deletes(pub, t0, t1, mode, open_keys, total):
    spec = HistorySpec("id", hard_deletes=mode)
    run_history(pub, "snap", t0, spec, T0)
    run_history(pub, "snap", t1, spec, T1)
    out = run_history(pub, "snap", t1, spec, T2)
    assert out.count() == total
    assert sorted(r.id for r in h.current_rows(out, spec).collect()) == open_keys
    if mode == "new_record":
        assert rows(out.where("id = 2").select("score", "is_deleted", "valid_to")) == [
            (200, "False", datetime(2024, 2, 1)), (200, "True", None)]


def test_deleted_key_that_returns_opens_a_version(pub, t0, t1):
    spec = HistorySpec("id", hard_deletes="new_record")
    run_history(pub, "snap", t0, spec, T0)
    run_history(pub, "snap", t1, spec, T1)
    out = run_history(pub, "snap", t0.union(t1.where("id = 3")), spec, T2)
    assert rows(out.where("id = 2").select("is_deleted", "valid_from", "valid_to")) == [
        ("False", datetime(2024, 1, 1), datetime(2024, 2, 1)), ("False", datetime(2024, 3, 1), None),
        ("True", datetime(2024, 2, 1), datetime(2024, 3, 1))]


def test_timestamp_strategy_keeps_microseconds(spark, pub):
    shape = "id int, name string, updated timestamp_ntz"
    a, b = datetime(2024, 1, 1, 0, 0, 0, 123456), datetime(2024, 1, 1, 0, 0, 0, 123457)
    spec = HistorySpec("id", strategy="timestamp", updated_at="updated", hard_deletes="invalidate")
    run_history(pub, "snap", spark.createDataFrame([(1, "x", a), (2, "y", a)], shape), spec, T0)
    out = run_history(pub, "snap", spark.createDataFrame([(1, "z", b), (2, "changed unseen", a), (3, "n", a)], shape), spec, T1)
    assert rows(out.select("id", "name", "valid_from", "valid_to")) == [
        (1, "x", a, b), (1, "z", b, None), (2, "y", a, None), (3, "n", a, None)]


@pytest.mark.parametrize("bad, found", [
    ([(1, "x", None)], "null_updated_at"), ([(1, "x", datetime(2023, 1, 1))], "regressed_updated_at")])
def test_bad_update_times_are_refused(spark, pub, bad, found):
    shape = "id int, name string, updated timestamp_ntz"
    spec = HistorySpec("id", strategy="timestamp", updated_at="updated")
    run_history(pub, "snap", spark.createDataFrame([(1, "x", datetime(2024, 1, 1))], shape), spec, T0)
    before = rows(pub.read("snap"))
    with pytest.raises(ViolationError, match=found):
        run_history(pub, "snap", spark.createDataFrame(bad, shape), spec, T1)
    assert rows(pub.read("snap")) == before


@pytest.mark.parametrize("bad, found", [([(1, "a"), (1, "b")], "duplicate_keys"), ([(None, "a")], "null_keys")])
def test_bad_keys_are_refused(spark, pub, bad, found):
    spec = HistorySpec("id")
    run_history(pub, "snap", spark.createDataFrame([(1, "x")], "id int, value string"), spec, T0)
    before = rows(pub.read("snap"))
    with pytest.raises(ViolationError, match=found):
        run_history(pub, "snap", spark.createDataFrame(bad, "id int, value string"), spec, T1)
    assert rows(pub.read("snap")) == before


def test_composite_key_renamed_metadata_and_sentinel(spark, pub):
    shape = "tenant_id int, id int, name string, score int"
    spec = HistorySpec(("tenant_id", "id"), current_sentinel="2099-12-31 00:00:00",
                       names=MetaNames("vkey", "changed", "since", "until"))
    run_history(pub, "snap", spark.createDataFrame([(1, 1, "a", 1), (1, 2, "b", 2)], shape), spec, T0)
    out = run_history(pub, "snap", spark.createDataFrame([(1, 1, "a", 9), (1, 2, "b", 2)], shape), spec, T1)
    assert out.columns == ["tenant_id", "id", "name", "score", "vkey", "changed", "since", "until"]
    far = datetime(2099, 12, 31)
    assert rows(out.select("id", "score", "until")) == [(1, 1, datetime(2024, 2, 1)), (1, 9, far), (2, 2, far)]


def test_new_columns_extend_history(pub, t0):
    spec = HistorySpec("id")
    run_history(pub, "snap", t0, spec, T0)
    wider = t0.withColumn("email", F.concat("name", F.lit("@x"))).withColumn("region", F.lit("EU"))
    out = run_history(pub, "snap", wider, spec, T1)
    assert rows(out.where("id = 1").select("email", "region", "valid_to")) == [
        ("alice@x", "EU", None), (None, None, datetime(2024, 2, 1))]
    assert run_history(pub, "snap", wider, spec, T2).count() == 4


def test_removed_or_retyped_columns_are_refused(pub, t0):
    spec = HistorySpec("id")
    run_history(pub, "snap", t0, spec, T0)
    with pytest.raises(SchemaChangeError, match="removed"):
        run_history(pub, "snap", t0.drop("score"), spec, T1)
    with pytest.raises(SchemaChangeError, match="type"):
        run_history(pub, "snap", t0.withColumn("score", F.col("score").cast("string")), spec, T1)
    assert pub.read("snap").count() == 2


def test_failure_before_publishing_keeps_old_history_and_retry_works(pub, t0, t1):
    spec = HistorySpec("id", hard_deletes="invalidate")
    run_history(pub, "snap", t0, spec, T0)
    before = rows(pub.read("snap"))

    def fail():
        raise RuntimeError("switch failed")

    with pytest.raises(RuntimeError, match="switch failed"):
        run_history(pub, "snap", t1, spec, T1, before_publish=fail)
    assert rows(pub.read("snap")) == before
    assert run_history(pub, "snap", t1, spec, T1).count() == 4


def test_change_set_applied_equals_one_step(t0, t1):
    for mode in h.DELETE_MODES:
        spec = HistorySpec("id", hard_deletes=mode)
        first = h.initial_history(t0, spec, T0)
        changes = h.change_set(first, t1, spec, T1)
        assert rows(h.apply_changes(first, changes, spec)) == rows(h.advance(first, t1, spec, T1))


def test_null_values_are_compared_null_safely(spark):
    spec = HistorySpec("id", check_cols=("v",))
    a = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "id int, v string")
    b = spark.createDataFrame([(1, None), (2, None), (3, "y")], "id int, v string")
    out = h.advance(h.initial_history(a, spec, T0), b, spec, T1)
    assert sorted(r.id for r in out.where("valid_to IS NOT NULL").collect()) == [2, 3]


def test_result_validation_counts(spark):
    spec = HistorySpec("id")
    shape = "id int, scd_id string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    d1, d2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    bad = spark.createDataFrame(
        [(1, "a", d1, None), (1, "b", d1, None), (2, "c", d2, d1), (3, None, d1, d1), (4, "d", None, d2), (5, "d", d1, d1)], shape)
    assert h.history_violations(bad, spec).first().asDict() == {
        "null_ids": 1, "null_valid_from": 1, "invalid_windows": 1, "duplicate_ids": 1, "duplicate_current": 1}
    empty = h.history_violations(bad.limit(0), spec).first().asDict()
    assert set(empty.values()) == {0}


@pytest.mark.parametrize("mode", h.DELETE_MODES)
def test_touched_keys_give_the_same_history(spark, t0, t1, mode):
    extra = [F.lit(i).alias(f"c{i}") for i in range(3)]
    a, b = t0.select("*", *extra), t1.select("*", *extra).unionByName(t0.where("id = 2").select("*", *extra).limit(0))
    spec = HistorySpec("id", check_cols=("score",), hard_deletes=mode)
    current = h.initial_history(a, spec, T0)
    assert h.compares_few_columns(current, b, spec)
    touched = h.touched_keys(current, b, spec, T1)
    assert sorted(r.id for r in touched.collect()) == ([1, 3] if mode == "ignore" else [1, 2, 3])
    assert rows(h.advance_touched(current, b, touched, spec, T1)) == rows(h.advance_current(current, b, spec, T1))
