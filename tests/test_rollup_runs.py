"""Definitions told from plans, refreshes that open few files, commits that are merged."""

from __future__ import annotations

from datetime import date, datetime, timedelta
import subprocess
import sys

from conftest import rows
from pyspark.sql import functions as F
import pytest

from tableloom.functions.timing import Calendar
from tableloom.operators import rollup
from tableloom.plans.rollup_run import DefinitionChanged, RollupConfig, build_rollup, refresh_rollup
from tableloom.session import scratch_path
from tableloom.streaming.refresh import merge_on_commit, refresh_on_commit

SHAPE = "sold date, till string, pence int"
BY_YEAR = {"year": Calendar("sold", "year")}


def takings():
    return rollup.Mergeable(
        {"year": F.year("sold"), "till": "till"},
        {"pence": ("sum", "pence"), "n": ("count", "pence"), "least": ("min", "pence"), "most": ("max", "pence")},
    )


@pytest.fixture
def sales(spark):
    return spark.createDataFrame([(date(2019 + i % 5, 1 + i % 12, 1 + i % 28), "ab"[i % 2], 10 * i if i % 7 else None) for i in range(200)], SHAPE)


def test_a_changed_expression_is_found_without_a_stated_definition(pub, sales):
    config = RollupConfig(partition=BY_YEAR, on_definition_change="fail")
    build_rollup(pub, "t", sales, takings(), config)
    refresh_rollup(pub, "t", sales, takings(), config)
    before = rows(pub.read("t"))
    scaled = rollup.Mergeable(takings().by, takings().measures | {"pence": ("sum", F.col("pence") * 100)})
    with pytest.raises(DefinitionChanged):
        refresh_rollup(pub, "t", sales.limit(3), scaled, config)
    filtered = lambda base: takings()(base.where("pence > 20"))
    with pytest.raises(DefinitionChanged):
        refresh_rollup(pub, "t", sales, filtered, config)
    assert rows(pub.read("t")) == before


DIGEST = """
import sys
sys.path[:0] = [{root!r}]
from pyspark.sql import functions as F
from tableloom.session import local_session
from tableloom.operators.rollup import definition_digest
spark = local_session(1, 1)
for _ in range({warm}):
    spark.range(3).select(F.transform(F.array("id"), lambda v: v + 1)).collect()
base = spark.createDataFrame([(1, [2])], "k int, v array<int>")
print("digest", definition_digest(lambda df: df.groupBy("k").agg(F.sum(F.aggregate("v", F.lit(0), lambda a, x: a + x)).alias("s")), base))
"""


def test_a_definition_is_the_same_in_every_session():
    root = str(__import__("pathlib").Path(__file__).parents[1])
    found = {
        [line for line in subprocess.run([sys.executable, "-c", DIGEST.format(root=root, warm=warm)], capture_output=True, text=True, check=True).stdout.splitlines() if line.startswith("digest")][0]
        for warm in (0, 2)
    }
    assert len(found) == 1


def test_a_definition_does_not_depend_on_where_rows_come_from(spark, sales):
    path = scratch_path(spark, "sales")
    sales.write.parquet(path)
    digest = lambda base: rollup.definition_digest(takings(), base)
    assert digest(sales) == digest(spark.read.parquet(path)) == digest(sales.union(sales).where("pence IS NOT NULL").select(sales.columns))


def test_nested_values_a_microsecond_apart_have_other_fingerprints(spark):
    t = datetime(2024, 1, 1, 12)
    shape = "p int, s struct<at: timestamp_ntz, tags: array<array<int>>>, m map<string, timestamp_ntz>"

    def prints(at, tags, in_map):
        return rollup.fingerprints(spark.createDataFrame([(1, (at, tags), {"x": in_map, "w": t})], shape), {"p": "p"}).first()

    one = timedelta(microseconds=1)
    found = {tuple(prints(*v)) for v in [
        (t, [[1], [2]], t), (t + one, [[1], [2]], t), (t, [[1, 2]], t), (t, [[1], [2], []], t), (t, [[1], [2], None], t), (t, None, t), (None, [[1], [2]], t), (t, [[1], [2]], t + one),
    ]}
    assert len(found) == 8
    assert tuple(prints(t, [[1], [2]], t)) in found


def test_a_refresh_by_files_skips_what_did_not_change(spark, pub, sales):
    path = scratch_path(spark, "sales")
    sales.repartitionByRange(5, "sold").write.parquet(path)
    config = RollupConfig(partition=BY_YEAR, fingerprint="files")
    build_rollup(pub, "t", spark.read.parquet(path), takings(), config)
    late = spark.createDataFrame([(date(2020, 5, 5), "z", 7), (None, "z", 8)], SHAPE)
    late.coalesce(1).write.mode("append").parquet(path)

    plans = []

    def watched(base):
        plans.append((base._jdf.queryExecution().analyzed().toString(), base._jdf.queryExecution().executedPlan().toString()))
        return takings()(base)

    out = refresh_rollup(pub, "t", spark.read.parquet(path), watched, config)
    assert rows(out.select("year", "till", "pence", "n")) == rows(takings()(sales.union(late)).select("year", "till", "pence", "n"))
    named, plan = plans[-1]
    assert "GreaterThanOrEqual(sold,2020-01-01)" in plan and "LessThan(sold,2021-01-01)" in plan
    holding = {r[0].rsplit("/", 1)[1] for r in spark.read.parquet(path).where("year(sold) = 2020 OR sold IS NULL").select("_metadata.file_path").distinct().collect()}
    files = {f.rsplit("/", 1)[1] for f in spark.read.parquet(path).inputFiles()}
    assert {f for f in files if f in named} == holding < files

    same = pub.property("t", "live_table")
    refresh_rollup(pub, "t", spark.read.parquet(path), takings(), config)
    assert pub.property("t", "live_table") == same  # nothing changed, nothing was written

    rewritten = sales.where("year(sold) <> 2021").repartitionByRange(3, "sold")
    rewritten.write.mode("overwrite").parquet(path)
    out = refresh_rollup(pub, "t", spark.read.parquet(path), takings(), config)
    assert rows(out.select("year", "till", "pence", "n")) == rows(takings()(rewritten).select("year", "till", "pence", "n"))


@pytest.mark.parametrize("unit, kind", [("day", "date"), ("month", "timestamp_ntz"), ("year", "timestamp"), ("month", "date")])
def test_calendar_ranges_hold_all_rows_of_their_partitions(spark, unit, kind):
    rows_ = spark.range(3_000).select((F.lit("2019-12-30").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id") * 7)).cast(kind).alias("at"))
    part = Calendar("at", unit)
    values = [r[0] for r in rows_.select(part.expr).distinct().orderBy(part.expr).collect()]
    for least, greatest in ((values[0], values[0]), (values[1], values[2]), (values[-1], values[-1])):
        wanted = rows_.where((part.expr >= F.lit(least)) & (part.expr <= F.lit(greatest)))
        near = rows_.where(part.within(least, greatest, rows_.schema["at"].dataType))
        assert wanted.exceptAll(near).isEmpty() and near.count() <= wanted.count() + 8


def test_merged_commits_count_once_and_read_only_their_files(spark, pub, sales):
    base, offsets = scratch_path(spark, "base"), scratch_path(spark, "offsets")
    first, second = sales.where("till = 'a'"), sales.where("till = 'b' OR year(sold) = 2020")
    first.write.parquet(base)
    build_rollup(pub, "t", spark.read.parquet(base), takings(), RollupConfig(build="deferred", partition=BY_YEAR))
    merge_on_commit(pub, "t", base, sales.schema, takings(), BY_YEAR, offsets).awaitTermination()
    second.coalesce(1).write.mode("append").parquet(base)
    query = merge_on_commit(pub, "t", base, sales.schema, takings(), BY_YEAR, offsets)
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == second.count()  # and no row of the first commit
    want = rows(takings()(first.union(second)).select("year", "till", "pence", "n", "least", "most"))
    assert rows(pub.read("t").select("year", "till", "pence", "n", "least", "most")) == want
    # the same batch once more: its number is published with its rows
    assert pub.property("t", "last_commit") == "1"
    commits = f"{offsets}/commits/1"
    fs = spark._jvm.org.apache.hadoop.fs.Path(commits).getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.delete(spark._jvm.org.apache.hadoop.fs.Path(commits), False)
    merge_on_commit(pub, "t", base, sales.schema, takings(), BY_YEAR, offsets).awaitTermination()
    assert rows(pub.read("t").select("year", "till", "pence", "n", "least", "most")) == want


def test_streams_refuse_aggregates_that_are_not_theirs(spark, pub, sales):
    base = scratch_path(spark, "base")
    sales.write.parquet(base)
    stored, config = spark.read.parquet(base), RollupConfig(partition=BY_YEAR)
    with pytest.raises(ValueError, match="not been built"):
        merge_on_commit(pub, "t", base, sales.schema, takings(), BY_YEAR, scratch_path(spark, "offsets"))
    build_rollup(pub, "t", stored, takings(), config)
    with pytest.raises(ValueError, match="did not put there"):
        merge_on_commit(pub, "t", base, sales.schema, takings(), BY_YEAR, scratch_path(spark, "offsets"))
    doubled = rollup.Mergeable(takings().by, takings().measures | {"pence": ("sum", F.col("pence") * 2)})
    for stream in (merge_on_commit, refresh_on_commit):
        with pytest.raises(DefinitionChanged):
            stream(pub, "t", base, sales.schema, doubled, BY_YEAR, scratch_path(spark, "offsets"))
    with pytest.raises(ValueError, match="cannot be merged"):
        rollup.Mergeable({"k": "k"}, {"m": ("median", "v")})
