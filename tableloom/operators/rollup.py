"""Stored aggregates and their refresh."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.hashing import multiset_digest
from tableloom.functions.names import as_columns, as_list, col, same_keys
from tableloom.operators.incremental import anti_by_keys

Model = Callable[[DataFrame], DataFrame]


def aggregate(df: DataFrame, by: Mapping[str, Column | str], measures: Mapping[str, Column | str]) -> DataFrame:
    """Grouped aggregate with named keys and measures; Spark combines on the map side."""
    return df.groupBy(*[e.alias(n) for n, e in as_columns(by).items()]).agg(*[e.alias(n) for n, e in as_columns(measures).items()])


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of several sources, columns matched by name."""
    first, *rest = sources
    for df in rest:
        first = first.unionByName(df.select(*[col(c) for c in first.columns]))
    return first


def empty_like(df: DataFrame) -> DataFrame:
    """The schema with no rows. Spark plans this as an empty relation and reads nothing."""
    return df.limit(0)


@dataclass(frozen=True)
class Mergeable:
    """A grouped aggregate whose state is its own result, so that two parts of a base can be aggregated apart and put together.

    ``by`` names the keys and ``measures`` the aggregates: a kind (sum, count, min or max) and what it is of. Called on rows it aggregates
    them, so it is a model like any other; ``merge`` puts results together. An average is kept as a sum and a count.
    """

    by: Mapping[str, Column | str]
    measures: Mapping[str, tuple[str, Column | str]]

    # The kinds, each with how its results are put together.
    KINDS = {"sum": "sum", "count": "sum", "min": "min", "max": "max"}

    def __post_init__(self):
        unknown = sorted({kind for kind, _ in self.measures.values()} - set(self.KINDS))
        if unknown:
            raise ValueError(f"aggregates {unknown} cannot be merged; use {sorted(self.KINDS)}")

    def __call__(self, rows: DataFrame) -> DataFrame:
        return aggregate(rows, self.by, {n: getattr(F, kind)(F.expr(e) if isinstance(e, str) else e) for n, (kind, e) in self.measures.items()})

    def merge(self, results: DataFrame) -> DataFrame:
        kinds = {n: results.schema[n].dataType for n in self.measures}
        merged = aggregate(results, {n: col(n) for n in self.by}, {n: getattr(F, self.KINDS[kind])(col(n)).cast(kinds[n]) for n, (kind, _) in self.measures.items()})
        return merged.select(*[col(c) for c in results.columns])


def definition_digest(model: Model, base: DataFrame) -> str:
    """A digest of what a model does to rows of this shape: the plan it makes of an empty table, without ids and session values.

    Equal in every session, and whatever the base is read from. The body of a Python function is not part of a plan, and
    neither are tables the model reads besides its base, but for their names.
    """
    spark = base.sparkSession
    plan = json.loads(model(spark.createDataFrame([], base.schema))._jdf.queryExecution().analyzed().toJSON())
    ids: dict[int, int] = {}

    def plain(node):
        if isinstance(node, list):
            return [plain(n) for n in node]
        if not isinstance(node, dict):
            return node
        if str(node.get("product-class", "")).endswith(".ExprId"):
            return ids.setdefault(node["id"], len(ids))
        # lambda variables are numbered as a session makes them; their ids tell them apart
        drop = {"jvmId", "metadata", "nonInheritableMetadataKeys", "qualifier", *(["name"] if node.get("class", "").endswith("NamedLambdaVariable") else [])}
        return {k: plain(v) for k, v in node.items() if k not in drop}

    return hashlib.sha256(json.dumps(plain(plan)).encode()).hexdigest()


def _flagged(value: Column, kind: T.DataType) -> Column:
    """A value as something whose hash tells all values apart: hashes skip nulls, and say nothing of sizes."""
    if isinstance(kind, T.StructType):
        return F.struct(F.isnull(value), *[_flagged(value.getField(f.name), f.dataType) for f in kind])
    if isinstance(kind, T.ArrayType):
        return F.struct(F.isnull(value), F.size(value), F.transform(value, lambda x: _flagged(x, kind.elementType)))
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return _flagged(F.array_sort(F.map_entries(value)), T.ArrayType(entry))
    return F.struct(F.isnull(value), value)


def _hashable(f: T.StructField) -> Column:
    """A column as something whose hash tells all its values apart; nested values by their parts, maps in key order."""
    return _flagged(col(f.name), f.dataType) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else col(f.name)


def fingerprints(df: DataFrame, partition: Mapping[str, Column | str]) -> DataFrame:
    """Row count and content digest per partition, in one scan and one small shuffle."""
    aggs = multiset_digest(*[_hashable(f) for f in df.schema])
    return df.groupBy(*[e.alias(n) for n, e in as_columns(partition).items()]).agg(*[e.alias(n) for n, e in aggs.items()])


#: A file's name, size and modification time: what tells a changed file.
FILE = ("file", "file_bytes", "file_modified")

#: Changed files that a scan is confined to by name; a scan after more changes reads the partition columns of all files.
FILES_BY_NAME = 2_000


def file_list(base: DataFrame) -> DataFrame:
    """The files of a file-backed table. No column is read."""
    meta = ("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return base.select(*[F.col(m).alias(n) for m, n in zip(meta, FILE)]).distinct()


def in_files(base: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of the listed files, which need only be opened if they are not too many to be named."""
    names = [r[0] for r in files.select(FILE[0]).distinct().limit(FILES_BY_NAME + 1).collect()]
    return base.where(F.col("_metadata.file_path").isin(names)) if len(names) <= FILES_BY_NAME else base


def file_partitions(base: DataFrame, partition: Mapping[str, Column | str], files: DataFrame | None = None) -> DataFrame:
    """Which partitions each file has rows of: a row for each pair. Only the partition columns are read, of the listed files if any are."""
    rows = base if files is None else in_files(base, files)
    meta = ("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    pairs = rows.select(*[F.col(m).alias(n) for m, n in zip(meta, FILE)], *[e.alias(n) for n, e in as_columns(partition).items()]).distinct()
    return pairs if files is None else pairs.join(files.select(FILE[0]).distinct(), FILE[0], "left_semi").select(pairs.columns)


def changed_files(before: DataFrame, base: DataFrame, partition: Mapping[str, Column | str]) -> tuple[DataFrame, DataFrame]:
    """From the pairs of `file_partitions` before and the base now: the pairs of new and rewritten files, and those of files that are gone or rewritten."""
    now = file_list(base)
    new = file_partitions(base, partition, now.join(before.select(*FILE).distinct(), list(FILE), "left_anti"))
    return new, before.join(now, list(FILE), "left_anti")


def stale_partitions(before: DataFrame, after: DataFrame, partition: Sequence[str] | str) -> DataFrame:
    """Partitions that are new, gone or different."""
    names = as_list(partition)
    digests = [c for c in before.columns if c not in names]
    same = F.lit(True)
    for c in digests:
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
    return (
        before.alias("b")
        .join(after.alias("a"), same_keys("b", "a", names), "full")
        .where(~same)
        .select(*[F.coalesce(F.col(f"a.{n}"), F.col(f"b.{n}")).alias(n) for n in names])
    )


def only_partitions(df: DataFrame, stale: DataFrame, partition: Mapping[str, Column | str]) -> DataFrame:
    """Rows in the listed partitions."""
    on = F.lit(True)
    for n, e in as_columns(partition).items():
        on = on & e.eqNullSafe(F.col(f"stale_{n}"))
    keys = stale.select(*[F.col(n).alias(f"stale_{n}") for n in partition])
    return df.join(keys, on, "left_semi")


def refresh_partitions(
    stored: DataFrame, base: DataFrame, model: Model, stale: DataFrame, partition: Mapping[str, Column | str]
) -> DataFrame:
    """Recompute the stale partitions from the base, keep the stored rows of all others.

    ``partition`` names the columns of the stored aggregate and how the base computes them.
    """
    kept = anti_by_keys(stored, stale, list(partition))
    return kept.unionByName(model(only_partitions(base, stale, partition)).select(*[col(c) for c in stored.columns]))
