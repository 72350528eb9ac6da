"""Column order, partition labels and buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.names import as_list, col, others, resolve

DEFAULT_BUCKETS = 10  # fixed value: buckets per table where none are given


def key_first(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Key columns in key order, then the rest in their own order."""
    keys = resolve(df, as_list(keys))
    return df.select(*[col(c) for c in [*keys, *others(df, keys)]])


def range_label(value: Column, bounds: Sequence[tuple[str, object]]) -> Column:
    """The partition whose exclusive upper bound is the first above ``value``, else null.

    ``bounds`` are (name, upper bound) in ascending order. Comparisons form a balanced tree, so a
    table with hundreds of partitions costs under ten comparisons per row and no join. A null value
    sorts below every bound, as in range-partitioned tables, and takes the first partition.
    """
    if not bounds:
        raise ValueError("range partitioning needs at least one bound")

    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(bounds[lo][0]) if lo < len(bounds) else F.lit(None).cast("string")
        mid = (lo + hi) // 2
        return F.when(value < F.lit(bounds[mid][1]), pick(lo, mid)).otherwise(pick(mid + 1, hi))

    return F.when(value.isNull(), F.lit(bounds[0][0])).otherwise(pick(0, len(bounds)))


def list_label(value: Column, lists: Mapping[str, Sequence]) -> Column:
    """The partition whose value list holds ``value``, else null."""
    label = F.lit(None).cast("string")
    for name, members in reversed(list(lists.items())):
        label = F.when(value.isin(list(members)), F.lit(name)).otherwise(label)
    return label


def assign_partition(df: DataFrame, label: Column, name: str = "partition_name") -> DataFrame:
    """Rows that have a partition, labelled."""
    return df.withColumn(name, label).where(col(name).isNotNull())


def partition_rejects(df: DataFrame, label: Column) -> DataFrame:
    """Rows that no partition accepts."""
    return df.where(label.isNull())


def bucket_of(keys: Sequence[str] | str, buckets: int = DEFAULT_BUCKETS) -> Column:
    """The bucket Spark's own bucketed tables would place a row in."""
    return F.pmod(F.hash(*[col(k) for k in as_list(keys)]), F.lit(buckets))


def bucket_counts(df: DataFrame, bucket: Column) -> DataFrame:
    """Rows per bucket: the evidence on whether a distribution key is skewed."""
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"))
