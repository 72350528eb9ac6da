"""Data tests. Each returns the failing rows; none means the test passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.names import as_list, col, fresh_name, quoted, resolve, same_keys


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    (column,) = resolve(df, [column])
    return (
        df.where(col(column).isNotNull())
        .groupBy(col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the set, with their row counts. Null is not a value and passes."""
    return (
        df.where(~col(column).isin(list(values)))
        .groupBy(col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child keys with no parent, one row per child row.

    A left anti join: parents need not be distinct, and a hot child key sits on the side that
    adaptive execution can split.
    """
    keys = child.where(col(column).isNotNull()).select(col(column).alias("from_field"))
    known = parent.where(col(parent_column).isNotNull()).select(col(parent_column).alias("to_field"))
    return keys.join(known, F.col("from_field") == F.col("to_field"), "left_anti")


def multi_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row of violation counts from one scan."""
    return df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in checks.items()])


def bag_difference(a: DataFrame, b: DataFrame, side: str = "side", copies: str = "copies") -> DataFrame:
    """Rows that occur more often on one side, with that side and the surplus.

    One shuffle for both directions: rows are tagged +1 or -1, folded per distinct row on the map
    side, and only those with a non-zero balance remain. Two empty results of EXCEPT ALL would read
    and shuffle both inputs twice.
    """
    sign = fresh_name(a.columns, "balance")
    both = a.withColumn(sign, F.lit(1)).unionByName(b.withColumn(sign, F.lit(-1)))
    balanced = both.groupBy(*[col(c) for c in a.columns]).agg(F.sum(col(sign)).alias(sign)).where(col(sign) != 0)
    return balanced.select(
        *[col(c) for c in a.columns],
        F.when(col(sign) > 0, "a").otherwise("b").alias(side),
        F.abs(col(sign)).alias(copies),
    )


def keyed_difference(a: DataFrame, b: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Keys whose rows differ between two versions: only_a, only_b or changed, with the columns that differ.

    Both versions must have the same columns, and a key at most one row in each; a repeated key stops the job. Rows of a key
    are folded on the map side first, so a key of very many rows is found out before anything is joined.
    """
    keys = resolve(a, as_list(keys))
    keyed = {k.lower() for k in keys}
    odd = {c.lower() for c in a.columns} ^ {c.lower() for c in b.columns}
    if odd:
        raise ValueError(f"columns {sorted(odd)} are in one version only")
    rest = [c for c in a.columns if c.lower() not in keyed]
    row = fresh_name(a.columns, "version_row")

    def once(df: DataFrame, side: str) -> DataFrame:
        folded = df.groupBy(*[col(k) for k in keys]).agg(
            F.first(F.struct(F.lit(True).alias("there"), *[col(c) for c in rest])).alias(row), F.count(F.lit(1)).alias(f"{row}_n")
        )
        repeated = F.raise_error(F.lit(f"a key has several rows in version {side}"))
        return folded.select(*[col(k) for k in keys], F.when(col(f"{row}_n") == 1, col(row)).otherwise(repeated.cast(folded.schema[row].dataType)).alias(row))

    old, new = (F.col(f"{side}.{quoted(row)}") for side in "ab")
    differing = F.concat_ws(",", *[F.when(~old[c].eqNullSafe(new[c]), F.lit(c)) for c in rest])
    change = F.when(new.isNull(), "only_a").when(old.isNull(), "only_b").otherwise("changed")
    return (
        once(a, "a").alias("a").join(once(b, "b").alias("b"), same_keys("a", "b", keys), "full")
        .select(
            *[F.coalesce(F.col(f"a.{quoted(k)}"), F.col(f"b.{quoted(k)}")).alias(k) for k in keys],
            change.alias("change"),
            F.when(change == "changed", differing).alias("columns_changed"),
        )
        .where("change <> 'changed' OR columns_changed <> ''")
    )
