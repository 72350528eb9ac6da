"""Key checks that stop a write before any row is published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.functions.names import as_list, col, fresh_name, others, resolve, same_keys


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str, count_name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their counts. Nulls group together."""
    keys = resolve(df, as_list(keys))
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(count_name)).where(col(count_name) > 1)


def with_key_count(df: DataFrame, keys: Sequence[str] | str, count_name: str = "n") -> DataFrame:
    """Every row with the number of rows that share its key.

    Counts are folded on the map side and joined back, where a windowed count would put all rows of
    a hot key into one task. In the join such a key sits on the side adaptive execution can split.
    """
    keys = resolve(df, as_list(keys))
    counts = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(count_name))
    joined = df.alias("r").join(counts.alias("c"), same_keys("r", "c", keys))
    return joined.select("r.*", F.col(f"c.{count_name}"))


def require_unique(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """The same rows, in a plan that fails as soon as it meets a repeated key.

    The source is read once. Counting is a grouped aggregate rather than a window, so copies of a
    hot key are folded on the map side and no task ever holds them all. The check is a filter
    because an unused projection would be pruned.
    """
    keys = resolve(df, as_list(keys))
    if not keys:
        raise ValueError("a uniqueness guard needs at least one key column")
    rest = others(df, keys)
    n = fresh_name(df.columns, "key_count")
    row = fresh_name([*df.columns, n], "row_values")
    aggs = [F.count(F.lit(1)).alias(n)]
    if rest:
        aggs.append(F.any_value(F.struct(*[col(c) for c in rest])).alias(row))
    grouped = df.groupBy(*[col(k) for k in keys]).agg(*aggs)
    described = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(col(k).cast("string"), F.lit("null"))) for k in keys])
    checked = grouped.where(
        F.when(col(n) > 1, F.raise_error(F.concat(F.lit("duplicate key in batch: "), described)).cast("boolean"))
        .otherwise(True)
    )
    keyed = {k.lower() for k in keys}
    return checked.select(
        *[col(c) if c.lower() in keyed else col(row).getField(c).alias(c) for c in df.columns]
    )


def repeated_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """One row: how many keys occur more than once."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("repeated"))


def fail_if_repeated(df: DataFrame, keys: Sequence[str] | str, within: DataFrame | None = None) -> DataFrame:
    """The same rows, behind a scalar subquery that fails if any key repeats in them, or in ``within``.

    Only the key columns are shuffled, and folded first, while the rows themselves stay where they
    are. The source is read twice, so it must be frozen or deterministic; see ``require_unique`` for
    one that is not.
    """
    n = F.col("repeated")
    message = F.concat(F.lit("duplicate key in batch: "), n.cast("string"), F.lit(" keys repeat"))
    verdict = repeated_keys(df if within is None else within, keys).select(
        F.when(n > 0, F.raise_error(message).cast("boolean")).otherwise(True).alias("is_unique")
    )
    return df.where(verdict.scalar())


class DuplicateKeyError(ValueError):
    """A batch or table holds a key more than once; nothing has been published."""


def assert_unique(df: DataFrame, keys: Sequence[str] | str) -> None:
    """Run the check on rows that are already written, reading their key columns only."""
    repeated = repeated_keys(df, keys).first()["repeated"]
    if repeated:
        raise DuplicateKeyError(f"duplicate key: {repeated} values of {as_list(keys)} repeat")


def reject_rows(df: DataFrame, bad, message: str) -> DataFrame:
    """The same rows, failing on the first one for which ``bad`` holds."""
    return df.where(
        F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(message)).cast("boolean")).otherwise(True)
    )
