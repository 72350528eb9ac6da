"""What the target holds after one incremental run.

Every function takes the stored rows and the batch and returns the new rows. None of them writes.
Where a batch feeds two branches of a plan, pass a frozen one (``session.freeze``) unless its query
is deterministic.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.names import as_columns, as_list, col, fresh_name, others, quoted, resolve, same_keys
from tableloom.functions.timing import in_window, ntz, windows_between
from tableloom.operators.guards import fail_if_repeated, reject_rows


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows plus the batch, columns matched by name."""
    return target.unionByName(batch.select(*[col(c) for c in target.columns]))


def anti_by_keys(rows: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with no null-safe key match. ``keyed`` should be unique by key.

    The join is left to Spark: a small key set is broadcast and ``rows`` is not shuffled at all; a
    large one is shuffled, and adaptive execution splits a hot key on the ``rows`` side.
    """
    return rows.alias("r").join(
        keyed.select(*[col(k) for k in keys]).alias("k"), same_keys("r", "k", keys), "left_anti"
    )


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str] | str, guard: bool = True) -> DataFrame:
    """Whole-row upsert: batch rows win, stored rows with other keys stay."""
    keys = resolve(target, as_list(keys))
    batch = batch.select(*[col(c) for c in target.columns])
    if guard:
        return anti_by_keys(target, batch, keys).unionByName(fail_if_repeated(batch, keys))
    return anti_by_keys(target, batch, keys).unionByName(batch)


def sequence_winners(
    target: DataFrame, batch: DataFrame, keys: Sequence[str] | str, sequence: str
) -> DataFrame:
    """The batch rows that may replace what is stored: those without a higher stored sequence.

    Equal sequences let the batch row win; a null sequence is lower than any other. Only the key and
    sequence columns of the target are read, and a small batch leaves them unshuffled.
    """
    keys = resolve(target, as_list(keys))
    (sequence,) = resolve(target, [sequence])
    wanted = [*keys, sequence] if sequence not in keys else list(keys)
    stored, incoming = F.col(f"t.{quoted(sequence)}"), F.col(f"b.{quoted(sequence)}")
    stale = (
        target.select(*[col(c) for c in wanted])
        .alias("t")
        .join(batch.select(*[col(c) for c in wanted]).alias("b"), same_keys("t", "b", keys))
        .where((stored > incoming) | (stored.isNotNull() & incoming.isNull()))
        .select(*[F.col(f"b.{quoted(k)}").alias(k) for k in keys])
    )
    return anti_by_keys(batch.select(*[col(c) for c in target.columns]), stale, keys)


def upsert_sequenced(
    target: DataFrame, batch: DataFrame, keys: Sequence[str] | str, sequence: str, guard: bool = True
) -> DataFrame:
    """Upsert in which a row with a lower sequence than the stored one does not replace it.

    Repeated keys are refused before sequences are looked at.
    """
    keys = resolve(target, as_list(keys))
    winners = sequence_winners(target, batch, keys, sequence)
    kept = anti_by_keys(target, winners, keys)
    return kept.unionByName(fail_if_repeated(winners, keys, within=batch) if guard else winners)


def within_partitions(rows: DataFrame, touched: DataFrame, partition: Mapping[str, Column | str] | Sequence[str]) -> DataFrame:
    """Rows in the listed partitions, however many there are. Null is a partition of its own.

    ``partition`` names the columns of ``touched`` and how ``rows`` computes them. Rows without a null in them are found by plain
    equality, which lets Spark prune a partitioned scan by the list at run time. It does so for lists that pass a selective
    filter only, hence a comparison that always holds. Rows with a null are few partitions, and compared null-safely.
    """
    exprs = as_columns(partition) if isinstance(partition, Mapping) else {p: col(p) for p in partition}
    names = list(exprs)
    any_null = reduce(lambda a, b: a | b, [e.isNull() for e in exprs.values()])
    listed = [F.col(f"touched_{i}") for i in range(len(names))]
    keys = touched.select(*[col(n).alias(f"touched_{i}") for i, n in enumerate(names)]).where(F.xxhash64(*listed) >= F.lit(-(2**63)))
    plain = rows.where(~any_null).join(keys, all_of([e == k for e, k in zip(exprs.values(), listed)]), "left_semi")
    nulls = rows.where(any_null).join(keys.where(reduce(lambda a, b: a | b, [k.isNull() for k in listed])), all_of([e.eqNullSafe(k) for e, k in zip(exprs.values(), listed)]), "left_semi")
    return plain.unionByName(nulls)


def latest_by_key(log: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """One row per key: the greatest by ``order``, ties going to the later order column.

    ``max_by`` combines on the map side, so a key that fills a third of the log still sends one row
    per map task.
    """
    keys, order = resolve(log, as_list(keys)), resolve(log, as_list(order))
    row = fresh_name(log.columns, "latest")
    latest = F.max_by(F.struct(*[col(c) for c in others(log, keys)]), F.struct(*[col(c) for c in order]))
    keyed = {k.lower() for k in keys}
    return (
        log.groupBy(*[col(k) for k in keys])
        .agg(latest.alias(row))
        .select(*[col(c) if c.lower() in keyed else col(row).getField(c).alias(c) for c in log.columns])
    )


def overwrite(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch, in the target's column order."""
    return batch.select(*[col(c) for c in target.columns])


def overwrite_partitions(target: DataFrame, batch: DataFrame, partition: Column, values: Sequence) -> DataFrame:
    """Replace the named partitions, with nothing if the batch has no row for them.

    ``partition`` is an expression both sides can evaluate. A batch row outside the named
    partitions stops the run.
    """
    if not values:
        raise ValueError("name at least one partition to overwrite")
    named = F.coalesce(partition.isin(list(values)), F.lit(False))
    batch = reject_rows(
        batch.select(*[col(c) for c in target.columns]), ~named, "batch row outside the partitions to overwrite"
    )
    return target.where(~named).unionByName(batch)


def overwrite_dynamic(target: DataFrame, batch: DataFrame, partition: Column) -> DataFrame:
    """Replace exactly the partitions the batch has rows for; an empty batch changes nothing."""
    batch = batch.select(*[col(c) for c in target.columns])
    key = fresh_name(target.columns, "partition_key")
    touched = batch.select(partition.alias(key)).distinct()
    kept = anti_by_keys(target.withColumn(key, partition), touched, [key]).drop(key)
    return kept.unionByName(batch)


def replace_window(
    target: DataFrame, batch: DataFrame, event_time: str, start: datetime, end: datetime
) -> DataFrame:
    """Microbatch: rows in ``[start, end)`` come from the batch, even if it has none.

    Rows with a null event time belong to no window, so stored ones stay. A batch row outside the
    window cannot be placed and stops the run.
    """
    at = col(event_time)
    # Spelled out rather than negated, so that both scans can skip row groups by their statistics.
    outside = (at < ntz(start)) | (at >= ntz(end)) | at.isNull()
    batch = reject_rows(
        batch.select(*[col(c) for c in target.columns]), outside, "batch row outside its event-time window"
    )
    return target.where(outside).unionByName(batch)


def backfill(
    target: DataFrame,
    source: DataFrame,
    event_time: str,
    start: datetime,
    end: datetime,
    unit: str,
) -> DataFrame:
    """Re-run every window that covers ``[start, end)`` from the source.

    Consecutive windows form one range and replacing each in turn gives the same rows as replacing
    the range, so the plan holds one scan per side however many windows there are.
    """
    windows = windows_between(start, end, unit)
    if not windows:
        return target
    lo, hi = windows[0][0], windows[-1][1]
    batch = source.where(in_window(col(event_time), lo, hi))
    return replace_window(target, batch, event_time, lo, hi)


Strategy = Callable[[DataFrame, DataFrame, list[str], list[str], list[Column]], DataFrame]


def custom(
    target: DataFrame,
    batch: DataFrame,
    strategy: Strategy,
    keys: Sequence[str] | str | None = None,
    predicates: Sequence[Column] = (),
) -> DataFrame:
    """Run a caller's strategy over the batch, columns matched by name."""
    result = strategy(target, batch, as_list(keys), list(target.columns), list(predicates))
    return result.select(*[col(c) for c in target.columns])


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))
