"""Merge on read: a run writes its batch and nothing else, reading finds the newest row per key.

Batches go to a log partitioned by batch number. The published view takes, per key, the row of the
highest sequence and then the latest committed batch. A run costs what its batch costs however
large the table is. The log has two levels: one row per key as of the last folding, and the batches since. All files are
bucketed by key, so a read groups each bucket where it lies, without a shuffle; ``FOLD_AFTER`` batches are folded into the
first level by the run that adds the last of them, and ``compact`` does so at any time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.functions.names import as_list, col, quoted, resolve
from tableloom.operators.guards import assert_unique
from tableloom.operators.layout import key_first
from tableloom.operators.schema import SchemaChangeError, align, check_protected
from tableloom.plans.publish import Publisher

BATCH = "batch_no"

#: Buckets of a log, unless its first run says otherwise, and the batches after which it is folded.
BUCKETS, FOLD_AFTER = 16, 20


def _latest(publisher: Publisher, version: str, keys: Sequence[str], sequence: str | None, last: int) -> str:
    """The view's query. One ``max_by`` per column lets a reader of few columns scan few columns,
    and filters on the key reach the log."""
    columns = [c for c in publisher.spark.table(publisher.name(version)).columns if c != BATCH]
    keyed = {k.lower() for k in keys}
    order = f"struct({quoted(sequence)}, {BATCH})" if sequence else BATCH
    shown = ", ".join(
        quoted(c) if c.lower() in keyed else f"max_by({quoted(c)}, {order}) AS {quoted(c)}" for c in columns
    )
    by = ", ".join(quoted(k) for k in keys)
    return f"SELECT {shown} FROM {publisher.name(version)} WHERE {BATCH} <= {last} GROUP BY {by}"


def _publish(publisher, table, version, keys, sequence, last: int) -> DataFrame:
    props = {"table_model": "merge_log", "unique_key": ",".join(keys), "sequence": sequence or "", "last_batch": last}
    publisher.switch(table, version, props, select=_latest(publisher, version, keys, sequence, last))
    return publisher.read(table)


def _rebuild(publisher, table, rows: DataFrame, keys, sequence, buckets: int | None = None) -> DataFrame:
    current = publisher.current_version(table)
    buckets = buckets or (publisher.buckets(current)[0] if current else 0) or BUCKETS
    labelled = key_first(rows, keys).withColumn(BATCH, F.lit(0))
    version = publisher.write_version(table, labelled.repartition(buckets, *[col(k) for k in keys]), partition_by=BATCH, bucket_by=(buckets, keys), gather=False)
    try:
        assert_unique(publisher.spark.table(publisher.name(version)), keys)
    except Exception:
        publisher.spark.sql(f"DROP TABLE IF EXISTS {publisher.name(version)}")
        raise
    return _publish(publisher, table, version, keys, sequence, 0)


def run_merge_log(
    publisher: Publisher,
    table: str,
    batch: DataFrame,
    keys: Sequence[str] | str,
    sequence: str | None = None,
    on_schema_change: str = "ignore",
    full_refresh: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Add one batch. It becomes visible when the view is replaced; a refused batch never does."""
    publisher.require_model(table, "merge_log", rebuild=full_refresh)
    keys = resolve(batch, as_list(keys))
    if BATCH in (c.lower() for c in batch.columns):
        raise SchemaChangeError(f"the column name {BATCH} is taken by the log")
    check_protected(batch.schema, batch.schema, keys, sequence)
    known = publisher.properties(table)
    last = known.get("last_batch")
    if full_refresh or not known:
        return _rebuild(publisher, table, batch, keys, sequence, buckets)
    if known.get("unique_key", "").lower() != ",".join(keys).lower():
        raise SchemaChangeError(f"{table} is stored with another key; rebuild it")
    if known.get("sequence", "").lower() != (sequence or "").lower():
        raise SchemaChangeError(f"{table} is stored with another sequence column; rebuild it")
    log = publisher.stored(table)
    check_protected(log.schema, batch.schema, keys, sequence)
    stored, aligned = align(log.drop(BATCH), batch, on_schema_change)
    if stored.schema != log.drop(BATCH).schema:
        # A changed schema rewrites the log once; the batch then goes on top as usual.
        current, _ = align(publisher.read(table), batch, on_schema_change)
        _rebuild(publisher, table, current, keys, sequence)
        last = 0
    version, run = publisher.current_version(table), int(last) + 1
    # A failed earlier attempt at this batch number was never visible and is replaced here.
    publisher.drop_partition(table, **{BATCH: run})
    publisher.insert(version, aligned.withColumn(BATCH, F.lit(run)))
    try:
        assert_unique(publisher.stored(table).where(col(BATCH) == run), keys)
    except Exception:
        publisher.drop_partition(table, **{BATCH: run})
        raise
    out = _publish(publisher, table, version, keys, sequence, run)
    return compact(publisher, table) if run >= FOLD_AFTER else out


def compact(publisher: Publisher, table: str) -> DataFrame:
    """Rewrite the log as one row per key. Readers see the same rows before and after."""
    known = publisher.properties(table)
    keys, sequence = known["unique_key"].split(","), known["sequence"] or None
    return _rebuild(publisher, table, publisher.read(table), keys, sequence)
