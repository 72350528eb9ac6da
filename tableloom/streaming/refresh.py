"""Refresh on commit: new files in a base folder trigger the refresh of what they touch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tableloom.functions.names import as_columns, col
from tableloom.functions.timing import Calendar
from tableloom.operators.incremental import within_partitions
from tableloom.operators.rollup import Mergeable, Model
from tableloom.plans.publish import Publisher
from tableloom.plans.rollup_run import DefinitionChanged, RollupConfig, rewrite_partitions

Partition = Mapping[str, Column | str | Calendar]


def _require_definition(publisher: Publisher, table: str, base: DataFrame, model: Model, partition: Partition, definition: str) -> None:
    """A stream only adds to an aggregate that is stored by its own model; one of an unknown or another definition is rebuilt first."""
    publisher.require_model(table, "rollup")
    if not publisher.exists(table):
        raise ValueError(f"{table} has not been built; a deferred build will do")
    if publisher.property(table, "definition") != RollupConfig(partition=partition, definition=definition).defined(base, model):
        raise DefinitionChanged(f"{table} is stored by another definition than the stream's; rebuild it")


def _start(publisher: Publisher, base_path, base_schema, handle: Callable[[DataFrame, int], None], checkpoint, trigger, read_options) -> StreamingQuery:
    stream = publisher.spark.readStream.schema(base_schema).options(**(read_options or {})).parquet(base_path)
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def merge_on_commit(
    publisher: Publisher,
    table: str,
    base_path: str,
    base_schema: T.StructType,
    model: Mergeable,
    partition: Partition,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    read_options: Mapping[str, str] | None = None,
    definition: str = "",
) -> StreamingQuery:
    """Start the stream that adds new files under ``base_path`` to ``table``, reading nothing else of the base.

    Each micro-batch is aggregated by itself and put together with the stored partitions it touches; late rows thus land in the
    partitions they belong to. The number of the last batch is published in the same step as its rows, so a batch delivered
    twice counts once. Files that are rewritten or removed are not seen: `refresh_on_commit` is for those, and for aggregates that
    cannot be merged. The table must hold what this very stream put there, so it starts from a deferred build.
    """
    names = list(partition)
    if not set(names) <= set(model.by):
        raise ValueError(f"the partition columns {names} are not all among the keys {list(model.by)}")
    _require_definition(publisher, table, publisher.spark.read.schema(base_schema).parquet(base_path), model, partition, definition)
    stream = publisher.property(table, "commits_of")
    if stream != checkpoint and (stream or not publisher.read(table).isEmpty()):
        raise ValueError(f"{table} holds rows that this stream did not put there; build it deferred, with a checkpoint of its own")

    def handle(batch: DataFrame, number: int) -> None:
        last = publisher.property(table, "last_commit")
        if last is not None and number <= int(last):
            return
        with publisher.stage(table, model(batch)) as fresh:
            stored = within_partitions(publisher.stored(table), fresh.select(*[col(n) for n in names]).distinct(), names)
            merged = model.merge(stored.unionByName(fresh))
            publisher.overwrite_partitions(table, merged, properties={"commits_of": checkpoint, "last_commit": number})

    return _start(publisher, base_path, base_schema, handle, checkpoint, trigger, read_options)


def refresh_on_commit(
    publisher: Publisher,
    table: str,
    base_path: str,
    base_schema: T.StructType,
    model: Model,
    partition: Partition,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    read_options: Mapping[str, str] | None = None,
    definition: str = "",
) -> StreamingQuery:
    """Start the stream that keeps ``table`` in step with the files under ``base_path``, for any aggregate.

    Each micro-batch only says which partitions it touches; those are recomputed from the whole base. Late rows are thus folded into
    the windows they belong to, any aggregate works, and a micro-batch delivered twice gives the same table. The default
    trigger handles what is there and stops; without new files it does nothing.
    """
    spark = publisher.spark
    _require_definition(publisher, table, spark.read.schema(base_schema).parquet(base_path), model, partition, definition)

    def handle(batch: DataFrame, _number: int) -> None:
        touched = batch.select(*[e.alias(n) for n, e in as_columns(partition).items()])
        base = spark.read.schema(base_schema).parquet(base_path)
        rewrite_partitions(publisher, table, base, model, partition, touched)

    return _start(publisher, base_path, base_schema, handle, checkpoint, trigger, read_options)
