"""Microbatch windows kept in step with a folder of event files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tableloom.functions.names import col
from tableloom.functions.timing import Calendar, add_interval, check_unit, window_start
from tableloom.operators.incremental import within_partitions
from tableloom.plans.incremental_run import WINDOW_COLUMN, ConfigError, IncrementalConfig, label_windows, stored_properties, window_label
from tableloom.plans.publish import Publisher


def replace_windows_on_commit(
    publisher: Publisher,
    table: str,
    base_path: str,
    base_schema: T.StructType,
    config: IncrementalConfig,
    checkpoint: str,
    lookback: int = 0,
    trigger: Mapping[str, object] | None = None,
    read_options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start the stream that replaces just the windows new files have events of, and ``lookback`` windows before each.

    However late an event is, its window is built again from all its events in the base, and all windows of a micro-batch are
    replaced in one step; a micro-batch delivered twice gives the same table. Which windows are touched stays a table, and
    the scan of the base for them is confined to their range of time. Events without a time belong to no window.
    """
    config.validate()
    if config.effective != "microbatch":
        raise ConfigError("windows are replaced by the microbatch strategy")
    publisher.require_model(table, "microbatch")
    spark, unit, at = publisher.spark, check_unit(config.batch_size), col(config.event_time)
    stored_size = publisher.property(table, "batch_size")
    if stored_size not in (None, config.batch_size):
        raise ConfigError(f"{table} is stored with batch_size={stored_size!r}; rebuild it")

    def handle(batch: DataFrame, _number: int) -> None:
        starts = batch.where(at.isNotNull()).select(window_start(at, unit).alias("start"))
        starts = starts.select(F.explode(F.array(*[add_interval(F.col("start"), -i, unit).cast("timestamp_ntz") for i in range(lookback + 1)])).alias("start"))
        with publisher.stage(table, starts.distinct().withColumn(WINDOW_COLUMN, window_label(F.col("start"), unit))) as touched:
            least, greatest = touched.agg(F.min("start"), F.max("start")).first()
            base = spark.read.schema(base_schema).parquet(base_path)
            if least is None:
                return
            near = base.where(Calendar(config.event_time, "day" if unit == "hour" else unit).within(
                *((v.year if unit == "year" else v.date()) for v in (least, greatest)), base.schema[config.event_time].dataType))
            rows = within_partitions(label_windows(near, config), touched, [WINDOW_COLUMN])
            if publisher.current_version(table) is None:
                publisher.replace(table, rows, partition_by=WINDOW_COLUMN, properties=stored_properties(config), hidden=[WINDOW_COLUMN])
            else:
                publisher.overwrite_partitions(table, rows, touched)

    stream = spark.readStream.schema(base_schema).options(**(read_options or {})).parquet(base_path)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
