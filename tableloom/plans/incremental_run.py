"""One incremental run: validate, align, compute, publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import ExitStack, nullcontext
from dataclasses import dataclass
from datetime import datetime
import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.names import as_list, col
from tableloom.functions.timing import (
    BATCH_SIZES, NTZ, add_interval, batch_id, check_unit, floor_to, naive_utc, next_window, ntz, window_start, windows_between,
)
from tableloom.operators import incremental as inc
from tableloom.operators.guards import assert_unique
from tableloom.operators.layout import key_first
from tableloom.operators.schema import (
    POLICIES, SchemaChangeError, align, apply_contract, check_protected, conform, declared_widths, text_lengths,
)
from tableloom.operators.windows import require_exact, resolve_partitions
from tableloom.plans.merge_log import run_merge_log
from tableloom.plans.publish import Publisher

BUILT_IN = ("append", "merge", "insert_overwrite", "microbatch")
_PLAIN_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


class ConfigError(ValueError):
    """A combination of options that cannot work or could lose rows."""


@dataclass(frozen=True)
class IncrementalConfig:
    strategy: str = "default"
    unique_key: tuple[str, ...] | str | None = None
    sequence: str | None = None
    on_schema_change: str = "ignore"
    partition_by: tuple[str, ...] | str | None = None
    bucket_by: tuple[int, Sequence[str] | str] | None = None
    overwrite_partitions: tuple | str | None = None
    event_time: str | None = None
    batch_size: str | None = None
    custom: inc.Strategy | None = None
    predicates: tuple[Column, ...] = ()
    contract: T.StructType | None = None
    merge_on_read: bool = False

    @property
    def keys(self) -> list[str]:
        return as_list(self.unique_key)

    @property
    def partitions(self) -> list[str]:
        return as_list(self.partition_by)

    @property
    def effective(self) -> str:
        """Without a strategy, a key means merge and no key means append."""
        if self.custom is not None:
            return "custom"
        if self.strategy == "default":
            return "merge" if self.keys else "append"
        return self.strategy

    def validate(self) -> None:
        """Everything that can be refused without looking at data."""
        kind = self.effective
        if kind not in (*BUILT_IN, "custom"):
            raise ConfigError(f"strategy {kind!r} is not one of {BUILT_IN}")
        if self.on_schema_change not in POLICIES:
            raise ConfigError(f"on_schema_change {self.on_schema_change!r} is not one of {POLICIES}")
        if kind == "merge":
            if not self.keys:
                raise ConfigError("merge needs a unique_key")
            if len({k.lower() for k in self.keys}) < len(self.keys):
                raise ConfigError("unique_key repeats a column")
            bad = [k for k in self.keys if not _PLAIN_NAME.fullmatch(k)]
            if bad:
                raise ConfigError(f"unique_key columns {bad} are not plain names")
        elif kind in ("insert_overwrite", "microbatch") and self.keys:
            raise ConfigError(f"{kind} with a unique_key could drop rows absent from the batch; use merge")
        if self.sequence and kind != "merge":
            raise ConfigError("a sequence column only works with merge")
        if self.merge_on_read and kind != "merge":
            raise ConfigError("merge_on_read only works with merge")
        if self.merge_on_read and (self.partition_by or (self.bucket_by and as_list(self.bucket_by[1]) != self.keys)):
            raise ConfigError("merge_on_read stores by batch, in buckets of the key; it cannot be partitioned or bucketed otherwise")
        if kind == "microbatch" and (self.partition_by or self.bucket_by):
            raise ConfigError("microbatch stores by window; it cannot be partitioned or bucketed otherwise")
        if self.predicates and kind != "custom":
            raise ConfigError(f"predicates are not supported by {kind}")
        if self.overwrite_partitions is not None:
            named = as_list(self.overwrite_partitions)
            if kind != "insert_overwrite":
                raise ConfigError("overwrite_partitions only works with insert_overwrite")
            if not named:
                raise ConfigError("overwrite_partitions is empty")
            if "*" in named and len(named) > 1:
                raise ConfigError("'*' cannot be combined with named partitions")
            if not self.partition_by:
                raise ConfigError("overwrite_partitions needs partition_by")
            if named != ["*"] and len(self.partitions) > 1:
                raise ConfigError("named partitions need a single partition column")
        if kind == "microbatch":
            if not self.event_time or not _PLAIN_NAME.fullmatch(self.event_time):
                raise ConfigError("microbatch needs event_time to name one plain column")
            check_unit(self.batch_size or "")


Model = Callable[[], DataFrame]


def stored_properties(config: IncrementalConfig) -> dict[str, str]:
    """What a table remembers of the runs that store it."""
    return {"table_model": config.effective, "unique_key": ",".join(config.keys), "sequence": config.sequence or "",
            "batch_size": config.batch_size or "", "partition_by": ",".join(config.partitions)}


def _partition_merge(config: IncrementalConfig, target: DataFrame) -> bool:
    """Whether a merge can be confined to the partitions its batch touches.

    It can when the partition columns are part of the key: then a key never moves between partitions.
    """
    keys = {k.lower() for k in config.keys}
    return bool(config.partitions) and all(p.lower() in keys and p in target.columns for p in config.partitions)


def run_incremental(
    publisher: Publisher,
    table: str,
    model: Model,
    config: IncrementalConfig,
    full_refresh: bool = False,
    window: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """Bring one table up to date and return it.

    ``model`` gives the batch; for microbatch it gives the whole source and ``window`` picks the rows.
    All refusals come before the first write.
    """
    config.validate()
    windows = []
    if config.effective == "microbatch":
        if window is None:
            raise ConfigError("microbatch needs an event-time window")
        start, end = naive_utc(window[0]), naive_utc(window[1])
        unit = check_unit(config.batch_size)
        if floor_to(start, unit) != start or next_window(start, unit) != end:
            raise ConfigError(f"[{start}, {end}) is not one {unit} window")
        if full_refresh and publisher.exists(table):
            raise ConfigError("a full refresh from one window would drop all others; use run_backfill")
        windows = [(start, end)]
    return _run(publisher, table, model, config, full_refresh, windows)


def run_backfill(
    publisher: Publisher,
    table: str,
    model: Model,
    config: IncrementalConfig,
    start: datetime,
    end: datetime,
    full_refresh: bool = False,
) -> DataFrame:
    """Replace every window that covers ``[start, end)``, as running each of them in turn would.

    The windows are consecutive and independent, so they go through one job that reads the source
    once and writes their partitions in parallel, and either all of them are replaced or none.
    """
    config.validate()
    if config.effective != "microbatch":
        raise ConfigError("backfill needs the microbatch strategy")
    windows = windows_between(start, end, config.batch_size)
    if not windows:
        raise ConfigError(f"no {config.batch_size} window lies between {start} and {end}")
    return _run(publisher, table, model, config, full_refresh, windows)


def _run(
    publisher: Publisher,
    table: str,
    model: Model,
    config: IncrementalConfig,
    full_refresh: bool,
    windows: Sequence[tuple[datetime, datetime]],
) -> DataFrame:
    kind = config.effective
    publisher.require_model(table, "merge_log" if config.merge_on_read else kind, rebuild=full_refresh)
    batch = apply_contract(model(), config.contract)
    if windows:
        span = windows[0][0], windows[-1][1]
        batch = batch.where(inc.in_window(col(config.event_time), *span))

    if kind == "microbatch" and full_refresh:
        _refuse_lost_windows(publisher, table, windows)
    props = stored_properties(config)
    if config.merge_on_read:
        return run_merge_log(publisher, table, batch, config.keys, config.sequence, config.on_schema_change, full_refresh,
                             config.bucket_by[0] if config.bucket_by else None)
    first = full_refresh or publisher.current_version(table) is None
    if first:
        if kind == "merge":
            check_protected(batch.schema, batch.schema, config.keys, config.sequence)
            return publisher.replace(
                table, key_first(batch, config.keys), partition_by=config.partitions, bucket_by=config.bucket_by, properties=props,
                check=lambda written: assert_unique(written, config.keys),
            )
        if kind == "microbatch":
            return publisher.replace(table, label_windows(batch, config), partition_by=WINDOW_COLUMN,
                                     properties=props, hidden=[WINDOW_COLUMN])
        return publisher.replace(table, batch, partition_by=config.partitions, bucket_by=config.bucket_by, properties=props)

    target = publisher.stored(table)
    _check_target(publisher, table, config)
    if kind == "merge":
        check_protected(target.schema, batch.schema, config.keys, config.sequence)
    publisher.drop_stale(table)  # helpers a killed run left behind
    with ExitStack() as stages:
        wide = target
        lengths = text_lengths(batch, declared_widths(target.schema)) if config.contract is None else {}
        if lengths:
            # one pass: the batch is measured while it is written, and all that follows reads what was written
            seen = Observation()
            batch = stages.enter_context(publisher.stage(table, batch.observe(seen, *lengths.values())))
            wide = _widened(target, seen.get, config)
        return _advance(publisher, table, target, wide, batch, config, windows, props)


def _advance(publisher, table, target, wide, batch, config, windows, props) -> DataFrame:
    """Put a batch into what is stored, by the strategy of the run."""
    kind = config.effective
    if kind == "microbatch":
        return _replace_windows(publisher, table, wide, batch, config, windows, props)

    stored, batch = align(wide, batch, config.on_schema_change)
    same_shape = stored.schema.names == target.schema.names and stored.schema == target.schema
    if kind == "append" and same_shape:
        return publisher.append(table, batch)
    if kind == "insert_overwrite" and config.overwrite_partitions is None:
        return publisher.replace(table, batch, partition_by=config.partitions, bucket_by=config.bucket_by, properties=props)
    if kind == "insert_overwrite" and same_shape:
        return _overwrite(publisher, table, target, batch, config)

    with publisher.stage(table, batch) as staged:
        if kind == "merge":
            assert_unique(staged, config.keys)
            if same_shape and _partition_merge(config, target):
                touched = inc.within_partitions(target, staged.select(*[col(p) for p in config.partitions]).distinct(), config.partitions)
                with _winners(publisher, table, touched, staged, config) as rows:
                    return publisher.overwrite_partitions(table, inc.upsert(touched, rows, config.keys, guard=False))
            with _winners(publisher, table, stored, staged, config) as rows:
                result = inc.upsert(stored, rows, config.keys, guard=False)
                return publisher.replace(table, result, partition_by=config.partitions, bucket_by=config.bucket_by,
                                         properties=props)
        elif kind == "append":
            result = inc.append(stored, staged)
        elif kind == "insert_overwrite":
            result = _overwritten(stored, staged, config)
        else:
            result = inc.custom(stored, staged, config.custom, config.keys, config.predicates)
        return publisher.replace(table, result, partition_by=config.partitions, bucket_by=config.bucket_by, properties=props)


def _widened(target: DataFrame, lengths: Mapping[str, int | None], config: IncrementalConfig) -> DataFrame:
    """The target with declared text widths raised to the longest text of the batch.

    A contract fixes widths, and keys never change. Stored tables keep the widths they were written
    with, so a run that raises one writes a new version, as for any other schema change.
    """
    widths = {n.lower(): w for n, w in declared_widths(target.schema).items()}
    needed = {n.lower(): longest for n, longest in lengths.items() if longest is not None and longest > widths[n.lower()]}
    fixed = [c for c in [*config.keys, *as_list(config.sequence)] if c.lower() in needed]
    if fixed:
        raise SchemaChangeError(f"key or sequence columns {fixed} would have to widen; rebuild the table instead")
    fields = [
        T.StructField(f.name, T.VarcharType(needed[f.name.lower()])) if f.name.lower() in needed else f
        for f in target.schema
    ]
    return conform(target, T.StructType(fields)) if needed else target


def _check_target(publisher: Publisher, table: str, config: IncrementalConfig) -> None:
    """The stored key, sequence and layout must be the configured ones."""
    properties = publisher.properties(table)
    for name, wanted in (
        ("unique_key", ",".join(config.keys)),
        ("sequence", config.sequence or ""),
        ("batch_size", config.batch_size or ""),
        ("partition_by", ",".join(config.partitions)),
    ):
        if name == "batch_size" and config.effective == "microbatch":
            continue  # windows are held against the stored ones each by itself
        stored = properties.get(name)
        if stored is None and config.effective not in ("merge", "microbatch"):
            continue
        if (stored or "").lower() != wanted.lower():
            raise ConfigError(f"{table} is stored with {name}={stored!r} but configured with {wanted!r}; rebuild it")


def _winners(publisher: Publisher, table: str, stored: DataFrame, batch: DataFrame, config: IncrementalConfig):
    """The rows to upsert. With a sequence they are written first, so the target is compared once only."""
    if not config.sequence:
        return nullcontext(batch)
    return publisher.stage(table, inc.sequence_winners(stored, batch, config.keys, config.sequence))


def _overwritten(stored: DataFrame, batch: DataFrame, config: IncrementalConfig) -> DataFrame:
    named = as_list(config.overwrite_partitions)
    if named == ["*"]:
        return inc.overwrite_dynamic(stored, batch, F.struct(*[col(p) for p in config.partitions]))
    return inc.overwrite_partitions(stored, batch, col(config.partitions[0]), named)


def _overwrite(
    publisher: Publisher, table: str, target: DataFrame, batch: DataFrame, config: IncrementalConfig
) -> DataFrame:
    """Replace stored partitions; partitions without a batch row are emptied only if named."""
    named = as_list(config.overwrite_partitions)
    if named == ["*"]:
        return publisher.overwrite_partitions(table, batch)
    (partition,) = config.partitions
    checked = inc.overwrite_partitions(target.limit(0), batch, col(partition), named)
    listed = publisher.spark.createDataFrame([(str(v),) for v in named], T.StructType([T.StructField(partition, T.StringType())]))
    return publisher.overwrite_partitions(table, checked, listed)


# -- microbatch -----------------------------------------------------------------------------

WINDOW_COLUMN = "event_window"


def _labels(windows: Sequence[tuple[datetime, datetime]], unit: str) -> list[str]:
    return [f"{start.strftime('%Y%m%dT%H')}-{unit}" for start, _ in windows]


def window_label(ts: Column, unit: str) -> Column:
    return F.concat(batch_id(window_start(ts, unit), "hour"), F.lit(f"-{unit}"))


def label_windows(df: DataFrame, config: IncrementalConfig) -> DataFrame:
    """Rows with the start and the size of their window as text, which is what they are stored by."""
    return df.withColumn(WINDOW_COLUMN, window_label(col(config.event_time), check_unit(config.batch_size)))


def stored_windows(publisher: Publisher, table: str) -> DataFrame:
    """The windows a microbatch table has rows of: ``partition_name, lower, upper``."""
    name = F.col("partition_name")
    entries = publisher.entries(table).select(col(WINDOW_COLUMN).alias("partition_name"))
    digits, unit = F.substring(name, 1, 8), F.substring_index(name, "-", -1)
    lower = F.to_date(digits, "yyyyMMdd").cast(NTZ) + F.make_dt_interval(hours=F.substring(name, 10, 2).cast("int"))
    upper = F.lit(None).cast(NTZ)
    for size in BATCH_SIZES:
        upper = F.when(unit == size, add_interval(F.col("lower"), 1, size).cast(NTZ)).otherwise(upper)
    return entries.withColumn("lower", lower).withColumn("upper", upper)


def _require_windows(publisher: Publisher, table: str, windows: Sequence[tuple[datetime, datetime]], unit: str) -> None:
    """Each window of a run must be a stored one, or meet none: one that shares rows with a window of another size would lose or repeat them."""
    wanted = publisher.spark.createDataFrame(list(windows), f"window_start {NTZ}, window_end {NTZ}")
    try:
        require_exact(resolve_partitions(wanted, stored_windows(publisher, table), unit), allow_missing=True).count()
    except Exception as error:
        if "no exact partition" not in str(error):
            raise
        raise ConfigError(f"{table} stores windows of another batch_size where the run would write; rebuild them first: {str(error).splitlines()[0]}") from error


def _refuse_lost_windows(publisher: Publisher, table: str, windows: Sequence[tuple[datetime, datetime]]) -> None:
    """A full refresh replaces the whole table, so its range must cover every stored window."""
    if publisher.property(table, "table_model") != "microbatch":
        return
    outside = (F.col("lower") < ntz(windows[0][0])) | (F.col("upper") > ntz(windows[-1][1])) | F.col("lower").isNull()
    if not stored_windows(publisher, table).where(outside).isEmpty():
        raise ConfigError(f"a full refresh of [{windows[0][0]}, {windows[-1][1]}) would drop the windows of {table} outside it")


def _replace_windows(
    publisher: Publisher,
    table: str,
    wide: DataFrame,
    source: DataFrame,
    config: IncrementalConfig,
    windows: Sequence[tuple[datetime, datetime]],
    props: dict[str, str],
) -> DataFrame:
    """Replace stored windows in one step. Only their partitions are written; those the batch has no rows for are emptied."""
    _require_windows(publisher, table, windows, check_unit(config.batch_size))
    target, labels = wide.drop(WINDOW_COLUMN), _labels(windows, check_unit(config.batch_size))
    aligned, batch = align(target, source, config.on_schema_change)
    batch = label_windows(batch, config)
    if aligned.schema != target.schema or wide.schema != publisher.stored(table).schema:
        kept, batch = align(wide.where(~col(WINDOW_COLUMN).isin(labels)), batch, config.on_schema_change)
        return publisher.replace(table, kept.unionByName(batch), partition_by=WINDOW_COLUMN,
                                 properties=props, hidden=[WINDOW_COLUMN])
    listed = publisher.spark.createDataFrame([(label,) for label in labels], f"{WINDOW_COLUMN} string")
    return publisher.overwrite_partitions(table, batch, listed)
