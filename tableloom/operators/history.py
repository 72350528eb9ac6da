"""Type-2 history: one row per version of each key.

A history table has the source's columns plus a version id, the time of the change, and the
half-open validity of the version. Current versions carry no end, or a sentinel end if one is set.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.hashing import version_id
from tableloom.functions.names import as_list, col, fresh_name, quoted, resolve
from tableloom.functions.timing import NTZ, ntz
from tableloom.operators.schema import SchemaChangeError, can_store, diff_schemas

DELETE_MODES = ("ignore", "invalidate", "new_record")


@dataclass(frozen=True)
class MetaNames:
    """Names of the columns history adds; all can be changed."""

    scd_id: str = "scd_id"
    updated_at: str = "updated_at"
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_deleted: str = "is_deleted"


@dataclass(frozen=True)
class HistorySpec:
    keys: tuple[str, ...]
    strategy: str = "check"
    check_cols: tuple[str, ...] | str = "all"
    updated_at: str | None = None
    hard_deletes: str = "ignore"
    current_sentinel: datetime | str | None = None
    names: MetaNames = field(default_factory=MetaNames)

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(as_list(self.keys)))
        if not self.keys:
            raise ValueError("history needs at least one key column")
        if self.strategy not in ("check", "timestamp"):
            raise ValueError(f"strategy {self.strategy!r} is neither check nor timestamp")
        if self.strategy == "timestamp" and not self.updated_at:
            raise ValueError("the timestamp strategy needs updated_at")
        if self.hard_deletes not in DELETE_MODES:
            raise ValueError(f"hard_deletes {self.hard_deletes!r} is not one of {DELETE_MODES}")

    @property
    def tracks_deletes(self) -> bool:
        return self.hard_deletes == "new_record"

    @property
    def meta_columns(self) -> list[str]:
        n = self.names
        return [n.scd_id, n.updated_at, n.valid_from, n.valid_to, *([n.is_deleted] if self.tracks_deletes else [])]

    def open_end(self) -> Column:
        return F.lit(None).cast(NTZ) if self.current_sentinel is None else ntz(self.current_sentinel)

    def is_current(self, valid_to: Column) -> Column:
        if self.current_sentinel is None:
            return valid_to.isNull()
        return valid_to.isNull() | (valid_to == ntz(self.current_sentinel))

    def clock(self, run_ts: datetime | str) -> Column:
        return col(self.updated_at).cast(NTZ) if self.strategy == "timestamp" else ntz(run_ts)


def initial_history(source: DataFrame, spec: HistorySpec, run_ts: datetime | str) -> DataFrame:
    """Every source row as a current version."""
    n, clock = spec.names, spec.clock(run_ts)
    out = source.select(
        *[col(c) for c in source.columns],
        version_id(*[col(k) for k in spec.keys], clock).alias(n.scd_id),
        clock.alias(n.updated_at),
        clock.alias(n.valid_from),
        spec.open_end().alias(n.valid_to),
    )
    return out.withColumn(n.is_deleted, F.lit("False")) if spec.tracks_deletes else out


def current_rows(history: DataFrame, spec: HistorySpec) -> DataFrame:
    return history.where(spec.is_current(col(spec.names.valid_to)))


def closed_rows(history: DataFrame, spec: HistorySpec) -> DataFrame:
    return history.where(~F.coalesce(spec.is_current(col(spec.names.valid_to)), F.lit(False)))


def check_schema(history: T.StructType, source: T.StructType, spec: HistorySpec) -> list[str]:
    """Source columns new to history. Removed or incompatibly retyped columns raise."""
    meta = {c.lower() for c in [*spec.meta_columns, spec.names.is_deleted]}
    business = T.StructType([f for f in history if f.name.lower() not in meta])
    diff = diff_schemas(business, source)
    if diff.removed:
        raise SchemaChangeError(f"the source removed history columns {diff.removed}")
    unsafe = [n for n, (stored, incoming) in diff.retyped.items() if not can_store(incoming, stored)]
    if unsafe:
        raise SchemaChangeError(f"the source changed the type of history columns {unsafe}")
    return diff.added


def extend_history(history: DataFrame, source: DataFrame, spec: HistorySpec) -> DataFrame:
    """History with the source's new columns added as nulls, and the metadata columns of the spec.

    Business columns come in history's order, new ones after them, metadata last.
    """
    added = check_schema(history.schema, source.schema, spec)
    meta = {c.lower() for c in [*spec.meta_columns, spec.names.is_deleted]}
    business = [c for c in history.columns if c.lower() not in meta]
    present = {c.lower() for c in history.columns}
    out = [col(c) for c in business]
    out += [F.lit(None).cast(source.schema[c].dataType).alias(c) for c in added]
    n = spec.names
    out += [col(c) for c in (n.scd_id, n.updated_at, n.valid_from, n.valid_to)]
    if n.is_deleted.lower() in present:
        out.append(col(n.is_deleted))
    elif spec.tracks_deletes:
        out.append(F.lit("False").alias(n.is_deleted))
    return history.select(*out)


def _change_columns(history: DataFrame, source: DataFrame, spec: HistorySpec) -> tuple[list[str], bool]:
    """The columns to compare, and whether a checked column is new to history."""
    keys = {k.lower() for k in spec.keys}
    if spec.check_cols == "all":
        checked = [c for c in source.columns if c.lower() not in keys]
    else:
        checked = resolve(source, as_list(spec.check_cols))
    stored = {c.lower() for c in history.columns}
    return [c for c in checked if c.lower() in stored], any(c.lower() not in stored for c in checked)


def _matched(history: DataFrame, source: DataFrame, spec: HistorySpec, run_ts) -> tuple[DataFrame, list[str]]:
    """Current versions and source rows paired by key in one full outer join.

    Both sides are unique by key, so there is no hot key here; closed versions take no part. The
    result has struct columns ``cur`` and ``src`` and the verdict ``change`` per key.
    """
    n = spec.names
    compared, column_added = _change_columns(history, source, spec)
    wide = extend_history(history, source, spec)
    # ``is_deleted`` may outlive the delete mode that wrote it; a row flagged so can still be current.
    flagged = n.is_deleted.lower() in {c.lower() for c in wide.columns}
    columns = wide.columns

    cur = current_rows(wide, spec).select(
        *[col(k).alias(f"cur_key_{i}") for i, k in enumerate(spec.keys)],
        F.struct(*[col(c) for c in columns]).alias("cur"),
    )
    fresh = initial_history(source, spec, run_ts)
    names = {c.lower(): c for c in fresh.columns}
    fields = []
    for c in columns:
        found = names.get(c.lower())
        value = col(found) if found else F.lit(None)
        fields.append(value.cast(wide.schema[c].dataType).alias(c))
    src = fresh.select(
        *[col(k).alias(f"src_key_{i}") for i, k in enumerate(spec.keys)],
        F.struct(*fields).alias("src"),
    )
    on = F.lit(True)
    for i in range(len(spec.keys)):
        on = (F.col(f"cur_key_{i}") == F.col(f"src_key_{i}")) if i == 0 else on & (F.col(f"cur_key_{i}") == F.col(f"src_key_{i}"))
    paired = cur.join(src, on, "full")

    if spec.strategy == "timestamp":
        changed = F.col("src").getField(n.updated_at) > F.col("cur").getField(n.valid_from)
    elif column_added:
        changed = F.lit(True)
    else:
        changed = F.lit(False)
        for i, c in enumerate(compared):
            stored = next(x for x in columns if x.lower() == c.lower())
            term = ~F.col("src").getField(stored).eqNullSafe(F.col("cur").getField(stored))
            changed = term if i == 0 else changed | term
    deleted = F.lit(False)
    if flagged:
        deleted = F.coalesce(F.col("cur").getField(n.is_deleted) == "True", F.lit(False))
    came_back = deleted if spec.tracks_deletes else F.lit(False)
    gone = "keep" if spec.hard_deletes == "ignore" else "delete"
    change = (
        F.when(F.col("cur").isNull(), "insert")
        .when(F.col("src").isNull(), F.when(deleted & F.lit(spec.tracks_deletes), "keep").otherwise(gone))
        .when(F.coalesce(changed, F.lit(False)) | came_back, "update")
        .otherwise("keep")
    )
    return paired.select("cur", "src", change.alias("change")), columns


def _with(row: Column, columns: list[str], schema: T.StructType, **changes: Column) -> Column:
    """``row`` with some fields replaced, field order unchanged."""
    return F.struct(
        *[changes.get(c, row.getField(c)).cast(schema[c].dataType).alias(c) for c in columns]
    )


def _versions(paired: DataFrame, columns: list[str], spec: HistorySpec, run_ts, keep_unchanged: bool) -> DataFrame:
    """Per key, the change rows it gives rise to: at most one closing and one opening."""
    n = spec.names
    schema = paired.schema["cur"].dataType
    cur, src, change = F.col("cur"), F.col("src"), F.col("change")
    now = ntz(run_ts)

    def tagged(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), row.alias("row"))

    closing_at = F.when(change == "delete", now).otherwise(src.getField(n.updated_at))
    closing = F.when(
        change.isin("update", "delete"),
        F.struct(change.alias("change_type"), _with(cur, columns, schema, **{n.valid_to: closing_at}).alias("row")),
    )
    opening = F.when(change.isin("insert", "update"), tagged("insert", _with(src, columns, schema)))
    produced = [closing, opening]
    if spec.tracks_deletes:
        tombstone = _with(
            cur, columns, schema,
            **{
                n.scd_id: version_id(cur.getField(n.scd_id), now),
                n.updated_at: now,
                n.valid_from: now,
                n.valid_to: spec.open_end(),
                n.is_deleted: F.lit("True"),
            },
        )
        produced.append(F.when(change == "delete", tagged("insert", tombstone)))
    if keep_unchanged:
        produced.append(F.when(change == "keep", tagged("keep", _with(cur, columns, schema))))
    rows = paired.select(F.explode(F.array(*produced)).alias("item")).where("item IS NOT NULL")
    tag = fresh_name(columns, "change_type")
    return rows.select(F.col("item.change_type").alias(tag), *[F.col(f"item.row.{quoted(c)}").alias(c) for c in columns])


def change_set(history: DataFrame, source: DataFrame, spec: HistorySpec, run_ts: datetime | str) -> DataFrame:
    """What this run does: rows tagged insert, update or delete in the first column, ``change_type`` (with a number if that is taken).

    Update and delete rows carry the id of the version they close and the end it gets.
    """
    paired, columns = _matched(history, source, spec, run_ts)
    return _versions(paired, columns, spec, run_ts, keep_unchanged=False)


def apply_changes(history: DataFrame, changes: DataFrame, spec: HistorySpec) -> DataFrame:
    """Unchanged, closed and inserted versions in one plan.

    Closings are matched by version id. A left join keeps each stored version once and takes the
    new end where there is one, so unchanged and closed versions need a single pass.
    """
    n = spec.names
    tag, *columns = changes.columns
    stored = {c.lower(): c for c in history.columns}
    wide = history.select(
        *[
            col(stored[c.lower()]) if c.lower() in stored
            else (F.lit("False") if c.lower() == n.is_deleted.lower() else F.lit(None)).cast(changes.schema[c].dataType).alias(c)
            for c in columns
        ]
    )
    closed_id, closed_at = fresh_name(columns, "closed_id"), fresh_name(columns, "closed_at")
    closings = changes.where(col(tag).isin("update", "delete")).select(
        col(n.scd_id).alias(closed_id), col(n.valid_to).alias(closed_at)
    )
    kept = wide.join(closings, col(n.scd_id) == col(closed_id), "left").select(
        *[
            (F.when(col(closed_id).isNotNull(), col(closed_at)).otherwise(col(c)).alias(c)
             if c.lower() == n.valid_to.lower() else col(c))
            for c in columns
        ]
    )
    return kept.unionByName(changes.where(col(tag) == "insert").select(*[col(c) for c in columns]))


def advance(history: DataFrame, source: DataFrame, spec: HistorySpec, run_ts: datetime | str) -> DataFrame:
    """The next history in one step: one join of current versions with the source.

    Closed versions pass through untouched and are neither joined nor shuffled.
    """
    wide = extend_history(history, source, spec)
    decided = advance_current(history, source, spec, run_ts)
    return closed_rows(wide, spec).unionByName(decided.select(*[col(c) for c in decided.columns[1:]]))


def advance_current(history: DataFrame, source: DataFrame, spec: HistorySpec, run_ts: datetime | str) -> DataFrame:
    """Only the versions this run decides: those still current and those it closes, tagged in the first column as by ``change_set``."""
    paired, columns = _matched(history, source, spec, run_ts)
    return _versions(paired, columns, spec, run_ts, keep_unchanged=True)


def compares_few_columns(history: DataFrame, source: DataFrame, spec: HistorySpec) -> bool:
    """Whether changes can be told from a minority of the columns."""
    if spec.strategy == "timestamp":
        return True
    compared, column_added = _change_columns(history, source, spec)
    return not column_added and 2 * len(compared) < len(source.columns)


def touched_keys(current: DataFrame, source: DataFrame, spec: HistorySpec, run_ts: datetime | str) -> DataFrame:
    """Keys this run changes in any way, found from the key and compared columns alone."""
    n = spec.names
    compared = [spec.updated_at] if spec.strategy == "timestamp" else _change_columns(current, source, spec)[0]
    keys = resolve(source, spec.keys)
    wanted = [*keys, *[c for c in resolve(source, compared) if c not in keys]]
    stored = resolve(current, wanted)
    meta = [c for c in (n.scd_id, n.updated_at, n.valid_from, n.valid_to, n.is_deleted) if c in current.columns]
    slim = current.select(*[col(c) for c in [*stored, *[m for m in meta if m not in stored]]])
    paired, _ = _matched(slim, source.select(*[col(c) for c in wanted]), spec, run_ts)
    return paired.where("change <> 'keep'").select(
        *[F.coalesce(F.col("cur").getField(s), F.col("src").getField(s)).alias(k) for k, s in zip(keys, stored)]
    )


def advance_touched(
    current: DataFrame, source: DataFrame, touched: DataFrame, spec: HistorySpec, run_ts: datetime | str
) -> DataFrame:
    """``advance_current``, given the keys that change (written beforehand: they are used three times).

    Rows of other keys are passed on by a filter. Where few keys change, they are broadcast and no
    whole row is shuffled.
    """
    keys = resolve(source, spec.keys)
    stored = resolve(current, keys)
    as_stored = touched.select(*[col(k).alias(s) for k, s in zip(keys, stored)])
    changed = current.join(as_stored, stored, "left_semi")
    arriving = source.join(touched, keys, "left_semi")
    kept = extend_history(current.join(as_stored, stored, "left_anti"), source, spec)
    decided = advance_current(changed, arriving, spec, run_ts)
    return decided.unionByName(kept.withColumn(decided.columns[0], F.lit("keep")))


def source_violations(
    source: DataFrame, spec: HistorySpec, history: DataFrame | None = None
) -> DataFrame:
    """One row of counts: null keys, repeated keys, null or regressed update times.

    Rows are folded to one per key on the map side, so a key that fills a third of the source costs
    one row per task. Update times are compared in a join that feeds nothing but a count, which
    leaves adaptive execution free to split a hot key.
    """
    keys = resolve(source, spec.keys)
    timed = spec.strategy == "timestamp"
    zero = F.lit(0).cast("bigint")
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | col(k).isNull()
    at = col(spec.updated_at).cast(NTZ) if timed else ntz("1970-01-01")
    names = [f"k{i}" for i in range(len(keys))]
    rows = source.select(*[col(k).alias(n) for k, n in zip(keys, names)], any_null.alias("null_key"), at.alias("at"))
    counted = (
        rows.groupBy(*names, "null_key")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("at").isNull()).alias("n_missing"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("null_key"), F.col("n"))), zero).alias("null_keys"),
            F.count_if(F.col("n") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum("n_missing"), zero).alias("null_updated_at"),
        )
    )
    if not timed or history is None:
        return counted.withColumn("regressed_updated_at", zero)
    since = current_rows(history, spec).select(
        *[col(k).alias(f"h{i}") for i, k in enumerate(spec.keys)], col(spec.names.valid_from).alias("since")
    )
    on = F.col("at") < F.col("since")
    for i, n in enumerate(names):
        on = on & (F.col(n) == F.col(f"h{i}"))
    late = rows.join(since, on).agg(F.count(F.lit(1)).alias("regressed_updated_at"))
    parts = counted.withColumn("regressed_updated_at", zero).unionByName(late, allowMissingColumns=True)
    return parts.agg(*[F.sum(c).alias(c) for c in parts.columns])


def history_violations(history: DataFrame, spec: HistorySpec) -> DataFrame:
    """One row of counts over a history about to be published.

    Ids and current keys are counted in one grouping each; the row-level counts ride along with
    the first.
    """
    n = spec.names
    current = F.coalesce(spec.is_current(col(n.valid_to)), F.lit(False))
    by_id = (
        history.groupBy(col(n.scd_id).alias("id"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(col(n.valid_from).isNull()).alias("no_start"),
            F.count_if(F.coalesce(col(n.valid_from) > col(n.valid_to), F.lit(False))).alias("bad_window"),
        )
        .agg(
            F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("rows"))), F.lit(0).cast("bigint")).alias("null_ids"),
            F.coalesce(F.sum("no_start"), F.lit(0).cast("bigint")).alias("null_valid_from"),
            F.coalesce(F.sum("bad_window"), F.lit(0).cast("bigint")).alias("invalid_windows"),
            F.count_if(F.col("rows") > 1).alias("duplicate_ids"),
            F.lit(0).cast("bigint").alias("duplicate_current"),
        )
    )
    zero = F.lit(0).cast("bigint")
    by_key = (
        history.where(current)
        .groupBy(*[col(k).alias(f"k{i}") for i, k in enumerate(spec.keys)])
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            *[zero.alias(c) for c in ("null_ids", "null_valid_from", "invalid_windows", "duplicate_ids")],
            F.count_if(F.col("rows") > 1).alias("duplicate_current"),
        )
    )
    both = by_id.unionByName(by_key)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


class ViolationError(ValueError):
    """A validation found rows that must not be published."""


def raise_on_violations(counts: DataFrame, what: str) -> None:
    """Run a one-row count query and raise if any count is above zero."""
    found = {k: v for k, v in counts.first().asDict().items() if v}
    if found:
        raise ViolationError(f"{what}: {found}")
