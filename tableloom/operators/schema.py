"""Schema comparison, schema-change policies, contracts and cast safety."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.casting import safe_cast
from tableloom.functions.names import as_list, col, others

POLICIES = ("ignore", "fail", "append_new_columns", "sync_all_columns")


class SchemaChangeError(ValueError):
    """The batch does not fit the target; nothing has been written."""


class ContractError(ValueError):
    """The model does not return the columns its contract declares."""


@dataclass(frozen=True)
class SchemaDiff:
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    retyped: dict[str, tuple[T.DataType, T.DataType]] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.retyped)

    def describe(self) -> str:
        types = {k: f"{a.simpleString()} -> {b.simpleString()}" for k, (a, b) in self.retyped.items()}
        return f"added {self.added}, removed {self.removed}, retyped {types}"


def diff_schemas(target: T.StructType, batch: T.StructType) -> SchemaDiff:
    """Case-insensitive difference; ``retyped`` maps the target's name to (stored, incoming) types."""
    stored = {f.name.lower(): f for f in target}
    incoming = {f.name.lower(): f for f in batch}
    return SchemaDiff(
        added=[f.name for f in batch if f.name.lower() not in stored],
        removed=[f.name for f in target if f.name.lower() not in incoming],
        retyped={
            f.name: (f.dataType, incoming[f.name.lower()].dataType)
            for f in target
            if f.name.lower() in incoming and incoming[f.name.lower()].dataType != f.dataType
        },
    )


def check_protected(
    target: T.StructType, batch: T.StructType, keys=(), sequence: str | None = None
) -> None:
    """Key and sequence columns must be in the batch, with the stored types."""
    protected = [*as_list(keys), *as_list(sequence)]
    names = {f.name.lower() for f in batch}
    missing = [c for c in protected if c.lower() not in names]
    if missing:
        raise SchemaChangeError(f"the batch lacks key or sequence columns {missing}")
    wanted = {c.lower() for c in protected}
    changed = [n for n in diff_schemas(target, batch).retyped if n.lower() in wanted]
    changed += [n for n in narrowed_widths(target, batch) if n.lower() in wanted]
    if changed:
        raise SchemaChangeError(f"key or sequence columns {changed} change type; rebuild the table instead")


def declared_widths(schema: T.StructType) -> dict[str, int]:
    """``varchar(n)`` and ``char(n)`` widths by column, for those that declare one."""
    widths = {}
    for f in schema:
        text = str(f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", ""))
        if isinstance(f.dataType, (T.VarcharType, T.CharType)):
            widths[f.name] = f.dataType.length
        elif m := re.fullmatch(r"(?:var)?char\((\d+)\)", text):
            widths[f.name] = int(m.group(1))
    return widths


def narrowed_widths(target: T.StructType, batch: T.StructType) -> list[str]:
    """Target columns whose declared width is below the one the batch declares."""
    incoming = {n.lower(): w for n, w in declared_widths(batch).items()}
    return [n for n, w in declared_widths(target).items() if incoming.get(n.lower(), 0) > w]


def widened_widths(target: T.StructType, batch: T.StructType) -> dict[str, int]:
    """The declared widths the target needs to hold the batch: only ever wider, never narrower."""
    incoming = {n.lower(): w for n, w in declared_widths(batch).items()}
    return {n: max(w, incoming.get(n.lower(), 0)) for n, w in declared_widths(target).items()}


def align(target: DataFrame, batch: DataFrame, policy: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Both sides in one schema under a schema-change policy, or an error before any write.

    * ``ignore``: the target's columns; extra batch columns are dropped, a missing one is an error.
    * ``fail``: any difference is an error that lists all three kinds.
    * ``append_new_columns``: new columns join the target, columns the batch lacks are null in it.
    * ``sync_all_columns``: the batch's columns and types, with stored rows cast to them.
    """
    if policy not in POLICIES:
        raise ValueError(f"on_schema_change {policy!r} is not one of {POLICIES}")
    diff = diff_schemas(target.schema, batch.schema)
    if policy == "fail" and diff:
        raise SchemaChangeError(f"batch and target are out of sync: {diff.describe()}")
    if policy in ("ignore", "fail"):
        if diff.removed:
            raise SchemaChangeError(f"the batch lacks target columns {diff.removed}")
        return target, conform(batch, target.schema)
    if policy == "append_new_columns":
        schema = T.StructType([*target.schema.fields, *[f for f in batch.schema if f.name in diff.added]])
        return conform(target, schema), conform(batch, schema)
    spelled = {f.name.lower(): f.name for f in target.schema}
    schema = T.StructType(
        [T.StructField(spelled.get(f.name.lower(), f.name), f.dataType, True, f.metadata) for f in batch.schema]
    )
    return conform(target, schema), conform(batch, schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name in the schema's order and types; those ``df`` lacks become null."""
    present = {c.lower(): c for c in df.columns}
    out = []
    for f in schema:
        found = present.get(f.name.lower())
        kind, metadata = f.dataType, dict(f.metadata)
        if isinstance(kind, (T.VarcharType, T.CharType)):
            # Spark holds such columns as strings that carry their declared type.
            metadata["__CHAR_VARCHAR_TYPE_STRING"], kind = kind.simpleString(), T.StringType()
        value = F.lit(None).cast(kind) if found is None else col(found)
        if found is not None and df.schema[found].dataType != kind:
            value = value.cast(kind) if can_store(df.schema[found].dataType, kind) else _whole_cast(value, kind, f.name)
        out.append(value.alias(f.name, metadata=metadata) if metadata else value.alias(f.name))
    return df.select(*out)


def _whole_cast(value: Column, kind: T.DataType, name: str) -> Column:
    """A cast that stops the job on a value it cannot take, whatever the session says of ANSI mode."""
    taken = value.try_cast(kind)
    failed = F.raise_error(F.concat(F.lit(f"a value of {name} does not fit {kind.simpleString()}: "), value.cast("string")))
    return F.when(value.isNotNull() & taken.isNull(), failed.cast(kind)).otherwise(taken)


def apply_contract(df: DataFrame, contract: T.StructType | None) -> DataFrame:
    """Cast and order the model's columns as declared; the sets of names must be equal.

    Without a contract the model passes through untouched.
    """
    if contract is None:
        return df
    diff = diff_schemas(contract, df.schema)
    if diff.added or diff.removed:
        raise ContractError(f"contract mismatch: not declared {diff.added}, not returned {diff.removed}")
    return conform(df, contract)


def null_fill(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns ``df`` lacks as typed nulls."""
    present = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(None).cast(t).alias(n) for n, t in columns.items() if n.lower() not in present])


def text_lengths(batch: DataFrame, declared: Mapping[str, int]) -> dict[str, Column]:
    """The longest text of each column that has a declared width: aggregates to observe while the batch is written."""
    wanted = {n.lower() for n in declared}
    return {f.name: F.max(F.length(col(f.name))).alias(f.name) for f in batch.schema if isinstance(f.dataType, T.StringType) and f.name.lower() in wanted}


def string_width_plan(batch: DataFrame, declared: Mapping[str, int]) -> DataFrame:
    """Longest text per declared string column, and whether its column must widen.

    All maxima come from one aggregate over one scan; the reshape afterwards works on one row.
    """
    by_name = {n.lower(): w for n, w in declared.items()}
    texts = [f.name for f in batch.schema if isinstance(f.dataType, T.StringType) and f.name.lower() in by_name]
    if not texts:
        empty = "column_name string, declared_width bigint, max_length bigint, needs_widening boolean"
        return batch.sparkSession.createDataFrame([], empty)
    maxima = batch.agg(*[F.max(F.length(col(c))).cast("bigint").alias(c) for c in texts])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(by_name[c.lower()]).cast("bigint").alias("declared_width"),
                 col(c).alias("max_length"))
        for c in texts
    ]
    return maxima.select(F.inline(F.array(*rows))).withColumn(
        "needs_widening", F.coalesce(F.col("max_length") > F.col("declared_width"), F.lit(False))
    )


def _lost(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """True where casting a non-null value drops it or changes it."""
    there = safe_cast(value, source, target)
    back = safe_cast(there, target, source)
    return value.isNotNull() & (there.isNull() | ~back.eqNullSafe(value))


def cast_loss_profile(df: DataFrame, targets: Mapping[str, T.DataType | str]) -> DataFrame:
    """Per column: rows, and rows whose value would not survive the cast. One scan for all columns."""
    parsed = {
        n: (T._parse_datatype_string(t) if isinstance(t, str) else t) for n, t in targets.items()
    }
    counts = [F.count(F.lit(1)).alias("rows_total")]
    for i, (name, target) in enumerate(parsed.items()):
        counts.append(F.count_if(_lost(col(name), df.schema[name].dataType, target)).alias(f"lost_{i}"))
    rows = [
        F.struct(F.lit(n).alias("column_name"), F.lit(t.simpleString()).alias("target_type"),
                 F.col("rows_total"), F.col(f"lost_{i}").alias("rows_lost"))
        for i, (n, t) in enumerate(parsed.items())
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


_INT_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_FLOAT_ORDER = [T.FloatType, T.DoubleType]


def can_store(source: T.DataType, target: T.DataType) -> bool:
    """Whether every value of ``source`` fits ``target`` within one type family."""
    if source == target:
        return True
    for order in (_INT_ORDER, _FLOAT_ORDER):
        if type(source) in order and type(target) in order:
            return order.index(type(source)) <= order.index(type(target))
    if type(source) in _INT_ORDER and target == T.DecimalType(38, 0):
        return True  # the stand-in for a 128-bit integer
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        return source.scale <= target.scale and source.precision - source.scale <= target.precision - target.scale
    if isinstance(source, T.DateType):
        return isinstance(target, (T.TimestampType, T.TimestampNTZType))
    text = (T.StringType, T.VarcharType, T.CharType)
    if isinstance(source, text) and isinstance(target, text):
        if not isinstance(target, (T.VarcharType, T.CharType)):
            return True
        return isinstance(source, (T.VarcharType, T.CharType)) and source.length <= target.length
    return False
