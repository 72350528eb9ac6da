"""CSV seeds and typed loads of text columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.casting import safe_cast
from tableloom.functions.names import col


def seed_csv(
    spark: SparkSession,
    path: str,
    column_types: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    timestamp_ntz: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """A CSV with a header as a typed table.

    Types come from ``schema`` if given, else from Spark's inference; ``column_types`` overrides
    single columns, whose names match without regard to case. Inference reads the file once more,
    so large files should come with a schema. A value that its type does not take, a row with too few or too many
    values and a header that differs from the schema stop the job. ``multi_line`` lets quoted text span lines; each file is then
    one task, so it is for small files, and without it such a text stops the job.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    if schema is None:
        prefer = "TIMESTAMP_NTZ" if timestamp_ntz else "TIMESTAMP_LTZ"
        before = spark.conf.get("spark.sql.timestampType")
        spark.conf.set("spark.sql.timestampType", prefer)
        try:
            schema = reader.option("inferSchema", True).csv(path).schema
        finally:
            spark.conf.set("spark.sql.timestampType", before)
    overrides = {n.lower(): t for n, t in (column_types or {}).items()}
    unknown = set(overrides) - {f.name.lower() for f in schema}
    if unknown:
        raise ValueError(f"column_types name columns {sorted(unknown)} that the file does not have")
    typed = T.StructType(
        [
            T.StructField(
                f.name,
                T._parse_datatype_string(overrides[f.name.lower()]) if f.name.lower() in overrides else f.dataType,
            )
            for f in schema
        ]
    )
    return reader.option("mode", "FAILFAST").option("enforceSchema", False).schema(typed).csv(path)


def _as_text(df: DataFrame, types: Mapping[str, str]) -> dict[str, str]:
    """Declared type per column as ``df`` spells it; columns without a declared type are refused."""
    declared = {n.lower(): t for n, t in types.items()}
    unknown = [c for c in df.columns if c.lower() not in declared]
    if unknown:
        raise ValueError(f"columns {unknown} are not among the accepted columns {list(types)}")
    return {c: declared[c.lower()] for c in df.columns}


def _cast(name: str, kind: str) -> Column:
    """Safe cast. Declared widths of text are ignored, so long text is never cut."""
    base = kind.strip().lower()
    if base.startswith(("varchar", "char", "character varying", "string", "text")):
        return col(name).cast("string")
    return safe_cast(col(name), T.StringType(), T._parse_datatype_string(kind))


def typed_load(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Text rows as typed rows, and the rows in which a cast lost a value.

    Both come from one expression per column, so each is a plain filtered scan without a shuffle.
    """
    kinds = _as_text(df, types)
    lost = F.lit(False)
    for c, kind in kinds.items():
        lost = lost | (col(c).isNotNull() & _cast(c, kind).isNull())
    typed = df.where(~lost).select(*[_cast(c, kind).alias(c) for c, kind in kinds.items()])
    return typed, df.where(lost)
