"""Column-name helpers. Matching ignores case, as Spark does by default."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(value: str | Sequence[str] | None) -> list[str]:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Reference a column whose name may be a reserved word or hold dots."""
    return F.col(quoted(name))


def as_columns(named: Mapping[str, object]) -> dict[str, Column]:
    """Named expressions: columns, SQL text, or what has an ``expr`` of its own."""
    return {n: F.expr(e) if isinstance(e, str) else getattr(e, "expr", e) if not isinstance(e, Column) else e for n, e in named.items()}


def fresh_name(taken: Iterable[str], stem: str) -> str:
    """A name derived from ``stem`` that clashes with none of ``taken``."""
    used = {name.lower() for name in taken}
    name, i = stem, 0
    while name.lower() in used:
        i += 1
        name = f"{stem}_{i}"
    return name


def resolve(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The names as ``df`` spells them; unknown names raise."""
    spelled = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in spelled]
    if missing:
        raise ValueError(f"columns {missing} are not among {df.columns}")
    return [spelled[n.lower()] for n in names]


def others(df: DataFrame, names: Sequence[str]) -> list[str]:
    drop = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in drop]


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of every key between two aliased DataFrames."""
    cond = F.lit(True)
    for i, key in enumerate(keys):
        term = F.col(f"{left}.{quoted(key)}").eqNullSafe(F.col(f"{right}.{quoted(key)}"))
        cond = term if i == 0 else cond & term
    return cond
