"""Event-time expressions. All times are naive UTC (``TIMESTAMP_NTZ``)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions.names import col

NTZ = "timestamp_ntz"

# The batch sizes. Batch ids read 20240110T07, 20240110, 202401 and 2024.
BATCH_SIZES = ("hour", "day", "month", "year")


@dataclass(frozen=True)
class Calendar:
    """The year, or the first day of the month, or the day of a date or time column: a partition whose values are ranges of the column."""

    column: str
    unit: str

    def __post_init__(self):
        if self.unit not in ("day", "month", "year"):
            raise ValueError(f"calendar partitions are days, months or years, not {self.unit!r}")

    @property
    def expr(self) -> Column:
        if self.unit == "year":
            return F.year(col(self.column))
        day = col(self.column).cast("date")
        return day if self.unit == "day" else F.trunc(day, self.unit)

    def within(self, least: int | date, greatest: int | date, kind: T.DataType) -> Column:
        """A comparison of the bare column, which reaches a file's statistics, that holds for all rows of these partitions and those between them."""
        first, last = (datetime(v, 1, 1) if self.unit == "year" else datetime(v.year, v.month, v.day) for v in (least, greatest))
        stop = next_window(last, self.unit) if (last.year, last.month) < (9999, 12) and (self.unit != "year" or last.year < 9999) else None
        # the session decides which day an instant lies on, so instants get a day on both sides
        slack = timedelta(days=1 if isinstance(kind, T.TimestampType) else 0)
        bound = (lambda v: F.lit(v.date())) if isinstance(kind, T.DateType) else (lambda v: bound_for(v, kind))
        lower = col(self.column) >= bound(first - slack if first.year > 1 else first)
        return lower if stop is None else lower & (col(self.column) < bound(stop + slack))


def check_unit(unit: str) -> str:
    unit = unit.lower()
    if unit not in BATCH_SIZES:
        raise ValueError(f"batch size {unit!r} is not one of {list(BATCH_SIZES)}")
    return unit


def naive_utc(value: datetime) -> datetime:
    """Bounds given with an offset are moved to UTC; naive ones already are UTC."""
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def utc_of(ts: Column, kind: T.DataType) -> Column:
    """A time column as naive UTC. One that stands for instants is moved by its microseconds, so the session's zone plays no part."""
    if not isinstance(kind, T.TimestampType):
        return ts.cast(NTZ)
    seconds = F.unix_micros(ts).cast("decimal(24,6)") / F.lit(1_000_000)
    return F.lit("1970-01-01 00:00:00").cast(NTZ) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def ntz(value: datetime | str) -> Column:
    if isinstance(value, datetime):
        value = naive_utc(value).isoformat(sep=" ")
    return F.lit(value).cast(NTZ)


def bound_for(value: datetime | str, kind: T.DataType) -> Column:
    """A UTC bound to compare a bare column of this type with: an instant for instants, naive time for all others."""
    if not isinstance(kind, T.TimestampType):
        return ntz(value)
    if isinstance(value, datetime):
        value = naive_utc(value).isoformat(sep=" ")
    return F.lit(f"{value}+00:00").cast("timestamp")


def in_window(ts: Column, start: datetime | str, end: datetime | str) -> Column:
    return (ts >= ntz(start)) & (ts < ntz(end))


def window_start(ts: Column, unit: str) -> Column:
    """Truncation that stays in naive time, so no session zone can shift it."""
    unit, day = check_unit(unit), ts.cast("date")
    if unit == "hour":
        return day.cast(NTZ) + F.make_dt_interval(hours=F.hour(ts))
    return (day if unit == "day" else F.trunc(day, unit)).cast(NTZ)


def add_interval(ts: Column, number: int, unit: str) -> Column:
    """``ts + interval number unit`` for second … year."""
    part = {"second": "secs", "minute": "mins"}.get(unit, unit + "s")
    if part == "secs":
        return ts + F.make_interval(secs=F.lit(number))
    return ts + F.make_interval(**{part: F.lit(number)})


def window_end(ts: Column, unit: str) -> Column:
    return add_interval(window_start(ts, unit), 1, unit).cast(NTZ)


def batch_id(ts: Column, unit: str) -> Column:
    unit = check_unit(unit)
    text = ts.cast("string")
    digits = F.replace(F.substring(text, 1, {"year": 4, "month": 7}.get(unit, 10)), F.lit("-"), F.lit(""))
    return F.concat(digits, F.lit("T"), F.substring(text, 12, 2)) if unit == "hour" else digits


def partition_name(ts: Column, unit: str, prefix: str = "mb_") -> Column:
    return F.concat(F.lit(prefix), F.replace(batch_id(ts, unit), F.lit("T"), F.lit("")))


def parse_datetime(text: Column) -> Column:
    """Text in ``yyyy-MM-dd HH:mm:ss``; anything else becomes null."""
    well_formed = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    return F.when(well_formed, text.try_cast(NTZ))


def floor_to(value: datetime, unit: str) -> datetime:
    value = naive_utc(value).replace(minute=0, second=0, microsecond=0)
    if unit == "hour":
        return value
    value = value.replace(hour=0)
    if unit == "day":
        return value
    value = value.replace(day=1)
    return value if unit == "month" else value.replace(month=1)


def next_window(start: datetime, unit: str) -> datetime:
    if unit == "hour":
        return start + timedelta(hours=1)
    if unit == "day":
        return start + timedelta(days=1)
    if unit == "month":
        return (start.replace(day=1) + timedelta(days=32)).replace(day=1)
    return start.replace(year=start.year + 1)


def windows_between(start: datetime, end: datetime, unit: str) -> list[tuple[datetime, datetime]]:
    """The consecutive batch windows that cover ``[start, end)``."""
    unit, end = check_unit(unit), naive_utc(end)
    out, at = [], floor_to(start, unit)
    while at < end:
        out.append((at, next_window(at, unit)))
        at = next_window(at, unit)
    return out
