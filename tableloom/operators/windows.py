"""Which stored partition, if any, is exactly a batch window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.timing import check_unit, window_start


# The calendar levels an interval is covered by, from hours up, and how many of each make one of the next. Months are counted
# from year 0; a month has as many days as the calendar says.
LEVELS = ("hour", "day", "month", "year", "decade", "century", "millennium")
_NEXT = {"hour": 24, "month": 12, "year": 10, "decade": 10, "century": 10}


def _div(value: Column, by: int) -> Column:
    return ((value - F.pmod(value, F.lit(by))) / by).cast("long")


def _month_of(day: Column) -> Column:
    at = F.date_from_unix_date(day.cast("int"))
    return (F.year(at) * 12 + F.month(at) - 1).cast("long")


def _first_day(month: Column) -> Column:
    return F.unix_date(F.make_date(_div(month, 12).cast("int"), (F.pmod(month, F.lit(12)) + 1).cast("int"), F.lit(1))).cast("long")


def _above(level: str, at: Column) -> Column:
    """The unit of the next level that a unit lies in."""
    return _month_of(at) if level == "day" else _div(at, _NEXT[level])


def _begin(level: str, at: Column) -> Column:
    """The first unit of a level in a unit of the next."""
    return _first_day(at) if level == "day" else at * _NEXT[level]


def _hour(ts: Column) -> Column:
    return F.unix_date(ts.cast("date")).cast("long") * 24 + F.hour(ts)


def _units_above(units: Column, i: int) -> Column:
    """The units of level i + 1 that those of level i lie in."""
    own = F.filter(units, lambda u: u["level"] == i)
    return F.transform(own, lambda u: F.struct(F.lit(i + 1).alias("level"), _above(LEVELS[i], u["at"]).alias("at")))


def _marked(units: Column, own: bool) -> Column:
    return F.transform(units, lambda u: F.struct(u["level"].alias("level"), u["at"].alias("at"), F.lit(own).alias("own")))


def calendar_cover(df: DataFrame, start: str, end: str) -> DataFrame:
    """Each interval ``[start, end)`` as a few calendar units: a row for each with ``level``, ``at`` and ``own``.

    Own units do not overlap and together cover the interval to the hour, the largest that fit first: an interval of any width has some dozens
    at most. Units with ``own`` off are those an own one lies in. ``hour_from`` is the interval's first hour.
    """
    ts = F.col(end)
    df = df.withColumn("hour_from", _hour(F.col(start))).withColumn("cover_lo", F.col("hour_from"))
    df = df.withColumn("cover_hi", _hour(ts) + (ts > window_start(ts, "hour")).cast("int"))
    lo, hi = F.col("cover_lo"), F.col("cover_hi")
    units = lambda level, a, b: F.when(a < b, F.transform(F.sequence(a, b - 1), lambda i: F.struct(F.lit(level).alias("level"), i.alias("at")))).otherwise(F.array().cast("array<struct<level:int,at:bigint>>"))
    found = []
    for i, level in enumerate(LEVELS[:-1]):
        df = df.withColumn("next_lo", _above(level, lo) + (_begin(level, _above(level, lo)) < lo).cast("int")).withColumn("next_hi", _above(level, hi))
        whole = F.col("next_lo") < F.col("next_hi")
        inner_lo, inner_hi = F.when(whole, _begin(level, F.col("next_lo"))).otherwise(hi), F.when(whole, _begin(level, F.col("next_hi"))).otherwise(hi)
        df = df.withColumn(f"cover_{i}", F.concat(units(i, lo, inner_lo), units(i, inner_hi, hi)))
        df = df.withColumn("cover_lo", F.when(whole, F.col("next_lo")).otherwise(0)).withColumn("cover_hi", F.when(whole, F.col("next_hi")).otherwise(0))
        found.append(F.col(f"cover_{i}"))
    last = len(LEVELS) - 1
    df = df.withColumn("own_units", F.concat(*found, units(last, lo, hi)))
    above, level_units = F.array().cast("array<struct<level:int,at:bigint>>"), F.col("own_units")
    for i, level in enumerate(LEVELS[:-1]):
        # the units one level up, of own ones and of those found so far
        up = _units_above(F.concat(level_units, above), i)
        df = df.withColumn(f"above_{i}", F.array_distinct(F.concat(above, up)))
        above = F.col(f"above_{i}")
    marked = F.concat(_marked(level_units, True), _marked(above, False))
    helpers = [c for c in df.columns if c.startswith(("cover_", "next_", "above_")) or c == "own_units"]
    return df.withColumn("unit", F.explode(marked)).drop(*helpers).select("*", "unit.*").drop("unit")


def _holds(level: Column, at: Column, hour: Column) -> Column:
    """Whether a unit holds an hour."""
    found, own = F.lit(False), hour
    for i, name in enumerate(LEVELS):
        found = F.when(level == i, at == own).otherwise(found)
        if i < len(LEVELS) - 1:
            own = _above(name, own)
    return found


def resolve_partitions(windows: DataFrame, partitions: DataFrame, unit: str) -> DataFrame:
    """Classify each window against the stored ranges of one table.

    ``windows`` has (window_start, window_end), ``partitions`` has (partition_name, lower, upper). Status is ``exact`` with the
    partition's name, ``ambiguous`` for more than one exact range, ``overlap`` when only other ranges intersect it, ``unparsable`` when
    none does but there is a partition whose range is not known, as one of its bounds is null or they are the wrong way round, and
    ``missing`` when nothing does. A window of that kind is itself ``unparsable``.

    Both sides are covered by calendar units, so a range of any width is a few rows, and two intervals overlap where a unit of one is, or
    lies in, a unit of the other. Of all such places only the one that holds the later of both first hours counts, and there is exactly one.
    """
    check_unit(unit)
    sound = (F.col("lower") < F.col("upper"))
    unknown = partitions.where(~F.coalesce(sound, F.lit(False))).agg(F.count(F.lit(1))).scalar()
    wanted = windows.where(F.col("window_start") < F.col("window_end")).distinct()
    w = calendar_cover(wanted, "window_start", "window_end").withColumnsRenamed({"own": "w_own", "hour_from": "w_from"})
    p = calendar_cover(partitions.where(sound).select("partition_name", "lower", "upper"), "lower", "upper").withColumnsRenamed({"own": "p_own", "hour_from": "p_from"})
    pairs = w.join(p, ["level", "at"]).where(
        (F.col("w_own") | F.col("p_own"))
        & _holds(F.col("level"), F.col("at"), F.greatest("w_from", "p_from"))
        & (F.col("lower") < F.col("window_end"))
        & (F.col("upper") > F.col("window_start"))
    )
    exact = (F.col("lower") == F.col("window_start")) & (F.col("upper") == F.col("window_end"))
    found = pairs.groupBy("window_start", "window_end").agg(
        F.count_if(exact).alias("exact_count"),
        F.count_if(~exact).alias("overlap_count"),
        F.min(F.when(exact, F.col("partition_name"))).alias("exact_name"),
    )
    n_exact, n_other = F.coalesce("exact_count", F.lit(0)), F.coalesce("overlap_count", F.lit(0))
    sound_window = F.coalesce(F.col("window_start") < F.col("window_end"), F.lit(False))
    status = (
        F.when(~sound_window, "unparsable").when(n_exact == 1, "exact").when(n_exact > 1, "ambiguous").when(n_other > 0, "overlap")
        .when(unknown > 0, "unparsable").otherwise("missing")
    )
    return windows.join(found, ["window_start", "window_end"], "left").select(
        "window_start",
        "window_end",
        status.alias("status"),
        F.when(n_exact == 1, F.col("exact_name")).alias("partition_name"),
        n_exact.alias("exact_count"),
        n_other.alias("overlap_count"),
    )


def require_exact(resolved: DataFrame, allow_missing: bool) -> DataFrame:
    """The resolved windows, failing on any that a run could not write without losing rows."""
    bad = F.col("status").isin("overlap", "ambiguous", "unparsable")
    if not allow_missing:
        bad = bad | (F.col("status") == "missing")
    text = F.concat(
        F.lit("no exact partition for window ["), F.col("window_start").cast("string"), F.lit(", "),
        F.col("window_end").cast("string"), F.lit("): "), F.col("status"),
    )
    return resolved.where(F.when(bad, F.raise_error(text).cast("boolean")).otherwise(True))
