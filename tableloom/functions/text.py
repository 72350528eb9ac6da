"""Text helpers of the table operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_name(left: Column, right: Column) -> Column:
    """Case-insensitive name equality."""
    return F.upper(left) == F.upper(right)


def bound_text(bound: Column) -> Column:
    """A partition bound in one spelling, by way of the time it stands for; null if it stands for none."""
    return F.date_format(bound.try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")


def squeezed(text: Column) -> Column:
    """Trimmed, runs of white space as one space, lower case: how labels of different writers are compared."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))
