"""Safe casts that stay cheap when many values fail.

``try_cast`` signals each failing value by an internal exception, which costs far more than a good
value does. A test that every castable value passes keeps most bad ones away from it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_BLANK = r"[\x00-\x20]*"


def _may_cast(value: Column, source: T.DataType, target: T.DataType) -> Column | None:
    """A condition that holds for every castable value, or None where there is no cheap one."""
    if isinstance(source, T.StringType):
        if type(target) in _BITS:
            return value.rlike(rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$")
        if isinstance(target, (T.FloatType, T.DoubleType, T.DecimalType)):
            return value.rlike(r"(?i)[0-9]|inf|nan")
        if isinstance(target, (T.DateType, T.TimestampNTZType)):
            return value.rlike(rf"^{_BLANK}[+-]?[0-9]{{4}}")
        return None
    if type(target) in _BITS and isinstance(source, (*_BITS, T.FloatType, T.DoubleType)):
        top = 1 << (_BITS[type(target)] - 1)
        if type(source) in _BITS:
            return value.between(-top, top - 1) if _BITS[type(source)] > _BITS[type(target)] else None
        return value.between(float(-top) - 1, float(top))
    return None


def safe_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``value`` as ``target``, or null where it cannot be."""
    if source == target:
        return value
    condition = _may_cast(value, source, target)
    cast = value.try_cast(target)
    return cast if condition is None else F.when(condition, cast)
