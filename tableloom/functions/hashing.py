"""Hash expressions: text keys for stored ids, 64-bit sums for change detection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def version_id(*parts: Column | str) -> Column:
    """md5 of the parts as text, joined by a pipe, with null as the empty string."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]))


def prefixed_md5(*parts: Column | str) -> Column:
    """md5 over ``length:text`` fields, so moving text between fields changes the hash."""
    fields = []
    for part in parts:
        text = F.coalesce(_c(part).cast("string"), F.lit(""))
        fields += [F.length(text).cast("string"), F.lit(":"), text]
    return F.md5(F.concat(*fields))


def multiset_digest(*parts: Column | str) -> dict[str, Column]:
    """Order-free aggregates that together identify a bag of rows.

    Each part is hashed with a flag that tells null from any value, as the hash alone skips nulls. The 64-bit row hash is summed in three slices of at most 22 bits, so no sum overflows below
    2**41 rows in a group, and all buffers are longs that stay in the hash aggregate.
    """
    h = F.xxhash64(*[x for p in parts for x in (F.isnull(_c(p)), _c(p))])
    mask = F.lit((1 << 22) - 1).cast("long")
    return {
        "row_count": F.count(F.lit(1)),
        "hash_low": F.sum(h.bitwiseAND(mask)),
        "hash_mid": F.sum(F.shiftrightunsigned(h, 22).bitwiseAND(mask)),
        "hash_high": F.sum(F.shiftrightunsigned(h, 44)),
    }
