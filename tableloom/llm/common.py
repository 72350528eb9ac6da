"""What several operators share: text batches that keep their rows, and byte-level word hashing."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

#: Bytes of text one numpy pass works on; longer texts are passes of their own.
PASS_BYTES = 2 << 20

MIX = np.uint64(0x9E3779B97F4A7C15)


def let_workers_import(spark: SparkSession) -> None:
    """Have Python workers on this machine find this package where the driver found it; a cluster gets it shipped."""
    root, paths = str(Path(__file__).parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


#: Bits of a sieve for each of its tags, and for all of them together.
BITS_A_TAG, MOST_BITS = 32, 1 << 26

_held: dict[str, object] = {}


def held_by_worker(key: str, make: Callable[[], object]):
    """What ``make`` gave for this key in this worker process; only the last key's is held, whatever operator it is of."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def hold_nothing() -> None:
    """Give back what an operator before this one left in this worker process."""
    _held.clear()
    pa.default_memory_pool().release_unused()


def text_batches(texts: pa.Array, limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each."""
    sizes = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1] \
        if pa.types.is_string(texts.type) else \
        np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(sizes, int(sizes[start]) + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each starts (one more for the end); null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    kind = np.int32 if pa.types.is_string(texts.type) else np.int64
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    filled, step = 1, int(base)
    while filled < n:
        take = min(filled, n - filled)
        out[filled:filled + take] = out[:take] * np.uint64(step)
        filled += take
        step = step * step & 0xFFFFFFFFFFFFFFFF
    return out


_BASE = np.uint64(0x2545F4914F6CDD1D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_up = _down = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _up, _down
    if len(_up) < n:
        size = 1 << (n - 1).bit_length()
        _up, _down = powers(size, _BASE), powers(size, _INVERSE)
    return _up, _down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes that depends on the bytes alone, not on where they lie."""
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    out = (sums[ends] - sums[starts]) * down[starts]
    return mix64(out + (ends - starts).astype(np.uint64) * MIX)


def word_spans(data: np.ndarray, is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and how many words come before each text. ``is_word`` has a flag for each byte value."""
    inside = is_word[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def with_results(
    df: DataFrame, text: str, fields: list[StructField], make: Callable[[], Callable[[pa.Array], list[pa.Array]]], keep: list[str] | None = None,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Rows as ``row`` (a struct of ``keep``, or of all columns) beside result columns computed from the text.

    ``make`` runs once a task and gives the function that turns an array of texts into the result arrays. The struct
    keeps the names of a table's own columns apart from those of the results.
    """
    let_workers_import(df.sparkSession)
    columns = [F.col(f"`{c}`") for c in (keep if keep is not None else df.columns)]
    packed = df.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        work = make()
        for batch in batches:
            rows, texts = batch.column(0), batch.column(1)
            for start, stop in text_batches(texts, pass_bytes):
                part = texts.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([rows.slice(start, stop - start), *work(part)], ["row", *(f.name for f in fields)])

    return packed.mapInArrow(run, StructType([packed.schema["row"], *fields]))


def sifted(rows: DataFrame, tag: Column, tags: DataFrame) -> DataFrame:
    """The rows with ``among``: false only where ``tag``, a 64-bit hash, is none of ``tags`` (one column), so that a join with these may leave the row where it is.

    It says true for all of ``tags`` and for one in ``BITS_A_TAG`` others or fewer (more of them beyond ``MOST_BITS / BITS_A_TAG`` tags): an exact join has to
    follow. Every task gets the bits, as the words that are not zero: 2**20 of them at most, whatever the tables.
    """
    bits = min(1 << max((BITS_A_TAG * tags.count() - 1).bit_length(), 6), MOST_BITS)
    spots = tags.select(F.col(tags.columns[0]).bitwiseAND(F.lit(bits - 1)).alias("spot"))
    words = spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(spot % 64 AS INT))")).alias("set"))
    placed = rows.withColumn("spot", tag.bitwiseAND(F.lit(bits - 1))).withColumn("word", F.shiftright("spot", 6))
    among = F.coalesce(F.getbit("set", (F.col("spot") % 64).cast("int")) == 1, F.lit(False))
    return placed.join(F.broadcast(words), "word", "left").withColumn("among", among).drop("word", "spot", "set")


def packed(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the text as ``packed``: compressed UTF-8, so that a shuffle moves a third of it. Null becomes empty."""

    def make():
        press = zstandard.ZstdCompressor(level=1)

        def work(texts: pa.Array) -> list[pa.Array]:
            return [pa.array([press.compress((t or "").encode()) for t in texts.to_pylist()], pa.binary())]

        return work

    return with_results(df, text, [StructField("packed", BinaryType())], make, keep).select("row.*", "packed")


def unpacked(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the text in place of ``packed``, the last column."""
    let_workers_import(df.sparkSession)
    *others, last = df.schema.fields

    def run(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            at = batch.num_columns - 1
            texts = pa.array([open_.decompress(p.as_py()).decode() for p in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts], [*batch.schema.names[:at], text])

    return df.mapInArrow(run, StructType([*others, StructField(text, StringType())]))
