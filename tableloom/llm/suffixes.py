"""Removal of long repeated byte strings, by what earlier matches suffixes have.

A position's longest previous factor reaches ``length`` bytes exactly if, among the suffixes that share its first ``length`` bytes
(neighbours in suffix order), some has a smaller position. Only that threshold is asked for, so suffixes are compared on
their first ``length`` bytes.

Which suffixes can match at all is found by anchors: of each ``length``-byte string the smallest hash of its ``GRAM``-byte
substrings. Equal strings have equal anchors at equal places, so each string belongs to one anchor and only strings
of one anchor hash are compared. The strings of an anchor form a block of consecutive positions. A block whose bytes
all occur again is settled at once. One block of each kind of the others is sent with its bytes to where its anchor's blocks
meet; there its suffixes are sorted, and equal neighbours are matches. Anchors with very many different blocks (a line in
very many texts) are not gathered: their strings are counted by hash, folded on the map side.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tableloom.llm import common
from tableloom.llm.common import mix64, text_bytes, with_results
from tableloom.session import freeze

LENGTH = 200
GRAM = 50

#: Different blocks of one anchor that are gathered; more are counted instead.
GATHERED = 2_000

#: Bytes of text whose anchors are found in one go; each takes some dozens of bytes of memory.
ANCHORED = 1 << 20

#: Blocks whose suffixes are sorted in one go.
SORTED = 500


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = common._tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums


def _hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = common._tables(len(sums))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * common.MIX)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def blocks(texts: pa.Array, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """For each block: text, anchor hash, hash of all its bytes, first position in the text, number of positions."""
    data, offsets = text_bytes(texts)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    if len(data) < length:
        return none
    sums = _prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    grams = _hash(sums, at, at + gram)
    # the upper half of the hash, then the place: the leftmost of equal ones
    least = _sliding_least((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), length - gram + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(offsets, starts, side="right") - 1
    whole = starts + length <= offsets[text + 1]
    starts, anchor, text = starts[whole], anchor[whole], text[whole]
    if not len(starts):
        return none
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    all_bytes = mix64(_hash(sums, starts[first], starts[last] + length) + (anchor[first] - starts[first]).astype(np.uint64))
    return text[first], grams[anchor[first]], all_bytes, starts[first] - offsets[text[first]], last - first + 1


BLOCK = StructType([
    StructField("anchor", LongType()), StructField("whole", LongType()), StructField("start", IntegerType()), StructField("n", IntegerType()),
    StructField("more", ArrayType(IntegerType())),
])


def _blocks(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row for each kind of block in a text; ``more`` has the places where it occurs again in it (null: none), so that a text
    that repeats itself thousands of times is one row."""

    def work(texts: pa.Array) -> list[pa.Array]:
        text, anchor, whole, start, n = blocks(texts, length, gram)
        order = np.lexsort((start, whole, anchor, text))
        text, anchor, whole, start, n = (x[order] for x in (text, anchor, whole, start, n))
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(new)
        again = np.diff(np.append(first, len(text))) - 1
        ends = np.zeros(len(first) + 1, np.int32)
        np.cumsum(again, out=ends[1:])
        more = pa.ListArray.from_arrays(
            pa.array(ends, mask=np.append(again == 0, False)) if len(first) else pa.array(ends), pa.array(start[~new].astype(np.int32))
        )
        text, anchor, whole, start, n = (x[first] for x in (text, anchor, whole, start, n))
        offsets = np.zeros(len(texts) + 1, np.int32)
        np.cumsum(np.bincount(text, minlength=len(texts)), out=offsets[1:])
        values = pa.StructArray.from_arrays(
            [pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), more],
            ["anchor", "whole", "start", "n", "more"],
        )
        return [pa.ListArray.from_arrays(pa.array(offsets), values)]

    found = with_results(docs, "text", [StructField("blocks", ArrayType(BLOCK))], lambda: work, ["doc_id", "tag"], ANCHORED)
    return found.select("row.*", F.explode("blocks").alias("b")).select("doc_id", "tag", "b.*")


def _same_text(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.tag").eqNullSafe(F.col(f"{b}.tag"))


def _cut(packed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted blocks: ``doc_id, tag, anchor, many, start, n, bytes``."""
    lists = wanted.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("anchor", "many", "start", "n")).alias("blocks"))
    rows = packed.alias("p").join(lists.alias("l"), _same_text("p", "l")).select("p.doc_id", "p.tag", "packed", "blocks").dropDuplicates(["doc_id", "tag"])

    def run(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(len(batch)):
                doc, tag, packed, wanted = (c[i].as_py() for c in batch.columns)
                text = open_.decompress(packed)
                columns = [[b[k] for b in wanted] for k in ("anchor", "many", "start", "n")]
                cuts = [text[b["start"]:b["start"] + b["n"] - 1 + length] for b in wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(wanted), pa.int64()), pa.array([tag] * len(wanted), pa.int64()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()),
                     pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32()), pa.array(cuts, pa.binary())],
                    ["doc_id", "tag", "anchor", "many", "start", "n", "bytes"],
                )

    return rows.mapInArrow(run, "doc_id long, tag long, anchor long, many boolean, start int, n int, bytes binary")


def _suffixes(cuts: list[bytes], counts: np.ndarray, length: int) -> np.ndarray:
    """The first ``length`` bytes of all suffixes of all blocks, a row each."""
    data = np.frombuffer(b"".join(cuts), np.uint8)
    sizes = counts + length - 1
    first = np.repeat(np.cumsum(sizes) - sizes, counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.lib.stride_tricks.sliding_window_view(data, length)[first + within]


def _matched(cuts: list[bytes], counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, in order of position, whether an earlier and whether a later one has the same first bytes."""
    rows = np.ascontiguousarray(_suffixes(cuts, counts, length))
    keys = rows.view(f"V{length}").reshape(-1)
    order = np.argsort(keys, kind="stable")  # suffix order; equal ones by position
    ranked = rows[order]
    equal = (ranked[1:] == ranked[:-1]).all(axis=1)
    earlier, later = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    earlier[order[1:]] = equal
    later[order[:-1]] = equal
    return earlier, later


def _sorted_matches(segments: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """``doc_id, tag, start`` of positions with a match, anchors gathered."""
    dealt = segments.repartition("anchor").sortWithinPartitions("anchor", F.col("doc_id").asc_nulls_last(), "tag", "start")
    dealt = dealt.select("anchor", "doc_id", "tag", "start", "n", "bytes")

    def done(held):
        doc, tag, start, n, cuts = (list(c) for c in zip(*(h[1:] for h in held), strict=True))
        counts = np.array(n)
        earlier, later = _matched(cuts, counts, length)
        hit = np.flatnonzero(earlier if keep_first else earlier | later)
        of = np.repeat(np.arange(len(held)), counts)[hit]
        place = np.array(start)[of] + hit - (np.cumsum(counts) - counts)[of]
        docs = pa.array(doc, pa.int64()).take(pa.array(of))
        tags = pa.array(tag, pa.int64()).take(pa.array(of))
        return pa.RecordBatch.from_arrays([docs, tags, pa.array(place.astype(np.int32))], ["doc_id", "tag", "start"])

    def run(batches):
        held, ready = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != held[-1][0]:
                    ready = len(held)
                    if ready >= SORTED:
                        yield done(held)
                        held, ready = [], 0
                held.append(row)
        if held:
            yield done(held)

    return dealt.mapInArrow(run, "doc_id long, tag long, start int")


def _counted_matches(segments: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """The same for anchors with too many blocks to gather: their strings are grouped by hash."""

    def run(batches):
        for batch in batches:
            for doc, tag, anchor, start, n, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums = _prefix_sums(np.frombuffer(cut, np.uint8))
                at = np.arange(n)
                found = _hash(sums, at, at + length).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * n, pa.int64()), pa.array([tag] * n, pa.int64()), pa.array([anchor] * n, pa.int64()), pa.array((start + at).astype(np.int32)), pa.array(found)],
                    ["doc_id", "tag", "anchor", "start", "string"],
                )

    strings = segments.select("doc_id", "tag", "anchor", "start", "n", "bytes").mapInArrow(run, "doc_id long, tag long, anchor long, start int, string long")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag", "start")
    met = strings.groupBy("anchor", "string").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("first")).where("copies > 1")
    again = strings.join(met, ["anchor", "string"])
    return (again.where(place != F.col("first")) if keep_first else again).select("doc_id", "tag", "start")


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, keep_first: bool = True,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) and ``kept_sha256``.

    A byte is removed if a ``length``-byte string that covers it starts at an earlier position too, or with ``keep_first`` off
    anywhere else. Positions are in the order of doc_id (null last), then of the text's hash; matches stay inside a
    document, and are judged on the input. Rows with one doc_id and one text count as copies of each other; keeping the first,
    they count as one document that is listed again. Null texts are empty; texts below ``length`` bytes are kept whole.
    """
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("tag", F.xxhash64("text"))
    found = _blocks(source, length, gram)
    if keep_first:
        found = found.distinct()
    # windows spill, so an anchor of very many blocks needs no memory
    group = Window.partitionBy("anchor")
    kind = Window.partitionBy("anchor", "whole")
    order = kind.orderBy(F.col("doc_id").asc_nulls_last(), "tag", "start")
    ranked = found.repartition("anchor").select(
        "doc_id", "tag", "anchor", "start", "n", "more", F.sum(F.when(F.col("more").isNull(), 1).otherwise(1 + F.size("more"))).over(kind).alias("copies"), F.row_number().over(order).alias("nth"),
        (F.min("whole").over(group) != F.max("whole").over(group)).alias("differ"),
    ).where("copies > 1 OR differ")
    ranked = ranked.withColumn("many", F.sum((F.col("nth") == 1).cast("int")).over(group) > GATHERED)
    repeated = freeze(ranked, "blocks")

    later = F.coalesce("more", F.array().cast("array<int>"))
    places = F.concat(F.array("start"), later)
    gone = F.when(F.col("nth") > 1, places).otherwise(later) if keep_first else places
    settled = repeated.where("copies > 1").select("doc_id", "tag", F.explode(gone).alias("start"), (F.col("n") + (length - 1)).alias("size"))
    packed = common.packed(source, "text", ["doc_id", "tag"])
    segments = freeze(_cut(packed, repeated.where("nth = 1 AND differ"), length), "segments")
    positions = _sorted_matches(segments.where("NOT many"), length, keep_first).union(_counted_matches(segments.where("many"), length, keep_first))
    spans = settled.union(positions.withColumn("size", F.lit(length)))
    spans = spans.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    rows = packed.alias("p").join(spans.alias("s"), _same_text("p", "s"), "left").select("p.doc_id", "packed", "spans")

    def run(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            out = [[] for _ in range(6)]
            held = 0
            for i in range(len(batch)):
                data = np.frombuffer(open_.decompress(batch.column(1)[i].as_py()), np.uint8)
                spans = batch.column(2)[i].values
                edges = np.zeros(len(data) + 1, np.int32)
                if spans is not None and len(spans):
                    start, size = (spans.field(k).to_numpy() for k in (0, 1))
                    np.add.at(edges, start, 1)
                    np.add.at(edges, start + size, -1)
                gone = np.cumsum(edges[:-1]) > 0
                kept = data[~gone].tobytes()
                runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
                for column, value in zip(out, (batch.column(0)[i].as_py(), len(data), int(gone.sum()), runs, kept, hashlib.sha256(kept).hexdigest()), strict=True):
                    column.append(value)
                held += len(kept)
                if held > common.PASS_BYTES or i == len(batch) - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, KINDS, strict=True)], RESULT.names)
                    out, held = [[] for _ in range(6)], 0

    return rows.mapInArrow(run, RESULT)


KINDS = [pa.int64()] * 4 + [pa.binary(), pa.string()]
RESULT = StructType([
    StructField("doc_id", LongType()), StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()),
    StructField("kept", BinaryType()), StructField("kept_sha256", StringType()),
])
