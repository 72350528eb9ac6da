"""Scoring texts by context-tree weighting over bytes.

A context is up to ``DEPTH`` bytes before a byte. The byte is taken apart into eight binary choices, from its highest bit on, so each context
has a node for every beginning of a byte, with the counts of both choices. A node's estimate after Krichevsky and Trofimov is
mixed half and half with the product of its longer contexts' mixtures, up to the empty context: no depth is chosen, all of them vote, each
with the weight that its code length on the training texts has earned.

Texts are gathered into segments. A segment's different runs of ``DEPTH + 1`` bytes, and its different words, are dealt to parts and travel there
packed, a row for each part. A part adds up what all segments have of its runs and works out the trees under its contexts of two
bytes; the two depths above, which have 255 * 257 nodes at most, are put together on the driver. Every run then has one logarithm, which a
part sends back to the segments that asked for it, segment by segment as they stream past.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tableloom.llm.common import MIX, let_workers_import, mix64, span_hashes, text_bytes
from tableloom.llm.segments import Tokens, gathered, lowered
from tableloom.session import freeze

DEPTH = 5

#: Stands before and after a text: no byte of UTF-8 has this value.
EDGE = 0xFF

#: Bytes of text in a segment, and in one numpy pass over a part of it.
SEGMENT_BYTES, PASS_BYTES = 32 << 20, 1 << 19

#: Parts that runs, and words, are dealt to.
PARTS = 4_096

WORD = np.ones(256, bool)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Stands for the end of a text among the words, which are never empty.
END = ""

LOG_2 = np.log(2.0)


def runs_of_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text, and for its end: the text's number, and the byte under the ``DEPTH`` before it as one number."""
    data, offsets = text_bytes(texts)
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)
    padded = np.full(len(data) + (DEPTH + 1) * len(sizes), EDGE, np.int64)
    padded[np.arange(len(data)) + (DEPTH + 1) * text + DEPTH] = data
    of = np.repeat(np.arange(len(sizes)), sizes + 1)
    at = np.arange(len(of)) + DEPTH * of
    out = np.zeros(len(of), np.int64)
    for j in range(DEPTH + 1):
        out = out << 8 | padded[at + j]
    return of, out


def _log_gamma(n: np.ndarray, start: float) -> np.ndarray:
    """log of gamma(n + start), by Stirling's series beyond a shift of 8."""
    x = n + start + 8
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    for j in range(8):
        series = series - np.log(n + start + j)
    return series


def log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log of gamma(n + 1/2) / gamma(1/2)."""
    return _log_gamma(n, 0.5) - 0.5 * np.log(np.pi)


def log_gamma_one(n: np.ndarray) -> np.ndarray:
    """log of gamma(n + 1)."""
    return _log_gamma(n, 1.0)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of so many zeros and ones in a row."""
    zeros, ones = zeros.astype(float), ones.astype(float)
    return log_gamma_half(zeros) + log_gamma_half(ones) - log_gamma_one(zeros + ones)


class Level:
    """The nodes of one depth and one number of known bits: keys, counts, and both sides of their mixture."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.keys, self.zeros, self.ones, self.below = keys, zeros, ones, below
        self.own = log_estimate(zeros, ones)
        self.mixed = self.own if below is None else np.logaddexp(self.own, below) - LOG_2

    def above(self, depth: int) -> tuple[Level, np.ndarray]:
        """The nodes of the contexts with ``depth`` bytes, and which of them each node here is under."""
        keys, at = np.unique((self.keys >> 8 & (1 << 8 * depth) - 1) << 8 | self.keys & 255, return_inverse=True)
        add = lambda values: np.bincount(at, values, len(keys))
        return Level(keys, add(self.zeros), add(self.ones), add(self.mixed)), at

    def predict(self, bits: np.ndarray, at: np.ndarray, longer: np.ndarray | None) -> np.ndarray:
        """The probability of each bit at its node, given what the longer contexts say."""
        estimate = (np.where(bits == 1, self.ones[at], self.zeros[at]) + 0.5) / (self.zeros[at] + self.ones[at] + 1)
        if longer is None:
            return estimate
        weight = 1 / (1 + np.exp(np.clip(self.below - self.own, -700, 700)))[at]
        return weight * estimate + (1 - weight) * longer


def levels(runs: np.ndarray, counts: np.ndarray, bit: int, least: int) -> tuple[np.ndarray, list[tuple[Level, np.ndarray]]]:
    """The values of one bit of the runs, and the nodes of depth ``DEPTH`` down to ``least`` with each run's place among them."""
    known = (1 << bit) | (runs & 255) >> (8 - bit)
    bits = runs >> (7 - bit) & 1
    keys, at = np.unique((runs >> 8) << 8 | known, return_inverse=True)
    deepest = Level(keys, np.bincount(at, counts * (1 - bits), len(keys)), np.bincount(at, counts * bits, len(keys)), None)
    out = [(deepest, at)]
    for depth in range(DEPTH - 1, least - 1, -1):
        level, up = out[-1][0].above(depth)
        out.append((level, up[out[-1][1]]))
    return bits, out


class Roots:
    """The nodes of depth 1 and 0, in arrays by last byte and known bits."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        self.one = Level(np.arange(256 * 256), zeros.ravel(), ones.ravel(), below.ravel())
        self.none = Level(np.arange(256), zeros.sum(axis=0), ones.sum(axis=0), self.one.mixed.reshape(256, 256).sum(axis=0))

    def predict(self, runs: np.ndarray, bit: int, bits: np.ndarray, longer: np.ndarray) -> np.ndarray:
        known = (1 << bit) | (runs & 255) >> (8 - bit)
        return self.none.predict(bits, known, self.one.predict(bits, (runs >> 8 & 255) << 8 | known, longer))


def fit_roots(sums: DataFrame) -> Roots:
    """From a row of ``keys, n`` for each part: the trees under each two bytes are summed up in their tasks, 65,280 rows at most come to the driver."""
    let_workers_import(sums.sparkSession)

    def run(batches):
        for batch in batches:
            for keys, n in zip(batch.column(0), batch.column(1)):
                runs, n = from_planes(keys.as_py(), "<i8"), from_planes(n.as_py(), "<i8")
                runs, n = runs[n > 0], n[n > 0]
                for bit in range(8 if len(runs) else 0):
                    level = levels(runs, n, bit, 2)[1][-1][0]
                    yield pa.RecordBatch.from_arrays([pa.array(level.keys & 0xFFFF), pa.array(level.zeros), pa.array(level.ones), pa.array(level.mixed)], ["node", "zeros", "ones", "below"])

    nodes = sums.select("keys", "n").mapInArrow(run, "node long, zeros double, ones double, below double")
    found = nodes.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).toArrow()
    at = found["node"].to_numpy()
    arrays = []
    for name in ("zeros", "ones", "below"):
        arrays.append(np.zeros(256 * 256))
        arrays[-1][at] = found[name].to_numpy()
    return Roots(*(a.reshape(256, 256) for a in arrays))


def log_probabilities(runs: np.ndarray, n: np.ndarray, roots: Roots) -> np.ndarray:
    """The log10 of each run's last byte's probability after the bytes before it; all runs of their contexts of two bytes must be there."""
    total = np.zeros(len(runs))
    for bit in range(8):
        bits, nodes = levels(runs, n, bit, 2)
        p = None
        for level, at in nodes:
            p = level.predict(bits, at, p)
        total += np.log10(roots.predict(runs, bit, bits, p))
    return total


def _packed_segments(df: DataFrame, text: str, trained: Column, keep: list[str]) -> DataFrame:
    """``segment, trained, row, packed`` of all rows, segment by segment."""
    rows = df.select(F.coalesce(trained, F.lit(False)).alias("trained"), F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for number, table in gathered(batches, limit=SEGMENT_BYTES):
            for batch in table.to_batches():
                packed = pa.array([press.compress(t.encode()) for t in batch.column(2).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), number)), batch.column(0), batch.column(1), packed], ["segment", "trained", "row", "packed"])

    return rows.mapInArrow(run, StructType([StructField("segment", LongType()), rows.schema["trained"], rows.schema["row"]]).add("packed", "binary"))


def _passes(packed: pa.Array):
    """Row ranges with their texts, about ``PASS_BYTES`` each. What the work before held goes back to the system first."""
    pa.default_memory_pool().release_unused()
    unpack = zstandard.ZstdDecompressor()
    start, held, size = 0, [], 0
    for i, p in enumerate(packed):
        held.append(unpack.decompress(p.as_py()))
        size += len(held[-1])
        if size >= PASS_BYTES:
            yield start, pa.array(held, pa.binary()).cast(pa.string())
            start, held, size = i + 1, [], 0
    if held:
        yield start, pa.array(held, pa.binary()).cast(pa.string())


class _Sums:
    """Counts of numbers added up pass by pass."""

    def __init__(self):
        self.keys, self.n, self.new = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.new.append((keys, n))
        if sum(len(k) for k, _ in self.new) > max(len(self.keys), 1 << 20):
            self.fold()

    def fold(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.new)])
        n = np.concatenate([self.n, *(c for _, c in self.new)])
        self.keys, at = np.unique(keys, return_inverse=True)
        self.n = np.bincount(at, n, len(self.keys)).astype(np.int64)
        self.new = []


def _by_segment(batches):
    """The packed texts of a task, each with its segment and whether it is trained on, in runs of one segment."""
    for batch in batches:
        segment = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(segment)) + 1).tolist(), len(segment)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield int(segment[a]), batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False), batch.column(2).slice(a, b - a)


def planes(values: np.ndarray) -> bytes:
    """Numbers of eight bytes as all first bytes, then all second ones and so on: what shuffles and files compress far better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _dealt(keys: np.ndarray) -> np.ndarray:
    """The part of each run, which that of all runs after the same two bytes is."""
    return (mix64(keys >> 8 & 0xFFFF) >> np.uint64(40)).astype(np.int64) % PARTS


PACKED = "part int, segment long, keys binary, n binary"


def _packed(segment: int, part: np.ndarray, pack, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A segment's rows of keys sorted by part; ``pack`` gives the bytes of a range of keys."""
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)).tolist()
    spans = list(zip(cuts, cuts[1:]))
    n = n.astype("<i8")
    for i in range(0, len(spans), 512):
        some = spans[i:i + 512]
        yield pa.RecordBatch.from_arrays([
            pa.array([int(part[a]) for a, _ in some], pa.int32()), pa.array([segment] * len(some), pa.int64()),
            pa.array([pack(a, b) for a, b in some], pa.binary()), pa.array([planes(n[a:b]) for a, b in some], pa.binary()),
        ], ["part", "segment", "keys", "n"])


def run_counts(parts: DataFrame) -> DataFrame:
    """A segment's different runs of bytes, with their occurrences in training texts, which may be none: a row for each part."""

    def run(batches):
        sums, segment = _Sums(), None

        def out():
            sums.fold()
            part = _dealt(sums.keys)
            order = np.argsort(part, kind="stable")
            keys = sums.keys[order].astype("<i8")
            yield from _packed(segment, part[order], lambda a, b: planes(keys[a:b]), sums.n[order])

        for number, trained, packed in _by_segment(batches):
            if number != segment and segment is not None:
                yield from out()
                sums = _Sums()
            segment = number
            for start, texts in _passes(packed):
                of, runs = runs_of_bytes(texts)
                used = trained[start:start + len(texts)][of]
                sums.add(*np.unique(runs[used], return_counts=True))
                rest = np.unique(runs[~used])
                sums.add(rest, np.zeros(len(rest), np.int64))
        if segment is not None:
            yield from out()

    return parts.select("segment", "trained", "packed").mapInArrow(run, PACKED)


def word_counts(parts: DataFrame) -> DataFrame:
    """As `run_counts` for words, joined by line ends, and for the end of a text."""

    def run(batches):
        held, segment, rows = [], None, 0

        def out():
            summed = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).combine_chunks()
            words = summed["word"].chunk(0)
            data, offsets = text_bytes(words)
            part = (span_hashes(data, offsets[:-1], offsets[1:]) >> np.uint64(40)).astype(np.int64) % PARTS
            order = np.argsort(part, kind="stable")
            words = words.take(pa.array(order))
            yield from _packed(segment, part[order], lambda a, b: "\n".join(words.slice(a, b - a).to_pylist()).encode(), summed["n_sum"].to_numpy()[order])

        for number, trained, packed in _by_segment(batches):
            if number != segment and segment is not None:
                yield from out()
                held, rows = [], 0
            segment = number
            for start, texts in _passes(packed):
                tokens = Tokens(*lowered(texts), WORD)
                used = trained[start:start + len(texts)]
                n = np.bincount(tokens.ids, used[tokens.text], len(tokens.words)).astype(np.int64)
                held.append(pa.table({"word": pa.concat_arrays([tokens.words, pa.array([END])]), "n": np.append(n, int(used.sum()))}))
                rows += len(n)
                if rows > 500_000:
                    held = [pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"]).combine_chunks()]
                    rows = 0
        if segment is not None:
            yield from out()

    return parts.select("segment", "trained", "packed").mapInArrow(run, PACKED)


def _words(keys: bytes) -> list[str]:
    return keys.decode().split("\n")


def summed(packed: DataFrame, words: bool) -> DataFrame:
    """``part, keys, n``: each part's different keys and their sums over all segments."""
    let_workers_import(packed.sparkSession)

    def run(batches):
        part, sums, counts = None, _Sums(), {}

        def out():
            sums.fold()
            keys = "\n".join(counts).encode() if words else planes(sums.keys.astype("<i8"))
            n = np.fromiter(counts.values(), "<i8", len(counts)) if words else sums.n.astype("<i8")
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([keys], pa.binary()), pa.array([planes(n)], pa.binary())], ["part", "keys", "n"])

        for batch in batches:
            for own, keys, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if own != part and part is not None:
                    yield from out()
                    sums, counts = _Sums(), {}
                part, n = own, from_planes(n.as_py(), "<i8")
                if words:
                    for word, c in zip(_words(keys.as_py()), n.tolist()):
                        counts[word] = counts.get(word, 0) + c
                else:
                    sums.add(from_planes(keys.as_py(), "<i8"), n)
        if part is not None:
            yield from out()

    return packed.select("part", "keys", "n").repartition("part").sortWithinPartitions("part").mapInArrow(run, "part int, keys binary, n binary")


def answered(packed: DataFrame, sums: DataFrame, words: bool) -> DataFrame:
    """``segment, is_word, keys, values``: what every segment asked for, from its part's sums or logarithms (``n``)."""
    let_workers_import(packed.sparkSession)

    def run(batches):
        known: tuple | dict = {}
        for batch in batches:
            found = []
            for segment, keys, n in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if segment is None:  # the part's own row, which comes first
                    names, values = (_words(keys.as_py()) if words else from_planes(keys.as_py(), "<i8")), from_planes(n.as_py(), "<i8" if words else "<f8")
                    known = dict(zip(names, values.tolist())) if words else (names, values)
                    continue
                asked = keys.as_py()
                values = np.array([known[w] for w in _words(asked)], float) if words else known[1][np.searchsorted(known[0], from_planes(asked, "<i8"))]
                found.append((segment, asked, planes(values.astype("<f8"))))
            yield pa.RecordBatch.from_arrays([
                pa.array([f[0] for f in found], pa.int64()), pa.array([words] * len(found)), pa.array([f[1] for f in found], pa.binary()), pa.array([f[2] for f in found], pa.binary()),
            ], ["segment", "is_word", "keys", "values"])

    rows = packed.select("part", "segment", "keys", F.lit(None).cast("binary").alias("n")).unionAll(sums.select("part", F.lit(None).cast("long").alias("segment"), "keys", "n"))
    return rows.repartition("part").sortWithinPartitions("part", F.asc_nulls_first("segment")).mapInArrow(run, "segment long, is_word boolean, keys binary, values binary")


class Lookup:
    """Values by run: one probe of a table finds most, sorted arrays have the runs that share a place with another."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(int(4 * len(keys)).bit_length(), 4)
        self.keys, self.values = keys, values
        place = self._place(keys)
        self.table = np.zeros(1 << self.bits, np.int32)
        self.table[place] = np.arange(len(keys), dtype=np.int32)
        rest = np.flatnonzero(self.table[place] != np.arange(len(keys)))
        rest = rest[np.argsort(keys[rest])]
        self.more, self.more_values = keys[rest], values[rest]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[self._place(keys)]
        out = self.values[at]
        other = np.flatnonzero(self.keys[at] != keys)
        if len(other):
            out[other] = self.more_values[np.searchsorted(self.more, keys[other])]
        return out


def score_segments(parts: DataFrame, replies: DataFrame) -> DataFrame:
    """Each row with its numbers, from its segment's values of runs and counts of words."""
    fields = [("n_tokens", LongType()), ("n_known", LongType()), ("log_counts", DoubleType()), ("score", DoubleType()), ("n_bytes", LongType())]
    schema = StructType([parts.schema["trained"], parts.schema["row"], *(StructField(n, t) for n, t in fields)])

    def run(texts_of: pa.Table, replies: pa.Table) -> pa.Table:
        of_words = replies["is_word"].combine_chunks()
        values = lambda rows: np.concatenate([from_planes(v.as_py(), "<f8") for v in rows["values"]])
        runs = replies.filter(pc.invert(of_words))
        value_of = Lookup(np.concatenate([from_planes(k.as_py(), "<i8") for k in runs["keys"]]), values(runs))
        words = replies.filter(of_words)
        names = pa.concat_arrays([pc.split_pattern(pa.array([k.as_py().decode()]), "\n").flatten() for k in words["keys"]])
        counts = values(words)
        logs = np.log10(counts + 0.1)
        end = int(pc.index(names, END).as_py())
        found = {n: np.zeros(len(texts_of), np.int64 if isinstance(t, LongType) else float) for n, t in fields}
        for start, texts in _passes(texts_of["packed"].combine_chunks()):
            stop = start + len(texts)
            of, own = runs_of_bytes(texts)
            found["score"][start:stop] = np.bincount(of, value_of(own), len(texts))
            found["n_bytes"][start:stop] = np.bincount(of, minlength=len(texts)) - 1
            tokens = Tokens(*lowered(texts), WORD)
            at = pc.index_in(tokens.words, value_set=names).to_numpy(zero_copy_only=False)[tokens.ids].astype(np.int64)
            found["n_tokens"][start:stop] = tokens.counts + 1
            found["n_known"][start:stop] = np.bincount(tokens.text, counts[at] > 0, len(texts)) + (counts[end] > 0)
            found["log_counts"][start:stop] = np.bincount(tokens.text, logs[at], len(texts)) + logs[end]
        return pa.table([texts_of["trained"], texts_of["row"], *(pa.array(a) for a in found.values())], names=[f.name for f in schema.fields])

    return parts.groupBy("segment").cogroup(replies.groupBy("segment")).applyInArrow(run, schema)


def _with_logarithms(sums: DataFrame, roots: Roots) -> DataFrame:
    sent = sums.sparkSession.sparkContext.broadcast(roots)

    def run(batches):
        for batch in batches:
            for part, keys, n in zip(batch.column(0), batch.column(1), batch.column(2)):
                values = log_probabilities(from_planes(keys.as_py(), "<i8"), from_planes(n.as_py(), "<i8"), sent.value)
                yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int32()), pa.array([keys.as_py()], pa.binary()), pa.array([planes(values.astype("<f8"))], pa.binary())], ["part", "keys", "n"])

    return sums.mapInArrow(run, "part int, keys binary, n binary")


def _different(sums: DataFrame) -> DataFrame:
    """``words``: how many of a part's keys were counted at all."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int((from_planes(n.as_py(), "<i8") > 0).sum()) for n in batch.column(0)], pa.int64())], ["words"])

    return sums.select("n").mapInArrow(run, "words long")


def score(df: DataFrame, trained: Column, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row as ``row`` with ``score``, the log10 of its text's probability, ``bits_per_byte``, its code length for each byte, and a plain word model beside it.

    ``trained`` tells which rows the models learn from. The plain model: ``n_tokens`` words and one end, of which ``n_known`` occur in training texts,
    ``train_tokens`` there are, and ``base_score``, the sum of log10((c + 0.1) / (N + 0.1 (V + 1))). A probability covers the end of the text. Null texts
    are empty and have their end alone; each of repeated rows counts and gets its result; a very long text is a segment of its own.
    Without training rows every bit of a byte is as likely as not. An empty table gives no rows.
    """
    let_workers_import(df.sparkSession)
    parts = freeze(_packed_segments(df, text, trained, keep if keep is not None else df.columns), "segments")
    runs, words = freeze(run_counts(parts), "runs"), freeze(word_counts(parts), "words")
    run_sums, word_sums = freeze(summed(runs, False), "run_sums"), freeze(summed(words, True), "word_sums")
    replies = answered(runs, _with_logarithms(run_sums, fit_roots(run_sums)), False).unionAll(answered(words, word_sums, True))
    scored = freeze(score_segments(parts, replies), "scored")
    total = scored.agg(F.coalesce(F.sum(F.when(F.col("trained"), F.col("n_tokens"))), F.lit(0))).first()[0]
    different = _different(word_sums).agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    return scored.select(
        "row", "trained", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(total + 0.1 * (different + 1)))).alias("base_score"), "score",
        (F.col("score") * F.lit(-np.log2(10.0)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
