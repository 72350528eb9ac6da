"""Collocations: phrases whose words occur together more than their parts would suggest, counted by direct-address tiles.

A task gathers texts into segments. A segment's words become ids in order of frequency, and its pairs of neighbours are cut into
tiles of ``TILE`` by ``TILE`` ids. A tile with many occurrences is counted in a dense array, addressed by the ids; the occurrences of
all others are sorted by coordinates. Counts of all segments are added up by Spark. The frequent pairs then become symbols, ranked
anew, and pairs of neighbouring symbols are counted the same way: two pairs that share a word are a phrase of three words, two of those one
of four. A part of a frequent phrase is as frequent at least, so a symbol that is not frequent in the whole corpus ends a run. Tasks know
that from a sieve of fixed size; what passes it for nothing costs rows, never results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import MIX, let_workers_import, mix64, span_hashes, text_bytes
from tableloom.llm.segments import Tokens, gathered, lowered
from tableloom.session import freeze

LONGEST = 4
LEAST = 30

#: Ids along a side of a tile, and the occurrences from which a tile is dense.
TILE, DENSE = 512, 512 * 512 // 8

#: Bytes of text in a segment.
SEGMENT_BYTES = 4 << 20

#: Phrases passed on at once, and the parts they are dealt to by hash. A segment's phrases of one part travel as one row.
PHRASES, PARTS = 200_000, 4_096

#: Bits of the sieve of frequent phrases of one length that every task gets: a fixed size.
SIEVE_BITS = 22

UNKNOWN = "und"

BREAK = np.zeros(256, bool)
BREAK[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
WORD = ~BREAK
WORD[[0x20, 0x09]] = False


def pair_counts(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of two arrays of ids, which are in order of frequency, and how often each occurs."""
    if not len(first):
        return first, second, first
    side = int(max(first.max(), second.max())) // TILE + 1
    tile = first // TILE * side + second // TILE
    sizes = np.bincount(tile)
    dense = np.flatnonzero(sizes >= DENSE)
    parts = []
    for t in dense.tolist():
        some = tile == t
        cells = np.bincount(first[some] % TILE * TILE + second[some] % TILE, minlength=TILE * TILE)
        at = np.flatnonzero(cells)
        parts.append((t // side * TILE + at // TILE, t % side * TILE + at % TILE, cells[at]))
    sparse = sizes[tile] < DENSE
    width = side * TILE
    keys, n = np.unique(first[sparse] * width + second[sparse], return_counts=True)
    parts.append((keys // width, keys % width, n))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


class Symbols:
    """The runs of a segment: at each word the id of the phrase of ``size`` words that begins there, or -1.

    Ids are in order of frequency. ``words`` has a column of dictionary entries for each word of a phrase, ``lang`` and ``hashes`` an entry
    for each id.
    """

    def __init__(self, texts: pa.ChunkedArray, langs: pa.ChunkedArray):
        data, offsets = lowered(texts)
        tokens = Tokens(data, offsets, WORD)
        piece = np.cumsum(BREAK[data], dtype=np.int32)[tokens.starts] if len(tokens.starts) else tokens.starts
        self.follows = (tokens.text[1:] == tokens.text[:-1]) & (piece[1:] == piece[:-1])
        coded = langs.combine_chunks().dictionary_encode()
        self.langs, self.dictionary = coded.dictionary, tokens.words
        lang = coded.indices.to_numpy().astype(np.int64)[tokens.text]
        many = max(len(tokens.words), 1)
        keys, self.at = _ranked(lang * many + tokens.ids)
        self.size, self.words, self.lang = 1, (keys % many)[:, None], keys // many
        self.hashes = _word_hashes(tokens.words)[self.words[:, 0]] ^ _lang_hashes(self.langs)[self.lang]

    def sift(self, sieve: np.ndarray) -> None:
        """Only ids that pass the sieve, ranked anew."""
        passing = sieve[(self.hashes & np.uint64(len(sieve) - 1)).astype(np.int64)]
        ids = np.append(np.where(passing, np.cumsum(passing) - 1, -1), -1)  # the last for places without an id
        self.at = ids[self.at]
        self.words, self.lang, self.hashes = self.words[passing], self.lang[passing], self.hashes[passing]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where two ids stand side by side, and both ids."""
        a, b = self.at[:-1], self.at[1:]
        where = np.flatnonzero((a >= 0) & (b >= 0) & self.follows)
        return where, a[where], b[where]

    def join(self) -> None:
        """Each pair of ids side by side becomes an id: a phrase of one word more."""
        where, a, b = self.pairs()
        many = max(len(self.lang), 1)
        keys, ids = _ranked(a * many + b)
        self.at = np.full(len(self.at), -1)
        self.at[where] = ids
        a, b = keys // many, keys % many
        self.size += 1
        self.words, self.lang, self.hashes = np.column_stack([self.words[a], self.words[b, -1]]), self.lang[a], _joined(self.hashes[a], self.hashes[b])

    def batches(self, words: np.ndarray, lang: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``part, lang, phrases, n``: phrases of one part and language in a row, joined by line ends, which no phrase holds."""
        part = (hashes >> np.uint64(44)).astype(np.int64) % PARTS * max(len(self.langs), 1) + lang
        order = np.argsort(part, kind="stable")
        for i in range(0, len(order), PHRASES):
            some = order[i:i + PHRASES]
            columns = [self.dictionary.take(pa.array(words[some, j])) for j in range(words.shape[1])]
            text = pc.binary_join_element_wise(*columns, " ") if len(columns) > 1 else columns[0]
            first = np.flatnonzero(np.diff(part[some], prepend=-1))
            offsets = pa.array(np.append(first, len(some)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array((part[some[first]] // max(len(self.langs), 1)).astype(np.int32)), self.langs.take(pa.array(lang[some[first]])),
                pc.binary_join(pa.ListArray.from_arrays(offsets, text), "\n"), pa.ListArray.from_arrays(offsets, pa.array(n[some], pa.int64())),
            ], ["part", "lang", "phrases", "n"])


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, most frequent first, and each occurrence's place among them."""
    found, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    return found[order], rank[at]


def _word_hashes(words: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(words)
    return span_hashes(data, offsets[:-1], offsets[1:])


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    return mix64(_word_hashes(langs) + MIX)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * MIX + b)


def phrase_counts(docs: DataFrame, size: int, sieves: list[np.ndarray], segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``lang, phrase, n`` of all phrases of ``size`` words whose parts pass the sieves of the shorter sizes.

    For size 1 a language's row of phrase '' counts all its words.
    """
    let_workers_import(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast([np.packbits(s) for s in sieves])

    def run(batches):
        flags = [np.unpackbits(s).astype(bool) for s in sent.value]
        for _, table in gathered(batches, limit=segment_bytes):
            symbols = Symbols(table["text"], table["lang"])
            if size == 1:
                n = np.bincount(symbols.at, minlength=len(symbols.lang))
                yield from symbols.batches(symbols.words, symbols.lang, symbols.hashes, n)
                total = np.bincount(symbols.lang, n, len(symbols.langs)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(total), np.int32)), symbols.langs, pa.array([""] * len(total)), pa.array(total[:, None].tolist(), pa.list_(pa.int64()))], ["part", "lang", "phrases", "n"])
                continue
            for sieve in flags[:-1]:
                symbols.sift(sieve)
                symbols.join()
            symbols.sift(flags[-1])
            _, a, b = symbols.pairs()
            a, b, n = pair_counts(a, b)
            yield from symbols.batches(np.column_stack([symbols.words[a], symbols.words[b, -1]]), symbols.lang[a], _joined(symbols.hashes[a], symbols.hashes[b]), n)

    found = docs.select("text", "lang").mapInArrow(run, "part int, lang string, phrases string, n array<long>").repartition("part")
    # each part's rows are together now, so the sums need no other exchange
    each = found.select("part", "lang", F.explode(F.arrays_zip(F.split("phrases", "\n").alias("phrase"), "n")).alias("e")).select("part", "lang", "e.phrase", "e.n")
    return each.groupBy("part", "lang", "phrase").agg(F.sum("n").alias("n")).drop("part")


def phrase_sieve(frequent: DataFrame, size: int) -> np.ndarray:
    """Flags by the low bits of phrases' hashes; a number for each flag that is set comes to the driver."""
    let_workers_import(frequent.sparkSession)
    space = np.ones(256, bool)
    space[0x20] = False

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            tokens = Tokens(data, offsets, space)
            words = _word_hashes(tokens.words)[tokens.ids].reshape(-1, size)
            hashes = [words[:, j] ^ _lang_hashes(batch.column(0)) for j in range(size)]
            while len(hashes) > 1:
                hashes = [_joined(a, b) for a, b in zip(hashes, hashes[1:])]
            at = np.unique(hashes[0] & np.uint64((1 << SIEVE_BITS) - 1))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32))], ["at"])

    sieve = np.zeros(1 << SIEVE_BITS, bool)
    sieve[frequent.select("lang", "phrase").mapInArrow(run, "at int").distinct().toArrow().column(0).to_numpy()] = True
    return sieve


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, segment_bytes: int = SEGMENT_BYTES) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, n, size`` of all phrases of up to ``longest`` words that occur ``least`` times, and ``lang, n`` of all words."""
    sieves: list[np.ndarray] = []
    tables = []
    for size in range(1, longest + 1):
        counts = freeze(phrase_counts(docs, size, sieves, segment_bytes).where((F.col("n") >= least) | (F.col("phrase") == "")), f"phrases{size}")
        if size == 1:
            totals = counts.where("phrase = ''").select("lang", "n")
        frequent = counts.where("phrase <> ''")
        tables.append(frequent.withColumn("size", F.lit(size)))
        if size < longest:
            sieves.append(phrase_sieve(frequent, size))
            if not sieves[-1].any():
                break
    out = tables[0]
    for t in tables[1:]:
        out = out.unionAll(t)
    return out, totals


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = 2_000, segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase lies in one piece between punctuation or line ends. ``a`` counts it, ``l`` and ``r`` the parts of its worst cut, ``n`` all words. A
    phrase inside a longer one that occurs four fifths as often is left out. Null texts are empty, a null language is ``und``, repeated rows
    count each, a very long text is a segment of its own. Equal scores go by count, then in byte order. Without rows, or without a frequent pair,
    there are none.
    """
    rows = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    frequent, totals = frequent_phrases(rows, least, longest, segment_bytes)
    candidates = frequent.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    part = lambda begin, length: F.array_join(F.slice("w", begin, length), " ")
    cuts = candidates.select("lang", "phrase", "a", "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    counts = frequent.select("lang", "phrase", "n")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumn("above", F.lit(2_000_000).cast("decimal(7,0)") * wide("a")).withColumn("below", wide("l") + wide("r")).withColumn("score", F.expr("above div below"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = candidates.where("size > 2").select("lang", "a", "size", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    longer = longer.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"))
    inside = longer.select("lang", part(F.col("i"), F.col("m")).alias("phrase"), F.col("a").alias("b")).groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.col("b").isNull() | (100 * wide("b") < 80 * wide("a")))

    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
