"""Benchmark decontamination by winnowing.

Of each run of ``WINDOW - GRAM + 1`` consecutive word-gram hashes the smallest is a fingerprint (of equal ones the last).
Two texts that share ``WINDOW`` consecutive words choose the same fingerprint inside the shared words, so every shared window
meets in the join of fingerprints. A hit is then extended to all windows around it, whose digests are joined with those of the
items. Items shorter than a window have one fingerprint, that of all their words, and are looked up under their own length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tableloom.llm.common import hold_nothing, mix64, span_hashes, text_bytes, with_results, word_spans
from tableloom.session import freeze

WINDOW = 10
GRAM = 4

#: Bits of the sieve of benchmark fingerprints that every task gets: its size is fixed, whatever the benchmark's.
SIEVE_BITS = 20

#: Bytes of text in a pass: its words and n-grams take some fifty times as much.
PASS = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words, from the words' hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[:len(words) - n + 1].copy()
    for j in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[j:len(words) - n + 1 + j]
    return mix64(out + np.uint64(n))


def fingerprints(grams: np.ndarray, span: int, first: np.ndarray) -> np.ndarray:
    """Positions of the smallest of each ``span`` grams. ``first`` has for each gram the end of its text's grams."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, span):
        less = grams[j:n + j] <= best
        best[less] = grams[j:n + j][less]
        at[less] = np.flatnonzero(less) + j
    whole = np.arange(n) + span <= first[:n]
    chosen = np.zeros(len(grams), bool)
    chosen[at[whole]] = True
    return np.flatnonzero(chosen)


class Words:
    """The words of an array of texts, with the borders of the texts."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_bytes(texts)
        self.data = LOWER[data]
        self.starts, self.ends, self.first = word_spans(self.data, WORD, offsets)
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), self.counts)
        self.end = np.repeat(self.first[1:], self.counts)

    def grams(self, n: int) -> np.ndarray:
        return gram_hashes(self.hashes, n)

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each position on lie in one text."""
        m = max(len(self.hashes) - n + 1, 0)
        return np.arange(m) + n <= self.end[:m]

    def fingerprints(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        hashes = self.grams(gram)
        at = fingerprints(hashes, window - gram + 1, self.end[:len(hashes)] - gram + 1)
        return at, hashes[at]

    def digest(self, at: int, n: int) -> bytes:
        words = [self.data[a:b].tobytes() for a, b in zip(self.starts[at:at + n], self.ends[at:at + n], strict=True)]
        return hashlib.md5(b" ".join(words)).digest()


def _lists(per_text: np.ndarray, texts: int, values: pa.Array) -> pa.Array:
    """Values in the order of their texts as one list for each text."""
    offsets = np.zeros(texts + 1, np.int32)
    np.cumsum(np.bincount(per_text, minlength=texts), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def item_index(items: DataFrame, item_id: str, text: str, window: int, gram: int) -> DataFrame:
    """A row for each fingerprint and each window of an item: item_id, size, fingerprint (null for a window), digest (null for a fingerprint)."""
    entry = StructType([StructField("size", IntegerType()), StructField("print", LongType()), StructField("digest", BinaryType())])

    def work(texts: pa.Array) -> list[pa.Array]:
        words = Words(texts)
        at, prints = words.fingerprints(window, gram)
        rows = [(t, window, p, None) for t, p in zip(words.text[at].tolist(), prints.view(np.int64).tolist(), strict=True)]
        rows += [(int(words.text[a]), window, None, words.digest(int(a), window)) for a in np.flatnonzero(words.whole(window))]
        for t in np.flatnonzero((words.counts > 0) & (words.counts < window)).tolist():
            a, n = int(words.first[t]), int(words.counts[t])
            rows.append((t, n, int(gram_hashes(words.hashes[a:a + n], n).view(np.int64)[0]), None))
            rows.append((t, n, None, words.digest(a, n)))
        rows.sort(key=lambda r: r[0])
        values = pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in ((1, pa.int32()), (2, pa.int64()), (3, pa.binary()))], ["size", "print", "digest"]
        )
        return [_lists(np.array([r[0] for r in rows], np.int64), len(texts), values)]

    out = with_results(items, text, [StructField("entries", ArrayType(entry))], lambda: work, keep=[item_id])
    return out.select(F.col(f"row.`{item_id}`").alias("item_id"), F.explode("entries").alias("e")).select("item_id", "e.*")


def find_windows(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", item_text: str = "text",
    window: int = WINDOW, gram: int = GRAM, keep: list[str] | None = None,
) -> DataFrame:
    """Each document's row with ``n_words``, ``n_hit``, ``item_ids`` (as strings, sorted) and ``hit_spans`` (word ranges of occurrences).

    Null and empty texts have no words and no hits; an item without words matches nothing; an item without id hits
    words but is not listed; equal items are all listed; each of repeated document rows gets its own result. Empty
    tables give no rows, or no hits.
    """
    index = freeze(item_index(items, item_id, item_text, window, gram), "items")
    prints = index.where("print IS NOT NULL").select("size", "print").distinct()
    bits = prints.select((F.col("print").bitwiseAND((1 << SIEVE_BITS) - 1)).cast("int").alias("b")).distinct()
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    sieve[[r[0] for r in bits.collect()]] = True  # as many values as the sieve has bits, at most
    sizes = sorted(r[0] for r in prints.where(F.col("size") < window).select("size").distinct().collect())  # below the window's size
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(sieve))

    near = StructType([StructField("start", IntegerType()), StructField("digest", BinaryType())])
    hit = StructType([StructField("size", IntegerType()), StructField("print", LongType()), StructField("windows", ArrayType(near))])

    def make():
        hold_nothing()
        flags = np.unpackbits(sent.value).astype(bool)
        low = np.uint64((1 << SIEVE_BITS) - 1)

        def work(texts: pa.Array) -> list[pa.Array]:
            words = Words(texts)
            at, found = words.fingerprints(window, gram)
            some = flags[(found & low).astype(np.int64)]
            hits = [(window, a, p) for a, p in zip(at[some].tolist(), found[some].view(np.int64).tolist(), strict=True)]
            for n in sizes:
                grams = words.grams(n)
                some = np.flatnonzero(flags[(grams & low).astype(np.int64)] & words.whole(n))
                hits += [(n, a, p) for a, p in zip(some.tolist(), grams[some].view(np.int64).tolist(), strict=True)]
            rows, known = [], {}
            for n, a, p in hits:
                t = int(words.text[a])
                begin, end = int(words.first[t]), int(words.first[t + 1])
                around = range(max(begin, a - window + gram), min(a, end - window) + 1) if n == window else [a]
                for s in around:
                    if (s, n) not in known:
                        known[s, n] = words.digest(s, n)
                rows.append((t, n, p, [{"start": s - begin, "digest": known[s, n]} for s in around]))
            rows.sort(key=lambda r: r[0])
            values = pa.array([{"size": n, "print": p, "windows": w} for _, n, p, w in rows], HIT)
            return [pa.array(words.counts.astype(np.int64)), _lists(np.array([r[0] for r in rows], np.int64), len(texts), values)]

        return work

    out = with_results(docs, text, [StructField("n_words", LongType()), StructField("hits", ArrayType(hit))], make, keep, PASS)
    rows = freeze(out.withColumn("at", F.monotonically_increasing_id()), "prints")

    matched = rows.select("at", F.explode("hits").alias("h")).select("at", "h.*").join(prints, ["size", "print"], "left_semi")
    near_hits = matched.select("at", "size", F.explode("windows").alias("w")).select("at", "size", "w.start", "w.digest").distinct()
    windows = index.where("digest IS NOT NULL").select("size", "digest", "item_id")
    found = near_hits.join(windows.select("size", "digest").distinct(), ["size", "digest"], "left_semi")
    spans = found.groupBy("at").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("hit_spans"))
    listed = (
        found.select("at", "size", "digest").distinct()
        .join(windows.where("item_id IS NOT NULL").select("size", "digest", F.col("item_id").cast("string").alias("item")).distinct(), ["size", "digest"])
        .groupBy("at").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    )
    covered = F.aggregate(
        "hit_spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["end"], s["start"]))).alias("n"),
        ),
    )["n"]
    return (
        rows.select("row", "n_words", "at").join(spans, "at", "left").join(listed, "at", "left").select(
            "row", "n_words", F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "hit_spans",
        )
    )


HIT = pa.struct([("size", pa.int32()), ("print", pa.int64()), ("windows", pa.list_(pa.struct([("start", pa.int32()), ("digest", pa.binary())])))])
