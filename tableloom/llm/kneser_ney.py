"""Interpolated Kneser-Ney character models of several classes, counted by Spark over all training texts.

A model sees words (runs of letters, lower-cased), each padded so that every character has a full context. Counts of the
top order are taken as they are; a lower order counts in how many different longer n-grams it ends. N-grams are
addressed by the first 60 bits of their md5 and kept in sorted arrays. Even ten million of them leave no two of one address (odds of
one in 20,000), so every n-gram has its own counts, and a model grows with the different n-grams of the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import held_by_worker, let_workers_import
from tableloom.session import freeze

WORDS = re.compile(r"[^\W\d_]+")
START, STOP = "\x02", "\x03"

#: Words counted in a task before they are turned into n-grams and passed on.
HELD_WORDS = 50_000

#: Words, and n-grams, whose values a worker keeps; then it starts anew.
MEMO_WORDS, MEMO_GRAMS = 200_000, 150_000

#: Bits of an n-gram's address.
KEY_BITS = 60

# What a collected number is about.
GRAM, CONTEXT, DISCOUNT = 0, 1, 2


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def grams_of(word: str, order: int) -> list[str]:
    padded = START * (order - 1) + word + STOP
    return [padded[i:i + order] for i in range(len(word) + 1)]


def count_grams(rows: DataFrame, order: int) -> DataFrame:
    """``label, gram, n`` over all words of all rows (``label``, ``text``); added up in each task before the shuffle."""

    def run(batches):
        words: dict[str, Counter] = {}

        def grams():
            for label, counts in words.items():
                out: Counter = Counter()
                for word, n in counts.items():
                    for gram in grams_of(word, order):
                        out[gram] += n
                keys = list(out)
                for i in range(0, len(keys), 50_000):
                    part = keys[i:i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([label] * len(part)), pa.array(part), pa.array([out[g] for g in part], pa.int64())], ["label", "gram", "n"])
            words.clear()

        for batch in batches:
            for label, text in zip(batch.column(0), batch.column(1), strict=True):
                words.setdefault(label.as_py(), Counter()).update(words_of(text.as_py()))
                if sum(map(len, words.values())) > HELD_WORDS:
                    yield from grams()
        yield from grams()

    found = rows.select(F.col("label").cast("string").alias("label"), "text").mapInArrow(run, "label string, gram string, n long")
    return found.groupBy("label", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Table:
    """One order: n-gram counts and context counts by slot, an entry for each class (or the one that all share) that has any.

    Entries ``starts[i]`` to ``starts[i + 1]`` are those of slot ``i``, so a class costs nothing where it has no count.
    """

    slots: np.ndarray
    starts: np.ndarray
    of: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    context_starts: np.ndarray
    context_of: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray
    discounts: np.ndarray


@dataclass
class Model:
    classes: list[str]
    order: int
    slot_bits: int
    letters: int
    tables: list[Table] = field(default_factory=list)

    def slots(self, grams: list[str]) -> np.ndarray:
        mask = (1 << self.slot_bits) - 1
        return np.fromiter((int.from_bytes(hashlib.md5(g.encode(), usedforsecurity=False).digest()[:8], "big") >> 4 & mask for g in grams), np.int64, len(grams))

    def log_probabilities(self, grams: list[str]) -> np.ndarray:
        """log p of each top-order n-gram's last character, by class."""
        p = np.full((len(grams), len(self.classes)), 1.0 / (self.letters + 1))
        for k, t in enumerate(self.tables, start=1):
            ends = [g[len(g) - k:] for g in grams]
            width = len(t.discounts)
            (count,) = _look_up(t.slots, t.starts, t.of, [t.counts], self.slots(ends), width)
            total, kinds = _look_up(t.contexts, t.context_starts, t.context_of, [t.totals, t.kinds], self.slots([e[:-1] for e in ends]), width)
            known = total > 0
            safe = np.where(known, total, 1.0)
            p = np.where(known, np.maximum(count - t.discounts, 0) / safe + t.discounts * np.minimum(kinds, total) / safe * p, p)
        return np.log(np.maximum(p, 1e-300))


def _look_up(keys: np.ndarray, starts: np.ndarray, of: np.ndarray, values: list[np.ndarray], wanted: np.ndarray, width: int) -> list[np.ndarray]:
    out = [np.zeros((len(wanted), width)) for _ in values]
    if len(keys):
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == wanted)
        first, sizes = starts[at[hit]], np.diff(starts)[at[hit]]
        entries = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        for o, v in zip(out, values, strict=True):
            o[np.repeat(hit, sizes), of[entries]] = v[entries]
    return out


def fit(rows: DataFrame, order: int, slot_bits: int, shared_backoff: bool = False) -> Model:
    """Fit on all rows of ``label, text``. Null labels and texts are left out; no rows give a model without classes.

    With ``shared_backoff`` only the top order is counted by class; the orders below are counted over all classes
    together, so that an expression rare in one class is smoothed by what all texts say of it.
    """
    let_workers_import(rows.sparkSession)
    rows = rows.where("label IS NOT NULL AND text IS NOT NULL")
    top = freeze(count_grams(rows, order), "grams")
    classes = sorted(r[0] for r in top.select("label").distinct().collect())
    codes = rows.sparkSession.createDataFrame(list(enumerate(classes)), "class int, label string")
    slot = lambda c: F.conv(F.substring(F.md5(c.cast("binary")), 1, 15), 16, 10).cast("long").bitwiseAND(F.lit((1 << slot_bits) - 1))
    level, parts = top.join(F.broadcast(codes), "label").select("class", "gram", F.col("n").alias("c")), []
    for k in range(order, 0, -1):
        fact = lambda kind, key, a, b: F.struct(
            F.lit(kind).alias("kind"), key.cast("long").alias("slot"), a.cast("long").alias("a"), b.cast("long").alias("b")
        )
        facts = F.array(
            fact(GRAM, slot(F.col("gram")), F.col("c"), F.lit(0)),
            fact(CONTEXT, slot(F.expr(f"substring(gram, 1, {k - 1})")), F.col("c"), F.lit(1)),
            fact(DISCOUNT, F.lit(0), F.col("c") == 1, F.col("c") == 2),
        )
        parts.append(level.select(F.lit(k).alias("k"), "class", F.explode(facts).alias("f")).select("k", "class", "f.*"))
        if k == order and shared_backoff:
            level = level.select(F.lit(0).alias("class"), "gram").distinct()
        if k > 1:
            level = freeze(level.groupBy("class", F.expr(f"substring(gram, 2, {k - 1})").alias("gram")).agg(F.count(F.lit(1)).alias("c")), "level")
    union = parts[0]
    for p in parts[1:]:
        union = union.union(p)
    union = union.groupBy("k", "kind", "class", "slot").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    union = union.select(*(F.col(c).cast("byte").alias(c) for c in ("k", "kind")), "class", "slot", "a", "b")
    arrow = union.toArrow()  # numbers only, a row for each n-gram or context of an order and class
    found = {c: arrow.column(c).to_numpy() for c in arrow.column_names}
    del arrow
    model = Model(classes, order, slot_bits, 0)
    for k in range(1, order + 1):
        width = len(classes) if k == order or not shared_backoff else 1
        of = lambda kind: {c: v[(found["k"] == k) & (found["kind"] == kind)] for c, v in found.items()}  # noqa: B023, E731
        grams, contexts, d = of(GRAM), of(CONTEXT), of(DISCOUNT)
        slots, starts, classes_of, counts, _ = _by_slot(grams)
        discounts = np.full(max(width, 1), 0.5)
        for c, a, b in zip(d["class"], d["a"], d["b"], strict=True):
            discounts[c] = min(max(a / (a + 2 * b), 0.1), 0.95) if a + b else 0.5
        model.tables.append(Table(slots, starts, classes_of, counts, *_by_slot(contexts), discounts))
        if k == 1:
            model.letters = len(slots)
    return model


def _by_slot(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Slots, where their entries start, and the entries' classes and both values."""
    order = np.lexsort((rows["class"], rows["slot"]))
    slots, starts = np.unique(rows["slot"][order], return_index=True)
    return slots, np.append(starts, len(order)), rows["class"][order].astype(np.int32), rows["a"][order].astype(np.float32), rows["b"][order].astype(np.float32)


class WordValues:
    """The log-likelihoods of words, by class, computed once in a worker for each word it meets."""

    def __init__(self, model: Model):
        self.model = model
        self.at: dict[str, int] = {}
        self.gram_at: dict[str, int] = {}
        self.values = np.zeros((0, len(model.classes)))
        self.gram_values = np.zeros((0, len(model.classes)))

    def rows(self, words: list[str]) -> np.ndarray:
        """Where each word's values are in ``values``."""
        share = max(len(self.model.classes) // 4, 1)  # many classes, fewer words
        if len(self.at) > MEMO_WORDS // share:
            self.at, self.values = {}, np.zeros((0, len(self.model.classes)))
        if len(self.gram_at) > MEMO_GRAMS // share:
            self.gram_at, self.gram_values = {}, np.zeros((0, len(self.model.classes)))
        new = list(set(words).difference(self.at))
        if new:
            order, gram_at = self.model.order, self.gram_at
            grams = [grams_of(w, order) for w in new]
            flat = [g for gs in grams for g in gs]
            unseen = list(set(flat).difference(gram_at))
            if unseen:
                self.gram_values = np.concatenate([self.gram_values, self.model.log_probabilities(unseen)])
                gram_at.update(zip(unseen, range(len(gram_at), len(gram_at) + len(unseen)), strict=True))
            found = self.gram_values[np.fromiter(map(gram_at.__getitem__, flat), np.int64, len(flat))]
            starts = np.cumsum([0, *map(len, grams)])[:-1]
            self.values = np.concatenate([self.values, np.add.reduceat(found, starts, axis=0)])
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))


def word_values(key: str, sent) -> WordValues:
    """One table for all tasks of a worker process."""
    return held_by_worker(key, lambda: WordValues(sent.value))


def sampled_texts(rows: DataFrame, most: Callable[[int, int], int]) -> tuple[DataFrame, DataFrame, dict[str, tuple[int, int]]]:
    """Of ``label, text``: the different texts of each label with the smallest hashes, once each; their ``label, tag``; and each
    label's number of rows and of texts chosen. ``most`` says how many to choose, from a label's number of texts and the number of labels.
    """
    tagged = rows.select("label", "text", F.xxhash64("text").alias("tag"))
    keys = freeze(tagged.groupBy("label", "tag").agg(F.count(F.lit(1)).alias("n")), "tags")
    seen = {r[0]: (r[1], r[2]) for r in keys.groupBy("label").agg(F.count(F.lit(1)), F.sum("n")).collect()}  # a row for each label
    wanted = {label: min(texts, most(texts, len(seen))) for label, (texts, _) in seen.items()}
    # hashes are spread evenly: below a bound lie about twice as many as are wanted, and only these are put in order
    bound = lambda texts, n: (1 << 63) - 1 if 2 * n + 100 >= texts else int(((2 * n + 100) / texts - 0.5) * (1 << 64))
    bounds = rows.sparkSession.createDataFrame([(x, bound(seen[x][0], n), n) for x, n in wanted.items()], "label string, bound long, wanted long")
    nth = F.row_number().over(Window.partitionBy("label").orderBy("tag"))
    chosen = freeze(keys.join(F.broadcast(bounds), "label").where("tag <= bound").withColumn("nth", nth).where("nth <= wanted").select("label", "tag"), "chosen")
    sample = tagged.join(F.broadcast(chosen), ["label", "tag"]).groupBy("label", "tag").agg(F.min("text").alias("text")).select("label", "text")
    return sample, chosen, {label: (seen[label][1], n) for label, n in wanted.items()}
