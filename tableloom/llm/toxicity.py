"""Toxicity by two Kneser-Ney models, of toxic and of ordinary texts, whose lower orders are counted together.

A model sees words (runs of letters, lower-cased) as bytes, each byte after the ``DEPTH`` before it. A word's evidence is the difference of its
log-likelihoods under the two models. A text is described by the length-normalised difference of its likelihoods and by its
strongest words; a logistic curve turns these into a score.

Counts are Spark tables, one for each order, joined order by order to the evidence of every counted run of bytes, and of every context for
the runs that were not counted after it. Only this last table goes to the tasks that read texts, in ranges of bounded size. The curve is
fitted on some texts of each class as the models see them without the counts of these texts; lower orders, which both classes share, keep them.
"""

from __future__ import annotations

from dataclasses import dataclass
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tableloom.llm import kneser_ney
from tableloom.llm.common import MIX, held_by_worker, let_workers_import, text_batches, text_bytes
from tableloom.llm.ctw import DEPTH, runs_of_bytes
from tableloom.llm.segments import Tokens, gathered
from tableloom.session import freeze

#: Bytes of a run: the byte that is predicted and those before it.
ORDER = DEPTH + 1

#: Different texts that fit the curve, half of them of each class: of a class's texts a fifth at most, but ten of them or half if these are few.
CALIBRATION_ROWS = 4_000

#: Evidence of a word, in nats, beyond what chance resemblance gives.
STRONG = 3.0

#: Entries of the table of evidence that tasks hold at once, of 12 bytes each.
RANGE = 4_000_000

#: Marks the key of a context.
CONTEXT = 1 << 56

#: Bytes of text in one numpy pass.
PASS_BYTES = 1 << 20

FEATURES = 5

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def letters_of(texts: pa.Array) -> Tokens:
    """The words of texts: runs of letters, lower-cased; whatever is not ASCII counts as a letter."""
    return Tokens(*text_bytes(pc.utf8_lower(texts)), LETTER)


@dataclass
class Counts:
    """What both models are made of. ``top`` has a run's occurrences by class (``n0, n1``), and those in texts that fit the curve (``s0, s1``);
    ``lower[k]`` in how many different longer runs each run of k bytes ends. Discounts by the same names and orders."""

    top: DataFrame
    lower: dict[int, DataFrame]
    top_discounts: dict[str, float]
    discounts: dict[int, float]
    letters: int


@dataclass
class Scorer:
    counts: Counts
    weights: np.ndarray | None
    centre: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, features: list[Column]) -> Column:
        if self.weights is None:
            return F.lit(float(self.prior))
        z = F.lit(float(self.weights[0]))
        for f, w, c, s in zip(features, self.weights[1:], self.centre, self.scale, strict=True):
            z = z + (f - float(c)) * float(w / s)
        return 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))


def _discount(once: int, twice: int) -> float:
    return min(max(once / (once + 2 * twice), 0.1), 0.95) if once + twice else 0.5


def _tail(k: int) -> Column:
    """The last k bytes of a run."""
    return F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))


def count(rows: DataFrame) -> Counts:
    """Counts of ``label`` (0 or 1), ``sampled`` and ``text``: added up over a segment's words, then over all of them."""
    let_workers_import(rows.sparkSession)
    kinds = ("n0", "n1", "s0", "s1")

    def words(batches):
        for _, table in gathered(batches):
            tokens = letters_of(table["text"].combine_chunks())
            label, sampled = table["label"].to_numpy()[tokens.text], table["sampled"].to_numpy()[tokens.text]
            n = [np.bincount(tokens.ids[some], minlength=len(tokens.words)) for some in (label == 0, label == 1, (label == 0) & sampled, (label == 1) & sampled)]
            for i in range(0, len(tokens.words), 50_000):
                yield pa.RecordBatch.from_arrays([tokens.words[i:i + 50_000], *(pa.array(c[i:i + 50_000]) for c in n)], ["word", *kinds])

    def grams(batches):
        for batch in batches:
            of, runs = runs_of_bytes(batch.column(0))
            found, at = np.unique(runs, return_inverse=True)
            n = [np.bincount(at, batch.column(i).to_numpy()[of], len(found)).astype(np.int64) for i in range(1, 5)]
            yield pa.RecordBatch.from_arrays([pa.array(found), *(pa.array(c) for c in n)], ["gram", *kinds])

    sums = [F.sum(k).alias(k) for k in kinds]
    different = rows.select("label", "sampled", "text").mapInArrow(words, "word string, n0 long, n1 long, s0 long, s1 long").groupBy("word").agg(*sums)
    top = freeze(different.mapInArrow(grams, "gram long, n0 long, n1 long, s0 long, s1 long").groupBy("gram").agg(*sums), "top")
    without = {"n0": F.col("n0"), "n1": F.col("n1"), "h0": F.col("n0") - F.col("s0"), "h1": F.col("n1") - F.col("s1")}
    few = top.agg(*[F.count_if(c == n).alias(f"{k}_{n}") for k, c in without.items() for n in (1, 2)]).first()
    lower, discounts, level = {}, {}, top
    for k in range(ORDER - 1, 0, -1):
        level = lower[k] = freeze(level.groupBy(_tail(k).alias("gram")).agg(F.count(F.lit(1)).alias("c")), "lower")
        discounts[k] = _discount(*level.agg(F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first())
    return Counts(top, lower, {k: _discount(few[f"{k}_1"], few[f"{k}_2"]) for k in without}, discounts, lower[1].count())


def _smoothed(n: Column, total: Column, kinds: Column, discount: float, below: Column) -> Column:
    return F.when(total > 0, (F.greatest(F.coalesce(n, F.lit(0)) - discount, F.lit(0.0)) + discount * kinds * below) / total).otherwise(below)


def evidence(counts: Counts, runs: DataFrame, held: bool) -> DataFrame:
    """``gram, lean`` of the different runs in ``gram``: log-likelihood as toxic less that as ordinary; ``held``: without the counts of the curve's texts."""
    below = None
    for k in range(1, ORDER):
        level = counts.lower[k]
        contexts = level.groupBy(F.shiftright("gram", 8).alias("context")).agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
        rows = runs.select(_tail(k).alias("gram")).distinct().join(level, "gram", "left").withColumn("context", F.shiftright("gram", 8)).join(contexts, "context", "left")
        if below is None:
            rows = rows.withColumn("below", F.lit(1.0 / (counts.letters + 1)))
        else:
            rows = rows.withColumn("shorter", _tail(k - 1)).join(below, "shorter")
        p = _smoothed(F.col("c"), F.col("total"), F.col("kinds"), counts.discounts[k], F.col("below"))
        below = freeze(rows.select(F.col("gram").alias("shorter"), p.alias("below")), "below")
    own = {"0": F.col("n0"), "1": F.col("n1")} if not held else {"0": F.col("n0") - F.col("s0"), "1": F.col("n1") - F.col("s1")}
    top = counts.top.select("gram", *[c.alias(f"c{k}") for k, c in own.items()])
    contexts = top.groupBy(F.shiftright("gram", 8).alias("context")).agg(*[a for k in own for a in (F.sum(f"c{k}").alias(f"total{k}"), F.count_if(F.col(f"c{k}") > 0).alias(f"kinds{k}"))])
    rows = runs.join(top, "gram", "left").withColumn("context", F.shiftright("gram", 8)).join(contexts, "context", "left").withColumn("shorter", _tail(ORDER - 1)).join(below, "shorter")
    p = {k: _smoothed(F.col(f"c{k}"), F.col(f"total{k}"), F.col(f"kinds{k}"), counts.top_discounts[f"{'h' if held else 'n'}{k}"], F.col("below")) for k in own}
    return rows.select("gram", (F.log(F.greatest(p["1"], F.lit(1e-300))) - F.log(F.greatest(p["0"], F.lit(1e-300)))).alias("lean"))


def evidence_table(counts: Counts, held: bool) -> DataFrame:
    """``key, lean`` of every counted run, and of every context with ``CONTEXT`` set, for the runs that were not counted after it.

    Both models see an uncounted run as the context's share of unseen bytes times the same lower order, so its evidence is
    the context's alone; after a context that neither model knows there is none.
    """
    runs = evidence(counts, counts.top.select("gram"), held).select(F.col("gram").alias("key"), "lean")
    own = {"0": F.col("n0"), "1": F.col("n1")} if not held else {"0": F.col("n0") - F.col("s0"), "1": F.col("n1") - F.col("s1")}
    contexts = counts.top.groupBy(F.shiftright("gram", 8).alias("context")).agg(*[a for k, c in own.items() for a in (F.sum(c).alias(f"total{k}"), F.count_if(c > 0).alias(f"kinds{k}"))])
    share = {k: F.when(F.col(f"total{k}") > 0, counts.top_discounts[f"{'h' if held else 'n'}{k}"] * F.col(f"kinds{k}") / F.col(f"total{k}")).otherwise(F.lit(1.0)) for k in own}
    backed = contexts.select(F.col("context").bitwiseOR(F.lit(CONTEXT)).alias("key"), (F.log(share["1"]) - F.log(share["0"])).alias("lean"))
    return runs.unionAll(backed).select("key", F.col("lean").cast("float").alias("lean"))


def _range_of(ranges: int) -> Column:
    """A run and its context lie in one range."""
    context = F.when(F.col("key") >= CONTEXT, F.col("key") - CONTEXT).otherwise(F.shiftright("key", 8))
    return F.pmod(F.xxhash64(context), F.lit(ranges))


class Evidence:
    """Evidence by run, from one range of the table: one probe finds most, sorted arrays have the keys that share a place."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(int(2 * len(keys)).bit_length(), 4)
        self.keys, self.values = keys, values
        self.table = np.full(1 << self.bits, -1, np.int32)
        place = self._place(keys)
        self.table[place] = np.arange(len(keys), dtype=np.int32)
        rest = np.flatnonzero(self.table[place] != np.arange(len(keys)))
        self.rest = rest[np.argsort(keys[rest])]
        self.more = keys[self.rest]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = self.table[self._place(keys)]
        other = np.flatnonzero((at >= 0) & (self.keys[at] != keys))
        at[other] = -1
        if len(other) and len(self.more):
            near = np.minimum(np.searchsorted(self.more, keys[other]), len(self.more) - 1)
            at[other] = np.where(self.more[near] == keys[other], self.rest[near], -1)
        return at

    def of_words(self, tokens: Tokens) -> np.ndarray:
        """The evidence of each word of a dictionary."""
        of, runs = runs_of_bytes(tokens.words)
        at = self.find(runs)
        unseen = np.flatnonzero(at < 0)
        at[unseen] = self.find(runs[unseen] >> 8 | CONTEXT)
        values = np.where(at >= 0, self.values[at], 0) if len(self.values) else np.zeros(len(at))
        return np.bincount(of, values, len(tokens.words))


def described(df: DataFrame, counts: Counts, held: bool, text: str, keep: list[str]) -> DataFrame:
    """Each row as ``row`` with ``f0`` and so on: the length-normalised difference of log-likelihoods; evidence of the strongest and the second
    strongest word; log of all strong evidence; log of the number of words, as chance evidence grows with it.

    The table of evidence goes to the tasks in ranges of ``RANGE`` entries or so. With more than one, texts are passed over once for each, and
    carry what their words have gathered so far.
    """
    spark = df.sparkSession
    let_workers_import(spark)
    table = freeze(evidence_table(counts, held), "evidence")
    ranges = max(-(-table.count() // RANGE), 1)
    names = [f"f{i}" for i in range(FEATURES)]
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), F.lit(None).cast("array<float>").alias("lean"))
    for r in range(ranges):
        own = table.where(_range_of(ranges) == r).toArrow()  # of bounded size
        sent = spark.sparkContext.broadcast((own["key"].to_numpy(), own["lean"].to_numpy()))
        last, key = r == ranges - 1, uuid.uuid4().hex

        def run(batches, sent=sent, last=last, key=key):
            known = held_by_worker(key, lambda: Evidence(*sent.value))
            for batch in batches:
                row, texts, carried = batch.columns
                for start, stop in text_batches(texts, PASS_BYTES):
                    part = texts.slice(start, stop - start)
                    tokens = letters_of(part)
                    lean = known.of_words(tokens)[tokens.ids] if len(tokens.ids) else np.zeros(0)
                    before = carried.slice(start, stop - start)
                    if before.null_count < len(before):
                        lean = lean + before.flatten().to_numpy()
                    if last:
                        out = [pa.array(c) for c in features(lean, tokens).T]
                        yield pa.RecordBatch.from_arrays([row.slice(start, stop - start), *out], ["row", *names])
                    else:
                        lists = pa.ListArray.from_arrays(pa.array(tokens.first.astype(np.int32)), pa.array(lean.astype(np.float32)))
                        yield pa.RecordBatch.from_arrays([row.slice(start, stop - start), part, lists], ["row", "text", "lean"])

        if last:
            return rows.mapInArrow(run, StructType([rows.schema["row"], *(StructField(n, DoubleType()) for n in names)]))
        rows = freeze(rows.mapInArrow(run, rows.schema), "carried")


def features(lean: np.ndarray, tokens: Tokens) -> np.ndarray:
    """The description of each text from the evidence of its words."""
    sizes, of, texts = tokens.counts, tokens.text, len(tokens.counts)
    out, lean = np.zeros((texts, FEATURES)), lean.copy()
    chars = np.bincount(of, tokens.ends - tokens.starts + 1, texts)
    out[:, 0] = np.bincount(of, lean, texts) / np.maximum(chars, 1)
    out[:, 3] = np.log1p(np.bincount(of, np.maximum(lean - STRONG, 0), texts))
    out[:, 4] = np.log1p(sizes)
    some = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[some]
    for column in (1, 2):
        most = np.maximum.reduceat(lean, starts)
        out[some, column] = np.clip(most, 0, 25)
        top = np.flatnonzero(lean == np.repeat(most, sizes[some]))
        lean[top[np.unique(of[top], return_index=True)[1]]] = 0
    return out


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method with a small ridge; the intercept comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(rows: DataFrame) -> Scorer:
    """Fit on ``label`` (0 or 1) and ``text``: counts over all rows, the curve from some texts of each class, see ``CALIBRATION_ROWS``.

    Copies of a text are one for the curve, whose intercept is then moved to the classes' shares of all rows. If a class has one text
    only, the curve is fitted on the models that score. Null labels and texts are left out. If a class is missing or has no
    words, every score is the share of toxic rows (0.5 without any rows).
    """
    rows = rows.where("label IN (0, 1) AND text IS NOT NULL").select(F.col("label").cast("int").cast("string").alias("label"), "text")
    fifth = lambda texts, labels: min(CALIBRATION_ROWS // 2, max(texts // 5, min(10, -(-texts // 2))))
    sample, chosen, seen = kneser_ney.sampled_texts(rows, fifth)
    sizes = {label: n for label, (n, _) in seen.items()}
    total = sum(sizes.values())
    prior = sizes.get("1", 0) / total if total else 0.5
    tags = F.broadcast(chosen.select("tag", F.lit(True).alias("of_curve")).distinct())  # of bounded size, as CALIBRATION_ROWS says
    marked = rows.join(tags, F.xxhash64("text") == F.col("tag"), "left").select(F.col("label").cast("int").alias("label"), "text", F.coalesce("of_curve", F.lit(False)).alias("sampled"))
    counts = count(marked)
    left = counts.top.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n0", "n1", F.col("n0") - F.col("s0"), F.col("n1") - F.col("s1"))]).first()
    if len(seen) < 2 or not left[0] or not left[1]:
        return Scorer(counts, None, np.zeros(FEATURES), np.ones(FEATURES), prior)
    kept = described(sample, counts, bool(left[2] and left[3]), "text", ["label"]).select("row.label", *[f"f{i}" for i in range(FEATURES)]).toPandas()  # at most CALIBRATION_ROWS
    x, y = kept[[f"f{i}" for i in range(FEATURES)]].to_numpy(), (kept.label == "1").to_numpy(float)
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    weights = _curve((x - centre) / scale, y)
    odds = lambda of: np.log(seen["1"][of] / seen["0"][of])
    weights[0] += odds(0) - odds(1)
    return Scorer(counts, weights, centre, scale, prior)


def score(df: DataFrame, scorer: Scorer, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row as ``row`` with ``score`` and ``evidence`` (the length-normalised difference of log-likelihoods).

    Null texts and texts without a word have no evidence and get the curve's value for none; equal texts get equal scores.
    """
    out = described(df, scorer.counts, False, text, keep if keep is not None else df.columns)
    return out.select("row", scorer.score([F.col(f"f{i}") for i in range(FEATURES)]).alias("score"), F.col("f0").alias("evidence"))
