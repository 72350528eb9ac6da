"""Language identification by character models: the lowest cross-entropy per character wins, or all are rejected."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tableloom.llm import kneser_ney
from tableloom.llm.common import PASS_BYTES, let_workers_import, text_batches
from tableloom.llm.kneser_ney import Model, word_values, words_of
from tableloom.session import freeze

ORDER = 4
SLOT_BITS = kneser_ney.KEY_BITS

#: Ranges that the search for a median counts at a time; so many values or fewer are put in order by the driver.
MEDIAN_RANGES = 256

#: A text is rejected if its cross-entropy is so many standard deviations above its language's usual one, and also
#: most of the way to that of letters drawn at random.
REJECT_AT = 8.0

UNKNOWN = "und"


@dataclass
class Identifier:
    model: Model
    usual: np.ndarray
    spread: np.ndarray
    spread_of_one: np.ndarray


class Entropies:
    """Cross-entropy per character of each text in each language, and the number of characters."""

    def __init__(self, values):
        self.values = values

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        words, sizes = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = words_of(text) if text and any(map(str.isalpha, text)) else []
            sizes[i] = len(own)
            words += own
        classes = len(self.values.model.classes)
        if not words or not classes:
            return np.zeros((len(texts), classes)), np.zeros(len(texts), np.int64)
        at = self.values.rows(words)
        of = np.repeat(np.arange(len(texts)), sizes)
        chars = np.bincount(of, np.fromiter(map(len, words), np.int64, len(words)) + 1, len(texts)).astype(np.int64)
        sums = np.stack([np.bincount(of, self.values.values[at, c], len(texts)) for c in range(classes)], axis=1)
        return -sums / np.maximum(chars, 1)[:, None], chars


def fit(rows: DataFrame) -> Identifier:
    """Fit on ``label, text``: counts over all rows, the rejection limits from every different text of each label.

    Null labels and texts are left out. Without rows nothing is known and every text is unknown.
    """
    model = kneser_ney.fit(rows, ORDER, SLOT_BITS)
    return Identifier(model, *_limits(_judged(rows, model, "text", ["label"], F.col("label")), len(model.classes)))


def identify(df: DataFrame, identifier: Identifier, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row as ``row`` with ``lang_pred``, ``score`` (0 to 1, the share of the best language) and ``rejected``.

    Null texts and texts without a letter are ``und`` with score 0 and rejected, as is everything if no language
    was learned. A text with letters gets the best learned language and is rejected if its cross-entropy lies far above that
    language's usual one for its length, and most of the way to chance. Equal cross-entropies go to the language first in order.
    """
    return _with_rejected(_judged(df, identifier.model, text, keep, F.lit(None)), identifier)


def fit_and_identify(df: DataFrame, label: Column, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``identify`` of all rows after a ``fit`` on those of them whose ``label`` is not null; each text's cross-entropies are computed once for both."""
    model = kneser_ney.fit(df.select(label.alias("label"), F.col(f"`{text}`").cast("string").alias("text")), ORDER, SLOT_BITS)
    judged = freeze(_judged(df, model, text, keep, label), "judged")
    return _with_rejected(judged, Identifier(model, *_limits(judged, len(model.classes))))


def _judged(df: DataFrame, model: Model, text: str, keep: list[str] | None, label: Column) -> DataFrame:
    """Each row as ``row`` with ``lang_pred`` and ``score``; the place of the best language and the cross-entropy in it (null without
    letters or languages); the characters; and, if it has a learned label, a hash of its text, the label's place and the cross-entropy in that."""
    let_workers_import(df.sparkSession)
    columns = [F.col(f"`{c}`") for c in (keep if keep is not None else df.columns)]
    packed = df.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").cast("string").alias("text"), label.cast("string").alias("label"))
    packed = packed.withColumn("tag", F.when(F.col("label").isNotNull(), F.xxhash64("text")))
    sent = df.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex
    pass_bytes = max(4 * PASS_BYTES // max(len(model.classes), 4), 1 << 14)  # a pass holds a value for each word and class

    def run(batches):
        entropies = Entropies(word_values(key, sent))
        classes = sent.value.classes
        place = {c: i for i, c in enumerate(classes)}
        for batch in batches:
            for start, stop in text_batches(batch.column(1), pass_bytes):
                rows, texts, labels, tags = batch.slice(start, stop - start).columns
                found, chars = entropies(texts.to_pylist())
                empty = (chars == 0) | (not classes)
                if not classes:
                    found = np.zeros((len(texts), 1))
                at = np.arange(len(found))
                best = found.argmin(axis=1)
                least = found[at, best]
                weight = np.minimum(chars, 50)[:, None]
                score = 1 / np.exp(-(found - least[:, None]) * weight).sum(axis=1)
                names = np.array(classes or [UNKNOWN], object)[best]
                names[empty] = UNKNOWN
                own = np.fromiter((place.get(x, -1) for x in labels.to_pylist()), np.int32, len(labels))
                other = empty | (own < 0)
                yield pa.RecordBatch.from_arrays([
                    rows, pa.array(names.tolist(), pa.string()), pa.array(np.where(empty, 0.0, score)), pa.array(best.astype(np.int32), mask=empty),
                    pa.array(least, mask=empty), pa.array(chars), tags, pa.array(own, mask=other), pa.array(found[at, own], mask=other),
                ], names=["row", *fields.names[1:]])

    fields = StructType([packed.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("best", IntegerType())])
    fields = fields.add("least", DoubleType()).add("chars", LongType()).add("tag", LongType()).add("own", IntegerType()).add("entropy", DoubleType())
    return packed.mapInArrow(run, fields)


def _limits(judged: DataFrame, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By language: the usual cross-entropy, its spread and the part of the spread that falls with the length, from all different texts of it."""
    usual, spread, one = np.zeros(classes), np.zeros(classes), np.zeros(classes)
    if not classes:
        return usual, spread, one
    texts = judged.where("own IS NOT NULL").groupBy("own", "tag").agg(F.min("chars").alias("chars"), F.min("entropy").alias("entropy"))
    texts = freeze(texts.select("own", "chars", "entropy"), "entropies")
    for c, total, chars in texts.groupBy("own").agg(F.sum(F.col("entropy") * F.col("chars")), F.sum("chars")).collect():  # a row for each language
        usual[c] = total / chars
    known = judged.sparkSession.createDataFrame(list(enumerate(usual.tolist())), "own int, usual double")
    squares = texts.join(F.broadcast(known), "own").select("own", "chars", ((F.col("entropy") - F.col("usual")) * (F.col("entropy") - F.col("usual"))).alias("off"))
    # the spread of a text of n characters: a part that stays, and one that falls with the length
    values = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("off").alias("v")), F.struct(F.lit(1).alias("kind"), (F.col("off") * F.col("chars")).alias("v"))))
    found = medians(squares.select("own", values.alias("x")).select("own", "x.kind", "x.v"), ["own", "kind"])
    for (c, kind), median in found.items():
        if kind:
            one[c] = max(np.sqrt(median / 0.455), 0.5)
        else:
            spread[c] = max(np.sqrt(median / 0.455), 0.02)
    return usual, spread, one


def medians(values: DataFrame, keys: list[str]) -> dict[tuple, float]:
    """The exact median of the finite numbers ``v`` of each group (few groups, any number of values).

    Counts by range find the range that holds the middle, which is divided anew until it holds few values or equal ones. If
    the two middle values lie in different ranges, they are the end of one and the start of the other.
    """
    found, left = {}, {}
    for *group, n, lo, hi in values.groupBy(*keys).agg(F.count(F.lit(1)), F.min("v"), F.max("v")).collect():
        left[tuple(group)] = (lo, hi, n, (n - 1) // 2, n // 2)

    def inside(groups: list[tuple]) -> DataFrame:
        bounds = values.sparkSession.createDataFrame([(*g, *left[g][:2]) for g in groups], values.select(*keys).schema.add("lo", DoubleType()).add("hi", DoubleType()))
        return values.join(F.broadcast(bounds), keys).where("v BETWEEN lo AND hi")

    while wide := [g for g, (lo, hi, n, _, _) in left.items() if n > MEDIAN_RANGES and lo < hi]:
        nth = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * MEDIAN_RANGES), F.lit(MEDIAN_RANGES - 1))
        ranges: dict[tuple, list] = {g: [] for g in wide}
        for *group, at, n, lo, hi in inside(wide).groupBy(*keys, nth.alias("nth")).agg(F.count(F.lit(1)), F.min("v"), F.max("v")).collect():
            ranges[tuple(group)].append((at, n, lo, hi))
        for g, parts in ranges.items():
            *_, first, second = left[g]
            before, lower = 0, None
            for _, n, lo, hi in sorted(parts):
                if lower is not None:
                    found[g] = (lower + lo) / 2
                    del left[g]
                    break
                if first < before + n:
                    if second < before + n:
                        left[g] = (lo, hi, n, first - before, second - before)
                        break
                    lower = hi
                before += n
    few: dict[tuple, list] = {}
    for g, (lo, hi, *_) in left.items():
        if lo == hi:
            found[g] = lo
        else:
            few[g] = []
    if few:
        for *group, v in inside(list(few)).select(*keys, "v").collect():  # at most MEDIAN_RANGES a group
            few[tuple(group)].append(v)
    for g, own in few.items():
        own.sort()
        found[g] = (own[left[g][3]] + own[left[g][4]]) / 2
    return found


def _with_rejected(judged: DataFrame, identifier: Identifier) -> DataFrame:
    """``row, lang_pred, score`` and whether the text is rejected."""
    limits = list(zip(range(len(identifier.usual)), *(x.tolist() for x in (identifier.usual, identifier.spread, identifier.spread_of_one)), strict=True))
    limits = judged.sparkSession.createDataFrame(limits, "best int, usual double, spread double, one double")
    width = F.sqrt(F.col("spread") * F.col("spread") + F.col("one") * F.col("one") / F.greatest("chars", F.lit(1)))
    chance = float(2 * np.log(identifier.model.letters + 1))
    limit = F.greatest(F.col("usual") + REJECT_AT * width, (F.col("usual") + chance) / 3)
    out = judged.join(F.broadcast(limits), "best", "left")
    return out.select("row", "lang_pred", "score", F.coalesce(F.col("least") > limit, F.lit(True)).alias("rejected"))


def held_out(key: str, parts: int, part: int):
    """Whether a row's key falls in one of ``parts`` parts of the crc32 of the key as text; a null key counts as empty."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part
