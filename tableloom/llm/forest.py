"""Jaccard join of word n-grams by a MinHash LSH forest.

Two texts are candidates if they share the first ``depth`` hashes of some tree. The depth is fixed before any text is read: the longest
with which pairs at the threshold meet with at least the target recall. So the trees are bands of one length. All pairs of
fitting sizes in a group of connected candidates are verified on their full sets of n-grams. Texts with one set are one class from the
start. Verification runs block by block inside groups of connected candidates: it counts links without emitting pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField

from tableloom.llm.common import hold_nothing, mix64, sifted, with_results
from tableloom.llm.components import components
from tableloom.llm.winnow import PASS, Words, gram_hashes
from tableloom.session import freeze

GRAM = 5
SIMILARITY = 0.8
TREES = 20
LONGEST_PREFIX = 8
RECALL = 0.9999

#: Members of a block; two blocks at most are in a task at once.
BLOCK = 256


def prefix_length(similarity: float = SIMILARITY, trees: int = TREES, longest: int = LONGEST_PREFIX, recall: float = RECALL) -> int:
    """The longest matched prefix with which pairs at the threshold meet in some tree with the wanted probability."""
    for depth in range(longest, 1, -1):
        if 1 - (1 - similarity**depth) ** trees >= recall:
            return depth
    return 1


class Shingles:
    """The distinct word n-grams of each text (all words, if they are fewer), as hashes in order."""

    def __init__(self, texts: pa.Array, n: int):
        words = Words(texts)
        hashes = words.grams(n)
        whole = words.whole(n)
        values, of = hashes[whole], words.text[:len(hashes)][whole]
        short = np.flatnonzero((words.counts > 0) & (words.counts < n))
        if len(short):
            more = [gram_hashes(words.hashes[words.first[t]:words.first[t + 1]], int(words.counts[t]))[0] for t in short]
            values, of = np.concatenate([values, np.array(more, np.uint64)]), np.concatenate([of, short])
        order = np.lexsort((values, of))
        values, of = values[order], of[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
        self.values, self.of = values[new], of[new]
        self.sizes = np.bincount(self.of, minlength=len(texts))
        self.some = np.flatnonzero(self.sizes)
        self.starts = (np.cumsum(self.sizes) - self.sizes)[self.some]

    def key(self, salt: int) -> np.ndarray:
        """A value of each text's set, whatever its order."""
        out = np.zeros(len(self.sizes), np.uint64)
        if len(self.some):
            out[self.some] = np.add.reduceat(mix64(self.values ^ np.uint64(salt)), self.starts)
        return out.view(np.int64)

    def forest(self, trees: int, depth: int) -> np.ndarray:
        """For each text and tree a hash of the first ``depth`` minima of the tree's signature."""
        seeds = mix64(np.arange(1, 2 * trees * depth + 1, dtype=np.uint64))
        out = np.zeros((len(self.sizes), trees), np.uint64)
        if not len(self.some):
            return out.view(np.int64)
        for t in range(trees):
            prefix = np.full(len(self.some), t + 1, np.uint64)
            for d in range(depth):
                i = 2 * (t * depth + d)
                prefix = mix64(prefix * np.uint64(31) + np.minimum.reduceat((self.values * (seeds[i] | np.uint64(1)) + seeds[i + 1]) >> np.uint64(20), self.starts))
            out[self.some, t] = prefix
        return out.view(np.int64)


def _sets(rows: DataFrame, text: str, n: int, keep: list[str]) -> DataFrame:
    fields = [StructField("key_a", LongType()), StructField("key_b", LongType()), StructField("grams", ArrayType(LongType()))]

    def work(texts: pa.Array) -> list[pa.Array]:
        s = Shingles(texts, n)
        offsets = np.zeros(len(texts) + 1, np.int32)
        np.cumsum(s.sizes, out=offsets[1:])
        return [pa.array(s.key(1)), pa.array(s.key(2)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(s.values.view(np.int64)))]

    return with_results(rows, text, fields, lambda: work, keep, PASS)


def _pairs_of_block(rows: list[tuple], two: bool, similarity: float) -> list[tuple]:
    """Links among the members of a block (or between two): ``id, links, root`` of each member with a link."""
    ids = np.array([r[0] for r in rows])
    side = np.array([r[1] for r in rows])
    sizes = np.array([len(r[2]) for r in rows])
    flat = np.concatenate([r[2] for r in rows])
    _, flat = np.unique(flat, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    seen = np.zeros(flat.max() + 1, bool)
    links, parent = np.zeros(len(rows), np.int64), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        # pairs within one block are counted where that block is alone
        met = side[i + 1:] != side[i] if two else np.ones(len(rows) - i - 1, bool)
        least, most = np.minimum(sizes[i], sizes[i + 1:]), np.maximum(sizes[i], sizes[i + 1:])
        met = np.flatnonzero(met & (least >= similarity * most)) + i + 1
        if not len(met):
            continue
        own = flat[starts[i]:starts[i] + sizes[i]]
        seen[own] = True
        if len(met) > 8:
            first = starts[met[0]]
            common = np.add.reduceat(seen[flat[first:]].astype(np.int64), starts[met[0]:] - first)[met - met[0]]
        else:
            common = np.array([seen[flat[starts[j]:starts[j] + sizes[j]]].sum() for j in met])
        seen[own] = False
        # exact: similarity is given as a decimal, so compare in integers of a millionth
        linked = met[common * 1_000_000 >= round(similarity * 1_000_000) * (sizes[i] + sizes[met] - common)]
        links[i] += len(linked)
        links[linked] += 1
        for j in linked.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(int(ids[i]), int(links[i]), int(ids[root(i)])) for i in np.flatnonzero(links)]


def link_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = GRAM, similarity: float = SIMILARITY, trees: int = TREES, recall: float = RECALL,
) -> DataFrame:
    """One row per document: ``doc_id``, ``at`` (a number of the row), ``copy_id``, ``n_links``, ``class_id`` and ``keeper``.

    ``copy_id`` is the smallest doc_id with the same set of n-grams, ``n_links`` counts the other sets of a Jaccard similarity of
    at least ``similarity``, ``class_id`` is the smallest doc_id connected by links, and ``keeper`` marks one row of each class.
    Texts of fewer than ``n`` words have one n-gram of all their words. Null texts and texts without words link with
    nothing, and each is a class of its own. A null doc_id is greater than all others. An empty table gives no rows.
    """
    depth = prefix_length(similarity, trees, recall=recall)
    fields = [StructField("key_a", LongType()), StructField("key_b", LongType()), StructField("n_grams", IntegerType()), StructField("trees", ArrayType(LongType()))]

    def work(texts: pa.Array) -> list[pa.Array]:
        s = Shingles(texts, n)
        flat = s.forest(trees, depth).reshape(-1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * trees), pa.array(flat))
        return [pa.array(s.key(1)), pa.array(s.key(2)), pa.array(s.sizes.astype(np.int32)), lists]

    def make():
        hold_nothing()
        return work

    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    source = source.withColumn("tag", F.xxhash64("text"))
    signed = with_results(source, "text", fields, make, ["doc_id", "tag"], PASS).select("row.*", "key_a", "key_b", "n_grams", "trees")
    signed = freeze(signed.withColumn("at", F.monotonically_increasing_id()), "signatures")

    # one class per set of n-grams; its rows are counted and its first row found on the map side
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at", "tag"))
    sets = freeze(
        signed.where("n_grams > 0").groupBy("key_a", "key_b").agg(first.alias("f"), F.first("trees").alias("trees"))
        .select("key_a", "key_b", F.col("f.doc_id").alias("copy_id"), F.col("f.at").alias("id"), F.col("f.tag").alias("tag"), "trees"),
        "sets",
    )
    nodes = sets.select("id", F.posexplode("trees").alias("tree", "prefix"))
    shared = nodes.groupBy("tree", "prefix").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").drop("z")
    near = components(nodes.join(shared, ["tree", "prefix"]).where("id <> a").select("a", F.col("id").alias("b")).distinct())

    # the sets of all candidates, dealt to blocks of their group; a large group's blocks meet two by two
    wanted = freeze(near.join(sets, "id").select("id", "root", "copy_id", "tag", "key_a", "key_b"), "wanted")
    same_row = (F.col("s.tag") == F.col("w.tag")) & F.col("s.doc_id").eqNullSafe(F.col("w.copy_id"))
    texts = sifted(source, F.col("tag"), wanted.select("tag")).where("among").alias("s").join(wanted.alias("w"), same_row)
    grams = _sets(texts.select("w.id", "w.root", "w.key_a", "w.key_b", "s.text"), "text", n, ["id", "root", "key_a", "key_b"])
    filled = grams.where("row.key_a = key_a AND row.key_b = key_b").groupBy("row.id").agg(F.first("row.root").alias("root"), F.first("grams").alias("grams"))
    groups = near.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (
        filled.join(groups, "root").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("id", "root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).alias("side"), "grams")
        .repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "id")
    )

    def run(frames):
        group, held = None, []

        def done():
            if len(held) > 1:
                found = _pairs_of_block(held, group[1] != group[2], similarity)
                if found:
                    yield pd.DataFrame(found, columns=["id", "links", "root"])

        for batch in frames:
            roots, los, his = (batch.column(c).to_pylist() for c in (1, 2, 3))
            ids, sides = batch.column(0).to_pylist(), batch.column(4).to_pylist()
            for i, key in enumerate(zip(roots, los, his, strict=True)):
                if key != group:
                    for frame in done():
                        yield pa.RecordBatch.from_pandas(frame, preserve_index=False)
                    group, held = key, []
                held.append((ids[i], sides[i], batch.column(5)[i].values.to_numpy()))
        for frame in done():
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    links = freeze(dealt.mapInArrow(run, "id long, links long, root long"), "links")
    counted = links.groupBy("id").agg(F.sum("links").alias("n_links"))
    classes = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    least = F.min(F.struct(F.col("copy_id").isNull().alias("none"), "copy_id", "id"))
    joined = sets.select("key_a", "key_b", "id", "copy_id").join(counted, "id", "left").join(classes, "id", "left").withColumn("root", F.coalesce("root", "id"))
    heads = joined.groupBy("root").agg(least.alias("h"))
    described = joined.join(heads, "root").select(
        "key_a", "key_b", "copy_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("h.copy_id").alias("class_id"), F.col("h.id").alias("keeper_at"),
    )
    rows = signed.select("at", "doc_id", "tag", F.when(F.col("n_grams") > 0, F.col("key_a")).alias("key_a"), "key_b")
    return rows.join(described, ["key_a", "key_b"], "left").select(
        "doc_id", "at", "tag", F.when(F.col("keeper_at").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("keeper_at").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce(F.col("keeper_at") == F.col("at"), F.lit(True)).alias("keeper"),
    )
