"""Exact top-k inner products with an M-tree whose pages are rows of a table.

Vectors are lifted by one component to one common norm, which makes the largest inner product the smallest distance. Level by level
the tree has routing objects with covering radii: an inner node covers pages, a page holds entries with their
distances to the page's routing object. A query visits nodes in the order of the least distance they can hold; a
stored parent distance rules entries out by the triangle inequality before their distance is computed. Bounds are loosened by
more than rounding can amount to, and scores are computed in integers, so the result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import let_workers_import
from tableloom.session import freeze

#: Entries of a page and pages of a node, which is what one task holds of the tree at a time.
PAGE, FANOUT = 256, 64

#: Queries of a block.
BLOCK = 512

#: Routing objects that deal the vectors to neighbourhoods, from a sample of at most so many vectors.
ROUTERS = 128

SCALE = 256

#: Sums up to here are exact in double precision.
_EXACT = float(2**53)


def quantised(df: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` with v the whole numbers floor(scale * x); vectors that are null or hold null or non-finite components go."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    whole = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(f"`{vector}`").isNotNull() & F.coalesce(whole, F.lit(False))).select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v"))


class Node:
    """Pages of one inner node: lifted routing objects, covering radii, entries and their parent distances."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.norm2 = float(squares.max(initial=0.0))
        lifted = np.sqrt(np.maximum(self.norm2 - squares, 0))
        self.pages = []
        for a in range(0, len(vectors), PAGE):
            rows = np.arange(a, min(a + PAGE, len(vectors)))
            x = np.column_stack([vectors[rows].astype(np.float64), lifted[rows]])
            centre = x.mean(axis=0)
            parent = np.sqrt(((x - centre) ** 2).sum(axis=1))
            order = np.argsort(parent, kind="stable")
            self.pages.append((centre, float(parent.max(initial=0.0)), rows[order], parent[order]))
        self.centres = np.array([p[0] for p in self.pages])
        self.radii = np.array([p[1] for p in self.pages])

    def search(self, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """``score, row`` of all entries that can be among the k best scores, with those equal to the last; ``floor`` is a
        score that k vectors are known to reach."""
        q2 = float((query.astype(np.float64) ** 2).sum())
        lifted = np.append(query.astype(np.float64), 0.0)
        to_centres = np.sqrt(((self.centres - lifted) ** 2).sum(axis=1))
        slack = 1e-6 * (1.0 + np.sqrt(q2 + self.norm2))

        def reach(score: int | None) -> float:
            return np.inf if score is None else np.sqrt(max(q2 + self.norm2 - 2.0 * score, 0.0)) + slack

        best: list[int] = []
        found: list[tuple[int, int]] = []
        limit = reach(floor)
        least = np.maximum(to_centres - self.radii, 0.0)
        for p in np.argsort(least, kind="stable"):
            if least[p] > limit:
                break
            _, _, rows, parent = self.pages[p]
            # |d(q, centre) - d(entry, centre)| <= d(q, entry): entries in order of parent distance form one run
            a, b = np.searchsorted(parent, [to_centres[p] - limit, to_centres[p] + limit])
            near = rows[a:b]
            if not len(near):
                continue
            scores = self.vectors[near] @ query
            enough = floor if len(best) < k else max(best[0], floor if floor is not None else best[0])
            some = np.flatnonzero(scores >= enough) if enough is not None else np.arange(len(near))
            for i in some.tolist():
                s = int(scores[i])
                found.append((s, int(near[i])))
                if len(best) < k:
                    heapq.heappush(best, s)
                elif s > best[0]:
                    heapq.heapreplace(best, s)
            if len(best) == k:
                limit = min(limit, reach(best[0]))
        last = best[0] if len(best) == k else None
        return [f for f in found if last is None or f[0] >= last]


def _integers(lists: pa.ListArray, size: int) -> np.ndarray:
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(lists), size)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k largest inner products with vectors of other rows and its own size.

    Both tables have ``vec_id`` and ``v`` (whole numbers), see ``quantised``. Ties go to the smaller vec_id, a null one last; a
    query without other vectors of its size has no rows. A row stands for itself once, so repeated rows with one id are
    candidates for other ids only, and repeated queries are answered once. Components below 2**24 in size are searched
    by the tree; it is an error if larger ones make a sum of squares above 2**53.
    """
    spark = vectors.sparkSession
    let_workers_import(spark)
    # equal vectors are one entry: the k + 1 smallest ids of each are kept, found on the map side
    nth = F.row_number().over(Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last()))
    kept = vectors.select("vec_id", "v").distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
    entries = kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("size", F.size("v"))
    entries = freeze(entries, "entries")
    sample = entries.select("v", "size").limit(4 * ROUTERS).collect()
    routers: dict[int, np.ndarray] = {}
    for row in sample:
        held = routers.get(row["size"], np.zeros((0, row["size"])))
        if len(held) < ROUTERS:
            routers[row["size"]] = np.concatenate([held, np.array([row["v"]], np.float64).reshape(1, row["size"])])
    sent = spark.sparkContext.broadcast(routers)

    def place(batches):
        for batch in batches:
            sizes = np.array(batch.column("size"))
            near, away = np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                own = sent.value.get(size)
                if own is None or not size:
                    continue
                x = _integers(batch.column("v").take(pa.array(at)), size).astype(np.float64)
                if x.size and (x**2).sum(axis=1).max() > _EXACT:
                    raise ValueError("components too large for exact sums")
                d2 = (x**2).sum(axis=1)[:, None] - 2 * x @ own.T + (own**2).sum(axis=1)
                near[at] = d2.argmin(axis=1)
                away[at] = d2.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("size"), pa.array(near), pa.array(away), batch.column("ids"), batch.column("v")], ["size", "near", "away", "ids", "v"]
            )

    kind = "size int, near int, away double, ids array<long>, v array<long>"
    placed = entries.select("size", "ids", "v").mapInArrow(place, kind)
    # a range of neighbourhoods is cut wherever a node is full, so that a dense one is many nodes
    placed = placed.repartitionByRange("size", "near", "away").sortWithinPartitions("size", "near", "away")

    def pages(batches):
        held, size = [], None

        def node():
            flat = pa.array(np.concatenate([np.asarray(h[1], np.int64) for h in held]) if held else [], pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([size], pa.int32()), pa.array([[h[0] for h in held]], pa.list_(pa.list_(pa.int64()))), pa.ListArray.from_arrays([0, len(flat)], flat)], ["size", "ids", "flat"]
            )

        for batch in batches:
            for row_size, ids, v in zip(batch.column("size").to_pylist(), batch.column("ids").to_pylist(), batch.column("v").to_pylist(), strict=True):
                if held and (row_size != size or len(held) == PAGE * FANOUT):
                    yield node()
                    held = []
                size = row_size
                held.append((ids, v))
        if held:
            yield node()

    nodes = placed.mapInArrow(pages, "size int, ids array<array<long>>, flat array<long>")
    nodes = freeze(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    wanted = queries.select("vec_id", "v").where("vec_id IS NOT NULL").distinct().withColumn("size", F.size("v"))
    asked = wanted.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-wanted.count() // BLOCK)))))
    blocks = freeze(asked.groupBy("size", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries")), "queries")

    # every block of queries meets every node of its size, with nothing but the node's best k coming back
    met = nodes.join(blocks, "size").select("size", "ids", "flat", "queries")

    def answer(batches):
        for batch in batches:
            for i in range(len(batch)):
                size, ids, flat = batch.column("size")[i].as_py(), batch.column("ids")[i].as_py(), batch.column("flat")[i].values
                node = Node(np.asarray(flat.to_numpy(), np.int64).reshape(len(ids), size))
                out = []
                asked = batch.column("queries")[i].values
                q_ids, q = asked.field(0).to_pylist(), _integers(asked.field(1), size)
                for q_id, v in zip(q_ids, q, strict=True):
                    for score, row in node.search(v, k + 1, None):
                        out += [(q_id, x, score) for x in ids[row] if x != q_id]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    scored = met.mapInArrow(answer, "query_id long, vec_id long, score long").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last()))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
