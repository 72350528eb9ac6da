"""Ranked lexical search by Block-Max MaxScore over inverted segments.

A task gathers texts into segments and writes each segment's posting lists: blocks of ``BLOCK`` compressed postings, and for
each block the (occurrences, document length) pairs no other pair of the block beats, so that the block's exact maximum can be
worked out for whatever corpus statistics hold in the end. A query meets a segment with a threshold, the worst score of its heap.
Lists whose bounds add up to less than the threshold are not essential: they cannot lift a document into the heap alone.
Documents of the essential lists are scored, and looked up in the others from the strongest on, where first the list's bound
and then the bound of the document's block reject it before that block is decompressed. Each task passes its heaps on, and they are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import let_workers_import, span_hashes
from tableloom.llm.segments import SEGMENT_BYTES, Tokens, gathered, lowered
from tableloom.session import freeze

#: Postings in a block.
BLOCK = 64

#: Queries that are searched together, on average.
QUERY_BLOCK = 128

#: Bits of the sieve of query terms every task of the indexing gets: a fixed size; what passes it for nothing is dropped by a join.
SIEVE_BITS = 20

TERM = np.zeros(256, bool)
TERM[48:58] = TERM[97:123] = TERM[128:] = True

INDEX = "segment long, term string, df long, words long, doc_ids array<long>, lengths binary, heads binary, postings binary"


def encoded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values as bytes of 7 bits, lowest first, the last of each without the high bit; and where each value ends."""
    sizes = 1 + sum((values >= 1 << 7 * i).astype(np.int64) for i in range(1, 5))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(5):
        some = sizes > i
        out[(ends - sizes)[some] + i] = (values[some] >> 7 * i & 127) | np.where(sizes[some] > i + 1, 128, 0)
    return out, ends


def decoded(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128) + 1
    starts = np.concatenate([[0], ends[:-1]])
    shift = 7 * (np.arange(len(data)) - np.repeat(starts, ends - starts))
    return np.add.reduceat((data & 127).astype(np.int64) << shift, starts)


def posting_lists(tokens: Tokens, wanted: np.ndarray) -> list[tuple[str, int, bytes, bytes]]:
    """``term, df, heads, postings`` of each wanted term of a segment; heads are what a search reads before any posting."""
    some = wanted[tokens.ids]
    texts = len(tokens.counts)
    keys, tf = np.unique(tokens.ids[some] * texts + tokens.text[some], return_counts=True)
    if not len(keys):
        return []
    term, doc = keys // texts, keys % texts
    first = np.flatnonzero(np.diff(term, prepend=-1))
    df = np.diff(np.append(first, len(keys)))
    nth = np.arange(len(keys)) - np.repeat(first, df)
    opens = nth % BLOCK == 0
    block = np.cumsum(opens) - 1
    begin = np.flatnonzero(opens)
    last = doc[np.append(begin[1:], len(keys)) - 1]
    gap = np.where(nth == 0, doc, np.diff(doc, prepend=0) - 1)
    data, ends = encoded(np.stack([gap, tf], axis=1).ravel())
    block_end = ends[2 * np.append(begin[1:], len(keys)) - 1]

    # of each block the pairs that no pair of as many occurrences or more beats by a shorter document
    length = tokens.counts[doc]
    order = np.lexsort((length, -tf, block))
    falling = length[order] - block[order] * (int(length.max()) + 1)
    least = np.minimum.accumulate(falling)
    top = order[np.append(True, least[1:] < least[:-1])]
    top_end = np.cumsum(np.bincount(block[top], minlength=len(begin)))

    per_term = np.searchsorted(first, begin, side="right") - 1
    of = np.append(np.flatnonzero(np.diff(per_term, prepend=-1)), len(begin))
    names = tokens.words.take(pa.array(term[first])).to_pylist()
    out = []
    for i, name in enumerate(names):
        a, b = of[i], of[i + 1]
        byte, t = (0 if a == 0 else int(block_end[a - 1])), (0 if a == 0 else int(top_end[a - 1]))
        pairs = top[t:int(top_end[b - 1])]
        heads = np.concatenate([[b - a], last[a:b], block_end[a:b] - byte, top_end[a:b] - t, tf[pairs], length[pairs]])
        out.append((name, int(df[i]), heads.astype("<i8").tobytes(), data[byte:int(block_end[b - 1])].tobytes()))
    return out


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sieve: np.ndarray | None = None, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """A row for each segment and term, and one of term '' for each segment's documents; null texts have no terms.

    ``sieve`` has flags by the low bits of a term's hash: lists of terms that fall through it are not written. The numbers of
    documents and words always count everything.
    """
    let_workers_import(docs.sparkSession)
    sent = None if sieve is None else docs.sparkSession.sparkContext.broadcast(np.packbits(sieve))
    types = pa.schema([("segment", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("words", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("heads", pa.binary()), ("postings", pa.binary())])

    def run(batches):
        flags = None if sent is None else np.unpackbits(sent.value).astype(bool)
        for number, table in gathered(batches, limit=segment_bytes):
            tokens = Tokens(*lowered(table["text"]), TERM)
            wanted = np.ones(len(tokens.words), bool)
            if flags is not None and len(wanted):
                data, offsets = lowered(tokens.words)
                wanted = flags[(span_hashes(data, offsets[:-1], offsets[1:]) & np.uint64(len(flags) - 1)).astype(np.int64)]
            rows = [{"term": t, "df": n, "heads": h, "postings": p} for t, n, h, p in posting_lists(tokens, wanted)]
            rows.append({"term": "", "df": int((tokens.counts > 0).sum()), "words": int(tokens.counts.sum()), "doc_ids": table["doc_id"].to_pylist(), "lengths": tokens.counts.astype("<i8").tobytes()})
            for i in range(0, len(rows), 5_000):
                yield pa.RecordBatch.from_pylist([{"segment": number, **r} for r in rows[i:i + 5_000]], types)

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, INDEX)


class PostingList:
    """A term's postings in a segment, decompressed block by block as they are asked for."""

    def __init__(self, heads: bytes, postings: bytes, impact):
        heads = np.frombuffer(heads, "<i8")
        n = int(heads[0])
        self.last, self.end, tops = heads[1:n + 1], heads[n + 1:2 * n + 1], heads[2 * n + 1:3 * n + 1]
        tf, length = heads[3 * n + 1:].reshape(2, -1)
        self.block_top = np.maximum.reduceat(impact(tf, length), np.concatenate([[0], tops[:-1]]))
        self.top = int(self.block_top.max())
        self.postings, self.known = np.frombuffer(postings, np.uint8), np.zeros(n, bool)
        self.docs = self.tf = None

    def ask(self, blocks: np.ndarray) -> None:
        """Decompress these blocks, but for those that already are."""
        if self.docs is None:
            # of each block the last document, until it is decompressed: so the documents are in order all the time
            self.docs, self.tf = np.repeat(self.last, BLOCK), np.zeros(BLOCK * len(self.last), np.int64)
        for b in blocks[~self.known[blocks]].tolist():
            values = decoded(self.postings[self.end[b - 1] if b else 0:self.end[b]])
            at = b * BLOCK
            n = len(values) // 2
            self.docs[at:at + n] = np.cumsum(values[::2] + 1) + (self.last[b - 1] if b else -1)
            self.tf[at:at + n] = values[1::2]
            self.known[b] = True

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        self.ask(np.arange(len(self.last)))
        some = self.tf > 0
        return self.docs[some], self.tf[some]

    def find(self, docs: np.ndarray) -> np.ndarray:
        """The occurrences in these documents, whose blocks are known; 0 if not listed."""
        at = np.searchsorted(self.docs, docs)
        return np.where(self.docs[at] == docs, self.tf[at], 0)


class Heap:
    """The best k documents so far: highest score, then smallest id, null last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.lost, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """A document needs this score at least."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, lost: np.ndarray, ids: np.ndarray) -> None:
        score, lost, ids = np.append(self.score, score), np.append(self.lost, lost), np.append(self.ids, ids)
        best = np.lexsort((ids, lost, -score))[:self.k]
        self.score, self.lost, self.ids = score[best], lost[best], ids[best]


class Segment:
    """The documents of a segment and those of its posting lists that a block of queries asks for."""

    def __init__(self, doc_ids: list, lengths: bytes, documents: int, words: int):
        self.lost = np.array([d is None for d in doc_ids], bool)
        self.ids = np.array([0 if d is None else d for d in doc_ids], np.int64)
        self.documents, self.words = documents, words
        self.norm = self.norms(np.frombuffer(lengths, "<i8"))
        self.lists: dict[str, PostingList] = {}

    def norms(self, length: np.ndarray) -> np.ndarray:
        return 100 - 25 + 25 * length * self.documents // max(self.words, 1)

    def impact(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 12 * self.norms(length))

    def add(self, term: str, heads: bytes, postings: bytes) -> None:
        self.lists[term] = PostingList(heads, postings, self.impact)

    def search(self, query: list[tuple[str, int]], heap: Heap) -> None:
        """Put the segment's documents that belong there into the heap; ``query`` has terms and their weights."""
        own = sorted(((weight * self.lists[t].top, weight, self.lists[t]) for t, weight in query), key=lambda x: x[0])
        bounds = np.cumsum([0, *(x[0] for x in own)])
        floor = heap.floor
        if not own or bounds[-1] < floor:
            return
        essential = int(np.searchsorted(bounds[1:], floor))
        score = np.zeros(len(self.ids), np.int64)
        for _, weight, postings in own[essential:]:
            docs, tf = postings.all()
            score[docs] += weight * (1_000_000_000 * tf // (1000 * tf + 12 * self.norm[docs]))
        docs = np.flatnonzero(score)
        for i in range(essential - 1, -1, -1):
            _, weight, postings = own[i]
            docs = docs[score[docs] + bounds[i + 1] >= floor]
            block = np.searchsorted(postings.last, docs)
            top = weight * np.append(postings.block_top, 0)[block]
            near = score[docs] + top + bounds[i] >= floor
            docs, block, top = docs[near], block[near], top[near]
            if not len(docs):
                return
            postings.ask(np.unique(block[top > 0]))
            here = docs[top > 0]
            if len(here):
                tf = postings.find(here)
                score[here] += weight * (1_000_000_000 * tf // (1000 * tf + 12 * self.norm[here]))
        docs = docs[score[docs] >= floor]
        heap.add(score[docs], self.lost[docs], self.ids[docs])


def query_terms(queries: DataFrame) -> DataFrame:
    """``qno, term, n`` of ``qno, text``: how often a query holds a term."""
    let_workers_import(queries.sparkSession)

    def run(batches):
        for _, table in gathered(batches):
            tokens = Tokens(*lowered(table["text"]), TERM)
            texts = len(tokens.counts)
            keys, n = np.unique(tokens.ids * texts + tokens.text, return_counts=True)
            numbers = table["qno"].combine_chunks().take(pa.array(keys % texts))
            yield pa.RecordBatch.from_arrays([numbers, tokens.words.take(pa.array(keys // texts)), pa.array(n)], ["qno", "term", "n"])

    return queries.select("qno", "text").mapInArrow(run, "qno long, term string, n long")


def term_sieve(terms: DataFrame) -> np.ndarray:
    """Flags by the low bits of the terms' hashes; as many values as there are flags come to the driver, at most."""
    let_workers_import(terms.sparkSession)

    def run(batches):
        for batch in batches:
            data, offsets = lowered(batch.column(0))
            at = np.unique(span_hashes(data, offsets[:-1], offsets[1:]) & np.uint64((1 << SIEVE_BITS) - 1))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32))], ["at"])

    sieve = np.zeros(1 << SIEVE_BITS, bool)
    sieve[[r[0] for r in terms.select("term").distinct().mapInArrow(run, "at int").distinct().collect()]] = True
    return sieve


def search_segments(found: DataFrame, documents: int, words: int, k: int) -> DataFrame:
    """``qno, doc_id, score``: each task's best k of each query; ``found`` has a segment's rows of a query block together."""
    let_workers_import(found.sparkSession)

    def run(batches):
        heaps: dict[int, Heap] = {}
        block = segment = at = None
        queries: dict[int, list] = {}

        def finish():
            if segment is not None:
                for qno, terms in queries.items():
                    segment.search(terms, heaps.setdefault(qno, Heap(k)))

        def out():
            for qno, heap in heaps.items():
                n = len(heap.score)
                yield pa.RecordBatch.from_arrays([pa.array([qno] * n, pa.int64()), pa.array(heap.ids, pa.int64(), mask=heap.lost), pa.array(heap.score)], ["qno", "doc_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["block"], row["segment"]) != at:
                    finish()
                    if row["block"] != block:
                        yield from out()
                        heaps.clear()
                        block = row["block"]
                    # the row of term '' comes first
                    at, segment, queries = (row["block"], row["segment"]), Segment(row["doc_ids"], row["lengths"], documents, words), {}
                    continue
                segment.add(row["term"], row["heads"], row["postings"])
                for user in row["users"]:
                    queries.setdefault(user["qno"], []).append((row["term"], user["weight"]))
        finish()
        yield from out()

    return found.mapInArrow(run, "qno long, doc_id long, score long")


def search(
    docs: DataFrame, queries: DataFrame, k: int, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", item_text: str = "text",
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each query's k best documents with a score above 0.

    Equal scores go by ascending doc_id, null last; each of repeated document rows is ranked. Each query row is ranked on its own, so
    equal rows give equal results each. Null and empty texts hold no term: as documents they are not counted, as queries
    they find nothing. A document's id is an integer. Empty tables give no rows.
    """
    asked = freeze(queries.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text")).withColumn("qno", F.monotonically_increasing_id()), "queries")
    terms = freeze(query_terms(asked), "query_terms")
    index = freeze(build_index(docs, doc_id, text, term_sieve(terms), segment_bytes), "index")
    heads, lists = index.where("term = ''"), index.where("term <> ''")
    documents, words = heads.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    blocks = max(math.ceil(asked.count() / QUERY_BLOCK), 1)

    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    rarity = lists.groupBy("term").agg(F.sum("df").alias("df")).select("term", weight.alias("w"))
    needs = (
        terms.join(rarity, "term").withColumn("block", F.pmod(F.xxhash64("qno"), F.lit(blocks)).cast("int"))
        .groupBy("block", "term").agg(F.collect_list(F.struct("qno", (F.col("n") * F.col("w")).alias("weight"))).alias("users"))
    )
    columns = ["block", "segment", "term", "doc_ids", "lengths", "heads", "postings", "users"]
    opened = heads.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast(needs.schema["users"].dataType).alias("users"))
    found = lists.join(needs, "term").select(columns).unionAll(opened.select(columns))
    together = found.repartition("segment").sortWithinPartitions("block", "segment", "term")
    best = search_segments(together, documents, words, k)
    order = Window.partitionBy("qno").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("qno", "item_id"), "qno").select("item_id", "rank", "doc_id", "score")
