from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom.llm import ranking
from tests.llm.conftest import ODD_TEXTS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, queries, k):
    """Every score worked out for every document, in whole numbers."""
    counts = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    full = [(d, c) for d, c in counts if c]
    n, words = len(full), sum(sum(c.values()) for _, c in full)
    df = Counter(t for _, c in full for t in c)
    out = []
    for item_id, text in queries:
        scored = []
        for doc_id, c in full:
            m = 75 + 25 * sum(c.values()) * n // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms_of(text) if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i, doc_id, -score) for i, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], start=1)]
    return sorted(out, key=str)


def found(spark, documents, docs, queries, k, **sizes):
    table = documents([(i, t, "en", "s", 0) for i, t in docs])
    asked = spark.createDataFrame(queries, "item_id long, text string").withColumns({c: F.lit(1) for c in ("term", "qno", "doc_id")})
    return sorted((tuple(r) for r in ranking.search(table, asked, k, **sizes).collect()), key=str)


def test_numbers_survive_compression():
    values = np.array([0, 1, 127, 128, 300, 2**14, 2**21 - 1, 2**28 + 5, 2**34])
    data, ends = ranking.encoded(values)
    assert ranking.decoded(data).tolist() == values.tolist()
    assert ends[-1] == len(data)


@pytest.mark.parametrize("segment_bytes", [200, 4_000, 1 << 20])
def test_rankings_are_those_of_scoring_every_document(spark, documents, segment_bytes):
    rng = np.random.default_rng(5)
    names = [f"w{i}" for i in range(60)]
    weights = 1 / np.arange(1, 61)
    docs = [(i, " ".join(rng.choice(names, rng.integers(1, 60), p=weights / weights.sum()))) for i in range(600)]
    docs += [(1000 + i, "W0 w1, w2!") for i in range(30)]  # equal scores
    queries = [(i, " ".join(rng.choice(names, rng.integers(1, 12)))) for i in range(40)] + [(99, "w0 w0 w59 unseen")]
    assert found(spark, documents, docs, queries, 7, segment_bytes=segment_bytes) == expected(docs, queries, 7)


def test_odd_rows(spark, documents):
    docs = [(r[0], r[1]) for r in ODD_TEXTS]
    queries = [(1, "one five"), (1, "one five"), (None, "WORD"), (2, None), (3, ""), (4, "é 漢字"), (5, "x" * 50_000), (6, "12 12 34")]
    got = found(spark, documents, docs, queries, 2)
    assert got == expected(docs, queries, 2)
    assert [r[2] for r in got if r[0] == 1] == [5, 5, 5, 5]  # equal queries, and equal documents before the one without id


def test_empty_tables(spark, documents):
    assert found(spark, documents, [], [(1, "a")], 3) == []
    assert found(spark, documents, [(1, "a")], [], 3) == []


def test_weak_lists_are_rejected_before_they_are_decompressed():
    from tableloom.llm.segments import Tokens, lowered
    import pyarrow as pa

    texts = ["rare rare rare common"] * 3 + ["common filler filler filler filler filler"] * 3_000
    tokens = Tokens(*lowered(pa.array(texts)), ranking.TERM)
    segment = ranking.Segment(list(range(len(texts))), tokens.counts.astype("<i8").tobytes(), len(texts), int(tokens.counts.sum()))
    for term, _, heads, postings in ranking.posting_lists(tokens, np.ones(len(tokens.words), bool)):
        segment.add(term, heads, postings)
    heap = ranking.Heap(3)
    heap.add(np.array([900_000 * 8] * 3), np.zeros(3, bool), np.array([10**6, 10**6 + 1, 10**6 + 2]))
    segment.search([("rare", 8_000), ("common", 1)], heap)
    assert heap.ids.tolist() == [0, 1, 2]
    assert segment.lists["common"].known.sum() == 1
