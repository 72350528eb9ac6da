from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableloom.llm import ctw
from tests.llm.conftest import ODD_TEXTS


class Tree:
    """One bit's context tree, node by node as the definition has it."""

    def __init__(self):
        self.counts = defaultdict(lambda: [0, 0])
        self.longer = defaultdict(set)

    def learn(self, context, bit):
        for d in range(len(context) + 1):
            own = context[len(context) - d:]
            self.counts[own][bit] += 1
            if d:
                self.longer[own[1:]].add(own)

    def estimate(self, node):
        a, b = self.counts[node] if node in self.counts else (0, 0)
        return 2 * -math.lgamma(0.5) + math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1)

    def mixed(self, node, depth):
        if len(node) == depth:
            return self.estimate(node)
        return np.logaddexp(self.estimate(node), sum(self.mixed(n, depth) for n in self.longer.get(node, ()))) - math.log(2)

    def probability(self, context, bit):
        """The ratio of the root's mixtures with and without one more bit."""
        depth = len(context)
        before = self.mixed(b"", depth)
        self.learn(context, bit)
        after = self.mixed(b"", depth)
        for d in range(depth + 1):
            self.counts[context[depth - d:]][bit] -= 1
        return after - before


def coded(text):
    data = (text or "").encode() + b"\xff"
    padded = b"\xff" * ctw.DEPTH + data
    for i, byte in enumerate(data):
        for k in range(8):
            yield padded[i:i + ctw.DEPTH], (1 << k) | byte >> (8 - k), byte >> (7 - k) & 1


def expected_scores(docs):
    trees = defaultdict(Tree)
    for text, trained in docs:
        if trained:
            for context, known, bit in coded(text):
                trees[known].learn(context, bit)
    return [sum(trees[known].probability(context, bit) for context, known, bit in coded(text)) / math.log(10) for text, _ in docs]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [""]


def expected_base(docs):
    c = Counter(w for text, trained in docs if trained for w in words_of(text))
    n = sum(c.values())
    below = n + 0.1 * (len(c) + 1)
    return [(len(words_of(t)), sum(c[w] > 0 for w in words_of(t)), n, sum(math.log10((c[w] + 0.1) / below) for w in words_of(t))) for t, _ in docs]


def found(documents, docs, **sizes):
    table = documents([(i, text, "en", "s", int(trained)) for i, (text, trained) in enumerate(docs)])
    out = ctw.score(table, F.col("n_chars") == 1, keep=["doc_id"])
    return out.orderBy("row.doc_id").collect()


@pytest.mark.parametrize("small", [False, True])
def test_scores_are_those_of_the_definition(documents, monkeypatch, small):
    if small:
        monkeypatch.setattr(ctw, "SEGMENT_BYTES", 40)
        monkeypatch.setattr(ctw, "PASS_BYTES", 25)
    docs = [("the cat sat on the mat", True), ("The Cat\tsat", True), ("", True), ("the cat sat on the mat", False), ("zebra ñandú", False), (None, False), ("the then they", False), ("aaaa", True)]
    got = found(documents, docs)
    assert [r.score for r in got] == pytest.approx(expected_scores(docs), rel=1e-9)
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [pytest.approx(x) for x in expected_base(docs)]
    assert got[0].bits_per_byte == pytest.approx(-got[0].score * math.log2(10) / 23)


def test_probabilities_of_all_next_bytes_add_up_to_one(spark):
    """Of any context, seen or not, the 256 next bytes share one probability."""
    rng = np.random.default_rng(2)
    number = lambda values: int.from_bytes(bytes(int(v) for v in values), "big")
    seen = rng.integers(97, 100, (300, ctw.DEPTH + 1))
    asked = [list(seen[0][:ctw.DEPTH]), [97, 97, 98, 99, 97], [1, 2, 3, 4, 97], [250, 251, 252, 253, 254]]
    rows = Counter(number(r) for r in seen)
    for context in asked:
        for byte in range(256):
            rows.setdefault(number([*context, byte]), 0)
    runs = np.array(sorted(rows))
    counts = np.array([rows[r] for r in runs.tolist()])
    part = ctw._dealt(runs)
    sums = spark.createDataFrame([(int(p), ctw.planes(runs[part == p].astype("<i8")), ctw.planes(counts[part == p].astype("<i8"))) for p in set(part.tolist())], "part int, keys binary, n binary")
    values = dict(zip(runs.tolist(), ctw.log_probabilities(runs, counts, ctw.fit_roots(sums))))
    for context in asked:
        assert sum(10 ** values[number([*context, byte])] for byte in range(256)) == pytest.approx(1)


def test_numbers_survive_their_planes():
    for values in (np.array([], "<i8"), np.array([0, -1, 1 << 47, 255], "<i8"), np.array([0.5, -1e300, np.inf])):
        assert ctw.from_planes(ctw.planes(values), values.dtype.str).tolist() == values.tolist()


def test_lookup_finds_every_run():
    keys = np.unique(np.random.default_rng(4).integers(0, 1 << 48, 50_000))
    values = keys * 0.5
    lookup = ctw.Lookup(keys, values)
    assert 0 < len(lookup.more) < len(keys) // 4
    assert (lookup(keys[::-1]) == values[::-1]).all()


def test_log_gamma():
    n = np.array([0, 1, 2, 5, 30, 1e3, 1e7])
    assert ctw.log_gamma_one(n) == pytest.approx([math.lgamma(x + 1) for x in n], rel=1e-12, abs=1e-9)
    assert ctw.log_gamma_half(n) == pytest.approx([math.lgamma(x + 0.5) - math.lgamma(0.5) for x in n], rel=1e-12, abs=1e-9)


def test_odd_rows_nothing_learned_and_empty_tables(documents):
    docs = [(r[1], False) for r in ODD_TEXTS]
    got = found(documents, docs)
    assert [r.score for r in got] == pytest.approx([-(len((t or "").encode()) + 1) * 8 * math.log10(2) for t, _ in docs])
    assert [(r.n_known, r.train_tokens, r.base_score) for r in got] == [(0, 0, pytest.approx(0))] * len(docs)
    assert found(documents, []) == []
    docs = [(r[1], True) for r in ODD_TEXTS]
    got = found(documents, docs)
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [pytest.approx(x) for x in expected_base(docs)]
    assert got[3].bits_per_byte < 0.1  # thirty thousand times one word
