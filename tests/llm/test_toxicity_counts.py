"""The evidence of runs of bytes, from Spark's tables, against a plain computation; the whole query against one too."""

from __future__ import annotations

from collections import Counter
import math
import random

import pyarrow as pa
import pytest

from llm.test_models import text
from tableloom.llm import toxicity
from tableloom.llm.ctw import runs_of_bytes


def runs(words):
    return [int(g).to_bytes(toxicity.ORDER, "big") for g in runs_of_bytes(pa.array(words))[1]]


def plain_evidence(rows, held):
    """Both models of ``label, sampled, text`` worked out one run at a time."""
    n = {c: Counter(g for label, sampled, t in rows if label == c and not (held and sampled) for g in runs(t.split())) for c in (0, 1)}
    seen = {toxicity.ORDER: set(g for _, _, t in rows for g in runs(t.split()))}
    counts = {}
    for k in range(toxicity.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in seen[k + 1])
        seen[k] = set(counts[k])

    def discount(c):
        one, two = (sum(v == x for v in c.values()) for x in (1, 2))
        return min(max(one / (one + 2 * two), 0.1), 0.95) if one + two else 0.5

    def smooth(c, g, below):
        total = sum(v for h, v in c.items() if h[:-1] == g[:-1])
        kinds = sum(v > 0 and h[:-1] == g[:-1] for h, v in c.items())
        d = discount(c)
        return (max(c[g] - d, 0) + d * kinds * below) / total if total else below

    def lean(g):
        p = 1 / (len(counts[1]) + 1)
        for k in range(1, toxicity.ORDER):
            p = smooth(counts[k], g[-k:], p)
        return math.log(smooth(n[1], g, p)) - math.log(smooth(n[0], g, p))

    return lean


@pytest.mark.parametrize("held", [False, True])
def test_evidence_against_a_plain_computation(spark, held):
    r = random.Random(5)
    rows = [(i % 2, i % 5 == 0, text(r, "de" if i % 2 else "en", 6)) for i in range(30)]
    counts = toxicity.count(spark.createDataFrame(rows, "label int, sampled boolean, text string"))
    words = [w for _, _, t in rows[:6] for w in t.split()] + ["zzz", "über", "thering"]
    asked = spark.createDataFrame([(int.from_bytes(g, "big"),) for g in set(runs(words))], "gram long")
    lean = plain_evidence(rows, held)
    found = {x.gram: x.lean for x in toxicity.evidence(counts, asked, held).collect()}
    assert len(found) == asked.count()
    for g, value in found.items():
        assert value == pytest.approx(lean(g.to_bytes(toxicity.ORDER, "big")), abs=1e-9)


@pytest.mark.parametrize("size", [400, 4_000_000])
def test_a_text_is_described_by_its_words(spark, documents, monkeypatch, size):
    monkeypatch.setattr(toxicity, "RANGE", size)
    r = random.Random(7)
    rows = [(i % 2, False, text(r, "de" if i % 2 else "en", 6)) for i in range(24)]
    counts = toxicity.count(spark.createDataFrame(rows, "label int, sampled boolean, text string"))
    lean = plain_evidence(rows, False)
    texts = ["Thering ung, SCHUNG on2on", "über", "", None, "42", "ing " * 40]
    out = {x.row.doc_id: x for x in toxicity.described(documents([(i, t, "en", "s", 0) for i, t in enumerate(texts)]), counts, False, "text", ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        words = ["".join(c if c.isalpha() else " " for c in (t or "").lower())][0].split()
        values = sorted((sum(lean(g) for g in runs([w])) for w in words), reverse=True)
        size = sum(len(w.encode()) + 1 for w in words)
        want = [sum(values) / max(size, 1), *(min(max(v, 0), 25) for v in (values + [0, 0])[:2]), math.log1p(sum(max(v - toxicity.STRONG, 0) for v in values)), math.log1p(len(words))]
        assert [out[i][f"f{j}"] for j in range(toxicity.FEATURES)] == pytest.approx(want, abs=1e-4)
