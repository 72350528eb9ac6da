from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tableloom.llm import phrases
from tests.llm.conftest import ODD_TEXTS


def expected(docs, least, top, longest=4):
    """All phrases of all pieces counted one by one."""
    f, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(w)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        over = defaultdict(int)
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    over[p[i:i + m]] = max(over[p[i:i + m]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * over[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], start=1)]
    return sorted(out)


def found(documents, docs, **options):
    table = documents([(i, text, lang, "s", 0) for i, (text, lang) in enumerate(docs)])
    return sorted(tuple(r) for r in phrases.collocations(table, **options).collect())


@pytest.mark.parametrize("segment_bytes", [500, 1 << 20])
def test_phrases_are_those_of_counting_one_by_one(documents, segment_bytes):
    rng = np.random.default_rng(3)
    names = ["a", "B", "ç", "漢", "dd", "e-e", "f\x00", "g"]
    docs = []
    for i in range(300):
        words = rng.choice(names, rng.integers(1, 40), p=np.array([8, 6, 5, 4, 3, 2, 1, 1]) / 30)
        seps = rng.choice([" ", "  ", "\t", ". ", "\n", " !", " "], len(words), p=[0.7, 0.08, 0.05, 0.05, 0.05, 0.05, 0.02])
        docs.append(("".join(w + s for w, s in zip(words, seps)), [None, "en", "und", "fr"][i % 4]))
    docs += [("New York City Hall " * 9, "en")] * 4
    options = {"least": 5, "top": 50}
    assert found(documents, docs, segment_bytes=segment_bytes, **options) == expected(docs, **options)


def test_odd_rows_and_empty_tables(documents):
    docs = [(r[1], r[2]) for r in ODD_TEXTS]
    assert found(documents, docs, least=2, top=9) == expected(docs, 2, 9)
    assert found(documents, [], least=2) == []
    assert found(documents, [(None, None), ("lonely", "en")], least=1) == []


@pytest.mark.parametrize("many", [10, 700])
def test_dense_and_sparse_tiles_count_alike(many):
    rng = np.random.default_rng(1)
    a, b = (np.minimum(rng.geometric(8 / many, 120_000) - 1, 3 * many) for _ in range(2))
    x, y, n = phrases.pair_counts(a, b)
    assert Counter(zip(a.tolist(), b.tolist())) == dict(zip(zip(x.tolist(), y.tolist()), n.tolist()))


def test_a_full_sieve_changes_no_result(documents, monkeypatch):
    docs = [("x y z u v w " * 5, "en"), ("y z q", "de")] * 3
    monkeypatch.setattr(phrases, "SIEVE_BITS", 3)
    assert found(documents, docs, least=4, top=20) == expected(docs, 4, 20)
