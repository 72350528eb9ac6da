from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tableloom.llm import suffixes
from llm.conftest import ODD_TEXTS


def brute(rows, length, keep_first):
    data = [(i, (t or "").encode()) for i, t in rows]
    if keep_first:  # one id with one text is one document
        order = sorted(set(data), key=lambda x: (x[0] is None, x[0] or 0))
    else:
        order = data
    where, gone = defaultdict(list), [np.zeros(len(b), bool) for _, b in order]
    for k, (_, b) in enumerate(order):
        for s in range(len(b) - length + 1):
            where[b[s:s + length]].append((k, s))
    for found in where.values():
        if len(found) > 1:
            for k, s in found[1:] if keep_first else found:
                gone[k][s:s + length] = True
    cut = {x: g for x, g in zip(order, gone, strict=True)} if keep_first else None
    out = []
    for n, x in enumerate(data):
        g = cut[x] if keep_first else gone[n]
        kept = np.frombuffer(x[1], np.uint8)[~g].tobytes()
        out.append((x[0], len(x[1]), int(g.sum()), int((g[1:] & ~g[:-1]).sum() + (len(g) > 0 and g[0])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts():
    r = random.Random(3)
    pieces = ["alpha", "beta ", "gam", "ma é", "漢字", "x", "\n", "the quick "]
    base = ["".join(r.choice(pieces) for _ in range(r.randint(1, 120))) for _ in range(40)]
    line, out = "A common licence line that is in many texts, " * 3, []
    for i in range(150):
        parts = [
            r.choice(base)[r.randint(0, 30):] if r.random() < 0.5 else "".join(r.choice(pieces) + str(r.random()) for _ in range(r.randint(1, 40)))
            for _ in range(r.randint(1, 5))
        ]
        out.append((100 + i, "".join(parts) + line * (r.random() < 0.4), "en", "s", 0))
    return out + [(1002, "a" * 3000, "en", "s", 0), (1003, "ab" * 800, "en", "s", 0)] + [x for x in ODD_TEXTS if x[0] not in (3, 4)]


@pytest.mark.parametrize("gathered", [2000, 3])
@pytest.mark.parametrize("keep_first", [False, True])
def test_against_brute_force(documents, monkeypatch, gathered, keep_first):
    monkeypatch.setattr(suffixes, "GATHERED", gathered)
    rows = texts()
    found = suffixes.remove_repeats(documents(rows), keep_first=keep_first).collect()
    got = sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in found), key=str)
    want = brute([(x[0], x[1]) for x in rows], 200, keep_first)
    if keep_first:  # equal positions are ordered by doc_id first; compare what does not depend on the order within one id
        assert [g[:2] for g in got] == [w[:2] for w in want]
    assert got == want


def test_empty_table(documents):
    assert suffixes.remove_repeats(documents([])).count() == 0
