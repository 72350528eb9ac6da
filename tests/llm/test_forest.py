from __future__ import annotations

import random

from tableloom.llm import forest
from llm.conftest import ODD_TEXTS
from llm.test_winnow import words


def sets(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i:i + n]) for i in range(max(len(w) - n + 1, 1))) if w else frozenset()


def brute(docs):
    """(doc_id, copy_id, n_links, class_id) by comparing all sets."""
    key = lambda d: (d is None, d or 0)
    first = {}
    for d, t in sorted(docs, key=lambda x: key(x[0])):
        if sets(t):
            first.setdefault(sets(t), d)
    groups = list(first)
    links = {a: [b for b in groups if a != b and 5 * len(a & b) >= 4 * len(a | b)] for a in groups}
    root = {}
    for a in groups:
        if a not in root:
            seen, todo = {a}, [a]
            while todo:
                for b in links[todo.pop()]:
                    if b not in seen:
                        seen.add(b)
                        todo.append(b)
            least = min((first[x] for x in seen), key=key)
            root |= dict.fromkeys(seen, least)
    out = []
    for d, t in docs:
        s = sets(t)
        out.append((d, first[s], len(links[s]), root[s]) if s else (d, d, 0, d))
    return sorted(out, key=str)


def near_copies(r, n):
    base, out = [f"w{r.randint(0, 5000)}" for _ in range(r.randint(30, 120))], []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(len(copy))] = f"x{r.randint(0, 9)}"
        out.append(" ".join(copy))
    return out


def run(table, **options):
    rows = forest.link_classes(table, **options).collect()
    return rows, sorted(((x.doc_id, x.copy_id, x.n_links, x.class_id) for x in rows), key=str)


def test_against_brute_force(documents):
    r = random.Random(3)
    texts = [t for _ in range(25) for t in near_copies(r, r.choice((1, 2, 6)))]
    rows = [(100 + i, t, "en", "s", 0) for i, t in enumerate(texts)] + ODD_TEXTS
    found, got = run(documents(rows))
    assert got == brute([(x[0], x[1]) for x in rows])
    linked = {x.class_id for x in found if x.n_links}
    assert all(sum(x.keeper for x in found if x.class_id == c and x.copy_id is not None) == 1 for c in linked)


def test_large_groups_meet_block_by_block(documents, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 7)
    r = random.Random(5)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(near_copies(r, 60) + near_copies(r, 9))]
    assert run(documents(rows))[1] == brute([(x[0], x[1]) for x in rows])


def test_prefix_reaches_the_target_recall():
    d = forest.prefix_length()
    assert 1 - (1 - forest.SIMILARITY**d) ** forest.TREES >= forest.RECALL > 1 - (1 - forest.SIMILARITY ** (d + 1)) ** forest.TREES


def test_empty_table(documents):
    assert run(documents([]))[0] == []
