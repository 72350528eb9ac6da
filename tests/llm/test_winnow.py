from __future__ import annotations

import random
import re

from tableloom.llm import winnow
from llm.conftest import ODD_TEXTS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in range(1, 11):
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[g]
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def test_against_brute_force(spark, documents):
    r = random.Random(2)
    vocabulary = ["a", "B", "cé", "d1", "e", "f"] + [f"w{i}" for i in range(40)]
    some = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, some(r.choice((0, 1, 3, 6, 9, 10, 11, 25)))) for i in range(40)] + [(100, None), (101, ""), (None, some(12))]
    items.append((102, items[5][1]))
    texts = []
    for i in range(200):
        parts = [some(r.randint(0, 20))]
        for _ in range(r.randint(0, 3)):
            source = words(r.choice(items)[1])
            a = r.randint(0, max(len(source) - 1, 0))
            parts += [", ".join(source[a:a + r.choice((9, 10, 14, 40))]).upper(), some(r.randint(0, 8))]
        texts.append((1000 + i, " ".join(parts), "en", "s", 0))
    table = documents(texts + ODD_TEXTS)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("text", "body")
    rows = winnow.find_windows(table, bench, item_text="body").select("row.doc_id", "n_words", "n_hit", "item_ids").collect()
    got = sorted(((x.doc_id, x.n_words, x.n_hit, x.item_ids) for x in rows), key=str)
    assert got == brute([(t[0], t[1]) for t in texts + ODD_TEXTS], items)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in winnow.find_windows(documents([(1, "a b c", "en", "s", 5)]), none).collect()] == [0]
    assert winnow.find_windows(documents([]), none).count() == 0


def test_every_shared_window_has_a_common_fingerprint():
    import pyarrow as pa

    r = random.Random(4)
    shared = [f"s{r.randint(0, 3)}" for _ in range(winnow.WINDOW)]
    for _ in range(200):
        pad = lambda: [f"p{r.randint(0, 3)}" for _ in range(r.randint(0, 12))]
        prints = [winnow.Words(pa.array([" ".join(pad() + shared + pad())])).fingerprints(winnow.WINDOW, winnow.GRAM)[1] for _ in range(2)]
        assert set(prints[0].tolist()) & set(prints[1].tolist())
