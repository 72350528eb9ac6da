"""Kneser-Ney models: against a plain computation, and by held-out accuracy."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableloom.llm import kneser_ney, language, toxicity
from llm.conftest import ODD_TEXTS

SYLLABLES = {"en": ["th", "er", "ing", "on", "ed"], "de": ["sch", "ung", "ein", "ü", "keit"], "fr": ["eau", "é", "tion", "ç", "oi"]}


def text(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.mark.parametrize("shared", [False, True])
def test_probabilities_against_a_plain_computation(spark, shared):
    r = random.Random(1)
    rows = [(lang, text(r, lang, 8)) for lang in ("en", "de") for _ in range(6)]
    order = 3
    model = kneser_ney.fit(spark.createDataFrame(rows, "label string, text string"), order, 26, shared_backoff=shared)
    tops = {c: Counter(g for lang, t in rows if lang == c for w in kneser_ney.words_of(t) for g in kneser_ney.grams_of(w, order)) for c in ("de", "en")}
    letters = len({g[-1] for c in tops.values() for g in c})

    def probability(counts, gram, all_counts):
        k = len(gram)
        below = {g[1:]: 0 for g in (all_counts if shared and k == order else counts)}
        for g in (all_counts if shared and k == order else counts):
            below[g[1:]] += 1
        p = probability(below, gram[1:], below) if k > 1 else 1 / (letters + 1)
        total = sum(n for g, n in counts.items() if g[:-1] == gram[:-1])
        kinds = sum(g[:-1] == gram[:-1] for g in counts)
        one, two = (sum(n == x for n in counts.values()) for x in (1, 2))
        d = min(max(one / (one + 2 * two), 0.1), 0.95) if one + two else 0.5
        return max(counts.get(gram, 0) - d, 0) / total + d * kinds / total * p if total else p

    grams = list(tops["en"])[:25] + ["zzz", "\x02\x02q"]
    got = model.log_probabilities(grams)
    for i, g in enumerate(grams):
        for c, name in enumerate(("de", "en")):
            assert got[i, c] == pytest.approx(math.log(probability(tops[name], g, tops["de"] + tops["en"])), rel=1e-4)


def test_languages_are_told_apart_and_noise_is_rejected(documents):
    r = random.Random(2)
    rows = [(i, text(r, lang, r.randint(5, 60)), lang, "s", 0) for i, lang in enumerate(["en", "de", "fr"] * 60)]
    table = documents(rows)
    fitted = language.fit(table.where(~language.held_out("doc_id", 3, 1)).select(F.col("lang").alias("label"), "text"))
    noise = [(1000, "qxzj wvkpq jjxq zzqk xwqz qqjv kxzw" * 5, "en", "s", 0)]
    found = {x.row.doc_id: x for x in language.identify(documents(rows + noise), fitted).collect()}
    assert all(found[i].lang_pred == lang and not found[i].rejected and 0 <= found[i].score <= 1 for i, _, lang, _, _ in rows)
    assert found[1000].rejected
    odd = {x.row.doc_id: x for x in language.identify(documents(ODD_TEXTS), fitted).collect()}
    assert [odd[i].lang_pred for i in (1, 2, 6)] == ["und"] * 3 and all(odd[i].rejected and odd[i].score == 0 for i in (1, 2, 6))
    assert odd[7].lang_pred in SYLLABLES


def test_nothing_learned(documents):
    table = documents(ODD_TEXTS)
    fitted = language.fit(table.where("false").select(F.col("lang").alias("label"), "text"))
    assert {x.lang_pred for x in language.identify(table, fitted).collect()} == {"und"}
    scorer = toxicity.fit(table.where("false").select(F.lit(1).alias("label"), "text"))
    assert {x.score for x in toxicity.score(table, scorer).collect()} == {0.5}


def test_toxic_words_are_found_in_unseen_texts(documents):
    r = random.Random(3)
    rows, toxic = [], {}
    for i in range(900):
        words = text(r, "en", r.randint(20, 80)).split()
        toxic[i] = i % 6 == 0
        if toxic[i]:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["vrakkul", "zomplat"]) + r.choice(["a", "o", "is", ""]))
        rows.append((i, " ".join(words), "en", "s", 0))
    known = documents([x for x in rows if x[0] % 5]).select(F.when(F.col("doc_id") % 6 == 0, 1).otherwise(0).alias("label"), "text")
    scorer = toxicity.fit(known)
    found = {x.row.doc_id: x.score for x in toxicity.score(documents(rows), scorer).collect()}
    held = [i for i in found if i % 5 == 0]
    assert sum((found[i] >= 0.5) == toxic[i] for i in held) >= 0.97 * len(held)
    odd = toxicity.score(documents(ODD_TEXTS), scorer).collect()
    assert len(odd) == len(ODD_TEXTS) and all(0 <= x.score <= 1 for x in odd)
    assert toxicity.score(documents([]), scorer).count() == 0
