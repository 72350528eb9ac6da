"""The rejection limits come from every different text, however many there are."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tableloom.llm import kneser_ney, language
from llm.test_models import text


def test_every_different_text_counts(spark):
    r = random.Random(4)
    rows = [(lang, text(r, lang, r.randint(1, 12))) for lang in ("en", "de") for _ in range(2_600)] + [("en", "12 34"), ("fr", None)]
    table = spark.createDataFrame(rows + rows[:500], "label string, text string").repartition(5)
    fitted = language.fit(table)
    entropies = language.Entropies(kneser_ney.WordValues(fitted.model))
    assert fitted.model.classes == ["de", "en"]
    for i, lang in enumerate(fitted.model.classes):
        own = sorted({t for x, t in rows if x == lang})
        found, chars = entropies(own)
        found, chars = found[chars > 0, i], chars[chars > 0]
        usual = (found * chars).sum() / chars.sum()
        off = (found - usual) ** 2
        assert fitted.usual[i] == pytest.approx(usual, rel=1e-9)
        assert fitted.spread[i] == pytest.approx(max(np.sqrt(np.median(off) / 0.455), 0.02), rel=1e-9)
        assert fitted.spread_of_one[i] == pytest.approx(max(np.sqrt(np.median(off * chars) / 0.455), 0.5), rel=1e-9)


def test_medians_are_exact(spark):
    r = random.Random(5)
    groups = {
        "odd": [r.gauss(0, 1) for _ in range(5_001)], "even": [10 ** r.uniform(-12, 6) for _ in range(6_000)], "split": [0.0] * 700 + [3.0] * 700,
        "equal": [2.5] * 900, "few": [1.0, 4.0], "one": [7.0], "close": [1.0 + i * 2**-52 for i in range(1_200)] + [1e9],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    found = language.medians(spark.createDataFrame(rows, "g string, v double").repartition(6), ["g"])
    assert found == {(g,): float(np.median(values)) for g, values in groups.items()}


def test_judging_the_rows_learned_from(documents):
    r = random.Random(6)
    rows = [(i, text(r, lang or "fr", r.randint(2, 30)), lang, "s", 0) for i, lang in enumerate(["en", "de", None] * 40)] + [(200, "qxzj wvkpq jjxq zzqk xwqz " * 6, None, "s", 0)]
    table = documents(rows)
    label = F.when(~language.held_out("doc_id", 3, 1), F.col("lang"))
    once = {x.row.doc_id: x[1:] for x in language.fit_and_identify(table, label).collect()}
    twice = {x.row.doc_id: x[1:] for x in language.identify(table, language.fit(table.select(label.alias("label"), "text"))).collect()}
    assert once == twice and len(once) == len(rows) and once[200][2]


def test_the_pipeline_learns_its_limits_from_all_texts(spark, documents, monkeypatch):
    made, plain = [], language.Identifier.__init__
    monkeypatch.setattr(language.Identifier, "__init__", lambda self, *parts: made.append(self) or plain(self, *parts))
    r = random.Random(7)
    table = documents([(i, text(r, "en", r.randint(1, 9)), "en", "s", 0) for i in range(3_600)])
    corpus_pipeline.known_language(spark, table, "")
    own = sorted({x.text for x in table.where(~language.held_out("doc_id", 3, 1)).select("text").collect()})
    found, chars = language.Entropies(kneser_ney.WordValues(made[0].model))(own)
    assert len(own) > 2_000
    assert made[0].usual[0] == pytest.approx((found[:, 0] * chars).sum() / chars.sum(), rel=1e-9)
