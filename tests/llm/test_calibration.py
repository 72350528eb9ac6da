"""The toxicity curve: what it is fitted on, and what it leaves in the counts."""

from __future__ import annotations

import random

from tableloom.llm import toxicity
from llm.test_models import text


def labelled(spark, r, ordinary, toxic, copies=1):
    mild = [(0, text(r, "en", 30)) for _ in range(ordinary)]
    bad = [(1, text(r, "en", 25) + f" vrakkul zomplat{x} vrakkula") for x in ["", "a", "o", "is"] * toxic][:toxic]
    return spark.createDataFrame((mild + bad) * copies, "label int, text string").repartition(3)


def test_all_labelled_rows_are_counted(spark):
    rows = labelled(spark, random.Random(1), 30, 10, 2)
    top = toxicity.fit(rows).counts.top
    assert top.selectExpr("sum(n0 + n1)").first()[0] == sum(len(w.encode()) + 1 for x in rows.collect() for w in x.text.split())


def test_rare_toxic_texts_and_a_hot_text_still_give_a_curve(spark):
    r = random.Random(2)
    rows = labelled(spark, r, 400, 4)
    hot = spark.createDataFrame([(0, "one very common line of words")] * 500, "label int, text string")
    scorer = toxicity.fit(rows.union(hot))
    assert scorer.weights is not None
    unseen = spark.createDataFrame([(0, text(r, "en", 30)), (1, text(r, "en", 25) + " vrakkulo zomplat vrakkul")], "label int, text string")
    found = {x.row.label: x.score for x in toxicity.score(unseen, scorer).collect()}
    assert found[1] > 10 * found[0]


def test_one_text_of_a_class(spark):
    assert toxicity.fit(labelled(spark, random.Random(3), 20, 1)).weights is not None
