"""What the language models keep of a corpus."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from tableloom.llm import kneser_ney, language


@pytest.mark.parametrize("operator", [language])
def test_no_two_of_many_grams_share_their_counts(operator):
    grams = ["".join(g) for g in itertools.islice(itertools.product("abcdefghij", repeat=6), 300_000)]
    assert len(np.unique(kneser_ney.Model(["a"], 6, operator.SLOT_BITS, 0).slots(grams))) == len(grams)


def test_spark_and_the_model_address_grams_alike(spark):
    r = random.Random(4)
    words = ["".join(r.choice("abcé漢") for _ in range(r.randint(1, 6))) for _ in range(200)]
    model = kneser_ney.fit(spark.createDataFrame([("x", " ".join(words))], "label string, text string"), 3, language.SLOT_BITS)
    grams = {g for w in words for g in kneser_ney.grams_of(w, 3)}
    for k, t in enumerate(model.tables, start=1):
        assert t.slots.tolist() == sorted(model.slots(list({g[3 - k:] for g in grams})))
