"""More languages than any fixed number of columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tableloom.llm import language


def test_seventy_languages_are_told_apart(documents):
    r = random.Random(6)
    letters = {f"l{i}": r.sample("abcdefghijklmnopqrstuvwxyzäöüßéèçñåø", 5) for i in range(70)}
    rows = [(i, " ".join("".join(r.choice(letters[lang]) for _ in range(6)) for _ in range(30)), lang, "s", 0) for i, lang in enumerate(list(letters) * 4)]
    table = documents(rows)
    found = {x.row.doc_id: x.lang_pred for x in language.identify(table, language.fit(table.select(F.col("lang").alias("label"), "text"))).collect()}
    assert sum(found[i] == lang for i, _, lang, _, _ in rows) >= 0.98 * len(rows)
