from __future__ import annotations

import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """Builds a documents table with clashing extra columns."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        clash = ("score", "row", "packed", "n_words", "at", "tag", "blocks", "trees", "label")
        return df.withColumns({c: F.lit(7) for c in clash}).repartition(5)

    return make


#: Nulls, empty and very long texts, ties, repeated rows.
ODD_TEXTS = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (None, "one two three four five six", "en", "s", 27), (3, "word " * 30_000, "en", "s", 150_000),
    (4, "x" * 50_000, "de", "s", 50_000), (5, "one two three four five six", "en", "s", 27), (5, "one two three four five six", "en", "s", 27),
    (6, "12 34 ½ !!", "fr", None, 10), (7, "漢字 🙂 é", "es", "s", 6),
]
