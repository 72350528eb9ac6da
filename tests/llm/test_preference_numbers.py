"""Conversations are paired by number exactly, however large the numbers are."""

from __future__ import annotations

import pytest

from tableloom.llm import preferences


@pytest.mark.parametrize("first", [0, 2**53, 2**62, -6])
def test_neighbours_by_number(spark, first):
    rows = [(first + i, 1, "assistant", "x" * (i + 1)) for i in range(8)]
    talks = preferences.gathered(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    pairs = sorted(tuple(r) for r in preferences.pairs_by_number(talks).collect())
    assert pairs == [(first + i + 1, first + i) for i in range(0, 8, 2)]
