"""Verification inside a group of candidates, which need not have met in a band themselves."""

from __future__ import annotations

import random

import numpy as np

from tableloom.llm import forest


def test_all_pairs_of_a_block_are_verified():
    r = random.Random(9)
    rows = [(i, False, np.array(sorted(r.sample(range(100), 100 - 4 * i)), np.int64)) for i in range(7)]
    sets = [set(x[2].tolist()) for x in rows]
    expected = {i: n for i, a in enumerate(sets) if (n := sum(5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets) if i != j))}
    assert {i: n for i, n, _ in forest._pairs_of_block(rows, False, 0.8)} == expected
