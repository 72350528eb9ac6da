"""Connected components of long chains, whose smallest label has far to go."""

from __future__ import annotations

import random

from tableloom.llm.components import components


def test_a_long_chain_in_shuffled_order_settles(spark):
    r = random.Random(8)
    chain, other = list(range(5_000)), [7_003, 7_001, 7_002]
    r.shuffle(chain)
    edges = [e for ids in (chain, other) for e in zip(ids, ids[1:], strict=False)] + [(9_000, 9_000)]
    found = {x.id: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == dict.fromkeys(chain, 0) | dict.fromkeys(other, 7_001)


def test_a_chain_that_falls_but_for_its_first_id(spark):
    n = 300
    ids = [0, *range(n, 0, -1)]
    found = {x.id: x.root for x in components(spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long")).collect()}
    assert found == dict.fromkeys(ids, 0)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
