"""Bootstrapping from seeds, and to tokens, that hold white space or few digits."""

from __future__ import annotations

import pytest

from tableloom.llm import pii


@pytest.mark.parametrize("seeds, unseen", [
    ([f"+1 (988) 555-24{i}5" for i in range(8)], "agent-77-0042"),
    (["4041 8949 7460 8795"] + [f"+44 20 7946 0{i}12" for i in range(7)], "7946 0958 33"),
    ([f"{x}.smith@mail.org" for x in ("ann", "bob", "cy", "dora", "eve", "fay", "gil", "hal")], "jo.smith@localhost"),
    ([f"10.0.0.{i}" for i in range(8)], "12-34-56"),
])
def test_spans_of_any_shape_seed_and_are_found(documents, seeds, unseen):
    rows = [(i, f"lorem {'ipsum' * (i % 3)} please call {x} today", "en", "s", 0) for i, x in enumerate(seeds)]
    late = f"as ever please call {unseen}, today"
    found = {x.row.doc_id: [(s.start, s.end) for s in x.spans if s.kind == "found"] for x in pii.find_personal_data(documents([*rows, (50, late, "en", "s", 0)])).collect()}
    assert found.pop(50) == [(late.index(unseen), late.index(", today"))]
    assert not any(found.values())
