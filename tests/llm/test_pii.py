from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from tableloom.llm import pii
from llm.conftest import ODD_TEXTS


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    text, digits, out = text or "", lambda s: re.sub("[^0-9]", "", s), []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    out += [("card", *m.span()) for m in cards if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m.group())) <= 15]


def test_base_spans_against_brute_force(documents):
    r = random.Random(5)
    parts = ["a@b.c_d@e.f", "a.b%+-@x-y.z", "1.2.3.4", "255.256.1.0", "4041894974608795", "4041 8949-7460 8795", " ", "+1 (988) 555-2485", "🙂é", "..", "@",
             "0001.2.3.4", "+", "12", "a", "_", "-", "+44", "z@", "b@c.d", "\n"]
    rows = [(100 + i, "".join(r.choice(parts) for _ in range(r.randint(1, 14))), "en", "s", 0) for i in range(800)]
    rows += [(90 + i, t, "en", "s", 0) for i, t in enumerate(["a" * 30_000, "1" * 30_000, "1 " * 3_000, "+1" * 3_000, "a@b." * 300])]
    for x in pii.find_personal_data(documents(rows + ODD_TEXTS)).collect():
        assert [tuple(s) for s in x.base] == brute(x.row.text)
        assert [tuple(s) for s in x.spans if s.kind != "found"] == brute(x.row.text)


def test_contexts_of_seeds_find_what_no_pattern_knows(documents):
    seeds = [(i, f"lorem {'ipsum' * (i % 3)} reachable via user{1000 + i}@mail.org today", "en", "s", 0) for i in range(8)]
    rows = seeds + [(50, "as ever reachable via agent-77-0042 today", "en", "s", 0), (51, "in the year of our 2024-25-26 season", "en", "s", 0)]
    found = {x.row.doc_id: [(s.start, s.end) for s in x.spans if s.kind == "found"] for x in pii.find_personal_data(documents(rows)).collect()}
    text = rows[8][1]
    assert found[50] == [(text.index("agent"), text.index(" today"))]
    assert not any(found[i] for i in found if i != 50)


def test_masking(spark):
    text = "é a@b.c and +1 (988) 555-2485!"
    spans = [("phone", 12, 29), ("email", 2, 7), ("card", 20, 29)]
    df = spark.createDataFrame([(text, spans), ("plain", [])], "text string, spans array<struct<kind:string,start:int,end:int>>")
    masked = [r[0] for r in df.select(pii.mask(F.col("text"), F.col("spans"))).collect()]
    assert masked == ["é [EMAIL] and [PHONE]!", "plain"]


def test_no_python_runs(documents):
    plan = pii.find_personal_data(documents(ODD_TEXTS))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert pii.find_personal_data(documents([])).count() == 0
