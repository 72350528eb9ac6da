"""WARC transactions, preference pairs, inner products, and the registered queries against their SQL."""

from __future__ import annotations

import hashlib
import os

import duckdb
import numpy as np
import pytest

from tableloom.llm import mtree, preferences, warc
from tableloom.llm.queries import ORACLES, QUERIES
from test_queries_against_sql import SF, TABLES, canonical


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got[1]
    if name in ORACLES:
        cur = duck.execute(ORACLES[name])
        assert got == canonical([d[0] for d in cur.description], cur.fetchall())


def test_captures(spark):
    tricky = "HTTP/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 4
    rows = [(3, "http://a/b c%?q=é\r\nX: y", "é" * 60), (1, None, "é" * 60), (2, "", "x" * 99), (4, "u", "x" * 99), (5, "u", None), (6, "u", ""), (7, "t", tricky), (8, "t", tricky),
            (None, "n", "é" * 60), (9, "long", "z" * 2_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS capture").repartition(3)
    found = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    assert len(found) == len(rows)
    for page, url, html in rows:
        body = (html or "").encode()
        assert (found[page].url, found[page].payload_bytes, found[page].payload_digest) == (url, len(body), hashlib.sha256(body).hexdigest())
    assert {p: found[p].refers_to for p in found if found[p].record_type == "revisit"} == {3: 1, None: 1, 8: 7}
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def test_a_capture_has_its_three_records(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "<p>hi</p>")], "page_id long, url string, html string")
    warc.write_archives(warc.plan_records(pages, "page_id", "url", "html"), str(tmp_path / "w"))
    (capture,) = warc.assemble(warc.read_archives(spark, str(tmp_path / "w"))).collect()
    assert [capture[k].kind for k in ("request", "response", "metadata")] == ["request", "response", "metadata"]
    assert capture.response.payload == b"<p>hi</p>" and capture.request.concurrent_to == capture.response.record_id == capture.capture_id


def test_preferences(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "good day"), (2, 0, "user", "hi"), (2, 1, "assistant", "<|im_end|>"), (2, 2, "user", None), (3, 0, "user", "hi"),
            (4, 0, None, "other"), (None, 0, "user", "hi"), (5, None, "user", "hi"), (5, 0, "assistant", "good day"), (5, 0, "assistant", "good day")]
    talks = preferences.gathered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "2 AS prompt"))
    pairs = preferences.pairs_by_opening(talks)
    assert {tuple(r) for r in pairs.collect()} == {(5, 1), (5, 2), (5, 3)}
    found = {r.rejected_id: r for r in preferences.format_pairs(talks, pairs.union(pairs)).collect()}
    assert {k: r.n_common for k, r in found.items()} == {1: 2, 2: 1, 3: 1}
    assert found[1].prompt.count("<|im_start|>") == 2 and found[1].rejected == "" and found[1].rejected_mask == []
    assert found[2].rejected == "<|im_start|>assistant\n<\\|im_end|><|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert [found[2].rejected[s.start:s.end] for s in found[2].rejected_mask] == ["<\\|im_end|><|im_end|>"]
    assert [found[2].chosen[s.start:s.end] for s in found[2].chosen_mask] == ["good day<|im_end|>"] * 2
    assert preferences.format_pairs(talks.where("false"), pairs).count() == 0


def test_inner_products_with_ties_copies_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "FANOUT", 4)
    rng = np.random.default_rng(0)
    vectors = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)]
    vectors += [(300 + i, vectors[7][1]) for i in range(40)] + [(500, None), (501, [1.0, None] + [0.0] * 4), (502, [float("nan")] * 6), (503, [float("inf")] * 6)]
    vectors += [(600, [0.5, 0.5]), (601, [0.25, 1.0]), (650, []), (700, vectors[0][1]), (700, vectors[0][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "1 AS v", "2 AS score").repartition(4)
    own = mtree.quantised(df, "vec_id", "embedding")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in mtree.top_k(own, own.where("vec_id % 50 = 0"), 5).collect())
    clean = {(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q, v in clean:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in clean if i != q and len(w) == len(v))[:5]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    assert mtree.top_k(own.where("false"), own.where("false"), 5).count() == 0


def test_pipeline_runs_and_drops_what_it_should(spark):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_copies", "benchmark", "personal_data", "bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, SF)
        assert out.columns == docs.columns
        left = out
    assert 0 < left.count() <= docs.count()
    assert os.path.isdir(SF)
