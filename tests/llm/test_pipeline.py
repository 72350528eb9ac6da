"""Each stage of the pipeline against a plain computation on what the stage before it kept."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import tokenizers

import corpus_pipeline
from llm import test_forest, test_pii, test_winnow
from llm.test_models import text

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)
    rows = [(i, text(r, lang, r.randint(30, 90)), lang, "s", 0) for i, lang in enumerate(["en", "de", "fr"] * 20)]
    base = rows[4][1].split()
    rows += [(100, rows[3][1], "en", "s", 0), (101, " ".join([*base, "onth"]), "de", "s", 0), (102, " ".join(base[:-1]), "de", "s", 0)]
    rows += [(110, rows[6][1] + " john.smith@mail.example.org and 10.20.30.40", "en", "s", 0), (111, rows[7][1] + " +49 (30) 1234567", "de", "s", 0)]
    rows += [(120, rows[9][1] + " " + " ".join(f"w{i}" for i in range(14)), "en", "s", 0), (130, None, "en", "s", 0), (131, "", None, "s", 0)]
    rows += [(140, "qxzj wvkpq jjxq zzqk xwqz qqjv kxzw " * 9, None, "s", 0), (0, rows[0][1], "en", "t", 0)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS BIGINT) AS n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(f"W{i}" for i in range(12))), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_language_drops_what_no_language_explains(spark, folder):
    docs = documents(spark, folder)
    kept = STAGES["language"](spark, docs, folder)
    assert rows(kept) == rows(docs.where("doc_id NOT IN (130, 131, 140)"))


def test_one_of_each_group_of_copies_stays(spark, folder):
    docs = documents(spark, folder)
    kept = rows(STAGES["near_copies"](spark, docs, folder).select("doc_id", "text"))
    classes = test_forest.brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted({d for d, _ in kept}) == sorted({d for d, _, _, least in classes if d == least})
    assert len(kept) == len({d for d, _ in kept})
    assert not {100, 101, 102} & {d for d, _ in kept}


def test_benchmark_windows_are_dropped(spark, folder):
    docs = documents(spark, folder)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {d for d, _, n, _ in test_winnow.brute([(r.doc_id, r.text) for r in docs.collect()], items) if n}
    assert hit == {120}
    assert rows(STAGES["benchmark"](spark, docs, folder)) == rows(docs.where("doc_id <> 120"))


@pytest.mark.parametrize("columns", [["doc_id", "text", "lang", "source", "n_chars"], ["doc_id", "text"]])
def test_personal_data_is_masked_and_the_rest_left_alone(spark, folder, columns):
    docs = documents(spark, folder).select(columns)
    out = STAGES["personal_data"](spark, docs, folder)
    assert out.columns == columns and out.count() == docs.count()
    before = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    after = {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()}
    assert {d for d, _ in before - after} == {110, 111}
    assert all(not test_pii.brute(t or "") for _, t in after)
    if "n_chars" in columns:
        assert out.where("n_chars <> length(text)").isEmpty()


def test_tokens_are_those_of_the_library(spark, folder):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = documents(spark, folder)
    out = STAGES["bpe"](spark, docs, folder)
    want = sorted((r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in out.collect()) == want


def test_the_whole_run_is_the_stages_in_turn(spark, folder):
    known = documents(spark, folder).where("doc_id NOT IN (130, 131, 140)").collect()
    first = {d for d, _, _, least in test_forest.brute([(r.doc_id, r.text) for r in known]) if d == least}
    assert {100, 101, 102}.isdisjoint(first)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, folder).collect()) == sorted(first - {120})
