"""Joins by a hash move few texts, the stages store none, and what is kept is the same."""

from __future__ import annotations

from collections import Counter
from pathlib import Path
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tableloom.llm import common, language
from tableloom.session import freeze
from llm.test_models import text


@pytest.fixture
def shuffled(spark):
    """Bytes of the shuffle files written since the last call; joins that shuffle do so whatever their size."""
    conf, seen = "spark.sql.autoBroadcastJoinThreshold", set()
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    folders = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def since():
        files = {f for folder in folders for f in Path(folder).rglob("shuffle_*.data")} - seen
        seen.update(files)
        return sum(f.stat().st_size for f in files if f.exists())

    since()
    yield since
    spark.conf.set(conf, before)


def long_texts(r, n):
    return [" ".join(f"{r.getrandbits(60):015x}" for _ in range(400)) for _ in range(n)]


def test_near_copies_move_few_texts(spark, shuffled):
    r = random.Random(12)
    rows = list(enumerate(long_texts(r, 300)))
    rows += [(1000 + i, t + " more") for i, t in rows[:10]]
    docs = freeze(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    shuffled()
    kept = corpus_pipeline.one_of_each(spark, docs, "").select("doc_id").collect()
    assert sorted(x.doc_id for x in kept) == list(range(300))
    assert shuffled() < sum(len(t) for _, t in rows) / 2


def test_benchmark_moves_few_texts(spark, shuffled, tmp_path):
    r = random.Random(13)
    rows = list(enumerate(long_texts(r, 300)))
    items = [(1, rows[7][1][1600:1840]), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = freeze(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    shuffled()
    kept = corpus_pipeline.no_benchmark(spark, docs, str(tmp_path)).collect()
    assert sorted(x.doc_id for x in kept) == [i for i in range(300) if i != 7]
    assert shuffled() < sum(len(t) for _, t in rows) / 4


def test_language_stores_no_texts(spark, documents, monkeypatch):
    stored, plain = [], language.freeze
    monkeypatch.setattr(language, "freeze", lambda df, label="frozen": stored.append(df.schema.simpleString()) or plain(df, label))
    r = random.Random(14)
    docs = documents([(i, text(r, "en", 20), "en", "s", 0) for i in range(60)] + [(60, None, "en", "s", 0), (61, "12", None, "s", 0)] * 2)
    assert sorted(x.doc_id for x in corpus_pipeline.known_language(spark, docs, "").collect()) == list(range(60))
    assert stored and not any("text" in kind for kind in stored)


def test_repeated_rows_and_ids_keep_their_number(spark):
    r = random.Random(15)
    a, b, c = long_texts(r, 3)
    rows = [(5, a, "x"), (5, a, "x"), (5, a, "y"), (3, a + " z", "x"), (None, b, "x"), (None, b, "x"), (None, c, "x"), (7, c, "x"), (8, "", "x"), (8, "", "x"), (9, None, "x"), (9, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(4)
    got = Counter((x.doc_id, x.text) for x in corpus_pipeline.one_of_each(spark, docs, "").collect())
    assert got == Counter({(3, a + " z"): 1, (None, b): 1, (7, c): 1, (8, ""): 2, (9, None): 2})


@pytest.mark.parametrize(("most", "tags"), [(1 << 26, 500), (1 << 26, 0), (1 << 26, 1), (1 << 9, 500)])
def test_a_sieve_passes_all_that_are_listed(spark, monkeypatch, most, tags):
    monkeypatch.setattr(common, "MOST_BITS", most)
    hashes = spark.range(5_000).select("id", F.xxhash64("id").alias("tag"))
    rows = common.sifted(hashes, F.col("tag"), hashes.where(F.col("id") < tags).select("tag")).collect()
    assert len(rows) == 5_000 and all(x.among for x in rows if x.id < tags)
    passed = sum(x.among for x in rows if x.id >= tags)
    assert passed < 5_000 if most < 32 * 500 else passed <= 5_000 / common.BITS_A_TAG * 1.3
