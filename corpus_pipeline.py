"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableloom.llm import bpe, forest, language, pii, winnow
from tableloom.llm.common import sifted
from tableloom.session import freeze


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that no learned language explains, among them those without a text or a letter; models are fitted on the
    rows with a language. Repeated rows are judged alike; without any row with a language all are dropped."""
    label = F.when(~language.held_out("doc_id", 3, 1), F.col("lang"))
    tagged = docs.select("doc_id", "text", "lang", F.xxhash64("text").alias("tag"))
    judged = language.fit_and_identify(tagged, label, keep=["doc_id", "tag"])
    return _without(docs, judged.where("rejected").select(F.col("row").alias("key")))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows as ``row`` under ``key``, their doc_id and a hash of their text: what a decision on a text is joined back by."""
    return docs.select(F.struct("*").alias("row"), F.struct("doc_id", F.xxhash64("text").alias("tag")).alias("key"))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` is not listed. Only those that may be listed are moved to a join."""
    keys = freeze(keys.distinct(), "keys")
    rows = sifted(_keyed(docs), F.col("key.tag"), keys.select("key.tag"))
    moved = rows.where("among").join(keys, "key", "left_anti")
    return rows.where("NOT among").select("row.*").union(moved.select("row.*"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one of the smallest doc_id (null last). Documents without words stay.
    Only rows that may share a key with a dropped row are moved to a join."""
    counts = forest.link_classes(docs).groupBy(F.struct("doc_id", "tag").alias("key")).agg(F.count(F.lit(1)).alias("rows"), F.count_if("keeper").alias("n"))
    fewer = freeze(counts.where("n < rows").select("key", "n"), "fewer")
    rows = sifted(_keyed(docs), F.col("key.tag"), fewer.select("key.tag"))
    some = rows.where("among").join(fewer, "key", "left").where("n IS NULL OR n > 0")
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    some = some.withColumn("nth", nth).where("n IS NULL OR nth <= n")
    return rows.where("NOT among").select("row.*").union(some.select("row.*"))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item. Null and empty texts hold none and stay; an empty benchmark drops nothing."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    tagged = docs.select("doc_id", "text", F.xxhash64("text").alias("tag"))
    return _without(docs, winnow.find_windows(tagged, items, keep=["doc_id", "tag"]).where("n_hit > 0").select(F.col("row").alias("key")))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars, where there is one, follows the new text. A null text stays null, all rows stay."""
    found = pii.find_personal_data(docs)
    masked = F.when(F.col("row.text").isNotNull(), pii.mask(F.col("row.text"), F.col("spans")))
    changed = {"text": masked}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") == 0, F.col("row.n_chars")).otherwise(F.length(masked)).cast(docs.schema["n_chars"].dataType)
    return found.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left, checked by decoding them; a null text is empty, repeated rows give a row each."""
    out = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("language", known_language), ("near_copies", one_of_each), ("benchmark", no_benchmark), ("personal_data", no_personal_data), ("bpe", tokens)]

ORACLE_SQL = None  # language models and a published merge table decide; tests/llm/test_pipeline.py holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return docs
