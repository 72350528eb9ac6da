"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.llm import bpe, common, ctw, forest, language, mtree, phrases, pii, preferences, ranking, suffixes, toxicity, warc, winnow
from tableloom.session import freeze

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query()
def op9_bpe_roundtrip(spark, sf):
    """Tokens of every document and the text decoded from them, as digests."""
    out = bpe.encode_decode(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
     d AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
     f AS (SELECT digest, min(page_id) AS first_id FROM d GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN f USING (digest)
""")
def op4_warc_transactions(spark, sf):
    """Every page written as a capture of three records, read back and joined by their concurrent-to identifiers."""
    return warc.archive_round_trip(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The words of a text, as the contract of this query defines them.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
             FROM b, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 9))) AS i) s WHERE len(w) > 0),
     sizes AS (SELECT DISTINCT n FROM win),
     grams AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
               FROM d, sizes, LATERAL (SELECT unnest(generate_series(1, len(w) - n + 1)) AS i) s WHERE len(w) >= n),
     hit AS (SELECT DISTINCT doc_id, item_id, grams.n AS n, i FROM grams JOIN win USING (n, g)),
     words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, LATERAL (SELECT unnest(generate_series(i, i + n - 1)) AS p) s GROUP BY doc_id),
     items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
               FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op2_benchmark_winnowing(spark, sf):
    """Every document's words that lie in a window of a benchmark item."""
    out = winnow.find_windows(table(spark, sf, "documents"), table(spark, sf, "benchmark"), keep=["doc_id"])
    return out.select(
        "row.doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op7_language_models(spark, sf):
    """The language of every document, from models fitted on the rows that are not held out."""
    docs = table(spark, sf, "documents")
    out = language.fit_and_identify(docs, F.when(~language.held_out("doc_id", 3, 1), F.col("lang")), keep=["doc_id"])
    return out.select("row.doc_id", language.held_out("row.doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "rejected")


@query()
def op1_toxicity_kneser_ney(spark, sf):
    """A toxicity score of every document, from models fitted on labelled rows that are not held out."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    # labels may be too many to broadcast: texts then move once, compressed
    texts = common.packed(docs.where("text IS NOT NULL").where(~language.held_out("doc_id", 5, 0)), "text", ["doc_id"])
    known = freeze(texts.join(labels.hint("merge"), "doc_id").select("label", "packed"), "labelled")
    out = toxicity.score(docs, toxicity.fit(common.unpacked(known)), keep=["doc_id"])
    return out.select(
        "row.doc_id", language.held_out("row.doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence",
    )


@query(f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS g
                 FROM d, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 4))) AS i) s WHERE len(w) > 0),
     size AS (SELECT doc_id, count(*) AS n, sha256(string_agg(g, '|' ORDER BY g)) AS digest FROM shingle GROUP BY doc_id),
     copy AS (SELECT digest, min(doc_id) AS copy_id, any_value(n) AS n FROM size GROUP BY digest),
     own AS (SELECT shingle.doc_id, g FROM shingle JOIN copy ON doc_id = copy_id),
     meets AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM own x JOIN own y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
     link AS (SELECT a, b FROM meets JOIN copy p ON a = p.copy_id JOIN copy q ON b = q.copy_id WHERE 5 * c >= 4 * (p.n + q.n - c)),
     reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
     least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
     degree AS (SELECT a, count(*) AS k FROM link GROUP BY a)
SELECT d.doc_id, coalesce(copy_id, d.doc_id) AS copy_id, coalesce(k, 0) AS n_links, coalesce(least(copy_id, m), copy_id, d.doc_id) AS class_id
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN copy USING (digest) LEFT JOIN degree ON degree.a = copy_id LEFT JOIN least_of ON least_of.a = copy_id
""")
def op10_jaccard_forest(spark, sf):
    """Every document's class of near copies, and how many different texts it is linked with."""
    return forest.link_classes(table(spark, sf, "documents")).select("doc_id", "copy_id", "n_links", "class_id")


@query()
def op3_personal_data(spark, sf):
    """Every document's personal data, by fixed patterns and by bootstrapped contexts."""
    out = pii.find_personal_data(table(spark, sf, "documents"), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(
        "row.doc_id", *(count(k) for k in ("email", "ip", "card", "phone")), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query()
def op6_repeated_bytes(spark, sf):
    """Every document without the bytes of 200-byte strings that occur elsewhere too."""
    out = suffixes.remove_repeats(table(spark, sf, "documents"), keep_first=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
           FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op8_inner_product_mtree(spark, sf):
    """The five best partners of every fiftieth vector."""
    vectors = freeze(mtree.quantised(table(spark, sf, "embeddings"), "vec_id", "embedding"), "vectors")
    return mtree.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def _render_sql(turns: str) -> str:
    return f"coalesce(list_aggregate(list_transform({turns}, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), 'string_agg', ''), '')"


def _mask_sql(turns: str) -> str:
    begin = f"coalesce(list_sum(list_transform({turns}[1 : i - 1], lambda t: length(t.role) + length(t.text) + 24)), 0) + 13 + length({turns}[i].role)"
    spans = f"list_transform(list_filter(generate_series(1, len({turns})), lambda i: {turns}[i].role = 'assistant'), lambda i: CAST(CAST({begin} AS BIGINT) AS VARCHAR) || ':' || CAST(CAST({begin} + length({turns}[i].text) + 10 AS BIGINT) AS VARCHAR))"
    return f"coalesce(list_aggregate({spans}, 'string_agg', ','), '')"


def _escape_sql(column: str) -> str:
    return f"regexp_replace({column}, '<([\\\\]*)\\|im_', '<\\1\\\\|im_', 'g')"


@query(f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
     conv AS (SELECT conv_id, list({{'role': {_escape_sql("role")}, 'text': {_escape_sql("text")}}} ORDER BY turn NULLS FIRST, role, text) AS t,
                     arg_min([role, text], (turn IS NOT NULL, turn, role, text)) AS opening,
                     coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS said FROM turns GROUP BY conv_id),
     best AS (SELECT opening, arg_min(conv_id, (-said, conv_id)) AS chosen_id FROM conv GROUP BY opening),
     two AS (SELECT arg_min(conv_id, (-said, conv_id)) AS chosen_id, arg_max(conv_id, (-said, conv_id)) AS rejected_id FROM conv GROUP BY conv_id >> 1),
     ids AS (SELECT chosen_id, conv_id AS rejected_id FROM conv JOIN best USING (opening) UNION SELECT chosen_id, rejected_id FROM two),
     pair AS (SELECT chosen_id, rejected_id, c.t AS c, r.t AS r, least(len(c.t), len(r.t)) AS m
              FROM ids JOIN conv r ON r.conv_id = rejected_id JOIN conv c ON c.conv_id = chosen_id WHERE rejected_id <> chosen_id),
     n AS (SELECT *, coalesce(list_position(list_transform(generate_series(1, m), lambda i: c[i] = r[i]), false) - 1, m) AS k FROM pair),
     cut AS (SELECT chosen_id, rejected_id, CAST(k AS INTEGER) AS n_common, c[1 : k] AS p, c[k + 1 :] AS x, r[k + 1 :] AS y FROM n)
SELECT chosen_id, rejected_id, n_common, sha256({_render_sql("p")}) AS prompt_sha256, sha256({_render_sql("x")}) AS chosen_sha256, sha256({_render_sql("y")}) AS rejected_sha256,
       {_mask_sql("x")} AS chosen_mask, {_mask_sql("y")} AS rejected_mask
FROM cut
""")
def op5_preference_pairs(spark, sf):
    """All conversations with one opening paired with the chosen one of them, and each with its neighbour by number."""
    conversations = preferences.gathered(table(spark, sf, "conversations"))
    pairs = preferences.pairs_by_opening(conversations).union(preferences.pairs_by_number(conversations))
    out = preferences.format_pairs(conversations, pairs)
    return out.select(
        "chosen_id", "rejected_id", "n_common", *(F.sha2(c, 256).alias(f"{c}_sha256") for c in ("prompt", "chosen", "rejected")),
        preferences.listed(F.col("chosen_mask")).alias("chosen_mask"), preferences.listed(F.col("rejected_mask")).alias("rejected_mask"),
    )


#: The terms of a text, as the contract of the ranked search defines them.
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
     q AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
     asked AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY item_id, term),
     total AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0),
     tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY doc_id, n, term),
     df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
     hit AS (SELECT item_id, doc_id,
                    times * CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nn) // ll))) AS part
             FROM asked JOIN tf USING (term) JOIN df USING (term), total),
     score AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM hit GROUP BY item_id, doc_id HAVING sum(part) > 0),
     ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM score)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""")
def op13_ranked_search(spark, sf):
    """The twenty best documents of every benchmark item."""
    return ranking.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 20).select("item_id", "rank", "doc_id", "score")


@query(r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     s AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
     g AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
           FROM s, LATERAL (SELECT unnest(generate_series(1, 4)) AS m) x, LATERAL (SELECT unnest(generate_series(1, len(w) - m + 1)) AS i) y),
     f AS (SELECT lang, m, phrase, count(*) AS n FROM g GROUP BY lang, m, phrase HAVING count(*) >= 30),
     total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM s GROUP BY lang),
     c AS (SELECT lang, m, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
     cut AS (SELECT c.lang, c.phrase, a, k, x.n AS l, y.n AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (x.n + y.n) AS BIGINT) AS score
             FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM c) c
             JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 :], ' ')),
     worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     inside AS (SELECT c.lang, array_to_string(c.w[i : i + s - 1], ' ') AS phrase, max(a) AS b
                FROM c, LATERAL (SELECT unnest(generate_series(2, m - 1)) AS s) x, LATERAL (SELECT unnest(generate_series(1, m - s + 1)) AS i) y GROUP BY 1, 2),
     kept AS (SELECT worst.* FROM worst LEFT JOIN inside USING (lang, phrase) WHERE b IS NULL OR 100 * CAST(b AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, total.n AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""")
def op11_collocations(spark, sf):
    """The two thousand strongest phrases of every language."""
    return phrases.collocations(table(spark, sf, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query()
def op12_context_trees(spark, sf):
    """The log probability of every document, by models of the rows that are not held out."""
    held = language.held_out("doc_id", 10, 0)
    out = ctw.score(table(spark, sf, "documents"), ~held, keep=["doc_id"])
    return out.select("row.doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
