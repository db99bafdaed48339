"""The queries of the subpackage, for the driver's registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import decontaminate, embed, langid, pack, quality, simhash, substring, suffix, token_count, tokenfile
from granary.llm.tokens import public_vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark, sf_dir):
    return token_count.count_tokens(_read(spark, sf_dir, "documents"), public_vocabulary("byte_bpe_50k.json"))


@query
def op2_quality(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, _read(spark, sf_dir, "labels")))


@query
def op3_paragraphs(spark, sf_dir):
    return substring.remove_passages(_read(spark, sf_dir, "documents").select("doc_id", "text"), min_words=substring.PASSAGE_WORDS)


@query
def op4_simhash(spark, sf_dir):
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


@query
def op5_language(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


@query
def op6_embeddings(spark, sf_dir):
    return embed.near_duplicates(_read(spark, sf_dir, "embeddings"))


@query
def op7_token_files(spark, sf_dir):
    return tokenfile.roundtrip(_read(spark, sf_dir, "documents"), public_vocabulary("word_bpe_49k.json"), end_id=1, alphabet=49_408)


@query
def op8_packing(spark, sf_dir):
    pieces = pack.pack(_read(spark, sf_dir, "documents"), public_vocabulary("byte_bpe_50k.json"), end_id=0, max_tokens=1024)
    return pieces.drop("n_loss")


@query
def op9_decontamination(spark, sf_dir):
    hits = decontaminate.find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    names = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), names.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op10_suffix_array(spark, sf_dir):
    return suffix.remove_repeats(_read(spark, sf_dir, "documents"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


ORACLES["op9_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT n FROM g),
o AS (SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT k, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, s WHERE len(w) >= n)),
h AS (SELECT k, i, o.n, item FROM o JOIN g ON o.n = g.n AND o.gram = g.gram),
c AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(generate_series(i, i + n - 1)) AS p FROM h) GROUP BY k),
t AS (SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM h GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (k) LEFT JOIN t USING (k)"""

ORACLES["op6_embeddings"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM v LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id"""
