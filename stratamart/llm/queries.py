"""The registered queries of this package, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.llm import (
    chat_formatting, conversation_repair, hard_negatives, html_text, jaccard_join, language_id, mixing, packing, quality_classifier, quality_rules,
    simhash, substring_dedup, topk_search,
)
from stratamart.llm.common import fold, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 3) == 1
    scored = quality_classifier.score_quality(docs, labels, learn=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("copies", "text_key")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.similarity_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    found = language_id.identify(docs, docs.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


# A conversation whose texts hold control strings, formatted along with the table's.
_SPOOF = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spoof = spark.createDataFrame(_SPOOF, "conv_id long, turn long, role string, text string")
    return chat_formatting.digests(chat_formatting.format_conversations(stored.unionByName(spoof)))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_quality_classifier, op3_best_fit_packing, op4_source_mixing, op5_ngram_jaccard_join,
        op6_topk_search, op7_html_extraction, op8_language_id, op9_chat_formatting, op10_quality_rules, op11_hard_negatives,
        op12_simhash_dedup, op13_conversation_repair,
    )
}

ORACLE: dict[str, str] = {
    "op6_topk_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS "rank", vec_id, score
FROM s QUALIFY "rank" <= 5
""",
    "op9_chat_formatting": """
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM c),
k AS (SELECT '[<\\[]\\\\*(?:\\||/s>|s>|INST\\]|/INST\\])' AS control)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
  sum(length(r) + length(t) + 13 + len(regexp_extract_all(t, control)))::BIGINT AS formatted_chars
FROM t, k GROUP BY conv_id
""",
    "op10_quality_rules": quality_rules.oracle(),
    "op11_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
    list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id))::INTEGER AS "rank",
  s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY "rank" <= 10
""",
    "op13_conversation_repair": conversation_repair.oracle(),
}
