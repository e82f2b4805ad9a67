"""From raw documents to packed training bins, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratamart.llm import jaccard_join, mixing, packing, quality_classifier, substring_dedup
from stratamart.llm.common import fold, table
from stratamart.operators.lookups import pin


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row whole, as ``row``, with what tells rows apart: the id, with a value for null, and a hash of the text."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _id("doc_id"), F.xxhash64("text").alias("key"))


def _id(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(-(1 << 63)).cast("long")).alias("id")


def _without_repeats(keyed: DataFrame) -> DataFrame:
    """One of each set of rows with equal id and text. Texts are moved only if there are any."""
    repeated = keyed.groupBy("id", "key").count().where("count > 1")
    return keyed.dropDuplicates(["id", "key"]) if repeated.limit(1).count() else keyed


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"), learn=fold("doc_id", 3) != 1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    keyed = _without_repeats(_keyed(docs))
    found = jaccard_join.similarity_components(keyed.select("row.doc_id", "row.text"))
    gone = found.where("NOT first").select(_id("doc_id"), F.col("text_key").alias("key"))
    return keyed.join(gone, ["id", "key"], "left_anti").select("row.*")


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences in repeated spans go, except where a span stands first."""
    own = {c: f"kept{i}" for i, c in enumerate(docs.columns)}  # names that the operator's cannot clash with
    kept = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(v) for c, v in own.items() if c != "text"])
    cleaned = substring_dedup.deduplicate(kept, keep=tuple(v for c, v in own.items() if c != "text"))
    new = {"text": F.col("text")}
    if "n_chars" in own:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.select(*[new.get(c, F.col(v)).alias(c) for c, v in own.items()])


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, as rows of its own."""
    mixed = mixing.mix_sources(docs)
    taken = mixed.select(_id("doc_id"), F.col("text_key").alias("key"), "copies").groupBy("id", "key").agg(F.sum("copies").alias("copies"))
    rows = _without_repeats(_keyed(docs)).join(taken.where("copies > 0"), ["id", "key"])
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in bins; copies of a document stand in different bins."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", reject_low_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeated_spans),
    ("source_mixing", mix_to_targets),
    ("best_fit_packing", pack_bins),
]

# A learnt classifier and a seeded sample have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
