"""Corpus pipeline: the stages a document passes, each written as a table and read again as the next one's input.

``doc_id`` identifies a document: rows that repeat one are copies of it. Documents without an id are judged like
others but cannot be told apart, so no stage that drops by id drops them. Stages keep the columns they get, whatever
others there are; the last one returns the packed pieces. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemat.llm import kneser_ney, langid, packing, pii, shingles
from placemat.scratch import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in at least one of the learnt languages; those without a letter, or in none of them, go."""
    return langid.keep_known(docs, langid.fit(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is within their language's threshold."""
    trusted = kneser_ney.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rejected = kneser_ney.classify(docs, trusted).filter(~F.col("kept")).select("doc_id")
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest id, once.

    Candidates are SimHash fingerprints within three bits, from two vantage-point trees, and MinHash buckets;
    the sets themselves are compared after.
    """
    groups = shingles.similar_groups(docs)
    copies = groups.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    left = docs.join(copies, "doc_id", "left_anti")
    # Rows without an id stay apart by a number of their own, in a column that no input has.
    number = "_" + max(docs.columns, key=len)
    row = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    return left.withColumn(number, row).dropDuplicates(["doc_id", number]).select(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for the personal data in their texts."""
    replaced = pii.replace_entities(docs, count=None)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return replaced.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("pii", private),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
