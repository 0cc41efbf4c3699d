"""The registered queries of the text operators, with their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemat.llm import alignment, bpe, hosts, kneser_ney, langid, merkle, packing, pii, secrets, simhash, suffix_dedup, token_files, winnow
from placemat.llm.core import QUERIES, documents, query
from placemat.scratch import fresh_path

__all__ = ["QUERIES"]


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[secrets.count_kind(F.col("secrets_base"), k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(secrets.span_text(F.col("secrets_base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("secrets")).alias("spans"),
    )


@query("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.neighbour_likeness(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        winnow.fingerprint_text(F.col("own")).alias("fingerprint"),
        winnow.fingerprint_text(F.col("other")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.array_join(winnow.positions(F.col("own")), " ").alias("positions"),
    )


@query("op4_host_rules", hosts.SQL)
def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hosts.host_verdicts(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_files.write_tokens(documents(spark, sf_dir), path)
    return token_files.token_digests(token_files.read_tokens(spark, path))


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir))
    return packed.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_text(F.col("fp")).alias("fingerprint"), "component_id")


@query("op3_word_bpe")
def op3_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode_documents(bpe.encode_documents(documents(spark, sf_dir)))
    return coded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op6_pii_surrogates")
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(documents(spark, sf_dir).select("doc_id", "text"))


@query("op7_quality_perplexity")
def op7_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = kneser_ney.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = kneser_ney.classify(documents(spark, sf_dir), trusted)
    return judged.select("doc_id", "lang", "n_bytes", "perplexity", "threshold", "kept")


@query("op13_merkle_manifest", merkle.SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return merkle.verify(merkle.manifest(docs, merkle.tampered(F.col("doc_id"), F.col("text"))))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.weigh_links(documents(spark, sf_dir))


@query("op12_suffix_dedup")
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))
