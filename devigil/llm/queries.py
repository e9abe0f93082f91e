"""One registered query per operator, over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.llm import (
    audit,
    byte_pairs,
    contamination,
    language,
    licences,
    lines,
    mixing,
    near,
    suffixes,
    toxicity,
    vectors,
    warc,
    whitening,
)
from devigil.llm.shared import Landing


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def domains(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, domain`` of the labels."""
    found = table(spark, folder, "labels").select("doc_id", mixing.domain_of_labels().alias("domain"))
    return found.filter("doc_id is not null and domain is not null")


def op1_soft_membership_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return mixing.mix(docs, domains(spark, folder)).drop("text")


def op2_benchmark_windows(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return contamination.scan(docs, table(spark, folder, "benchmark")).drop("text", "spans")


def op3_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = lines.remove_boilerplate(table(spark, folder, "documents"))
    digest = F.sha2("text", 256).alias("kept_sha256")
    return cleaned.select("doc_id", "n_lines", "n_removed", digest)


def op4_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents"))


def op5_licence_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(table(spark, folder, "documents").select("doc_id", "text"))


def op6_int8_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


def op7_nearest_toxic_examples(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_warc_transactions(spark: SparkSession, folder: str) -> DataFrame:
    store = Landing(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), f"{store.folder}/archives")
    # landed, so that the archives are read once for all record types
    records = store.land(warc.read_records(spark, f"{store.folder}/archives", payloads=False), "records")
    captures = warc.assemble(records)
    captures = captures.withColumn("page_id", F.element_at("metadata.fields", "pageId").cast("bigint"))
    captures = store.land(captures, "captures")
    return warc.digest(captures)


def op9_suffix_levels(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"), texts=False).drop("kept_text")


def op10_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return language.predictions(table(spark, folder, "documents"))


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_filter_diagrams(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_pairs.round_trip(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


QUERIES = {
    "op1_soft_membership_mix": op1_soft_membership_mix,
    "op2_benchmark_windows": op2_benchmark_windows,
    "op3_line_spread": op3_line_spread,
    "op4_minhash_near_duplicates": op4_minhash_near_duplicates,
    "op5_licence_paragraphs": op5_licence_paragraphs,
    "op6_int8_tiles": op6_int8_tiles,
    "op7_nearest_toxic_examples": op7_nearest_toxic_examples,
    "op8_warc_transactions": op8_warc_transactions,
    "op9_suffix_levels": op9_suffix_levels,
    "op10_language_mixture": op10_language_mixture,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_filter_diagrams": op12_filter_diagrams,
    "op13_byte_pairs": op13_byte_pairs,
}

CHECKS: dict[str, str] = {
    "op2_benchmark_windows": contamination.CHECK,
    "op3_line_spread": lines.CHECK,
    "op5_licence_paragraphs": licences.CHECK,
    "op8_warc_transactions": warc.CHECK,
    "op12_filter_diagrams": audit.CHECK,
}
