"""The registered queries of this subpackage, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm import audit, bpe, hamming, licenses, main_text, near, packing, quality, rules, token_files, toxicity, warc, whitening
from turnmill.llm.common import documents
from turnmill.llm.oracle import ORACLE
from turnmill.plans.inputs import table


#: Scores from which a document counts as good, and as toxic.
QUALITY_FROM = 0.3
TOXIC_FROM = 0.5


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(documents(spark, folder), word_tokenizer())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_warc_transactions(spark: SparkSession, folder: str) -> DataFrame:
    captures = warc.page_captures(warc.write_archives(table(spark, folder, "pages")))
    response = F.col("response")
    return captures.select(
        "page_id",
        response["payload_bytes"].alias("payload_bytes"),
        response["payload_digest"].alias("payload_digest"),
        response["type"].alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return _judged(quality.score(docs, model), QUALITY_FROM)


def _judged(scored: DataFrame, least: float) -> DataFrame:
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"),
    )


def op5_toxicity_network(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return _judged(toxicity.score(docs, model), TOXIC_FROM)


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_files.write_token_files(documents(spark, folder), byte_tokenizer())
    read = token_files.read_token_files(manifest)
    return read.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest codes, the row itself among them, of every row whose id is divisible by 20."""
    vectors = table(spark, folder, "embeddings")
    return hamming.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.judge(documents(spark, folder).select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    verdict = F.col("__verdict")
    return judged.select(
        "doc_id",
        *[F.col(f"__{c}").alias(c) for c in counts],
        verdict["base_failed"].alias("base_failed"),
        verdict["kept"].alias("kept"),
    )


def op8_rank_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode_decode(documents(spark, folder).select("doc_id", "text"), word_tokenizer())
    return coded.select("doc_id", "bpe").select(
        "doc_id",
        F.col("bpe")["n_tokens"].alias("n_tokens"),
        F.sha2(F.col("bpe")["ids"], 256).alias("ids_sha256"),
        F.sha2(F.col("bpe")["decoded"].cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_license_templates(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(documents(spark, folder).select("doc_id", "text"))
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return found.select("doc_id", "license").select("doc_id", *[F.col("license")[c].alias(c) for c in columns])


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = near.near_duplicates(documents(spark, folder).select("doc_id", "text"))
    return found.select(
        near.id_of("__a").alias("doc_id"), near.id_of("class_a").alias("class_id"), "n_links", "n_copies"
    )


def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    found = pages.select("page_id", "url", main_text.main_text(F.col("html")).alias("text"))
    return found.select("*", F.length("text").cast("long").alias("n_chars"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return whitening.whiten(rows, whitening.fit(rows))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "source")
    return audit.audit(docs, table(spark, folder, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_warc_transactions,
        op3_quality_classifier,
        op4_token_files,
        op5_toxicity_network,
        op6_multi_index_hashing,
        op7_quality_rules,
        op8_rank_bpe,
        op9_license_templates,
        op10_ngram_join,
        op11_main_text,
        op12_whitening,
        op13_filter_audit,
    )
}

__all__ = ["ORACLE", "QUERIES"]
