"""Queries of this subpackage: each applies one operator, with production parameters, to its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitpack, decontamination, html_extraction, language, packing, permutation_index, power_packing, quality, simhash_dedup, token_alignment, toxicity, warc
from .common import fold, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _decide(docs: DataFrame, held_out) -> DataFrame:
    return docs.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = quality.fit_network(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return _decide(quality.score(docs.select("doc_id", "text"), net), F.coalesce(fold("doc_id", 3) == 1, F.lit(False)))


def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op4_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bitpack.encode_and_read_back(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2, vocabulary=50_257)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit_model(docs, fold("doc_id", 4) != 2)
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_model(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return _decide(toxicity.score(docs.select("doc_id", "text"), model), F.coalesce(fold("doc_id", 5) == 0, F.lit(False)))


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = power_packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket_rank")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.score_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_vector_packing, op3_html_extraction, op4_bit_packing, op5_decontamination, op6_warc_transactions, op7_simhash_dedup, op8_language_id, op9_toxicity, op10_permutation_index, op11_power_of_two_packing, op12_token_alignment)}

#: Only this operator's result is expressible in SQL: the others rest on a tokenizer, a fitted model,
#: XXH64 or an HTML parser, which DuckDB lacks, or are approximate.
ORACLE_SQL = {
    "op6_warc_transactions": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM f
    """,
}
