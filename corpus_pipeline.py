"""Training-corpus pipeline: quality, toxicity, near duplicates, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` writes each stage's result as Parquet into the shared folder and reads it
back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.llm import decontamination, packing, quality, similar_texts, toxicity
from cumulo.llm.common import fold, materialize, table
from cumulo.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality network gives a probability of at least one half."""
    net = quality.fit_network(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    scored = quality.score(docs.select(F.struct(*docs.columns).alias("doc"), "text"), net)
    return scored.where(F.col("score") >= 0.5).select("doc.*")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxic passages reach a probability of one half."""
    model = toxicity.fit_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    scored = toxicity.score(docs.select(F.struct(*docs.columns).alias("doc"), "text"), model)
    return scored.where(F.col("score") < 0.5).select("doc.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five-word shingles, similarity 0.8): the
    smallest doc_id. op7's operator (fingerprints, byte-position index, bit check, components) gives the candidates, and
    so does the same index over min-hash positions for pairs that differ in more bits; each is then verified."""
    return similar_texts.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences; a row per piece."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The stages rest on fitted models, XXH64 and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
