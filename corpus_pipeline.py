"""The corpus pipeline: documents filtered, deduplicated, decontaminated and packed.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and
read again as the next stage's documents. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import decontamination, neardup, packing, quality, toxicity
from fieldloom.llm.common import Stage, small_side, table
from fieldloom.llm.queries import tokenizer_path, toxicity_model

#: Rows of ids that are broadcast at most; a join shuffles beyond.
MAX_IDS = 4_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model, keep=tuple(docs.columns), prefix="_toxicity_")
    return scored.where("_toxicity_score < 0.5").select(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is not above the limit of their language."""
    return quality.accept_documents(docs, table(spark, sf_dir, "labels"), Stage(spark, "quality"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    stage = Stage(spark, "neardup")
    kept = stage.numbered(docs, "docs")
    # rows go by number, since ids may repeat
    found = neardup.near_duplicates(kept.select(F.col("_row").alias("doc_id"), "text"), stage)
    goers = stage.table(found.where("not kept").select(F.col("doc_id").alias("_row")), "goers")
    return kept.join(small_side(goers, MAX_IDS), "_row", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    stage = Stage(spark, "decontamination")
    digest = F.md5(F.coalesce("text", F.lit("")))
    named = docs.select(digest.alias("_text_md5"), "text")
    leaks = decontamination.find_passages(named, table(spark, sf_dir, "benchmark"), stage, key="_text_md5")
    found = stage.table(leaks.select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    return docs.join(small_side(found, MAX_IDS), digest == F.col("_leak"), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(docs, tokenizer_path()), Stage(spark, "packing"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: SQL can express neither the trained models nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's documents are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    written = Stage(spark, "pipeline")
    for name, stage in STAGES:
        docs = written.table(stage(spark, docs, sf_dir), name)
    return docs
