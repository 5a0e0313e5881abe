"""The corpus pipeline: quality, line dedup, near duplicates, mixing, packing.

Every stage works on all that the one before it kept; its rows are written as Parquet
and read again by the next. All stages but the last return the columns of documents.
No SQL expresses the stages, so they are tested against brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from locusframe.llm import jaccard, linededup, mixing, packing, quality
from locusframe.operators.lineage import written_once


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of at least 0.3)."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of repeated runs of at least 50 words; documents that lose all their lines go, n_chars follows."""
    rows = linededup.drop_repeated_lines(docs, min_words=50)
    rows = rows.where((F.size("_deleted") == 0) | (F.size("_deleted") < F.col("_n_lines")))
    return rows.withColumn("n_chars", F.when(F.size("_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*[f"`{c}`" for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs, words=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs, weights=(1, 2, 3), most=3)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, size=1024)


STAGES = [("quality", quality_stage), ("line dedup", line_stage), ("near duplicates", near_stage), ("mixing", mix_stage), ("packing", pack_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
