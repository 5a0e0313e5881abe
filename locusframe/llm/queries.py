"""The registered queries of this package, one for each operator and the pipeline, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.lineage import scratch_path
from . import ann, conversations, decontamination, jaccard, linededup, lm, merkle, mixing, packing, phrases, quality, token_counts, token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_kneser_ney")
def op1_kneser_ney(spark, sf_dir):
    return lm.score_held_out(table(spark, sf_dir, "documents"), order=2)


@query("op2_line_dedup", linededup.line_report_sql(50))
def op2_line_dedup(spark, sf_dir):
    return linededup.line_report(table(spark, sf_dir, "documents"), min_words=50)


@query("op3_jaccard_join", jaccard.near_duplicates_sql(5, 80))
def op3_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=80).drop("text_hash")


@query("op4_pruned_graph")
def op4_pruned_graph(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query("op6_token_files")
def op6_token_files(spark, sf_dir):
    path = scratch_path(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.token_file_digest(spark, path)


@query("op7_pareto_mix")
def op7_pareto_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3)


@query("op8_quality")
def op8_quality(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


@query("op9_merkle", merkle.edit_report_sql())
def op9_merkle(spark, sf_dir):
    return merkle.edit_report(table(spark, sf_dir, "documents"))


@query("op10_best_two_fit")
def op10_best_two_fit(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, size=1024)


@query("op11_phrases", phrases.collocations_sql())
def op11_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=4, least=30, percent=80, top=2000)


@query("op12_decontamination", decontamination.contamination_sql(10))
def op12_decontamination(spark, sf_dir):
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=10)


@query("op13_conversation_repair", conversations.repair_report_sql())
def op13_conversation_repair(spark, sf_dir):
    return conversations.repair_report(table(spark, sf_dir, "conversations"))
