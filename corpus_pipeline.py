"""From raw documents to token ids: every stage takes the rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.llm import decontaminate, jaccard_join, quality_fm, sentencepiece_wfst, suffix_dedup
from casemill.llm.tables import scratch_path, table

STAGES = [
    ("quality_classifier", quality_fm.stage),
    ("ngram_jaccard_join", jaccard_join.stage),
    ("suffix_array_dedup", suffix_dedup.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("sentencepiece", sentencepiece_wfst.stage),
]

# Trained models, text removal and tokenisation can't be put in SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table. Each stage's rows are written and read again, so a
    lost executor costs one stage's work at most."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"{name}.parquet")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
