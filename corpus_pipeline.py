"""Corpus pipeline: each stage's output is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import stages
from marketlens.session import cut_lineage

STAGES = [
    ("quality rules", stages.quality_rules),
    ("line dedup", stages.line_dedup_stage),
    ("n-gram jaccard join", stages.jaccard_join),
    ("mixing sources to target weights", stages.mix_sources),
    ("sentencepiece encoding and decoding", stages.encode_pieces),
]
#: The last stage has no SQL form (piece ids of a model file); tests compare the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
