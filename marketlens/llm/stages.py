"""Stages of the corpus pipeline: each takes and returns rows with the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import host_rules, jaccard, line_dedup, mixing, pieces
from .common import lookup, packed, ship, unpacked


def _resized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose host is not rejected."""
    needed = ("source", "text")
    judged = cut_lineage(host_rules.judge_documents(host_rules.measure(packed(docs, *needed))))
    out = host_rules.apply_verdicts(judged, host_rules.host_verdicts(judged))
    return unpacked(out.filter("kept"), docs.columns, *needed)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated blocks of lines are deleted; a document of which nothing is left goes."""
    ship(spark)
    needed = ("doc_id", "text")
    out = line_dedup.dedup_lines(packed(docs, *needed))
    left = (F.col("n_removed") == 0) | F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return _resized(unpacked(out.filter(left), docs.columns, *needed))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component one row stays: that of the smallest doc_id (null last), then text hash.

    A row is named by doc_id and text, so two texts of one doc_id are judged each by itself, and of rows
    that share both one stays. Rows without words are in no component and all stay.
    """
    named = packed(docs, "doc_id", "text")
    found = cut_lineage(jaccard.row_components(named).filter("component IS NOT NULL"))
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")
    first = found.groupBy("component").agg(F.min(name).alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    members = found.join(first, "component")
    first_row = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("t") == F.col("first.t"))
    gone = cut_lineage(members.filter(~first_row).select("doc_id", "t").distinct())
    again = cut_lineage(members.filter(first_row).groupBy("doc_id", "t").count().filter("count > 1").select("doc_id", "t"))
    rows = named.withColumn("t", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    kept = lookup(rows, gone, ["doc_id", "t"], "left_anti")
    if again.limit(1).count():
        once = lookup(kept, again, ["doc_id", "t"], "left_semi").dropDuplicates(["doc_id", "t"])
        kept = lookup(kept, again, ["doc_id", "t"], "left_anti").unionByName(once)
    return unpacked(kept, docs.columns, "doc_id", "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    needed = ("doc_id", "source", "text")
    sized = cut_lineage(mixing.sized(packed(docs, *needed)))
    mixed = mixing.mix(sized)
    out = mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return unpacked(out, docs.columns, *needed)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's text, their number, and hashes of ids and decoded text."""
    ship(spark)
    return pieces.encode(docs, pieces.model_path(), keep_ids=True)
