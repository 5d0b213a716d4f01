"""Versioned model bundles: models with all that is needed to score rows not seen before.

A version is a folder with fitted pipelines, the learnt feature values, the measures and, written last, a
manifest that lists every file with its hash. A folder without a manifest is an unfinished save and is not
found. All of it is read and written by Spark, so the folder can be in any store that Spark reads.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import models as md

_FILES = "array<struct<path: string, length: bigint, sha256: string>>"
MANIFEST = (
    "version string, created_at string, best_model string, model_names array<string>, features array<string>, target string, "
    f"code_rows bigint, train_rows bigint, test_rows bigint, train_end string, test_start string, files {_FILES}"
)


@dataclass(frozen=True)
class Bundle:
    """A loaded version."""

    manifest: dict
    state: ft.FeatureState
    measures: DataFrame
    folder: str

    def model(self, name: str | None = None) -> PipelineModel:
        return PipelineModel.load(f"{self.folder}/models/{name or self.manifest['best_model']}")

    def score(self, rows: DataFrame, name: str | None = None) -> DataFrame:
        """``y_pred`` for rows as the training rows were before features; incomplete rows are left out."""
        built = ft.apply_features(rows, self.state)
        return self.model(name).transform(ft.complete_rows(built, self.manifest["features"]))


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """Path inside ``folder``, length and hash of every file. Files of a model are small enough for a row each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    inside = F.regexp_extract("path", r"/((?:models|codes|means|measures)/.*)$", 1)
    return files.filter(~F.col("path").rlike(r"/[._][^/]*$")).select(inside.alias("path"), "length", F.sha2("content", 256).alias("sha256"))


def _month(year_month) -> str | None:
    return None if year_month is None else f"{year_month // 100:04d}-{year_month % 100:02d}"


def save_bundle(
    base: str, version: str, fitted: Mapping[str, PipelineModel], state: ft.FeatureState, names: Sequence[str],
    split: DataFrame, as_of: dt.date, target: str = ft.TARGET,
) -> str:
    """Save ``fitted`` with the state, the measures on the test rows of ``split`` and its bounds; the folder."""
    spark = split.sparkSession
    folder = f"{base}/{version}"
    for name, model in fitted.items():
        model.write().overwrite().save(f"{folder}/models/{name}")
    state.codes.write.mode("overwrite").parquet(f"{folder}/codes")
    state.means.write.mode("overwrite").parquet(f"{folder}/means")
    md.evaluate_all(split, fitted, target).write.mode("overwrite").parquet(f"{folder}/measures")
    measures = spark.read.parquet(f"{folder}/measures")
    month = F.col("year") * 100 + F.col("month")
    bounds = split.agg(
        F.count(F.when(F.col("is_train"), 1)).alias("train_rows"), F.count(F.when(~F.col("is_train"), 1)).alias("test_rows"),
        F.max(F.when(F.col("is_train"), month)).alias("train_end"), F.min(F.when(~F.col("is_train"), month)).alias("test_start"),
    ).first()
    best = md.best_model(measures).select("model_name").first()
    row = (
        version, f"{as_of:%Y-%m-%d}", best[0] if best else None, sorted(fitted), list(names), target,
        spark.read.parquet(f"{folder}/codes").count(), bounds["train_rows"], bounds["test_rows"], _month(bounds["train_end"]), _month(bounds["test_start"]),
        sorted((r.path, r.length, r.sha256) for r in contents(spark, folder).filter("path <> ''").collect()),
    )
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
    return folder


def manifests(spark: SparkSession, base: str) -> DataFrame:
    """The manifests of all finished versions."""
    return spark.read.schema(MANIFEST).json(f"{base}/*/manifest")


def latest(spark: SparkSession, base: str) -> str | None:
    """The newest finished version."""
    return manifests(spark, base).agg(F.max_by("version", F.struct("created_at", "version"))).first()[0]


def damaged(spark: SparkSession, folder: str, files: Sequence) -> DataFrame:
    """Files of a version that are missing, changed or not in its manifest."""
    listed = spark.createDataFrame([tuple(f) for f in files], "path string, _length bigint, _sha256 string")
    found = contents(spark, folder).filter("path <> ''")
    both = found.join(listed, "path", "full")
    state = F.when(F.col("sha256").isNull(), "missing").when(F.col("_sha256").isNull(), "unknown").when(F.col("sha256") != F.col("_sha256"), "changed")
    return both.select("path", state.alias("state")).filter("state IS NOT NULL")


def load_bundle(spark: SparkSession, base: str, version: str | None = None) -> Bundle:
    """A finished version (default: the newest) whose files are as they were saved."""
    version = version or latest(spark, base)
    row = manifests(spark, base).filter(F.col("version") == version).first()
    if row is None:
        raise ValueError(f"no finished version {version!r} under {base}")
    folder = f"{base}/{version}"
    wrong = damaged(spark, folder, row["files"]).limit(5).collect()
    if wrong:
        raise ValueError(f"version {version!r} is damaged: " + ", ".join(f"{r.path} {r.state}" for r in wrong))
    state = ft.FeatureState(spark.read.parquet(f"{folder}/codes"), spark.read.parquet(f"{folder}/means"))
    return Bundle(row.asDict(), state, spark.read.parquet(f"{folder}/measures"), folder)
