"""Writers: replaced periods, whole tables, logs, exports, views, saved models."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


def replace_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace the periods that occur in ``df`` and leave the others as they are.

    Rows are gathered by period, and adaptive execution splits a large period over tasks.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def overwrite_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str, by: Sequence[str], rows_per_file: int = 1_000_000) -> None:
    """One folder per period; a large period is split into several files."""
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("header", True)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*by)
        .csv(path)
    )


def write_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def materialize(df: DataFrame, name: str, kind: str) -> None:
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        overwrite_table(df, name)
    else:
        raise ValueError(f"unknown kind {kind!r}")


#: Ranges that a column is cut into for clustering: 2 ** CLUSTER_BITS.
CLUSTER_BITS = 6


def range_bounds(df: DataFrame, column: str, ranges: int) -> list:
    """First values of up to ``ranges`` ranges of about equal numbers of rows, by Spark's own range partitioning."""
    some = df.select(F.col(column).alias("v")).filter("v IS NOT NULL")
    firsts = some.repartitionByRange(ranges, "v").groupBy(F.spark_partition_id().alias("p")).agg(F.min("v").alias("v"))
    return sorted({r["v"] for r in firsts.collect()})


def _rank(bounds: Column, value: Column) -> Column:
    """How many bounds are at most the value."""
    return F.when(value.isNull(), 0).otherwise(F.size(F.filter(bounds, lambda b: b <= value)))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = CLUSTER_BITS) -> Column:
    """One number from the range ranks of the columns: their bits in turn, the highest first. Rows that are
    near in it are near in every column. NULL ranks below all values."""
    ranks = []
    for column in columns:
        bounds = range_bounds(df, column, (1 << bits) - 1)
        kind = df.schema[column].dataType
        array = F.array(*[F.lit(b).cast(kind) for b in bounds]).cast(T.ArrayType(kind))
        ranks.append(_rank(array, F.col(column)) if bounds else F.lit(0))
    total = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for rank in ranks:
            total = total * 2 + F.shiftright(rank, bit).bitwiseAND(F.lit(1))
    return total


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Rows with near keys end up in the same files, so a range filter on any of the columns skips files.

    Call it on a saved table: the columns are read once each for their bounds. ``files`` is the number of
    files (default: that of shuffle partitions).
    """
    if not 1 <= len(columns) <= 4:
        raise ValueError("cluster by one to four columns")
    place = "_place"
    placed = df.withColumn(place, interleaved(df, columns))
    # Rows of one place can be many, so the columns themselves cut further.
    keys = [F.col(place), *[F.col(c) for c in columns]]
    dealt = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).drop(place).write.mode("overwrite").parquet(path)


def write_daily(df: DataFrame, path: str, timestamp: str) -> None:
    """One partition per day of a timestamp column."""
    day = "partition_day"
    (
        df.withColumn(day, F.to_date(timestamp))
        .hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def layer_table(layer: str, name: str, prefix: str, environment: str = "dev") -> str:
    """Table names by layer, such as ``shop_dev_mart.dim_market``."""
    return f"{prefix}_{environment}_{layer}.{name}"


def save_model(model: PipelineModel, base: str, as_of: dt.date) -> str:
    path = f"{base}/{as_of:%Y%m}"
    model.write().overwrite().save(path)
    return path


def load_model(base: str, as_of: dt.date) -> PipelineModel:
    return PipelineModel.load(f"{base}/{as_of:%Y%m}")


def metadata_rows(predictions: DataFrame, as_of: dt.date, environment: str = "dev") -> DataFrame:
    """One JSON line that describes a saved batch: models, items, number of rows."""
    spark_row = predictions.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.sort_array(F.collect_set("model_type")).alias("model_types"),
        F.sort_array(F.collect_set("item_name")).alias("items_covered"),
    )
    fields = spark_row.select(
        F.lit(f"{as_of:%Y%m}").alias("version"),
        F.lit(f"{as_of:%Y-%m-%d}T00:00:00").alias("created_at"),
        "total_predictions",
        "model_types",
        "items_covered",
        F.lit(environment).alias("environment"),
    )
    return fields.select("created_at", F.to_json(F.struct("*")).alias("json"))


def latest_metadata(records: DataFrame) -> DataFrame:
    """Newest record, parsed; ``records`` has ``created_at`` and ``json``."""
    newest = records.agg(F.max_by("json", F.struct("created_at", "json")).alias("json"))
    parsed = newest.select(F.from_json("json", schemas.MODEL_METADATA).alias("m"))
    return parsed.select(
        "m.version",
        "m.created_at",
        "m.total_predictions",
        F.array_join("m.model_types", ",").alias("model_types"),
        F.size("m.items_covered").cast("bigint").alias("items_covered"),
    )


def object_sizes(listing: DataFrame, bucket: str = "bucket", size: str = "length") -> DataFrame:
    """Stored GB per bucket from a listing of objects."""
    total = F.sum(F.coalesce(F.col(size), F.lit(0)))
    return listing.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("objects"), (total / F.lit(float(1024**3))).alias("size_gb")
    )


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every file under ``root``; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", "length", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("bucket"))


def registry(tables: Mapping[str, DataFrame], layer: str, **names: str) -> dict[str, DataFrame]:
    return {layer_table(layer, name, **names): df for name, df in tables.items()}
