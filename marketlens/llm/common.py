"""Helpers shared by the operators of this folder: words, row keys, size-checked joins."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence
from functools import reduce
from operator import and_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of other characters than these six.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"
#: Most rows of a side that is broadcast: at 100 bytes a row, 200 MB.
BROADCAST_ROWS = 2_000_000
LAST_ID = 2**63 - 1
#: Bytes of a batch of rows that is sent to a Python function: both sides hold it whole, in every task.
BATCH_BYTES = 4 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Bound what is sent to the workers at a time, and send them the package once per application, unless
    they find it by themselves."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = Path(__file__).resolve().parents[2]
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    application = spark.sparkContext.applicationId
    if str(root) in map(os.path.realpath, filter(None, found)) or application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in package.rglob("*.py"):
            out.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(application)


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    ship(spark)
    df = spark.read.parquet(f"{folder}/documents.parquet")
    return df.select(*columns) if columns else df


def words(text: Column | str) -> Column:
    """Array of the words of a text; null gives an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``_t``, a hash of the text.

    ``doc_id`` and ``_t`` together name a row: rows that share both are copies of one row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_t"))


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``limit`` rows. Call it on a saved table."""
    return df.limit(limit + 1).count() <= limit


def lookup(
    rows: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a saved ``side`` to wide ``rows``; a null key matches a null key.

    A side within ``limit`` rows is broadcast, so that the wide rows stay where they are;
    a larger one is joined by shuffle, where adaptive execution splits hot keys.
    """
    renamed = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_side_{k}")) for k in keys])
    if small(side, limit):
        renamed = F.broadcast(renamed)
    return rows.join(renamed, condition, how).drop(*[f"_side_{k}" for k in keys])


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all others in one column ``_rest``, so that no name can clash."""
    rest = [c for c in docs.columns if c not in needed]
    return docs.select(*needed, (F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0)).alias("_rest"))


def unpacked(df: DataFrame, columns: Sequence[str], *needed: str) -> DataFrame:
    """``columns`` of a packed table, in their order."""
    return df.select(*[F.col(c) if c in needed else F.col(f"_rest.`{c}`").alias(c) for c in columns])
