"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",
    # Recording the call site of every column expression takes longer than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "marketlens", master: str | None = None, **extra: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results depend on to a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without, and gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="marketlens-")
    return _local_folders[application]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read on from there.

    Used where several later steps read the same rows: they all see one result, the raw
    scan runs once, and a lost executor costs no recomputation. The table is columnar, so
    later steps read only their columns and the planner knows its size.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/marketlens/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
