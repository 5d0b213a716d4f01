"""Station catalogue with three coverages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import vocabulary as V
from . import schemas


def stations(spark: SparkSession, coverage: str = "all") -> DataFrame:
    known = {code: (name, block) for code, name, block in V.STATIONS}
    lists = {
        "all": tuple(known),
        "agriculture": V.AGRICULTURE_STATIONS,
        "current": V.CURRENT_STATIONS,
    }
    if coverage not in lists:
        raise ValueError(f"unknown coverage {coverage!r}; choose from {sorted(lists)}")
    rows = [(code, *known[code], rank) for rank, code in enumerate(lists[coverage], 1)]
    return spark.createDataFrame(rows, schemas.STATIONS)
