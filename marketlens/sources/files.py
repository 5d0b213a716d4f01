"""Readers for market files and weather files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import to_number
from . import schemas

# Headers of the published market file.
TRADE_HEADERS = {
    "年月(yyyy/m) ": "year_month_slash",
    "年月(yyyymm) ": "year_month_num",
    "年": "year",
    "月": "month",
    "市場コード": "market_code",
    "市場": "market",
    "大分類コード": "major_category_code",
    "大分類": "major_category",
    "中分類コード": "sub_category_code",
    "中分類": "sub_category",
    "品目コード": "item_code",
    "品目名称": "item_name",
    "産地コード": "origin_code",
    "産地": "origin",
    "国内外区分": "domestic_foreign",
    "数量(kg)": "quantity_kg",
    "金額(円)": "amount_yen",
}
# Headers of the weather export.
WEATHER_HEADERS = {
    "気温": "temperature",
    "相対湿度": "humidity",
    "降水量": "precipitation",
    "風速": "wind_speed",
    "風向": "wind_direction",
    "日照時間": "sunshine",
    "年": "year",
    "月": "month",
    "日": "day",
    "時": "hour",
}
PREAMBLE_LINES = 5


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TRADES).option("header", True).option("encoding", "UTF-8").csv(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.WEATHER).option("header", True).option("encoding", "UTF-8").csv(path)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are there; others are left alone."""
    return df.withColumnsRenamed(dict(names))


def numbers_or_default(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: to_number(c, default) for c in present})


def clean_market_file(df: DataFrame) -> DataFrame:
    return numbers_or_default(rename_columns(df, TRADE_HEADERS), ["quantity_kg", "amount_yen"])


def observation_time(year="year", month="month", day="day", hour="hour") -> Column:
    """Timestamp from four numbers; impossible parts such as hour 24 give NULL."""
    part = lambda c: F.col(c).try_cast("int")
    built = F.try_make_timestamp(part(year), part(month), part(day), part(hour), F.lit(0), F.lit(0))
    return F.when(part(hour).between(0, 23), built)


def read_weather_export(
    spark: SparkSession, path: str, stations: DataFrame, created_at: Column | None = None,
    encoding: str = "Shift_JIS",
) -> DataFrame:
    """Raw exports: five preamble lines, then a header line, then hourly rows.

    File names carry the station: ``weather_hourly_<station>_<yyyymm>.csv``. One file is one
    station-month, so it is decoded whole inside its task; files are spread over tasks.
    """
    whole = spark.read.format("binaryFile").load(path).select("path", F.decode("content", encoding).alias("text"))
    lines = F.split(F.regexp_replace("text", "\r", ""), "\n")
    table = whole.select(
        F.regexp_extract("path", r"weather_hourly_([^_/]+)_", 1).alias("station_id"),
        F.transform(F.split(lines[PREAMBLE_LINES], ","), lambda h: F.trim(h)).alias("header"),
        F.explode(F.slice(lines, F.lit(PREAMBLE_LINES + 2), F.greatest(F.size(lines) - PREAMBLE_LINES - 1, F.lit(0)))).alias("line"),
    ).filter(F.length(F.trim("line")) > 0)
    parsed = table.withColumn("_cells", F.split("line", ","))
    # A header may be repeated, as in exports with quality columns: its first column counts.
    cell = lambda header: F.get("_cells", F.array_position("header", header).cast("int") - 1)
    wide = parsed.select(
        "station_id",
        *[
            cell(header).try_cast("bigint" if name in ("year", "month", "day", "hour") else "double").alias(name)
            for header, name in WEATHER_HEADERS.items()
        ],
    )
    known = stations.select("station_id", "station_name", "region")
    stamped = wide.join(known, "station_id", "left").withColumns(
        {
            "observation_datetime": observation_time(),
            "created_at": created_at if created_at is not None else F.current_timestamp(),
        }
    )
    return stamped.select(*schemas.WEATHER.fieldNames())


