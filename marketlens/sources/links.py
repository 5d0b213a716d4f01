"""File links found in web pages, and the choice of the files to load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Address pattern of the market files: kind, year, optional month.
FILE_PATTERN = r"/documents/d/shijou/([y])(\d{4})(\d{2})?meisai(?:_[0-9]{6,8})?(?:\.xlsx)?"
BASE_URL = "https://www.shijou.metro.tokyo.lg.jp"
# Addresses in double quotes, in single quotes or without any.
_ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>(.*?)</a>"""


def extract_links(
    pages: DataFrame,
    pattern: str = FILE_PATTERN,
    base_url: str = BASE_URL,
    html: str = "html",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every anchor whose address fully matches ``pattern`` (groups: kind, year, month)."""
    pair = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(1)).alias("href"),
        F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(2)).alias("body"),
    )
    anchors = pages.select(*keep, F.explode(pair).alias("_a")).select(
        *keep, F.replace(F.btrim("_a.href", F.lit("\"'")), F.lit("&amp;"), F.lit("&")).alias("href"), "_a.body"
    )
    whole = f"^(?:{pattern})$"
    group = lambda i: F.regexp_extract("href", whole, i)
    return anchors.filter(F.col("href").rlike(whole)).select(
        *keep,
        group(2).try_cast("bigint").alias("year"),
        group(3).try_cast("bigint").alias("month"),
        group(1).alias("kind"),
        F.concat(F.lit(base_url), "href").alias("url"),
        F.trim(F.regexp_replace("body", "<[^>]*>", "")).alias("link_text"),
    )


def drop_superseded(files: DataFrame) -> DataFrame:
    """A yearly file (no month) replaces the monthly files of its year."""
    yearly = files.filter(F.col("month").isNull()).select("year").distinct()
    monthly = files.filter(F.col("month").isNotNull()).join(yearly, "year", "left_anti")
    return monthly.unionByName(files.filter(F.col("month").isNull())).select(*files.columns)


def select_files(files: DataFrame, mode: str, as_of_year: int | None = None, start: int | None = None,
                 end: int | None = None) -> DataFrame:
    """``latest-only``, ``backfill`` (year range, by default the last five) or ``all``."""
    if mode == "latest-only":
        order = [F.col("year").desc(), F.coalesce("month", F.lit(0)).desc(), F.col("url").asc()]
        return files.orderBy(*order).limit(1)
    if mode == "backfill":
        if as_of_year is None and (start is None or end is None):
            raise ValueError("backfill needs a year range or as_of_year")
        low = start if start is not None else as_of_year - 5
        high = end if end is not None else as_of_year
        return files.filter(F.col("year").between(low, high))
    if mode == "all":
        return files
    raise ValueError(f"unknown mode {mode!r}")


def period_file(year="year", month="month") -> Column:
    """``201203.csv`` for a month, ``2012.csv`` for a whole year."""
    y = F.col(year).cast("string")
    return F.concat(y, F.coalesce(F.lpad(F.col(month).cast("string"), 2, "0"), F.lit("")), F.lit(".csv"))


def pending(files: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Files whose period is not in the manifest of loaded file names."""
    named = files.withColumn("filename", period_file())
    return named if force else named.join(manifest.select("filename").distinct(), "filename", "left_anti")


def month_slices(ranges: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per calendar month of a range, clipped to the range."""
    first = F.sequence(F.trunc(start, "MM"), F.col(end), F.expr("interval 1 month"))
    rows = ranges.filter(F.col(start) <= F.col(end)).withColumn("_m", F.explode(first))
    return rows.withColumn("slice_start", F.greatest(F.col("_m"), F.col(start))).withColumn(
        "slice_end", F.least(F.last_day("_m"), F.col(end))
    ).drop("_m")


def task_grid(stations: DataFrame, slices: DataFrame) -> DataFrame:
    """Every station with every month slice; the station list is a fixed short one."""
    return slices.crossJoin(stations)


