"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.dates import day, month_start
from ..functions.numeric import ratio, round_to
from ..functions.rules import above, at_least, classify, contains_any, lookup, one_of
from ..functions.text import letters_digits, strip_suffix
from ..operators.aggregates import valid_trades
from ..operators.ranking import dense_key


def dim_market(trades: DataFrame) -> DataFrame:
    return dense_key(trades.select("market").distinct(), "market_key", ["market"]).select("market", "market_key")


def _regions_by_station() -> dict[str, list[str]]:
    regions: dict[str, list[str]] = {}
    for _, _, code, region in V.PREFECTURES:
        regions.setdefault(region, []).append(code)
    return regions


def dim_station(weather: DataFrame) -> DataFrame:
    """Stations seen in the observations, numbered by name."""
    seen = weather.select("station_id", "station_name").filter(
        F.col("station_id").isNotNull() & F.col("station_name").isNotNull()
    ).distinct()
    keyed = dense_key(seen, "station_key", ["station_name", "station_id"])
    return keyed.select(
        "station_key",
        "station_id",
        "station_name",
        F.col("station_id").isin(list(V.AGRICULTURE_STATIONS)).alias("is_agriculture_priority"),
        one_of("station_id", _regions_by_station(), V.STATION_REGION_DEFAULT).alias("region"),
        lookup("station_id", V.MAIN_CROPS).alias("major_crops"),
    )


def _prefecture_of(text: Column, renamed: dict[str, str]) -> Column:
    groups = {renamed.get(name, name): (word,) for word, name, _, _ in V.PREFECTURES}
    groups[V.IMPORTED] = V.IMPORT_WORDS
    return contains_any(text, groups, V.UNKNOWN)


def dim_location(trades: DataFrame, corrected: bool = False) -> DataFrame:
    """Origins with prefecture, weather station and region.

    The published table misses some places: two prefectures carry English names that the
    station and region lists lack, and the suffix strip shortens names such as Hokkaido's.
    That is the default here. ``corrected`` matches the full name and uses one spelling.
    """
    origin = F.col("origin")
    origins = trades.select("origin").filter(
        origin.isNotNull() & (origin != "") & ~origin.contains("その他") & ~origin.contains("計")
    ).distinct()
    keyed = dense_key(origins, "location_key", ["origin"])
    cleaned = strip_suffix("origin", "県府道都")
    text = F.upper("origin") if corrected else cleaned
    renamed = {} if corrected else V.PREFECTURE_AS_PUBLISHED
    placed = keyed.withColumn("cleaned_origin", cleaned).withColumn("prefecture", _prefecture_of(text, renamed))
    regions: dict[str, list[str]] = {}
    for _, name, _, region in V.PREFECTURES:
        regions.setdefault(region, []).append(name)
    regions[V.IMPORTED] = [V.IMPORTED]
    station = lookup("prefecture", {name: code for _, name, code, _ in V.PREFECTURES})
    return placed.withColumn("station_id", station).select(
        "location_key",
        F.col("origin").alias("origin_name"),
        "cleaned_origin",
        "prefecture",
        "station_id",
        lookup("station_id", V.STATION_NAMES).alias("station_name"),
        F.col("prefecture").isin(list(V.PRIORITY_PREFECTURES)).alias("is_agriculture_priority"),
        one_of("prefecture", regions, V.UNKNOWN).alias("region"),
        F.col("station_id").isNotNull().alias("has_weather_data"),
    )


def dim_time(spark: SparkSession, as_of, first_year: int = 2020, last_year: int = 2030) -> DataFrame:
    """Months of a range of years; the length is fixed by the arguments."""
    years = spark.range(first_year, last_year + 1, 1, 1).select(F.col("id").alias("year"))
    months = years.select("year", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(12).cast("bigint"))).alias("month"))
    return time_attributes(months, as_of)


def time_attributes(months: DataFrame, as_of) -> DataFrame:
    """Calendar attributes of (year, month) rows, which must be distinct.

    One row per calendar month, so ordering all of them in one task is bounded by the calendar.
    """
    year, month, today = F.col("year"), F.col("month"), day(as_of)
    this_year = F.year(today)
    text_year, text_month = year.cast("string"), month.cast("string")
    index = month.cast("int")
    named = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), index)
    order = Window.orderBy("year", "month")
    base = months.withColumn("month_start_date", month_start()).withColumn(
        "time_key", F.row_number().over(order).cast("bigint")
    )
    start = F.col("month_start_date")
    key = F.col("time_key")
    return base.select(
        "time_key",
        "year",
        "month",
        "month_start_date",
        F.last_day(start).alias("month_end_date"),
        F.concat(text_year, F.lpad(text_month, 2, "0")).alias("year_month_str"),
        F.concat_ws("/", text_year, text_month).alias("year_month_slash"),
        F.date_format(start, "yyyy-MM").alias("year_month_dash"),
        one_of(month, V.SEASON_JA).alias("season_japanese"),
        one_of(month, V.SEASON_EN).alias("season_english"),
        one_of(month, V.SEASON_NUMBER).cast("bigint").alias("season_number"),
        one_of(month, V.QUARTER).cast("bigint").alias("quarter"),
        one_of(month, V.CROP_SEASON).alias("agricultural_season"),
        F.concat(text_month, F.lit("月")).alias("month_name_japanese"),
        named(V.MONTHS_EN).alias("month_name_english"),
        named([m[:3] for m in V.MONTHS_EN]).alias("month_abbr"),
        (year - F.when(month < 4, 1).otherwise(0)).alias("fiscal_year"),
        one_of(month, V.FISCAL_QUARTER).cast("bigint").alias("fiscal_quarter"),
        one_of(month, V.DEMAND_CALENDAR, V.DEMAND_DEFAULT).alias("vegetable_demand_period"),
        (year == this_year).alias("is_current_year"),
        (year == this_year - 1).alias("is_previous_year"),
        (start <= today).alias("is_historical"),
        F.lag(key, 12).over(order).alias("previous_year_same_month_key"),
        F.lag(key, 1).over(order).alias("previous_month_key"),
        F.lead(key, 1).over(order).alias("next_month_key"),
        F.lead(key, 12).over(order).alias("next_year_same_month_key"),
    )


def item_profile(trades: DataFrame) -> DataFrame:
    price = F.col("unit_price")
    return valid_trades(trades).groupBy("item_name", "major_category", "sub_category").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg(price).alias("mean"),
        F.stddev_samp(price).alias("sd"),
        F.min(price).alias("low"),
        F.max(price).alias("high"),
        F.sum("quantity_kg").alias("total_quantity_kg"),
        F.sum("amount_yen").alias("total_amount_yen"),
    )


def dim_item(trades: DataFrame) -> DataFrame:
    """Items with price level, volume, kind, season and use."""
    keyed = dense_key(item_profile(trades), "item_key", ["item_name", "major_category", "sub_category"])
    item, mean, sd = F.col("item_name"), F.col("mean"), F.col("sd")
    out = keyed.select(
        "item_key",
        "item_name",
        "major_category",
        "sub_category",
        "transaction_count",
        round_to("mean", 2).alias("avg_unit_price_yen"),
        round_to("sd", 2).alias("price_volatility"),
        round_to("low", 2).alias("min_unit_price_yen"),
        round_to("high", 2).alias("max_unit_price_yen"),
        "total_quantity_kg",
        "total_amount_yen",
        at_least(mean, V.PRICE_TIER, V.PRICE_TIER_DEFAULT).alias("price_tier"),
        above(ratio(sd, mean), V.PRICE_STABILITY, "安定").alias("price_stability"),
        at_least("total_quantity_kg", V.VOLUME_TIER, V.VOLUME_TIER_DEFAULT).alias("volume_tier"),
        contains_any(item, V.ITEM_CATEGORY, V.ITEM_CATEGORY_DEFAULT).alias("vegetable_category"),
        contains_any(item, V.ITEM_SEASON, V.ITEM_SEASON_DEFAULT).alias("seasonality"),
        contains_any(item, V.ITEM_STORAGE, V.ITEM_STORAGE_DEFAULT).alias("storage_durability"),
        contains_any(item, V.ITEM_USAGE, V.ITEM_USAGE_DEFAULT).alias("cooking_usage"),
        round_to(ratio(F.col("high") - F.col("low"), mean), 2).alias("price_range_ratio"),
        round_to(ratio(sd, mean), 2).alias("coefficient_of_variation"),
        (F.col("transaction_count") >= 10).alias("is_frequent_item"),
        F.coalesce((mean > 0) & (sd > 0), F.lit(False)).alias("has_price_data"),
        F.upper(item).alias("item_name_upper"),
        letters_digits(item).alias("item_name_clean"),
    )
    return out.withColumn("has_seasonality", classify([(F.col("seasonality") != V.ITEM_SEASON_DEFAULT, True)], False))
