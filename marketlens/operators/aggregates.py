"""Grouped summaries used by several tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio, round_to, unit_price

TRADE_KEYS = ("year", "month", "item_name", "market", "origin", "major_category", "sub_category")


def valid_trades(trades: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Trades with an item and positive quantity and amount; unit price within bounds if given."""
    rows = trades.filter("quantity_kg > 0 and amount_yen > 0 and item_name is not null")
    rows = rows.withColumn("unit_price", unit_price())
    return rows if low is None else rows.filter(F.col("unit_price").between(low, high))


def price_cube(trades: DataFrame, keys: Sequence[str] = TRADE_KEYS) -> DataFrame:
    """Additive sums per key; coarser tables are built from it without a second raw scan."""
    return valid_trades(trades).groupBy(*keys).agg(
        F.sum("quantity_kg").alias("total_quantity_kg"),
        F.sum("amount_yen").alias("total_amount_yen"),
        F.sum("unit_price").alias("sum_unit_price"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def from_cube(cube: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Sums, mean of the row unit prices and number of trades, per row of the cube or per
    coarser ``keys``."""
    sums = ("total_quantity_kg", "total_amount_yen", "sum_unit_price", "transaction_count")
    if keys is not None:
        cube = cube.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    mean = round_to(ratio("sum_unit_price", "transaction_count"), 2)
    return cube.withColumn("avg_unit_price_yen", mean).drop("sum_unit_price")


def monthly_trades(trades: DataFrame, keys: Sequence[str] = TRADE_KEYS) -> DataFrame:
    """Sums, mean of the row unit prices, and number of trades per key."""
    return from_cube(price_cube(trades, keys))


def monthly_prices(trades: DataFrame, low: float = 1, high: float = 10000, keys: Sequence[str] = TRADE_KEYS) -> DataFrame:
    """Price statistics per key over trades with a plausible unit price."""
    price = F.col("unit_price")
    return valid_trades(trades, low, high).groupBy(*keys).agg(
        round_to(F.avg(price), 2).alias("avg_unit_price_yen"),
        round_to(F.min(price), 2).alias("min_unit_price_yen"),
        round_to(F.max(price), 2).alias("max_unit_price_yen"),
        round_to(F.stddev_samp(price), 2).alias("price_stddev"),
        F.sum("quantity_kg").alias("total_quantity_kg"),
        F.sum("amount_yen").alias("total_amount_yen"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def month_profile(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and calendar month: means, spread, extremes and coverage over the years."""
    price, quantity = F.col("avg_unit_price_yen"), F.col("total_quantity_kg")
    return base.groupBy(*keys, "month").agg(
        round_to(F.avg(quantity), 1).alias("avg_monthly_quantity"),
        round_to(F.avg("total_amount_yen"), 1).alias("avg_monthly_amount"),
        round_to(F.avg(price), 2).alias("avg_monthly_price"),
        round_to(F.stddev_samp(price), 2).alias("monthly_price_stddev"),
        F.min(price).alias("historical_min_price"),
        F.max(price).alias("historical_max_price"),
        F.count_distinct("year").alias("years_with_data"),
        F.sum("transaction_count").alias("total_transactions"),
        round_to(ratio(F.stddev_samp(quantity), F.avg(quantity)), 3).alias("quantity_cv"),
        round_to(ratio(F.stddev_samp(price), F.avg(price)), 3).alias("price_cv"),
    )


def annual_profile(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    price = F.col("avg_unit_price_yen")
    return base.groupBy(*keys).agg(
        round_to(F.avg(price), 2).alias("annual_avg_price"),
        round_to(F.stddev_samp(price), 2).alias("annual_price_stddev"),
        F.sum("total_quantity_kg").alias("annual_total_quantity"),
        F.sum("total_amount_yen").alias("annual_total_amount"),
        F.count_distinct(F.col("year") * 12 + F.col("month")).alias("months_with_data"),
        F.count_distinct("year").alias("years_available"),
    )


def month_climatology(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of each column per calendar month."""
    return df.groupBy(*keys, "month").agg(*[F.avg(c).alias(c) for c in columns])


def frequent_items(df: DataFrame, item: str, start_year: int, min_rows: int, limit: int) -> DataFrame:
    """Items with at least ``min_rows`` priced rows, the most frequent first."""
    counts = (
        df.filter((F.col("year") >= start_year) & F.col("avg_unit_price_yen").isNotNull())
        .groupBy(item)
        .agg(
            F.count(F.lit(1)).alias("data_points"),
            F.min("year").alias("start_year"),
            F.max("year").alias("end_year"),
        )
    )
    return counts.filter(F.col("data_points") >= min_rows).orderBy(F.desc("data_points"), item).limit(limit)
