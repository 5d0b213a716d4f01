"""Facts: daily weather, monthly weather, price movement, predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.dates import day, days_between, month_start
from ..functions.numeric import pct_change, ratio, round_to, zscore
from ..functions.rules import above, at_least, at_most, classify, one_of, relative
from ..operators import ranking
from ..operators.aggregates import monthly_prices
from ..operators.series import CHUNK_ROWS, index_series, moving_columns
from ..session import cut_lineage

SERIES = ("item_name", "market", "origin")
# Rows of one series and month differ in these only; they settle the order.
CATEGORIES = ("major_category", "sub_category")


def series_window() -> Window:
    """Rows of one series by month. At most one row per month and category, so a series
    is bounded by the calendar however many trades it has."""
    return Window.partitionBy(*SERIES).orderBy("year", "month", *CATEGORIES)


def fact_weather_daily(weather: DataFrame, stations: DataFrame) -> DataFrame:
    """Daily weather per station, with the station key."""
    daily = weather.filter(F.col("observation_date").isNotNull()).groupBy(
        "observation_date", "observation_year", "observation_month", "observation_day", "station_id"
    ).agg(
        F.avg("temperature").alias("avg_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.max("precipitation").alias("max_precipitation_1h"),
        F.sum("precipitation").alias("total_precipitation"),
        F.avg("wind_speed").alias("avg_wind_speed"),
        F.max("wind_speed").alias("max_wind_speed"),
        F.sum("sunshine").alias("total_sunshine"),
    )
    return daily.join(stations.select("station_id", "station_key"), "station_id")


def weather_monthly(daily: DataFrame, stations: DataFrame, names: Sequence[str]) -> DataFrame:
    """Monthly weather over the named stations; rain is summed over stations."""
    chosen = stations.filter(F.col("station_name").isin(list(names))).select("station_key")
    mean = lambda c: round_to(F.avg(c), 1)
    return daily.join(chosen, "station_key").groupBy(
        F.col("observation_year").alias("year"), F.col("observation_month").alias("month")
    ).agg(
        mean("avg_temperature").alias("avg_temperature"),
        mean("max_temperature").alias("avg_max_temperature"),
        mean("min_temperature").alias("avg_min_temperature"),
        mean("avg_humidity").alias("avg_humidity"),
        round_to(F.sum("total_precipitation"), 1).alias("total_precipitation"),
        mean("avg_wind_speed").alias("avg_wind_speed"),
        mean("total_sunshine").alias("total_sunshine"),
        F.count_distinct("observation_date").alias("weather_observation_days"),
    )


def moving_prices(base: DataFrame, chunk_rows: int = CHUNK_ROWS, fits: bool | None = None) -> DataFrame:
    """Lags and moving statistics per series, and over all rows of the item."""
    price, w = F.col("avg_unit_price_yen"), series_window()
    mean = lambda k: F.avg(price).over(w.rowsBetween(1 - k, 0))
    own = base.withColumns(
        {
            "prev_month_price": F.lag(price, 1).over(w),
            "prev_3month_price": F.lag(price, 3).over(w),
            "prev_6month_price": F.lag(price, 6).over(w),
            "prev_year_price": F.lag(price, 12).over(w),
            "ma3": mean(3),
            "ma6": mean(6),
            "ma12": mean(12),
            "sd12": F.stddev_samp(price).over(w.rowsBetween(-11, 0)),
        }
    )
    # All series of an item share one order; an item may hold a large part of the rows.
    if fits is None:
        fits = ranking.groups_fit(base, ["item_name"], chunk_rows)
    order = ["year", "month", "market", "origin", *CATEGORIES]
    item = index_series(own, ["item_name"], order, chunk_rows, fits)
    return moving_columns(item, "avg_unit_price_yen", {"item_ma12": 12}, {"item_sd12": 12}).rows()


def movement_measures(moving: DataFrame) -> DataFrame:
    """Changes, deviations, scores and the classes that follow from them."""
    price = F.col("avg_unit_price_yen")
    measured = moving.withColumns(
        {
            "mom_price_change_pct": pct_change(price, "prev_month_price"),
            "q3m_price_change_pct": pct_change(price, "prev_3month_price"),
            "q6m_price_change_pct": pct_change(price, "prev_6month_price"),
            "yoy_price_change_pct": pct_change(price, "prev_year_price"),
            "deviation_from_3m_ma_pct": pct_change(price, "ma3"),
            "deviation_from_6m_ma_pct": pct_change(price, "ma6"),
            "deviation_from_12m_ma_pct": pct_change(price, "ma12"),
            "price_zscore_12m": zscore(price, "ma12", "sd12"),
            "item_price_zscore_12m": zscore(price, "item_ma12", "item_sd12"),
            "price_volatility_12m": round_to(ratio("sd12", "ma12"), 3),
        }
    )
    ma3, ma6, ma12 = F.col("ma3"), F.col("ma6"), F.col("ma12")
    return measured.withColumns(
        {
            "price_trend_direction": classify(
                [
                    ((ma3 > ma6) & (ma6 > ma12), "上昇トレンド"),
                    ((ma3 < ma6) & (ma6 < ma12), "下降トレンド"),
                    (F.abs("deviation_from_6m_ma_pct") <= 5, "横這い"),
                ],
                "不安定",
            ),
            "price_range_category": relative(
                price, ma12, [(1.2, "高値圏"), (1.1, "やや高値")], [(0.8, "安値圏"), (0.9, "やや安値")], "適正圏"
            ),
            "volatility_level": above("price_volatility_12m", V.VOLATILITY_LEVEL, "安定"),
            "price_anomaly_status": above(F.abs("price_zscore_12m"), V.ANOMALY_STATUS, "正常範囲"),
            "short_term_movement": above(F.abs("mom_price_change_pct"), V.SHORT_MOVE, "微小変動"),
            "item_relative_status": above(F.abs("item_price_zscore_12m"), V.ITEM_STATUS, "品目内正常"),
        }
    )


def fact_price_movement(
    trades: DataFrame,
    start_year: int = 2020,
    low: float = 1,
    high: float = 10000,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Monthly price statistics per series with movement measures, ranks and a row key.

    History before ``start_year`` feeds the lags and moving statistics; ranks and key are
    taken over the rows that stay.
    """
    base = cut_lineage(monthly_prices(trades, low, high))
    rows = movement_measures(moving_prices(base, chunk_rows)).filter(F.col("year") >= start_year)
    price = F.col("avg_unit_price_yen")
    ties = [F.col(c) for c in (*SERIES, *CATEGORIES)]
    shown = base.filter(F.col("year") >= start_year)
    by_price = {"avg_unit_price_yen": price.desc()}
    ranked = ranking.number_by_value(rows, "monthly_price_rank_within_item", ["item_name", "year", "month"], by_price, ties[1:], source=shown)
    ranked = ranking.number_by_value(ranked, "monthly_overall_price_rank", ["year", "month"], by_price, ties, source=shown)
    # Months are counted first, so only the rows of one month are ordered together.
    months = {"year": F.col("year").asc(), "month": F.col("month").asc()}
    keyed = ranking.number_by_value(ranked, "price_movement_key", [], months, ties, source=shown)
    spread = F.col("max_unit_price_yen") - F.col("min_unit_price_yen")
    return keyed.select(
        "price_movement_key",
        "year",
        "month",
        month_start().alias("price_date"),
        *SERIES,
        *CATEGORIES,
        "avg_unit_price_yen",
        "min_unit_price_yen",
        "max_unit_price_yen",
        "price_stddev",
        "total_quantity_kg",
        "total_amount_yen",
        "transaction_count",
        "prev_month_price",
        "prev_3month_price",
        "prev_6month_price",
        "prev_year_price",
        round_to("ma3", 2).alias("price_3month_ma"),
        round_to("ma6", 2).alias("price_6month_ma"),
        round_to("ma12", 2).alias("price_12month_ma"),
        "mom_price_change_pct",
        "q3m_price_change_pct",
        "q6m_price_change_pct",
        "yoy_price_change_pct",
        "deviation_from_3m_ma_pct",
        "deviation_from_6m_ma_pct",
        "deviation_from_12m_ma_pct",
        "price_zscore_12m",
        "item_price_zscore_12m",
        "price_volatility_12m",
        "price_trend_direction",
        "price_range_category",
        "volatility_level",
        "price_anomaly_status",
        "short_term_movement",
        "item_relative_status",
        "monthly_price_rank_within_item",
        "monthly_overall_price_rank",
        round_to(spread, 2).alias("monthly_price_range"),
        round_to(ratio(spread, price) * 100, 2).alias("monthly_price_range_pct"),
        classify(
            [
                ((F.col("transaction_count") >= 10) & F.col("price_stddev").isNotNull(), "HIGH"),
                (F.col("transaction_count") >= 5, "MEDIUM"),
                (F.col("transaction_count") >= 2, "LOW"),
            ],
            "INSUFFICIENT",
        ).alias("data_quality_level"),
    )


def fact_predictions(staged: DataFrame, as_of) -> DataFrame:
    """Forecast facts with defaults, horizon, reliability and trend against the last price."""
    price, last = F.col("predicted_price"), F.col("last_actual_price")
    horizon = days_between("prediction_date", F.to_date("prediction_generated_at"))
    rows = staged.filter(
        F.col("prediction_date").isNotNull() & (price > 0) & (price < 10000)
        & (F.col("training_data_points") >= 12) & (horizon <= 1095)
    )
    low = F.coalesce("lower_bound_price", price * 0.8)
    high = F.coalesce("upper_bound_price", price * 1.2)
    score = F.coalesce("data_quality_score", F.lit(0.7))
    now = day(as_of).cast("timestamp")
    identity = F.concat_ws(
        "#", "prediction_id", "item_name", "model_type", F.coalesce("market", F.lit("")), F.coalesce("origin", F.lit("")),
        F.date_format("prediction_date", "yyyy-MM-dd"), F.date_format("prediction_generated_at", "yyyy-MM-dd HH:mm:ss"),
    )
    seasons = {name: months for name, months in V.SEASON_JA.items() if name != "冬"}
    return rows.select(
        F.sha2(identity, 256).alias("prediction_key"),
        "prediction_date",
        "prediction_year",
        "prediction_month",
        F.quarter("prediction_date").cast("bigint").alias("prediction_quarter"),
        one_of(F.month("prediction_date"), seasons, "冬").alias("prediction_season"),
        "prediction_generated_at",
        horizon.alias("forecast_horizon_days"),
        "item_name",
        F.coalesce("market", F.lit("ALL_MARKETS")).alias("market"),
        F.coalesce("origin", F.lit("ALL_ORIGINS")).alias("origin"),
        "model_type",
        F.coalesce("model_version", F.lit("1.0")).alias("model_version"),
        round_to(price, 2).alias("predicted_price"),
        round_to(low, 2).alias("lower_bound_price"),
        round_to(high, 2).alias("upper_bound_price"),
        round_to(high - low, 2).alias("prediction_range"),
        F.coalesce("confidence_interval", F.lit(0.8)).alias("confidence_interval"),
        "training_data_points",
        "training_period_start",
        "training_period_end",
        days_between("training_period_end", "training_period_start").alias("training_period_days"),
        round_to(last, 2).alias("last_actual_price"),
        "last_actual_date",
        days_between("prediction_date", "last_actual_date").alias("prediction_lead_time_days"),
        *[round_to(F.coalesce(c, F.lit(0.0)), 2).alias(c) for c in ("model_mae", "model_mse", "model_rmse")],
        round_to(F.coalesce("model_r2", F.lit(0.0)), 3).alias("model_r2"),
        score.alias("data_quality_score"),
        at_least(score, V.RELIABILITY, "VERY_LOW").alias("prediction_reliability"),
        at_most(horizon, V.HORIZON, "LONG_TERM").alias("prediction_horizon_type"),
        relative(price, last, [(1.1, "PRICE_INCREASE")], [(0.9, "PRICE_DECREASE")], "PRICE_STABLE").alias("predicted_price_trend"),
        pct_change(price, last).alias("predicted_price_change_pct"),
        F.coalesce("created_at", now).alias("created_at"),
        F.coalesce("updated_at", now).alias("updated_at"),
    )
