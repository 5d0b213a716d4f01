"""Wide analysis tables: price with weather, seasonal profile, prediction dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.dates import day, month_start
from ..functions.numeric import pct_change, ratio, round_to
from ..functions.rules import above, at_least, classify, contains_any, one_of, relative
from ..operators import ranking
from ..operators.aggregates import annual_profile, from_cube, month_profile
from ..session import cut_lineage
from .facts import CATEGORIES, SERIES, series_window, weather_monthly

WEATHER_STATIONS = ("東京", "熊谷", "千葉")
ITEM_KEYS = ("item_name", *CATEGORIES)


def price_trend(monthly: DataFrame) -> DataFrame:
    """Lags, growth rates, moving means and price zone of every series."""
    w = series_window()
    price = F.col("avg_unit_price_yen")
    lagged = monthly.withColumns(
        {
            "prev_year_amount_yen": F.lag("total_amount_yen", 12).over(w),
            "prev_year_unit_price_yen": F.lag(price, 12).over(w),
            "prev_year_quantity_kg": F.lag("total_quantity_kg", 12).over(w),
            "prev_month_amount_yen": F.lag("total_amount_yen", 1).over(w),
            "prev_month_unit_price_yen": F.lag(price, 1).over(w),
            "ma3": F.avg(price).over(w.rowsBetween(-2, 0)),
            "ma6": F.avg(price).over(w.rowsBetween(-5, 0)),
        }
    )
    zones = relative(price, "ma3", [(1.1, "高値圏")], [(0.9, "安値圏")], "通常圏")
    return lagged.withColumns(
        {
            "yoy_amount_growth_rate": pct_change("total_amount_yen", "prev_year_amount_yen"),
            "yoy_price_growth_rate": pct_change(price, "prev_year_unit_price_yen"),
            "yoy_quantity_growth_rate": pct_change("total_quantity_kg", "prev_year_quantity_kg"),
            "mom_amount_growth_rate": pct_change("total_amount_yen", "prev_month_amount_yen"),
            "mom_price_growth_rate": pct_change(price, "prev_month_unit_price_yen"),
            "price_deviation_from_3m_avg": pct_change(price, "ma3"),
            "price_trend_category": zones,
            "price_3month_moving_avg": round_to("ma3", 2),
            "price_6month_moving_avg": round_to("ma6", 2),
        }
    ).drop("ma3", "ma6")


def mart_price_weather(
    cube: DataFrame,
    weather_daily: DataFrame,
    stations: DataFrame,
    station_names: Sequence[str] = WEATHER_STATIONS,
) -> DataFrame:
    """Monthly series with growth, moving means, rank in the month, and the month's weather.

    ``cube`` is a saved ``price_cube``.
    """
    base = from_cube(cube)
    ranked = ranking.number_by_value(
        price_trend(base), "monthly_price_rank", ["year", "month"], {"avg_unit_price_yen": F.col("avg_unit_price_yen").desc()},
        [F.col(c) for c in (*SERIES, *CATEGORIES)], source=base,
    )
    # The weather has one row per calendar month, so it is sent to every task; a month that
    # holds very many prices is then not gathered in one of them.
    weather = F.broadcast(weather_monthly(weather_daily, stations, station_names))
    joined = ranked.join(weather, ["year", "month"], "left")
    short = {name: (name,) for name in V.SHORT_PREFECTURES}
    return joined.select(
        "year",
        "month",
        *SERIES,
        contains_any("origin", short, V.SHORT_PREFECTURE_DEFAULT).alias("origin_prefecture"),
        *CATEGORIES,
        "total_quantity_kg",
        "total_amount_yen",
        "avg_unit_price_yen",
        "prev_year_amount_yen",
        "prev_year_unit_price_yen",
        "prev_year_quantity_kg",
        "yoy_amount_growth_rate",
        "yoy_price_growth_rate",
        "yoy_quantity_growth_rate",
        "prev_month_amount_yen",
        "prev_month_unit_price_yen",
        "mom_amount_growth_rate",
        "mom_price_growth_rate",
        "price_3month_moving_avg",
        "price_6month_moving_avg",
        "price_deviation_from_3m_avg",
        "price_trend_category",
        "monthly_price_rank",
        "avg_temperature",
        "avg_max_temperature",
        "avg_min_temperature",
        "avg_humidity",
        "total_precipitation",
        "avg_wind_speed",
        "total_sunshine",
        above("total_precipitation", V.RAIN_CLASS, "少雨", V.UNKNOWN).alias("precipitation_category"),
        above("avg_temperature", V.HEAT_CLASS, "寒い", V.UNKNOWN).alias("temperature_category"),
        "weather_observation_days",
        at_least("weather_observation_days", V.WEATHER_COVER, "INSUFFICIENT").alias("weather_data_quality"),
    )


def seasonal_base(cube: DataFrame) -> DataFrame:
    """Markets summed up."""
    return from_cube(cube, ("item_name", *CATEGORIES, "year", "month", "origin"))


def seasonal_index(base: DataFrame) -> DataFrame:
    """Month profile against the annual profile, with month ranks per item.

    Rows per item are bounded by twelve months and its categories.
    """
    profile = month_profile(base, ITEM_KEYS)
    annual = annual_profile(base, ITEM_KEYS)
    per_month = ratio("annual_total_quantity", "months_with_data")
    ranks = lambda c: F.row_number().over(
        Window.partitionBy("item_name").orderBy(F.col(c).desc(), *CATEGORIES, "month")
    )
    return profile.join(annual, list(ITEM_KEYS)).withColumns(
        {
            "seasonal_price_index": pct_change("avg_monthly_price", "annual_avg_price"),
            "seasonal_quantity_index": round_to(ratio("avg_monthly_quantity", per_month) * 100, 1),
            "price_rank_high_to_low": ranks("avg_monthly_price").cast("bigint"),
            "quantity_rank_high_to_low": ranks("avg_monthly_quantity").cast("bigint"),
            "season": one_of("month", V.SEASON_JA),
            "vegetable_demand_period": one_of("month", V.DEMAND_SEASONAL, V.DEMAND_DEFAULT),
        }
    )


def top_months(value: str, count: int, descending: bool) -> Column:
    """The first months by value as text; a group has at most twelve."""
    key = -F.col(value) if descending else F.col(value)
    ordered = F.slice(F.sort_array(F.collect_list(F.struct(key.alias("k"), "month"))), 1, count)
    return F.array_join(F.transform(ordered, lambda s: s["month"].cast("string")), ", ")


def seasonal_peaks(index: DataFrame) -> DataFrame:
    in_season = F.when(F.col("quantity_rank_high_to_low") <= 3, F.col("avg_monthly_price"))
    return index.groupBy(*ITEM_KEYS).agg(
        top_months("avg_monthly_quantity", 3, True).alias("peak_supply_months"),
        top_months("avg_monthly_price", 3, True).alias("peak_price_months"),
        top_months("avg_monthly_price", 3, False).alias("low_price_months"),
        round_to(F.avg("price_cv"), 3).alias("seasonality_strength"),
        F.max(in_season).alias("peak_supply_max_price"),
        F.min(in_season).alias("peak_supply_min_price"),
    )


def season_pattern(months_text: str, mode: str = "text") -> Column:
    """Season of the peak months.

    ``text`` looks for the digits in the list, so month 1 is also found in 10, 11 and 12;
    ``month`` compares whole months. The order of the rules is the same.
    """
    groups = (("夏野菜", (6, 7, 8)), ("冬野菜", (12, 1, 2)), ("春野菜", (3, 4, 5)), ("秋野菜", (9, 10, 11)))
    text = F.col(months_text)
    if mode == "text":
        return contains_any(text, {label: [str(m) for m in months] for label, months in groups}, "通年野菜")
    listed = F.split(text, ", ")
    wanted = lambda months: F.array(*[F.lit(str(m)) for m in months])
    return classify([(F.arrays_overlap(listed, wanted(months)), label) for label, months in groups], "通年野菜")


def mart_seasonal(cube: DataFrame, pattern_mode: str = "text") -> DataFrame:
    """Seasonal profile per item, category and month, with peaks and levels.

    ``cube`` is a saved ``price_cube``. The index is read twice; both branches share the
    shuffle of the grouped cube.
    """
    index = seasonal_index(seasonal_base(cube))
    peaks = seasonal_peaks(index).withColumns(
        {
            "vegetable_category": contains_any("item_name", V.ITEM_CATEGORY_SEASONAL, V.ITEM_CATEGORY_DEFAULT),
            "seasonality_pattern": season_pattern("peak_supply_months", pattern_mode),
        }
    )
    return index.join(peaks, list(ITEM_KEYS)).select(
        *ITEM_KEYS,
        "month",
        "season",
        "vegetable_demand_period",
        "vegetable_category",
        "seasonality_pattern",
        "avg_monthly_quantity",
        "avg_monthly_amount",
        "avg_monthly_price",
        "monthly_price_stddev",
        "historical_min_price",
        "historical_max_price",
        "seasonal_price_index",
        "seasonal_quantity_index",
        "price_rank_high_to_low",
        "quantity_rank_high_to_low",
        "years_with_data",
        "total_transactions",
        "months_with_data",
        "years_available",
        "quantity_cv",
        "price_cv",
        "seasonality_strength",
        "peak_supply_months",
        "peak_price_months",
        "low_price_months",
        "peak_supply_max_price",
        "peak_supply_min_price",
        "annual_avg_price",
        "annual_price_stddev",
        above("seasonality_strength", V.SEASONALITY_LEVEL, "季節性なし").alias("seasonality_level"),
        above("price_cv", V.VOLATILITY_LEVEL, "安定").alias("price_volatility_level"),
    )


def latest_predictions(facts: DataFrame) -> DataFrame:
    """Newest row per item, target date and model; equal times are settled by the row key."""
    return ranking.latest_per_key(
        facts, ["item_name", "prediction_date", "model_type"],
        [F.col("prediction_generated_at"), F.col("prediction_key")],
    )


def upcoming(facts: DataFrame, as_of, months: int = 12) -> DataFrame:
    """Newest predictions for the coming months. The date filter comes first: the date is
    part of the key, so it drops whole groups only."""
    ahead = F.col("prediction_date").between(day(as_of), F.add_months(day(as_of), months))
    return latest_predictions(facts.filter(ahead))


def item_month_prices(price_weather: DataFrame, start_year: int) -> DataFrame:
    """Actual price per item and month: the mean of the series prices."""
    return price_weather.filter(F.col("year") >= start_year).groupBy("item_name", "year", "month").agg(
        F.avg("avg_unit_price_yen").alias("actual_price"),
        F.sum("total_quantity_kg").alias("actual_quantity"),
        F.count(F.lit(1)).alias("market_count"),
    ).withColumn("actual_date", month_start())


def model_accuracy(summary: DataFrame) -> DataFrame:
    high = F.when(F.col("prediction_reliability") == "HIGH", 1.0).otherwise(0.0)
    return summary.groupBy("item_name", "model_type").agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.avg("model_mae").alias("avg_mae"),
        F.avg("model_rmse").alias("avg_rmse"),
        F.avg("model_r2").alias("avg_r2"),
        F.avg(high).alias("high_reliability_ratio"),
    )


def consensus(summary: DataFrame) -> DataFrame:
    """Spread of the predictions of an item and month, and how many go up, down or stay."""
    price = F.col("predicted_price")
    share = lambda label: F.avg(F.when(F.col("predicted_price_trend") == label, 1.0).otherwise(0.0))
    return summary.groupBy("item_name", "prediction_month").agg(
        F.count_distinct("model_type").alias("model_count"),
        F.avg(price).alias("avg_predicted_price"),
        F.min(price).alias("min_predicted_price"),
        F.max(price).alias("max_predicted_price"),
        F.stddev_samp(price).alias("price_prediction_std"),
        share("PRICE_INCREASE").alias("increase_consensus"),
        share("PRICE_DECREASE").alias("decrease_consensus"),
        share("PRICE_STABLE").alias("stable_consensus"),
    )


def with_previous_year(summary: DataFrame, actual: DataFrame) -> DataFrame:
    """Add the actual price of the same month one year before the prediction."""
    past = actual.select(
        "item_name",
        (F.col("year") + 1).alias("prediction_year"),
        F.col("month").alias("prediction_month"),
        "actual_price",
        "actual_date",
    )
    return summary.join(past, ["item_name", "prediction_year", "prediction_month"], "left")


def mart_dashboard(
    facts: DataFrame,
    price_weather: DataFrame,
    as_of,
    start_year: int = 2020,
    min_score: float = 0.5,
    min_points: int = 12,
) -> DataFrame:
    """Newest predictions of the coming year with last year's price, consensus and ranks.

    Accuracy and consensus use all newest rows; ranks use the rows that pass the score filter.
    """
    summary = cut_lineage(upcoming(facts, as_of))
    accuracy = model_accuracy(summary).select("item_name", "model_type", "avg_mae")
    joined = (
        with_previous_year(summary, item_month_prices(price_weather, start_year))
        .join(accuracy, ["item_name", "model_type"], "left")
        .join(consensus(summary), ["item_name", "prediction_month"], "left")
        .filter((F.col("data_quality_score") >= min_score) & (F.col("training_data_points") >= min_points))
    )
    # An item has one row per date and model, so this window is bounded by the calendar.
    by_item = Window.partitionBy("item_name").orderBy(F.col("avg_mae").asc_nulls_first())
    ranked = joined.withColumn("model_accuracy_rank", F.rank().over(by_item).cast("bigint"))
    ranked = cut_lineage(ranked)
    ranked = ranking.rank_over(ranked, "monthly_price_rank", ["prediction_month"], "predicted_price", True)
    price, score = F.col("predicted_price"), F.col("data_quality_score")
    trusted = F.col("prediction_reliability")
    return ranked.select(
        "prediction_date", "prediction_year", "prediction_month", "prediction_quarter", "prediction_season",
        "item_name", "model_type",
        "predicted_price", "lower_bound_price", "upper_bound_price", "prediction_range", "confidence_interval",
        "predicted_price_trend", "predicted_price_change_pct",
        "last_actual_price", "last_actual_date",
        round_to("actual_price", 2).alias("comparable_actual_price"),
        F.col("actual_date").alias("comparable_actual_date"),
        pct_change(price, "actual_price").alias("vs_previous_year_pct"),
        "prediction_horizon_type", "forecast_horizon_days", "prediction_lead_time_days",
        "prediction_reliability", "data_quality_score",
        "model_mae", "model_rmse", "model_r2", "training_data_points",
        F.col("model_count").alias("total_models_for_item"),
        round_to("avg_predicted_price", 2).alias("item_month_avg_prediction"),
        round_to("min_predicted_price", 2).alias("item_month_min_prediction"),
        round_to("max_predicted_price", 2).alias("item_month_max_prediction"),
        round_to("price_prediction_std", 2).alias("item_month_prediction_std"),
        *[round_to(F.col(f"{c}_consensus") * 100, 1).alias(f"{c}_consensus_pct") for c in ("increase", "decrease", "stable")],
        "model_accuracy_rank",
        "monthly_price_rank",
        relative(
            price, "last_actual_price",
            [(1.2, "大幅上昇予測"), (1.1, "上昇予測")], [(0.8, "大幅下落予測"), (0.9, "下落予測")], "安定予測",
        ).alias("prediction_category"),
        classify(
            [
                ((trusted == "HIGH") & (score >= 0.8), "高信頼度"),
                (trusted.isin("HIGH", "MEDIUM") & (score >= 0.6), "中信頼度"),
            ],
            "低信頼度",
        ).alias("overall_confidence"),
        "prediction_generated_at",
        day(as_of).cast("timestamp").alias("dashboard_updated_at"),
    )
