"""Typed and cleaned views of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.dates import day, parse_date, parse_timestamp
from ..functions.numeric import clamp, round_to, to_int, to_number
from ..functions.text import strip_blanks, trim_blanks
from ..operators.ranking import latest_per_key

MEASURES = ("temperature", "humidity", "precipitation", "wind_speed", "wind_direction", "sunshine")


def stg_trades(raw: DataFrame, category: str = "野菜") -> DataFrame:
    """Vegetable trades with integer columns."""
    whole = lambda c: to_int(c, raw.schema[c].dataType).alias(c)
    return (
        raw.withColumn("major_category", strip_blanks("major_category"))
        .filter(F.col("major_category") == category)
        .select(
            whole("year"),
            whole("month"),
            "market",
            "major_category",
            "sub_category",
            "item_name",
            "origin",
            whole("quantity_kg"),
            whole("amount_yen"),
        )
    )


def stg_weather(raw: DataFrame) -> DataFrame:
    """One observation per station and time, the last loaded one, with date parts.

    Equal load times are settled by the values, so the choice is repeatable.
    """
    known = raw.filter(F.col("station_name").isNotNull() & F.col("observation_datetime").isNotNull())
    slim = known.select("station_id", "observation_datetime", "station_name", *MEASURES, "created_at")
    newest = latest_per_key(
        slim, ["station_id", "observation_datetime"], [F.col("created_at"), *[F.col(m) for m in MEASURES]]
    )
    time = F.col("observation_datetime")
    return newest.select(
        "station_id",
        "station_name",
        "observation_datetime",
        *[round_to(m, 1).alias(m) for m in MEASURES],
        F.to_date(time).alias("observation_date"),
        F.year(time).cast("bigint").alias("observation_year"),
        F.month(time).cast("bigint").alias("observation_month"),
        F.dayofmonth(time).cast("bigint").alias("observation_day"),
        F.hour(time).cast("bigint").alias("observation_hour"),
    )


def stg_predictions(raw: DataFrame, as_of, earliest: str = "2020-01-01") -> DataFrame:
    """Forecast rows with parsed types; implausible rows are dropped."""
    dates = ("prediction_date", "training_period_start", "training_period_end", "last_actual_date")
    times = ("prediction_generated_at", "created_at", "updated_at")
    prices = ("predicted_price", "lower_bound_price", "upper_bound_price", "last_actual_price")
    errors = ("model_mae", "model_mse", "model_rmse")
    typed = raw.withColumns(
        {
            **{c: parse_date(c) for c in dates},
            **{c: parse_timestamp(c) for c in times},
            **{c: to_number(c) for c in (*prices, *errors, "model_r2", "confidence_interval", "data_quality_score")},
            **{c: to_int(c) for c in ("prediction_year", "prediction_month", "training_data_points")},
            "item_name": trim_blanks(F.upper("item_name")),
            "market": trim_blanks("market"),
            "origin": trim_blanks("origin"),
            "model_type": F.upper(trim_blanks("model_type")),
            "model_version": F.coalesce("model_version", F.lit("1.0")),
            "_r2_given": F.col("model_r2").isNotNull(),
        }
    )
    price = F.col("predicted_price")
    kept = typed.filter(
        F.col("item_name").isNotNull()
        & (price > 0)
        & (price < 10000)
        & (F.col("prediction_date") >= day(earliest))
        & (F.col("prediction_date") <= F.add_months(day(as_of), 36))
        & F.col("model_type").isin(list(V.MODEL_TYPES))
        & (F.col("training_data_points") >= 12)
        & (~F.col("_r2_given") | F.col("model_r2").between(-10, 2))
    )
    rounded = kept.withColumns(
        {
            **{c: round_to(c, 2) for c in (*prices, *errors)},
            "model_r2": clamp(round_to("model_r2", 3), -1.0, 1.0),
        }
    )
    return rounded.select(
        "prediction_id", "prediction_date", "prediction_year", "prediction_month", "prediction_generated_at",
        "item_name", "market", "origin", "model_type", "model_version",
        "predicted_price", "lower_bound_price", "upper_bound_price", "confidence_interval",
        "training_data_points", "training_period_start", "training_period_end",
        "last_actual_price", "last_actual_date", *errors, "model_r2",
        "data_quality_score", "prediction_reliability", "created_at", "updated_at",
    )
