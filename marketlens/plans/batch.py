"""Backtests and the prediction batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..operators import accuracy, features, forecast, ranking
from ..operators import series as S
from ..session import cut_lineage
from ..sources.schemas import PREDICTIONS

ROW_ORDER = ("year", "month", "market", "origin", "major_category", "sub_category", "profile_category")
POOLED_FEATURES = ("y", "total_quantity_kg", "avg_temperature", "total_precipitation", "seasonal_price_index")
# Model names in the prediction table for the three forecast methods.
MODELS = {"trend": "PROPHET", "autoregression": "ARIMA", "pooled": "LSTM"}
SEQUENCE_LENGTH = 12
MIN_POINTS = 24
# Training rows that a model needs at least: a line; three lags and as many rows as the smallest order has
# coefficients, and two; one window and the value behind it.
LEAST_TRAINING = {"trend": 2, "autoregression": 6, "pooled": SEQUENCE_LENGTH + 1}


def clean_series(series: S.Series, fits: bool = True) -> S.Series:
    """Repair outliers, close gaps, smooth."""
    repaired = S.outlier_repair(series, "y", fits=fits)
    gaps = ["avg_temperature", "total_precipitation", "yoy_price_growth_rate", "seasonal_price_index"]
    return S.smooth_centred(S.close_gaps(repaired, gaps))


def prepared(frame: DataFrame, keys: Sequence[str], chunk_rows: int = S.CHUNK_ROWS) -> tuple[S.Series, bool]:
    """Indexed series over a saved frame, and whether every series is short."""
    saved = cut_lineage(frame)
    fits = ranking.groups_fit(saved, list(keys), chunk_rows)
    return S.index_series(saved, keys, list(ROW_ORDER), chunk_rows, fits), fits


def pooled_input(split: S.Series) -> S.Series:
    """Scaled features for the pooled model; what is still unknown counts as zero."""
    df = split.df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in POOLED_FEATURES})
    return S.minmax_scale(split.with_df(df), POOLED_FEATURES)


def _unscale(scored: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    out = ranking.join_groups(scored, ranges, keys)
    return out.withColumn("y_pred", F.col("y_scaled_pred") * (F.col("_hi") - F.col("_lo")) + F.col("_lo"))


def _ranges(split: S.Series) -> DataFrame:
    return split.df.filter("is_train").groupBy(*split.keys).agg(F.min("y").alias("_lo"), F.max("y").alias("_hi"))


def pooled_windows(scaled: S.Series, length: int) -> DataFrame:
    names = [f"{c}_scaled" for c in POOLED_FEATURES]
    return S.sequences(scaled, names, "y_scaled", length)


def backtest_predictions(split: S.Series, models: Sequence[str] = tuple(MODELS), length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Test rows of a split with every model's value and the naive one.

    A model that cannot be fitted to a series does not take part there (``backtest_status`` tells which).
    Of a series, only rows remain for which all the others have a value, so that these are scored on the same ones.
    """
    keys = list(split.keys)
    base = S.naive_baseline(split).select(*keys, "pos", "year", "month", "y", "y_naive")
    parts = []
    for name in models:
        if name == "trend":
            fit = forecast.fit_trend_season(split.df.filter("is_train"), keys, "multiplicative")
            made = fit.predict(base).select(*base.columns, "y_pred")
        elif name == "autoregression":
            values = forecast.backtest_autoregression(split)
            made = ranking.join_groups(base, values, [*keys, "pos"]).select(*base.columns, "y_pred")
        elif name == "pooled":
            windows = pooled_windows(pooled_input(split), length)
            names = [f"{c}_scaled" for c in POOLED_FEATURES]
            pooled = forecast.fit_pooled(windows.filter("is_train"), names, length)
            scored = pooled.score(windows.filter("not is_train")).select(*keys, "pos", "y_scaled_pred")
            values = _unscale(scored, _ranges(split), keys).select(*keys, "pos", "y_pred")
            made = ranking.join_groups(base, values, [*keys, "pos"]).select(*base.columns, "y_pred")
        else:
            raise ValueError(f"unknown model {name!r}")
        parts.append(made.withColumn("model_type", F.lit(MODELS[name])))
    # A row of a series has one row per model here.
    made = cut_lineage(features.merge(parts).filter(F.col("y_pred").isNotNull()))
    taking = made.select(*keys, "model_type").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_taking"))
    counted = made.withColumn("_made", F.count(F.lit(1)).over(Window.partitionBy(*keys, "pos")))
    return ranking.join_groups(counted, taking, keys).filter(F.col("_made") == F.col("_taking")).drop("_made", "_taking")


def backtest_status(series: S.Series, split: S.Series, rows: DataFrame, models: Sequence[str] = tuple(MODELS)) -> DataFrame:
    """What became of every (key, model): ``scored``, ``too short`` (no split, or too few rows for the model's
    lags or windows) or ``not fitted``; with the rows of the series and of its training part."""
    keys = list(series.keys)
    every = series.df.groupBy(*keys).agg(F.count(F.lit(1)).alias("points"))
    cut = split.df.groupBy(*keys).agg(F.max("train_n").alias("train_points"))
    known = ranking.join_groups(every, cut, keys, "left")
    tried = known.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    names = F.create_map(*[F.lit(x) for pair in MODELS.items() for x in pair])
    tried = tried.withColumn("model_type", F.element_at(names, F.col("model")))
    scored = rows.groupBy(*keys, "model_type").agg(F.count(F.lit(1)).alias("scored_rows"))
    both = ranking.join_groups(tried, scored, [*keys, "model_type"], "left")
    least = F.create_map(*[F.lit(x) for pair in LEAST_TRAINING.items() for x in pair])
    short = F.col("train_points").isNull() | (F.col("train_points") < F.element_at(least, F.col("model")))
    status = F.when(F.col("scored_rows") > 0, "scored").when(short, "too short").otherwise("not fitted")
    return both.select(*keys, "model_type", "points", "train_points", F.coalesce("scored_rows", F.lit(0).cast("bigint")).alias("scored_rows"), status.alias("status"))


def backtest_parts(
    frame: DataFrame, keys: Sequence[str] = features.SERIES, models: Sequence[str] = tuple(MODELS), chunk_rows: int = S.CHUNK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Scored rows of the last fifth of every series, and the status of every series and model."""
    series, fits = prepared(frame, keys, chunk_rows)
    split = S.holdout(clean_series(series, fits))
    split = split.with_df(cut_lineage(split.df))
    rows = cut_lineage(backtest_predictions(split, models))
    return rows, backtest_status(series, split, rows, models)


def backtest(
    frame: DataFrame, keys: Sequence[str] = features.SERIES, models: Sequence[str] = tuple(MODELS),
    report_by: Sequence[str] = ("item_name",), chunk_rows: int = S.CHUNK_ROWS,
) -> DataFrame:
    """Error measures and grade per ``report_by`` and model on the last fifth of every series."""
    rows, _ = backtest_parts(frame, keys, models, chunk_rows)
    measured = accuracy.metrics(rows, [*report_by, "model_type"])
    return measured.withColumn("grade", accuracy.grade("mase"))


def series_facts(series: S.Series) -> DataFrame:
    """Rows, first and last month and last price per key."""
    return series.df.groupBy(*series.keys).agg(
        F.count(F.lit(1)).alias("training_data_points"),
        F.min("ds").alias("training_period_start"),
        F.max("ds").alias("training_period_end"),
        F.max_by("y", "pos").alias("last_actual_price"),
        F.max_by("ds", "pos").alias("last_actual_date"),
    )


def _steps_to_dates(values: DataFrame, ahead: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ranking.join_groups(values, ahead.select(*keys, "step", "ds"), [*keys, "step"])


def forecasts(series: S.Series, months: int, models: Sequence[str] = tuple(MODELS), length: int = SEQUENCE_LENGTH, method: str = "linear") -> DataFrame:
    """Values of every model for the months after the last one: key, ``ds``, value, bounds.

    ``method`` is that of the pooled regression: ``linear`` or ``boosted``.
    """
    keys = list(series.keys)
    ahead = forecast.future_months(series.df, keys, months)
    parts = []
    for name in models:
        if name == "trend":
            fit = forecast.fit_trend_season(series.df, keys, "additive")
            dated = ahead.withColumn("year", F.year("ds").cast("bigint"))
            made = fit.predict(dated).select(*keys, "ds", "y_pred", "lower", "upper")
        elif name == "autoregression":
            made = _steps_to_dates(forecast.forecast_autoregression(series, months), ahead, keys)
            made = made.select(*keys, "ds", "y_pred", "lower", "upper")
        elif name == "pooled":
            whole = series.with_df(series.df.withColumn("is_train", F.lit(True)))
            scaled = pooled_input(whole)
            scaled = scaled.with_df(cut_lineage(scaled.df))
            names = [f"{c}_scaled" for c in POOLED_FEATURES]
            pooled = forecast.fit_pooled(pooled_windows(scaled, length), names, length, method=method)
            values = forecast.recur_pooled(pooled, forecast.last_window(scaled, names, length), keys, months)
            values = _unscale(values, _ranges(whole), keys)
            made = _steps_to_dates(values, ahead, keys).select(
                *keys, "ds", "y_pred", F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper")
            )
        else:
            raise ValueError(f"unknown model {name!r}")
        parts.append(made.withColumn("model_type", F.lit(MODELS[name])))
    return features.merge(parts)


def layout(rows: DataFrame) -> DataFrame:
    """Columns and types of the prediction table; absent ones become NULL."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in PREDICTIONS.fields
        ]
    )


def _stamp(rows: DataFrame, generated_at: str) -> DataFrame:
    now = F.lit(generated_at).cast("timestamp")
    return rows.withColumns(
        {
            "prediction_year": F.year("prediction_date"),
            "prediction_month": F.month("prediction_date"),
            "prediction_generated_at": now,
            "created_at": now,
            "updated_at": now,
            "prediction_reliability": F.lit("MEDIUM"),
        }
    )


def time_series_rows(values: DataFrame, facts: DataFrame, measures: DataFrame, generated_at: str) -> DataFrame:
    """Prediction rows per item: bounds default to 20 %, interval and score to 0.8."""
    joined = ranking.join_groups(values, facts, ["item_name"])
    scores = measures.select(
        "item_name", "model_type",
        *[F.col(c).alias(f"model_{c}") for c in ("mae", "mse", "rmse", "r2", "mape", "smape", "mase")],
    )
    joined = joined.join(scores, ["item_name", "model_type"], "left")
    price = F.col("y_pred")
    version = None
    for model in MODELS.values():
        one = forecast.model_version(generated_at, F.col("training_data_points"), model, F.col("item_name"))
        hit = F.col("model_type") == model
        version = F.when(hit, one) if version is None else version.when(hit, one)
    rows = joined.withColumn("prediction_date", F.col("ds")).withColumns(
        {
            "prediction_id": F.concat_ws("_", "item_name", F.lower("model_type"), F.date_format("ds", "yyyyMM"), F.lit("ts")),
            "model_version": version,
            "predicted_price": price,
            "lower_bound_price": F.coalesce("lower", price * 0.8),
            "upper_bound_price": F.coalesce("upper", price * 1.2),
            "confidence_interval": F.lit(0.8),
            "data_quality_score": F.lit(0.8),
        }
    )
    return layout(_stamp(rows, generated_at))


def latest_prices(price_weather: DataFrame, keys: Sequence[str] = ("item_name",)) -> DataFrame:
    """The newest row per key; rows of one month are settled by market, origin and category."""
    order = [F.col("year"), F.col("month"), *[F.col(c) for c in ("market", "origin", "major_category", "sub_category") if c not in keys]]
    slim = price_weather.select("item_name", "market", "origin", "major_category", "sub_category", "year", "month", "avg_unit_price_yen")
    return ranking.latest_per_key(slim, list(keys), order)


def regression_rows(projected: DataFrame, best: DataFrame, points: int, generated_at: str) -> DataFrame:
    """Prediction rows of the best regression model: bounds 15 %, interval and score 0.7."""
    # One row: the best model and its measures.
    joined = projected.withColumn("_k", F.lit(1)).join(F.broadcast(best.withColumn("_k", F.lit(1))), "_k")
    price = F.col("predicted_price")
    code = F.create_map(*[F.lit(x) for kv in V.MODEL_CODES.items() for x in kv])
    version = forecast.model_version(generated_at, F.lit(points), "XX")
    rows = joined.withColumns(
        {
            "prediction_id": F.concat_ws("_", "item_name", "model_name", F.date_format("prediction_date", "yyyyMM"), F.lit("ml")),
            "model_type": F.upper("model_name"),
            "model_version": F.concat(F.regexp_replace(version, "XX$", ""), F.element_at(code, F.col("model_name")), F.lit("_ML")),
            "lower_bound_price": price * 0.85,
            "upper_bound_price": price * 1.15,
            "confidence_interval": F.lit(0.7),
            "training_data_points": F.lit(points),
            "model_mae": F.col("mae"),
            "model_mse": F.col("mse"),
            "model_rmse": F.col("rmse"),
            "model_r2": F.col("r2"),
            "data_quality_score": F.lit(0.7),
            "market": F.lit(None),
            "origin": F.lit(None),
        }
    )
    return layout(_stamp(rows, generated_at))


def run_time_series(frame: DataFrame, generated_at: str, months: int = 6, min_points: int = MIN_POINTS,
                    models: Sequence[str] = tuple(MODELS), chunk_rows: int = S.CHUNK_ROWS) -> DataFrame:
    """Forecast rows of every item with at least ``min_points`` rows."""
    series, fits = prepared(frame, ["item_name"], chunk_rows)
    cleaned = S.outlier_filter(series, list(ROW_ORDER), fits=fits)
    cleaned = cleaned.with_df(cut_lineage(cleaned.df.filter(F.col("n") >= min_points)))
    # Scored on the series that is forecast.
    measures = backtest(cleaned.rows(), ["item_name"], models, chunk_rows=chunk_rows)
    return time_series_rows(forecasts(cleaned, months, models), series_facts(cleaned), measures, generated_at)


def merge_predictions(*families: DataFrame) -> DataFrame:
    """Prediction rows of several families of models as one batch."""
    return features.merge(list(families))


def describe(predictions: DataFrame) -> DataFrame:
    """Rows, items and months per model of a batch, with the versions that it holds."""
    return predictions.groupBy("model_type").agg(
        F.count(F.lit(1)).alias("predictions"), F.countDistinct("item_name").alias("items"), F.countDistinct("prediction_date").alias("months"),
        F.countDistinct("model_version").alias("versions"), F.countDistinct("prediction_id").alias("ids"),
    )
