"""Registered queries: every operator over the tables of a data folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.numeric import pct_change, round_to
from .operators import accuracy, aggregates, features, forecast, models, quality, ranking, structural
from .operators import series as ts
from .plans import batch, checks, control, dims, facts, marts, report, staging
from .session import cut_lineage, prepare, shared_folder
from .sources import bundles, links, sinks, stations, tables
from .sources.tables import AS_OF, START_YEAR

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
EARLIEST_PREDICTION = "1996-01-01"


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, folder: portable(build(prepare(spark), folder))
        return build

    return register


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that engines and drivers show the same values."""
    shown = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DateType):
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            shown[field.name] = F.col(field.name).cast("bigint")
    return df.withColumns(shown) if shown else df


def rounded(df: DataFrame, columns: Sequence[str], places: int = 6) -> DataFrame:
    return df.withColumns({c: round_to(c, places) for c in columns})


# -- shared inputs --------------------------------------------------------------------


def stg_trades(spark, folder):
    return staging.stg_trades(tables.trades(spark, folder))


def stg_weather(spark, folder):
    return staging.stg_weather(tables.weather_hourly(spark, folder))


def stg_predictions(spark, folder):
    return staging.stg_predictions(tables.predictions(spark, folder), AS_OF, EARLIEST_PREDICTION)


def weather(spark, folder):
    observed = stg_weather(spark, folder)
    stations = dims.dim_station(observed)
    return facts.fact_weather_daily(observed, stations), stations


def cube(spark, folder):
    return cut_lineage(aggregates.price_cube(stg_trades(spark, folder)))


def price_weather(spark, folder, sums=None):
    daily, stations = weather(spark, folder)
    return marts.mart_price_weather(sums if sums is not None else cube(spark, folder), daily, stations)


def fact_predictions(spark, folder):
    return facts.fact_predictions(stg_predictions(spark, folder), AS_OF)


def summary(spark, folder):
    return marts.upcoming(fact_predictions(spark, folder), AS_OF)


def actual_prices(spark, folder):
    monthly = aggregates.monthly_trades(stg_trades(spark, folder))
    return marts.item_month_prices(monthly, START_YEAR)


# -- staging, dimensions, facts, marts ------------------------------------------------


@query("price_trend")
def _(spark, folder):
    return marts.price_trend(aggregates.monthly_trades(stg_trades(spark, folder)))


query("stg_trades")(stg_trades)
query("stg_weather_dedup")(stg_weather)


@query("stg_predictions")
def _(spark, folder):
    return rounded(stg_predictions(spark, folder), ["confidence_interval", "data_quality_score"])


@query("dim_market")
def _(spark, folder):
    return dims.dim_market(stg_trades(spark, folder))


@query("dim_station")
def _(spark, folder):
    return dims.dim_station(stg_weather(spark, folder))


@query("dim_location")
def _(spark, folder):
    return dims.dim_location(stg_trades(spark, folder))


@query("dim_location_corrected")
def _(spark, folder):
    return dims.dim_location(stg_trades(spark, folder), corrected=True)


@query("dim_time")
def _(spark, folder):
    months = tables.trades(spark, folder).select("year", "month").distinct()
    return dims.time_attributes(months, AS_OF)


@query("dim_item")
def _(spark, folder):
    return dims.dim_item(stg_trades(spark, folder))


@query("fact_weather_daily")
def _(spark, folder):
    daily, _ = weather(spark, folder)
    return rounded(
        daily, ["avg_temperature", "avg_humidity", "total_precipitation", "avg_wind_speed", "total_sunshine"]
    )


@query("weather_monthly")
def _(spark, folder):
    daily, stations = weather(spark, folder)
    return facts.weather_monthly(daily, stations, marts.WEATHER_STATIONS)


query("mart_price_weather")(lambda spark, folder: price_weather(spark, folder))


@query("monthly_prices")
def _(spark, folder):
    return aggregates.monthly_prices(stg_trades(spark, folder))


def movement(spark, folder):
    return facts.fact_price_movement(stg_trades(spark, folder), START_YEAR)


query("price_movement")(movement)


@query("price_anomaly")
def _(spark, folder):
    return movement(spark, folder).groupBy("price_anomaly_status", "item_relative_status").agg(
        F.count(F.lit(1)).alias("series_months"),
        F.min("price_zscore_12m").alias("lowest_zscore"),
        F.max("price_zscore_12m").alias("highest_zscore"),
    )


@query("seasonal_month_profile")
def _(spark, folder):
    return aggregates.month_profile(marts.seasonal_base(aggregates.price_cube(stg_trades(spark, folder))), marts.ITEM_KEYS)


@query("seasonal_annual_profile")
def _(spark, folder):
    return aggregates.annual_profile(marts.seasonal_base(aggregates.price_cube(stg_trades(spark, folder))), marts.ITEM_KEYS)


@query("seasonal_peaks")
def _(spark, folder):
    return marts.seasonal_peaks(marts.seasonal_index(marts.seasonal_base(aggregates.price_cube(stg_trades(spark, folder)))))


def seasonal(spark, folder, sums=None):
    return marts.mart_seasonal(sums if sums is not None else cube(spark, folder))


query("mart_seasonal")(seasonal)


@query("fact_predictions")
def _(spark, folder):
    return rounded(fact_predictions(spark, folder), ["confidence_interval", "data_quality_score"])


@query("latest_prediction")
def _(spark, folder):
    latest = marts.latest_predictions(fact_predictions(spark, folder))
    return rounded(latest, ["confidence_interval", "data_quality_score"])


@query("model_accuracy")
def _(spark, folder):
    return rounded(
        marts.model_accuracy(summary(spark, folder)), ["avg_mae", "avg_rmse", "avg_r2", "high_reliability_ratio"]
    )


@query("prediction_consensus")
def _(spark, folder):
    return rounded(
        marts.consensus(summary(spark, folder)),
        ["avg_predicted_price", "price_prediction_std", "increase_consensus", "decrease_consensus", "stable_consensus"],
    )


@query("prev_year_compare")
def _(spark, folder):
    joined = marts.with_previous_year(summary(spark, folder), actual_prices(spark, folder))
    return joined.select(
        "prediction_key", "item_name", "prediction_year", "prediction_month", "predicted_price",
        round_to("actual_price", 6).alias("actual_price"),
        pct_change("predicted_price", "actual_price").alias("vs_previous_year_pct"),
    )


@query("mart_dashboard")
def _(spark, folder):
    # The dashboard needs the monthly prices of the price table only, not its weather.
    monthly = aggregates.monthly_trades(stg_trades(spark, folder))
    board = marts.mart_dashboard(fact_predictions(spark, folder), monthly, AS_OF, START_YEAR)
    return rounded(board, ["confidence_interval", "data_quality_score"])


# -- data tests -----------------------------------------------------------------------


@query("dq_unique")
def _(spark, folder):
    """Pages of observations loaded twice: station and time that occur more than once."""
    stamped = tables.weather_hourly(spark, folder).select(
        F.concat_ws("@", "station_id", F.date_format("observation_datetime", "yyyy-MM-dd HH")).alias("observation")
    )
    return quality.unique(stamped, "observation")


@query("dq_not_null")
def _(spark, folder):
    return quality.not_null(stg_trades(spark, folder), "amount_yen")


@query("dq_accepted_values")
def _(spark, folder):
    return quality.accepted_values(
        tables.trades(spark, folder).select("year", "month", "item_name", "major_category", "quantity_kg"),
        "major_category", ["野菜", "野 菜", "野　菜"],
    )


@query("dq_accepted_range")
def _(spark, folder):
    return quality.accepted_range(stg_weather(spark, folder), "humidity", 0, 100)


@query("dq_relationships")
def _(spark, folder):
    """Origins of trades that the location table lacks."""
    staged = stg_trades(spark, folder)
    return quality.relationships(staged, "origin", dims.dim_location(staged), "origin_name")


@query("dq_summary")
def _(spark, folder):
    """All declared checks of the staging views, two dimensions and the weather fact."""
    suite = {
        "stg_trades": lambda _: stg_trades(spark, folder),
        "stg_weather": lambda _: stg_weather(spark, folder),
        "stg_predictions": lambda _: stg_predictions(spark, folder),
        "dim_market": lambda saved: dims.dim_market(saved["stg_trades"]),
        "dim_station": lambda saved: dims.dim_station(saved["stg_weather"]),
        "fact_weather_daily": lambda saved: facts.fact_weather_daily(saved["stg_weather"], saved["dim_station"]),
    }
    return quality.run_suite(suite, checks.declared(1996, 2002))


@query("dq_summary_marts")
def _(spark, folder):
    """All declared checks of the other dimensions, facts and marts."""
    suite = {
        "stg_trades": lambda _: stg_trades(spark, folder),
        "price_cube": lambda saved: aggregates.price_cube(saved["stg_trades"]),
        "dim_location": lambda saved: dims.dim_location(saved["stg_trades"]),
        "dim_time": lambda _: dims.time_attributes(tables.trades(spark, folder).select("year", "month").distinct(), AS_OF),
        "dim_item": lambda saved: dims.dim_item(saved["stg_trades"]),
        "fact_predictions": lambda _: fact_predictions(spark, folder),
        "mart_price_weather": lambda saved: price_weather(spark, folder, saved["price_cube"]),
        "mart_seasonal": lambda saved: marts.mart_seasonal(saved["price_cube"]),
        "price_movement": lambda saved: facts.fact_price_movement(saved["stg_trades"], START_YEAR),
        "mart_dashboard": lambda saved: marts.mart_dashboard(saved["fact_predictions"], saved["mart_price_weather"], AS_OF, START_YEAR),
    }
    rules = checks.declared(1996, 2002)
    return quality.run_suite(suite, {name: rules[name] for name in suite if name not in ("stg_trades", "price_cube")})


@query("content_score")
def _(spark, folder):
    return rounded(quality.content_score(stg_trades(spark, folder)), ["score"])


# -- reports and control --------------------------------------------------------------

REPORT_MONTH = report.target_month(dt.date.fromisoformat(AS_OF))
USAGE_DATE = "2024-01-31"


def cheapest(spark, folder):
    return report.cheapest(fact_predictions(spark, folder), *REPORT_MONTH)


@query("cheapest_top10")
def _(spark, folder):
    return cheapest(spark, folder).drop("sort_price", "sort_confidence", "sort_r2")


@query("volatile_items")
def _(spark, folder):
    return report.volatile_items(seasonal(spark, folder), REPORT_MONTH[1])


@query("report_message")
def _(spark, folder):
    return report.message(
        cheapest(spark, folder),
        report.volatile_items(seasonal(spark, folder), REPORT_MONTH[1]),
        sinks.latest_metadata(tables.model_records(spark, folder)),
        REPORT_MONTH[1],
    )


@query("coverage_diagnosis")
def _(spark, folder):
    return report.coverage(tables.predictions(spark, folder), fact_predictions(spark, folder), 1996)


@query("batch_counts")
def _(spark, folder):
    return report.batch_counts(fact_predictions(spark, folder))


@query("usage_month")
def _(spark, folder):
    return rounded(control.usage_month(tables.job_log(spark, folder), USAGE_DATE, "market"), ["current_usage"])


def usage(spark, folder):
    return control.all_usage(tables.job_log(spark, folder), tables.stored_objects(spark, folder), USAGE_DATE, "market")


query("usage_rows")(usage)


@query("usage_alerts")
def _(spark, folder):
    """Alerts against a small quota, so that some level is passed."""
    jobs = control.usage_month(tables.job_log(spark, folder), USAGE_DATE, "market")
    rows = [control.usage_rows(jobs, "warehouse", f"quota_{limit}", float(limit), USAGE_DATE) for limit in (20, 60, 90, 110, 1024)]
    return control.alerts(reduce(DataFrame.unionByName, rows))


@query("safety_gate")
def _(spark, folder):
    jobs = control.usage_month(tables.job_log(spark, folder), USAGE_DATE, "market")
    gates = [control.safety_gate(jobs, need, 1024.0).withColumn("required_gb", F.lit(need)) for need in (0.01, 800.0, 1000.0)]
    return reduce(DataFrame.unionByName, gates)


@query("run_report")
def _(spark, folder):
    return control.run_report(tables.ingest_results(spark, folder))


# -- sources --------------------------------------------------------------------------


def file_links(spark, folder):
    return links.extract_links(tables.link_pages(spark, folder), keep=("page_id",))


query("file_links")(file_links)


def distinct_files(spark, folder):
    return file_links(spark, folder).select("year", "month", "kind", "url").distinct()


@query("files_superseded")
def _(spark, folder):
    return links.drop_superseded(distinct_files(spark, folder))


@query("files_select")
def _(spark, folder):
    files = distinct_files(spark, folder)
    latest = links.select_files(files, "latest-only").withColumn("mode", F.lit("latest-only"))
    return latest.unionByName(links.select_files(files, "backfill", as_of_year=2001).withColumn("mode", F.lit("backfill")))


@query("files_pending")
def _(spark, folder):
    """Files whose month has no trades yet."""
    loaded = tables.trades(spark, folder).select("year", "month").distinct()
    manifest = loaded.withColumn("filename", links.period_file())
    return links.pending(distinct_files(spark, folder), manifest)


@query("month_slices")
def _(spark, folder):
    """Month slices of the observed time of each station, as load tasks."""
    spans = stg_weather(spark, folder).groupBy("station_id").agg(
        F.min("observation_date").alias("start_date"), F.max("observation_date").alias("end_date")
    )
    return links.month_slices(spans)


@query("station_catalogue")
def _(spark, folder):
    """Observations per catalogue station, by coverage."""
    counts = stg_weather(spark, folder).groupBy("station_id").agg(F.count(F.lit(1)).alias("observations"))
    lists = [
        stations.stations(spark, name).withColumn("coverage", F.lit(name)) for name in ("all", "agriculture", "current")
    ]
    return reduce(DataFrame.unionByName, lists).join(counts, "station_id", "left")


@query("object_sizes")
def _(spark, folder):
    return rounded(sinks.object_sizes(tables.stored_objects(spark, folder)), ["size_gb"])


@query("latest_metadata")
def _(spark, folder):
    return sinks.latest_metadata(tables.model_records(spark, folder))


@query("target_items")
def _(spark, folder):
    monthly = aggregates.monthly_trades(stg_trades(spark, folder))
    return aggregates.frequent_items(monthly, "item_name", START_YEAR, 24, 20)


@query("ordered_months")
def _(spark, folder):
    """Monthly trades with their place in the order of an export, numbered without a single-task sort."""
    keys = ["year", "month", "item_name", "market", "origin", "major_category", "sub_category"]
    monthly = aggregates.monthly_trades(stg_trades(spark, folder)).select(*keys, "avg_unit_price_yen")
    return rounded(ranking.global_index(monthly, [F.col(c).asc_nulls_first() for c in keys], "position"), ["avg_unit_price_yen"])


@query("calendar_years")
def _(spark, folder):
    """The calendar from the first year of trades to the one after the last, whether or not a month has trades."""
    first, last = tables.trades(spark, folder).agg(F.min("year"), F.max("year")).first()
    return dims.dim_time(spark, AS_OF, int(first), int(last) + 1)


@query("load_tasks")
def _(spark, folder):
    """Every observed station with every month of the whole observed time."""
    observed = stg_weather(spark, folder)
    span = observed.agg(F.min("observation_date").alias("start_date"), F.max("observation_date").alias("end_date"))
    return links.task_grid(dims.dim_station(observed).select("station_id", "region"), links.month_slices(span))


# -- series ---------------------------------------------------------------------------

ITEM = ["item_name"]
ORDER = list(batch.ROW_ORDER)
ROW_KEYS = ["item_name", "market", "origin", "sub_category", "profile_category", "year", "month"]
GAPS = ["avg_temperature", "yoy_price_growth_rate"]
REPAIRED = [
    "y", "total_quantity_kg", "total_amount_yen", "yoy_price_growth_rate", "mom_price_growth_rate", "price_3month_moving_avg",
    "avg_temperature", "total_precipitation", "avg_wind_speed", "seasonal_price_index", "seasonal_quantity_index",
]


def series_frame(spark, folder):
    sums = cube(spark, folder)
    return features.series_frame(price_weather(spark, folder, sums), seasonal(spark, folder, sums))


def item_series(spark, folder):
    """All rows of an item in time order, as one series."""
    return batch.prepared(series_frame(spark, folder), ITEM)


def market_series(spark, folder):
    """One series per item, market and origin."""
    return batch.prepared(series_frame(spark, folder), features.SERIES)


def shown(series, *columns):
    return rounded(series.df.select(*ROW_KEYS, "pos", *columns), [c for c in columns if c != "n"])


query("series_extract")(series_frame)


@query("series_chosen")
def _(spark, folder):
    """The series of one item in one market, by parameters."""
    sums = cube(spark, folder)
    item, market = sums.agg(F.min("item_name"), F.max("market")).first()
    return features.series_frame(price_weather(spark, folder, sums), seasonal(spark, folder, sums), item=item, market=market)


@query("lag_matrix")
def _(spark, folder):
    series, _ = item_series(spark, folder)
    offsets = {"y_lag_1": 1, "y_lag_3": 3, "y_lag_6": 6, "y_lag_12": 12}
    return shown(ts.lag_columns(series, "y", offsets), "y", *offsets)


@query("moving_stats")
def _(spark, folder):
    series, _ = item_series(spark, folder)
    moved = ts.moving_columns(series, "y", {"y_ma_3": 3, "y_ma_6": 6, "y_ma_12": 12}, {"y_sd_12": 12})
    return shown(moved, "y", "y_ma_3", "y_ma_6", "y_ma_12", "y_sd_12")


@query("quartiles")
def _(spark, folder):
    series, fits = item_series(spark, folder)
    found = ts.quantiles(series.df, ITEM, "y", (0.25, 0.5, 0.75), ("q1", "median", "q3"), ["pos"], fits)
    return rounded(found, ["q1", "median", "q3"])


@query("outlier_filter")
def _(spark, folder):
    series, fits = item_series(spark, folder)
    return shown(ts.outlier_filter(series, ORDER, fits=fits), "y", "n")


@query("outlier_repair")
def _(spark, folder):
    series, fits = item_series(spark, folder)
    return shown(ts.outlier_repair(series, fits=fits), "y")


@query("interpolate_gaps")
def _(spark, folder):
    series, _ = item_series(spark, folder)
    return shown(ts.interpolate_gaps(series, GAPS), *GAPS)


@query("fill_gaps")
def _(spark, folder):
    series, _ = item_series(spark, folder)
    return shown(ts.fill_gaps(series, GAPS), *GAPS)


@query("repaired_series")
def _(spark, folder):
    """All numeric columns of a series repaired, with its lags, means, change and trend."""
    series, fits = item_series(spark, folder)
    numeric = series.with_df(series.df.withColumns({c: F.col(c).cast("double") for c in REPAIRED}))
    repaired = ts.repair(numeric, REPAIRED, fits=fits)
    return shown(repaired, *REPAIRED, "y_lag1", "y_lag3", "y_ma3", "y_ma6", "y_pct_change", "trend", "y_detrended")


@query("smooth_series")
def _(spark, folder):
    series, _ = item_series(spark, folder)
    return shown(ts.smooth_centred(series), "y")


@query("shape_features")
def _(spark, folder):
    series, _ = item_series(spark, folder)
    return shown(ts.shape_features(series), "y", "y_lag1", "y_lag3", "y_ma3", "y_ma6", "y_pct_change")


@query("detrend")
def _(spark, folder):
    series, _ = item_series(spark, folder)
    return shown(ts.detrend(series), "y", "trend", "y_detrended")


@query("sequences")
def _(spark, folder):
    series, _ = market_series(spark, folder)
    windows = ts.sequences(series, ["y", "total_quantity_kg"], "y", 12)
    text = lambda c: F.array_join(F.transform("window", lambda s: s[c].cast("string")), ",")
    return windows.select(*ROW_KEYS, "pos", "target", text("y").alias("prices"), text("total_quantity_kg").alias("quantities"))


@query("last_rows")
def _(spark, folder):
    series, _ = market_series(spark, folder)
    return ts.last_rows(series, 12).select(*ROW_KEYS, "pos", "y")


def item_split(spark, folder):
    series, fits = item_series(spark, folder)
    return ts.holdout(series), fits


@query("holdout_split")
def _(spark, folder):
    split, _ = item_split(spark, folder)
    return split.df.select(*ROW_KEYS, "pos", "train_n", "test_n", "is_train")


@query("naive_baseline")
def _(spark, folder):
    series, _ = market_series(spark, folder)
    return ts.naive_baseline(ts.holdout(series)).select(*ROW_KEYS, "pos", "y", "y_naive")


@query("minmax_scale")
def _(spark, folder):
    split, _ = item_split(spark, folder)
    return shown(ts.minmax_scale(split, ["y", "total_quantity_kg"]), "y_scaled", "total_quantity_kg_scaled")


@query("train_median_fill")
def _(spark, folder):
    split, fits = item_split(spark, folder)
    return shown(ts.fill_with_train_median(split, ["yoy_price_growth_rate"], fits), "yoy_price_growth_rate")


def mean_forecast(split):
    """The mean of the training rows as forecast, to have values to judge."""
    means = split.df.filter("is_train").groupBy(*split.keys).agg(F.avg("y").alias("y_pred"))
    return split.with_df(ranking.join_groups(split.df, means, split.keys))


def shown_measures(measured):
    return rounded(rounded(measured, ["mse"], 2), ["mae", "rmse", "mape", "smape", "mase", "r2"], 4)


def naive_metrics(spark, folder):
    split, _ = item_split(spark, folder)
    return accuracy.metrics(ts.naive_baseline(mean_forecast(split)), ITEM)


@query("accuracy_metrics")
def _(spark, folder):
    return shown_measures(naive_metrics(spark, folder))


@query("accuracy_metrics_diff")
def _(spark, folder):
    split, _ = item_split(spark, folder)
    return shown_measures(accuracy.metrics_by_steps(mean_forecast(split)))


@query("grade")
def _(spark, folder):
    graded = naive_metrics(spark, folder)
    return graded.select("item_name", round_to("mase", 6).alias("mase"), accuracy.grade("mase").alias("grade"))


# -- forecasts ------------------------------------------------------------------------


def seasonal_trend(mode):
    def build(spark, folder):
        series, _ = item_series(spark, folder)
        fit = forecast.fit_trend_season(series.df, ITEM, mode)
        ahead = forecast.future_months(series.df, ITEM, 6).withColumn("year", F.year("ds").cast("bigint"))
        out = fit.predict(ahead).select("item_name", "ds", "y_pred", "lower", "upper")
        return rounded(out, ["y_pred", "lower", "upper"], 4)

    return build


query("forecast_trend_seasonal")(seasonal_trend("additive"))
query("forecast_trend_multiplicative")(seasonal_trend("multiplicative"))


@query("forecast_trend_regressors")
def _(spark, folder):
    """Trend, months, events, temperature, rain and growth per item, six months ahead."""
    series, fits = item_series(spark, folder)
    return rounded(structural.forecast_structural(series, 6, fits=fits), ["y_pred", "lower", "upper"], 4)


@query("forecast_projection")
def _(spark, folder):
    latest = batch.latest_prices(price_weather(spark, folder))
    return forecast.projection(latest, 6).select(
        "item_name", "step", "prediction_date", "predicted_price", "lower_bound", "upper_bound"
    )


@query("future_months")
def _(spark, folder):
    months = forecast.future_months(series_frame(spark, folder), features.SERIES, 6)
    return months.select(*features.SERIES, "last_ds", "step", "ds", "month")


@query("climatology")
def _(spark, folder):
    out = forecast.future_regressors(
        series_frame(spark, folder), ITEM, 6, ["avg_temperature", "total_precipitation"], ["total_quantity_kg"]
    )
    return rounded(out, ["avg_temperature", "total_precipitation", "total_quantity_kg"])


@query("event_calendar")
def _(spark, folder):
    """Event flags of every observed day."""
    return forecast.event_flags(stg_weather(spark, folder).select(F.col("observation_date").alias("ds")).distinct())


@query("forecast_autoregressive")
def _(spark, folder):
    series, _ = market_series(spark, folder)
    return rounded(forecast.forecast_autoregression(series, 6), ["aic", "sigma", "y_pred", "lower", "upper"], 4).drop("lags")


@query("forecast_recursive")
def _(spark, folder):
    series, _ = market_series(spark, folder)
    return rounded(batch.forecasts(series, 6, ["pooled"]), ["y_pred"], 4)


@query("forecast_recursive_boosted")
def _(spark, folder):
    """The recursion with boosted trees instead of a linear model."""
    series, _ = market_series(spark, folder)
    return batch.forecasts(series, 6, ["pooled"], method="boosted")


@query("backtest")
def _(spark, folder):
    return batch.backtest(series_frame(spark, folder))


@query("backtest_status")
def _(spark, folder):
    """Which model could be scored on which series, and why not."""
    return batch.backtest_parts(series_frame(spark, folder))[1]


def all_predictions(spark, folder):
    """Time-series rows of three models and rows of the regression, as one batch."""
    generated = f"{AS_OF} 00:00:00"
    split, _, fitted = regression(spark, folder, ("linear_regression",))
    best = models.best_model(models.evaluate_all(split, fitted))
    projected = forecast.projection(batch.latest_prices(price_weather(spark, folder)), 6)
    regressed = batch.regression_rows(projected, best, split.count(), generated)
    return batch.merge_predictions(batch.run_time_series(series_frame(spark, folder), generated), regressed)


@query("prediction_union")
def _(spark, folder):
    return all_predictions(spark, folder).select(
        "prediction_id", "item_name", "model_type", "model_version", "prediction_date", "training_data_points", "confidence_interval"
    )


@query("batch_metadata")
def _(spark, folder):
    """The metadata record of a merged batch, written as a line and read again, beside counts per model."""
    predictions = cut_lineage(all_predictions(spark, folder))
    record = sinks.latest_metadata(sinks.metadata_rows(predictions, dt.date.fromisoformat(AS_OF)))
    # One row.
    return batch.describe(predictions).withColumn("_k", F.lit(1)).join(F.broadcast(record.withColumn("_k", F.lit(1))), "_k").drop("_k")


@query("prediction_batch")
def _(spark, folder):
    """Time-series prediction rows of all items with three models."""
    return batch.run_time_series(series_frame(spark, folder), f"{AS_OF} 00:00:00")


# -- regression -----------------------------------------------------------------------


def training_rows(spark, folder, lags_first=False):
    staged = stg_trades(spark, folder)
    sums = cube(spark, folder)
    prices, seasons = price_weather(spark, folder, sums), seasonal(spark, folder, sums)
    return features.training_rows(prices, seasons, dims.dim_item(staged), lags_first=lags_first)


TRAINING_KEYS = [*features.SERIES, *features.ROW_ORDER]


@query("training_features")
def _(spark, folder):
    return training_rows(spark, folder)


@query("training_features_lags_first")
def _(spark, folder):
    """Lags before the attributes, so that no lag is a copy of its own row's price."""
    return training_rows(spark, folder, lags_first=True)


@query("encode_categories")
def _(spark, folder):
    columns = ["item_name", "market", "origin", "sub_category"]
    encoded = features.encode_ordinal(stg_trades(spark, folder).select(*columns).distinct(), columns)
    return encoded


@query("feature_deviation")
def _(spark, folder):
    rows = features.month_deviation(
        training_rows(spark, folder).withColumn("price_volatility", features.price_volatility()),
        {"avg_temperature": "temperature_deviation", "total_precipitation": "precipitation_deviation"},
    ).withColumn("price_trend", features.trend_sign())
    names = ["price_volatility", "temperature_deviation", "precipitation_deviation"]
    return rounded(rows.select(*TRAINING_KEYS, *names, "price_trend"), names)


@query("quarter_dummies")
def _(spark, folder):
    rows = features.quarter_dummies(training_rows(spark, folder))
    return rows.select(*TRAINING_KEYS, "quarter", "quarter_1", "quarter_2", "quarter_3", "quarter_4")


def regression(spark, folder, wanted=None):
    """Split of rows whose lags do not hold the target, and the ``wanted`` models (default: all), fitted at their default sizes."""
    built = features.build_features(training_rows(spark, folder, lags_first=True))
    names = features.available_features(built)
    whole = features.complete_rows(built, [*names, features.TARGET])
    split = cut_lineage(features.chronological_split(whole))
    plans = {name: plan for name, plan in models.pipelines(names).items() if wanted is None or name in wanted}
    return split, names, models.fit_all(split, plans, [*names, features.TARGET])


@query("model_bundle")
def _(spark, folder):
    """Facts of a saved and reloaded bundle: manifest, code table and the rows it scores.

    The features are learnt from the training rows only; the test rows are scored by the reloaded bundle.
    """
    rows = features.chronological_split(training_rows(spark, folder, lags_first=True))
    rows = cut_lineage(rows)
    state = features.fit_features(rows.filter("is_train"))
    built = features.apply_features(rows, state)
    names = features.available_features(built)
    split = cut_lineage(features.complete_rows(built, [*names, features.TARGET]))
    plan = {"linear_regression": models.pipelines(names)["linear_regression"]}
    fitted = models.fit_all(split, plan, [*names, features.TARGET])
    base = f"{shared_folder(spark)}/marketlens/{spark.sparkContext.applicationId}/bundles-{uuid.uuid4().hex}"
    as_of = dt.date.fromisoformat(AS_OF)
    bundles.save_bundle(base, f"{as_of:%Y%m}", fitted, state, names, split, as_of)
    bundle = bundles.load_bundle(spark, base)
    scored = bundle.score(rows.filter("not is_train")).agg(F.count("y_pred").alias("scored_rows"))
    shown = bundles.manifests(spark, base).select(
        "version", "best_model", F.size("features").alias("features"), "code_rows", "train_rows", "test_rows", "train_end", "test_start"
    )
    # One row each.
    return shown.withColumn("_k", F.lit(1)).join(F.broadcast(scored.withColumn("_k", F.lit(1))), "_k").drop("_k")


@query("train_regressors")
def _(spark, folder):
    split, _, fitted = regression(spark, folder)
    return models.evaluate_all(split, fitted)


@query("feature_importance")
def _(spark, folder):
    _, names, fitted = regression(spark, folder, ("random_forest", "gradient_boosting"))
    return models.importance(spark, fitted, names)


@query("best_model")
def _(spark, folder):
    split, _, fitted = regression(spark, folder)
    return models.best_model(models.evaluate_all(split, fitted))


@query("regression_batch")
def _(spark, folder):
    split, _, fitted = regression(spark, folder)
    best = models.best_model(models.evaluate_all(split, fitted))
    projected = forecast.projection(batch.latest_prices(price_weather(spark, folder)), 6)
    return batch.regression_rows(projected, best, split.count(), f"{AS_OF} 00:00:00")


@query("chronological_split")
def _(spark, folder):
    split = features.chronological_split(training_rows(spark, folder))
    return split.select(*TRAINING_KEYS, "avg_unit_price_yen", "is_train")
