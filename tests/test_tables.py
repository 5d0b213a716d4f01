import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators import aggregates
from marketlens.plans import dims, facts, marts, staging
from marketlens.sources import schemas


def trades(spark, data):
    """(item, market, origin, sub, year, month, quantity, amount) rows as raw trades."""
    names = "item_name market origin sub_category year month quantity_kg amount_yen".split()
    df = spark.createDataFrame(data, "item_name string, market string, origin string, sub_category string, year bigint, month bigint, quantity_kg bigint, amount_yen bigint")
    missing = [f for f in schemas.TRADES.fields if f.name not in names]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).withColumn("major_category", F.lit("野　菜"))


@pytest.fixture(scope="module")
def staged(spark):
    data = []
    for item, origins in (("トマト", ("青森県", "北海道", "静岡")), ("なす", ("青森県",))):
        for o, origin in enumerate(origins):
            for m in range(30):
                if (m + o) % 11 == 4:
                    continue
                year, month = 2019 + m // 12, m % 12 + 1
                for k in range(1 + (m + o) % 3):
                    data.append((item, "大田", origin, "生鮮", year, month, 1 + (m * 7 + k) % 9, 300 + 37 * ((m * 5 + o * 3 + k) % 13)))
    data += [
        ("トマト", "大田", "静岡", "生鮮", 2020, 1, 0, 100),
        ("トマト", "大田", "静岡", "生鮮", 2020, 1, None, 100),
        (None, "大田", "静岡", "生鮮", 2020, 1, 5, 100),
        ("なす", "大田", "青森県", None, 2020, 1, 1, 20000),
    ]
    return staging.stg_trades(trades(spark, data)).persist()


def test_staging_strips_blanks_and_filters_category(staged):
    assert {r[0] for r in staged.select("major_category").distinct().collect()} == {"野菜"}
    other = staged.withColumn("major_category", F.lit("果実"))
    assert staging.stg_trades(other).count() == 0


def test_mean_of_ratios_and_filters(spark, rows):
    df = trades(spark, [("a", "m", "o", "s", 2020, 1, 1, 10), ("a", "m", "o", "s", 2020, 1, 4, 20), ("a", "m", "o", "s", 2020, 1, 0, 9)])
    got = aggregates.monthly_trades(staging.stg_trades(df)).select("total_quantity_kg", "total_amount_yen", "avg_unit_price_yen", "transaction_count")
    assert rows(got) == [(5, 30, 7.5, 2)]


def test_price_bounds_apply_to_movement_only(staged):
    cheap = aggregates.monthly_prices(staged).filter("item_name = 'なす' and sub_category is null")
    assert cheap.count() == 0
    assert aggregates.monthly_trades(staged).filter("item_name = 'なす' and sub_category is null").count() == 1


def test_movement_same_with_tiny_chunks(staged):
    columns = None
    results = []
    for limits in ({}, {"chunk_rows": 13}):
        df = facts.fact_price_movement(staged, start_year=2020, **limits)
        columns = df.columns
        results.append(sorted(map(tuple, df.collect())))
    assert len(results[0]) == len(results[1]) > 0
    for a, b in zip(*results):
        for name, x, y in zip(columns, a, b):
            assert x == (pytest.approx(y) if isinstance(y, float) else y), name


def test_movement_window_reads_history_before_start(staged):
    df = facts.fact_price_movement(staged, start_year=2020)
    first = df.filter("item_name = 'トマト' and origin = '北海道'").orderBy("year", "month").first()
    assert (first["year"], first["month"]) == (2020, 1)
    assert first["prev_month_price"] is not None
    keys = [r[0] for r in df.orderBy("price_movement_key").select("price_movement_key").collect()]
    assert keys == list(range(1, len(keys) + 1))


def test_one_row_series(spark):
    df = staging.stg_trades(trades(spark, [("a", "m", "o", "s", 2020, 1, 2, 100)]))
    row = facts.fact_price_movement(df, start_year=2020).first()
    assert row["prev_month_price"] is None and row["price_zscore_12m"] is None and row["price_stddev"] is None
    assert (row["price_trend_direction"], row["price_anomaly_status"], row["data_quality_level"]) == ("横這い", "正常範囲", "INSUFFICIENT")


def test_price_weather_rank_equals_a_window(spark, staged):
    cube = aggregates.price_cube(staged)
    observed = staging.stg_weather(
        spark.createDataFrame(
            [("44132", "東京", dt.datetime(2020, 1, d, 3), 10.0 + d, 50.0, 9.0, 1.0, 90.0, 0.5, dt.datetime(2020, 2, d)) for d in range(1, 27)],
            "station_id string, station_name string, observation_datetime timestamp, temperature double, humidity double,"
            " precipitation double, wind_speed double, wind_direction double, sunshine double, created_at timestamp",
        )
    )
    stations = dims.dim_station(observed)
    daily = facts.fact_weather_daily(observed, stations)
    made = marts.mart_price_weather(cube, daily, stations)
    order = [F.desc("avg_unit_price_yen"), "item_name", "market", "origin", "major_category", "sub_category"]
    windowed = made.withColumn("_rank", F.row_number().over(Window.partitionBy("year", "month").orderBy(*order)))
    assert windowed.filter("monthly_price_rank <> _rank").count() == 0 and made.agg(F.max("monthly_price_rank")).first()[0] > 1
    key = ["item_name", "market", "origin", "sub_category", "year", "month"]
    pick = lambda df: {tuple(r[:6]): r[6:] for r in map(tuple, df.select(*key, "monthly_price_rank", "weather_data_quality", "precipitation_category").collect())}
    january = [v for k, v in pick(made).items() if k[4:] == (2020, 1)]
    assert {v[1:] for v in january} == {("COMPLETE", "多雨")}
    assert {v[1:] for k, v in pick(made).items() if k[4:] == (2020, 2)} == {("INSUFFICIENT", "不明")}


def test_seasonal_drops_null_category_and_orders_peaks(staged):
    df = marts.mart_seasonal(aggregates.price_cube(staged))
    assert df.filter("sub_category is null").count() == 0
    row = df.filter("item_name = 'トマト'").first()
    volumes = {r["month"]: r["avg_monthly_quantity"] for r in df.filter("item_name = 'トマト'").collect()}
    best = sorted(volumes, key=lambda m: (-volumes[m], m))[:3]
    assert row["peak_supply_months"] == ", ".join(map(str, best))


def test_weather_dedup_takes_last_loaded(spark, rows):
    t = dt.datetime(2020, 1, 1, 5)
    data = [("s", "n", t, 1.04, 50.0, 0.0, 1.0, 2.0, None, dt.datetime(2020, 1, 2)), ("s", "n", t, 2.05, 50.0, 0.0, 1.0, 2.0, None, dt.datetime(2020, 1, 3)),
            ("s", None, dt.datetime(2020, 1, 1, 6), 3.0, 50.0, 0.0, 1.0, 2.0, None, dt.datetime(2020, 1, 3))]
    df = spark.createDataFrame(data, "station_id string, station_name string, observation_datetime timestamp, temperature double, humidity double, precipitation double, wind_speed double, wind_direction double, sunshine double, created_at timestamp")
    assert rows(staging.stg_weather(df).select("temperature", "observation_hour")) == [(2.1, 5)]


def test_location_as_published_and_corrected(staged, rows):
    pick = lambda df: {r["origin_name"]: (r["prefecture"], r["station_name"], r["region"], r["has_weather_data"]) for r in df.collect()}
    published, corrected = pick(dims.dim_location(staged)), pick(dims.dim_location(staged, corrected=True))
    assert published["北海道"] == ("不明", None, "不明", False)
    assert published["青森県"] == ("Aomori", None, "不明", False)
    assert corrected["北海道"] == ("北海道", "札幌", "北海道", True)
    assert corrected["青森県"] == ("青森県", "青森", "東北", True)
    assert published["静岡"] == corrected["静岡"] == ("静岡県", "静岡", "中部", True)


def test_dim_time(spark):
    df = dims.dim_time(spark, "2021-05-20", 2020, 2022)
    assert df.count() == 36
    row = df.filter("year = 2021 and month = 3").first()
    assert (row["time_key"], row["fiscal_year"], row["fiscal_quarter"], row["season_japanese"], row["vegetable_demand_period"]) == (15, 2020, 4, "春", "通常期")
    assert (row["previous_year_same_month_key"], row["next_month_key"], row["month_abbr"], row["month_end_date"]) == (3, 16, "Mar", dt.date(2021, 3, 31))
    assert df.filter("is_historical").count() == 17


PREDICTION = {
    "prediction_id": "p", "prediction_date": "2021-06-01", "prediction_year": "2021", "prediction_month": "6",
    "prediction_generated_at": "2021-05-01 00:00:00", "item_name": "　tomato ", "market": None, "origin": None, "model_type": " lstm ",
    "model_version": None, "predicted_price": "111.0", "lower_bound_price": None, "upper_bound_price": None, "confidence_interval": None,
    "training_data_points": "12", "training_period_start": "2019-01-01", "training_period_end": "2021-01-01", "last_actual_price": 100.0,
    "last_actual_date": "2021-04-01", "model_mae": None, "model_mse": None, "model_rmse": None, "model_r2": None, "data_quality_score": None,
    "prediction_reliability": "HIGH", "created_at": None, "updated_at": None,
}


def staged_predictions(spark, *changes):
    kinds = {"lower_bound_price": "double", "upper_bound_price": "double", "confidence_interval": "double", "last_actual_price": "double",
             "model_mae": "double", "model_mse": "double", "model_rmse": "double", "data_quality_score": "double"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in PREDICTION)
    data = [tuple({**PREDICTION, **change}.values()) for change in changes]
    return staging.stg_predictions(spark.createDataFrame(data, schema), "2021-05-10")


def test_prediction_filters(spark):
    bad = [{"prediction_date": "soon"}, {"prediction_date": "2019-12-31"}, {"prediction_date": "2024-05-11"}, {"predicted_price": "0"},
           {"predicted_price": "10000"}, {"predicted_price": "x"}, {"model_type": "XGBOOST"}, {"training_data_points": "11"}, {"model_r2": "-11"},
           {"model_r2": "2.5"}, {"item_name": None}]
    assert staged_predictions(spark, *bad).count() == 0


def test_prediction_defaults_and_trend(spark):
    df = staged_predictions(spark, {}, {"prediction_id": "q", "last_actual_price": 0.0, "model_r2": "-3", "data_quality_score": 0.9},
                            {"prediction_id": "r", "last_actual_price": None, "model_r2": "1.7", "data_quality_score": 0.4})
    got = {r["prediction_id"]: r for r in df.collect()}
    assert got["p"]["item_name"] == "TOMATO" and got["p"]["model_type"] == "LSTM" and got["q"]["model_r2"] == -1.0 and got["r"]["model_r2"] == 1.0
    fact = {r["last_actual_price"]: r for r in facts.fact_predictions(df, "2021-05-10").collect()}
    p = fact[100.0]
    assert (p["market"], p["origin"], p["model_version"], p["lower_bound_price"], p["upper_bound_price"]) == ("ALL_MARKETS", "ALL_ORIGINS", "1.0", 88.8, 133.2)
    assert (p["confidence_interval"], p["prediction_reliability"], p["predicted_price_trend"], p["predicted_price_change_pct"]) == (0.8, "MEDIUM", "PRICE_INCREASE", 11.0)
    assert (p["forecast_horizon_days"], p["prediction_horizon_type"], p["prediction_season"]) == (31, "MEDIUM_TERM", "夏")
    assert fact[0.0]["predicted_price_change_pct"] is None and fact[0.0]["prediction_reliability"] == "HIGH"
    assert fact[None]["predicted_price_trend"] == "PRICE_STABLE" and fact[None]["prediction_reliability"] == "VERY_LOW"


def test_dashboard_ranks(spark, staged):
    changes = [{"prediction_id": f"{i}{m}", "item_name": f"i{i}", "model_type": m, "predicted_price": str(100 + i % 3), "model_mae": float(i + len(m))}
               for i in range(6) for m in ("LSTM", "ARIMA", "PROPHET")]
    fact = facts.fact_predictions(staged_predictions(spark, *changes), "2021-05-10")
    prices = aggregates.monthly_trades(staged)
    made = marts.mart_dashboard(fact, prices, "2021-05-10")
    pick = lambda df: sorted(map(tuple, df.select("item_name", "model_type", "model_accuracy_rank", "monthly_price_rank", "total_models_for_item").collect()))
    assert len(pick(made)) == 18
    assert {r[3] for r in pick(made)} == {1, 7, 13} and {r[4] for r in pick(made)} == {3}
