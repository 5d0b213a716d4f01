import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.functions import vocabulary as V
from marketlens.operators import accuracy, features, forecast, models
from marketlens.operators import series as S
from marketlens.plans import batch


def months(n, start=2015):
    return [(start + i // 12, i % 12 + 1) for i in range(n)]


def series(spark, values, name="a"):
    data = [(name, y, m, dt.date(y, m, 1), float(v)) for (y, m), v in zip(months(len(values)), values)]
    return spark.createDataFrame(data, "item string, year bigint, month bigint, ds date, y double")


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_line_is_continued(spark, mode):
    df = series(spark, [2 * t + 5 for t in range(48)])
    fit = forecast.fit_trend_season(df, ["item"], mode)
    ahead = forecast.future_months(df, ["item"], 6).withColumn("year", F.year("ds").cast("bigint"))
    got = [r["y_pred"] for r in fit.predict(ahead).orderBy("ds").collect()]
    np.testing.assert_allclose(got, [2 * t + 5 for t in range(48, 54)], rtol=1e-6)


def test_line_with_month_effect(spark):
    effect = [10 * (m % 3 - 1) for m in range(12)]
    df = series(spark, [3 * t + effect[t % 12] for t in range(120)])
    fit = forecast.fit_trend_season(df, ["item"])
    ahead = forecast.future_months(df, ["item"], 12).withColumn("year", F.year("ds").cast("bigint"))
    rows = fit.predict(ahead).orderBy("ds").collect()
    np.testing.assert_allclose([r["y_pred"] for r in rows], [3 * t + effect[t % 12] for t in range(120, 132)], atol=1.5)
    assert all(r["lower"] <= r["y_pred"] <= r["upper"] for r in rows)


def test_one_month_only(spark):
    df = series(spark, [7.0])
    ahead = forecast.future_months(df, ["item"], 2).withColumn("year", F.year("ds").cast("bigint"))
    got = forecast.fit_trend_season(df, ["item"]).predict(ahead).collect()
    assert [r["y_pred"] for r in got] == [7.0, 7.0]


def test_future_months_roll_over_the_year(spark):
    got = forecast.future_months(series(spark, range(11)), ["item"], 3).orderBy("step").collect()
    assert [(r["step"], str(r["ds"]), r["month"]) for r in got] == [(1, "2015-12-01", 12), (2, "2016-01-01", 1), (3, "2016-02-01", 2)]


def test_autoregression_recovers_its_recursion(spark):
    y = [10.0, 14.0]
    for _ in range(60):
        y.append(5 + 0.6 * y[-1] + 0.3 * y[-2])
    s = S.index_series(series(spark, y), ["item"], ["year", "month"], fits=True)
    got = forecast.forecast_autoregression(s, 4).orderBy("step").collect()
    want = list(y)
    for _ in range(4):
        want.append(5 + 0.6 * want[-1] + 0.3 * want[-2])
    np.testing.assert_allclose([r["y_pred"] for r in got], want[-4:], rtol=1e-3)


def test_autoregression_line_with_differences(spark):
    s = S.index_series(series(spark, [4 * t + 1 for t in range(30)]), ["item"], ["year", "month"], fits=True)
    got = forecast.forecast_autoregression(s, 3).orderBy("step").collect()
    np.testing.assert_allclose([r["y_pred"] for r in got], [121, 125, 129], rtol=1e-3)


def test_autoregression_same_when_chunked(spark):
    rng = np.random.default_rng(1)
    df = series(spark, 100 + rng.normal(size=90).cumsum()).union(series(spark, 50 + rng.normal(size=40), "b"))
    a, b = (
        {(r["item"], r["step"]): r["y_pred"] for r in forecast.forecast_autoregression(s, 3).collect()}
        for s in (S.index_series(df, ["item"], ["year", "month"], fits=True), S.index_series(df, ["item"], ["year", "month"], chunk_rows=20))
    )
    assert len(a) == 6 and a == pytest.approx(b)


def test_backtest_autoregression_starts_after_training(spark):
    split = S.holdout(S.index_series(series(spark, [4 * t + 1 for t in range(40)]), ["item"], ["year", "month"], fits=True))
    got = {r["pos"]: r["y_pred"] for r in forecast.backtest_autoregression(split).collect()}
    assert got == pytest.approx({t: 4 * t + 1 for t in range(32, 40)}, rel=1e-3)


def test_pooled_recursion_follows_a_line(spark):
    df = series(spark, np.linspace(0, 1, 60)).withColumn("x", F.lit(0.5))
    s = S.index_series(df, ["item"], ["year", "month"], fits=True)
    pooled = forecast.fit_pooled(S.sequences(s, ["y", "x"], "y", 4), ["y", "x"], 4, regularisation=0.0)
    got = forecast.recur_pooled(pooled, forecast.last_window(s, ["y", "x"], 4), ["item"], 3).orderBy("step").collect()
    np.testing.assert_allclose([r["y_scaled_pred"] for r in got], [1 + k / 59 for k in (1, 2, 3)], rtol=1e-3)


def test_projection(spark):
    df = spark.createDataFrame([("a", 2020, 11, 100.0)], "item_name string, year bigint, month bigint, avg_unit_price_yen double")
    got = forecast.projection(df, 2).orderBy("step").collect()
    assert [str(r["prediction_date"]) for r in got] == ["2020-12-01", "2021-01-01"]
    assert got[0]["predicted_price"] == pytest.approx(100.0) and got[1]["predicted_price"] == pytest.approx(107.1)
    assert (got[1]["lower_bound"], got[1]["upper_bound"]) == (91.04, 123.17)


def test_event_flags(spark, rows):
    days = ["2021-01-01", "2021-01-04", "2021-01-05", "2021-05-08", "2021-08-13", "2021-12-27", "2021-12-26"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "ds date")
    got = {str(r[0]): r[1:] for r in rows(forecast.event_flags(df))}
    assert got["2021-01-01"] == (1, 0, 0, 1) and got["2021-01-04"] == (1, 0, 0, 0) and got["2021-01-05"] == (0, 0, 0, 0)
    assert got["2021-05-08"] == (0, 1, 0, 0) and got["2021-08-13"] == (0, 0, 1, 0) and got["2021-12-27"] == (0, 0, 0, 1) and got["2021-12-26"] == (0, 0, 0, 0)


@pytest.mark.parametrize("points, expected", [(812, "2001.12_v812r_LS"), (1500, "2001.12_v15h_LS"), (250000, "2001.12_v250k_LS")])
def test_model_version(spark, points, expected):
    assert spark.range(1).select(forecast.model_version("2001-12-01", F.lit(points), "lstm")).first()[0] == expected


def test_metrics_undefined_cases(spark):
    df = spark.createDataFrame([("c", 5.0, 5.0, 5.0), ("c", 5.0, 6.0, 5.0), ("z", 0.0, 0.0, 1.0)], "k string, y double, y_pred double, y_naive double")
    got = {r["k"]: r for r in accuracy.metrics(df, ["k"]).collect()}
    assert got["c"]["mae"] == 0.5 and got["c"]["mase"] == float("inf") and got["c"]["r2"] == float("-inf") and got["c"]["mape"] == 10.0
    assert got["z"]["mape"] == float("inf") and got["z"]["smape"] == float("inf") and got["z"]["mase"] == 0.0


@pytest.mark.parametrize("mase, expected", [(0.49, "EXCELLENT"), (0.5, "GOOD"), (0.99, "FAIR"), (1.0, "POOR"), (1.5, "VERY_POOR"), (float("inf"), "VERY_POOR"), (None, None)])
def test_grade(spark, mase, expected):
    assert spark.createDataFrame([(mase,)], "m double").select(accuracy.grade("m")).first()[0] == expected


def test_metrics_by_steps_match_numpy(spark):
    y = np.array([3.0, 5, 4, 8, 7, 9, 12, 10, 11, 15, 13, 18, 17, 16, 20])
    s = S.index_series(series(spark, y), ["item"], ["year", "month"], fits=True)
    split = S.holdout(s)
    split = split.with_df(split.df.withColumn("y_pred", F.col("y") + 1))
    row = accuracy.metrics_by_steps(split).first()
    test = y[12:]
    assert row["points"] == 3 and row["mae"] == pytest.approx(1.0)
    assert row["mase"] == pytest.approx(1 / np.abs(np.diff(test[:-1])).mean())


def test_encode_sorted_with_missing(spark, rows):
    df = spark.createDataFrame([("b", "x"), ("a", None), (None, "x")], "p string, q string")
    got = rows(features.encode_ordinal(df, ["p", "q"]).select("p", "q", "p_encoded", "q_encoded"), "p")
    assert got == [(None, "x", 0, 1), ("a", None, 1, 0), ("b", "x", 2, 1)]


def test_saved_codes_serve_later_rows(spark, rows, tmp_path):
    first = spark.createDataFrame([("b", "x"), ("a", None)], "p string, q string")
    features.fit_codes(first, ["p", "q"]).write.parquet(str(tmp_path / "codes"))
    codes = spark.read.parquet(str(tmp_path / "codes"))
    later = spark.createDataFrame([("b", None), ("new", "x"), (None, "y")], "p string, q string")
    got = features.apply_codes(later, codes, ["p", "q"]).select("p", "q", "p_encoded", "q_encoded")
    assert rows(got, "p") == [(None, "y", -1, -1), ("b", None, 1, 0), ("new", "x", -1, 1)]
    nulls = features.apply_codes(later, codes, ["p"], unseen=None).select("p", "p_encoded")
    assert rows(nulls, "p") == [(None, None), ("b", 1), ("new", None)]


def test_lags_first_do_not_hold_the_target(spark, rows):
    names = "item_name string, market string, origin string, major_category string, sub_category string, year bigint, month bigint, avg_unit_price_yen double, total_quantity_kg bigint"
    prices = spark.createDataFrame(
        [("i", "m", "o", "c", s, 2020, m, float(p), 5) for s, m, p in [("s", 1, 10), ("s", 2, 20), ("t", 1, 70), ("t", 2, 80), (None, 1, 1), (None, 2, 2)]], names)
    seasonal = spark.createDataFrame(
        [("i", s, m, 1.0, 1.0, "L") for s in ("s", "t") for m in (1, 2)],
        "item_name string, sub_category string, month bigint, seasonal_price_index double, seasonal_quantity_index double, seasonality_level string")
    items = spark.createDataFrame(
        [("i", s, "P", "V", "S", 3.0) for s in ("s", "t")],
        "item_name string, sub_category string, price_tier string, vegetable_category string, seasonality string, avg_unit_price_yen double")
    columns = ["sub_category", "month", "avg_unit_price_yen", "price_lag_1m", "profile_category"]
    own = features.training_rows(prices, seasonal, items, lags_first=True).select(*columns)
    assert rows(own, "sub_category") == [(None, 2, 2.0, 1.0, None), ("s", 2, 20.0, 10.0, "s"), ("t", 2, 80.0, 70.0, "t")]
    published = features.training_rows(prices, seasonal, items)
    assert published.filter("price_lag_1m = avg_unit_price_yen").count() > 0
    nothing = features.training_rows(prices.limit(0), seasonal, items, lags_first=True)
    assert nothing.count() == 0


def test_regression_models(spark):
    data = [(2000 + t // 12, t % 12 + 1, f"i{k}", "m", "o", "c", "s", "p", "q", float(t), float(k), 3.0 * t + 10 * k) for t in range(30) for k in range(4)]
    names = "year bigint, month bigint, item_name string, market string, origin string, major_category string, sub_category string, profile_category string, item_category string, f1 double, f2 double, avg_unit_price_yen double"
    df = spark.createDataFrame(data, names)
    split = features.chronological_split(df).persist()
    assert split.filter("is_train").count() == 96
    assert split.filter("is_train").agg(F.max("f1")).first()[0] <= split.filter("not is_train").agg(F.min("f1")).first()[0]
    assert features.chronological_split(df, limit=5).filter("is_train").exceptAll(split.filter("is_train")).count() == 0
    fitted = models.fit_all(split, models.pipelines(["f1", "f2"], trees=3, depth=3, rounds=2, boost_depth=2), ["f1", "f2", "avg_unit_price_yen"])
    measured = models.evaluate_all(split, fitted)
    assert models.best_model(measured).first()["model_name"] == "linear_regression"
    weights = models.importance(spark, fitted, ["f1", "f2"]).groupBy("model_name").agg(F.sum("importance")).collect()
    assert {r[0] for r in weights} == {"random_forest", "gradient_boosting"} and all(r[1] == pytest.approx(1.0) for r in weights)


def test_regression_rows_layout(spark):
    projected = spark.createDataFrame([("a", dt.date(2021, 1, 1), 100.0)], "item_name string, prediction_date date, predicted_price double")
    best = spark.createDataFrame([("random_forest", 10, 4.0, 2.0, 2.0, 0.5)], "model_name string, points bigint, mse double, mae double, rmse double, r2 double")
    row = batch.regression_rows(projected, best, 1500, "2020-12-01 00:00:00").first()
    assert (row["prediction_id"], row["model_type"], row["model_version"]) == ("a_random_forest_202101_ml", "RANDOM_FOREST", "2020.12_v15h_RF_ML")
    assert (row["lower_bound_price"], row["upper_bound_price"], row["confidence_interval"], row["last_actual_price"]) == (85.0, pytest.approx(115.0), 0.7, None)


def test_batch_covers_every_method():
    assert set(batch.MODELS.values()) <= set(V.MODEL_TYPES)


def test_autoregression_with_three_lags(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from marketlens.operators import forecast
    from marketlens.operators.series import Series

    y = np.random.default_rng(5).normal(size=200)
    for k in range(3, 200):
        y[k] += 1.0 + 0.5 * y[k - 1] - 0.3 * y[k - 2] + 0.2 * y[k - 3]
    x = np.column_stack([np.ones(197), y[2:-1], y[1:-2], y[:-3]])
    expected = np.linalg.lstsq(x, y[3:], rcond=None)[0]
    rows = [("a", k, len(y), 0, float(v)) for k, v in enumerate(y)]
    df = spark.createDataFrame(rows, "k string, pos bigint, n bigint, chunk bigint, y double").withColumn("y", F.col("y"))
    best = forecast.fit_autoregression(Series(df, ("k",), None), orders=[forecast.Order(3, 0)]).first()
    assert np.allclose(best["coef"], expected, atol=1e-8)


def test_interval_weights_follow_the_recursion():
    spread = lambda coef, lags, d: forecast._recur.func(
        pd.Series([[1.0] * 14]), pd.Series([coef]), pd.Series([lags]), pd.Series([d]), pd.Series([4])
    )["spread"][0]
    np.testing.assert_allclose(spread([0.0], [], 1), np.sqrt([1, 2, 3, 4]))
    np.testing.assert_allclose(spread([0.0], [], 2), np.sqrt(np.cumsum([1, 4, 9, 16])))
    np.testing.assert_allclose(spread([0.0, 0.5], [1], 0), np.sqrt(np.cumsum([1, 0.25, 0.0625, 0.015625])))
    np.testing.assert_allclose(spread([3.0], [], 0), np.ones(4))


def test_orders_are_compared_on_common_rows(spark):
    rng = np.random.default_rng(7)
    y = 1e6 + rng.normal(size=30)
    s = S.index_series(series(spark, y), ["item"], ["year", "month"], fits=True)
    one, two = forecast.Order(1, 0), forecast.Order(2, 1)
    both = forecast.fit_autoregression(s, orders=[one, two]).first()
    rss = lambda rows: float(np.linalg.lstsq(*rows, rcond=None)[1][0])
    # Rows with all lags that either order needs: from the fourth on.
    z = np.diff(y)
    first = rss((np.column_stack([np.ones(27), y[2:-1] - y.mean()]), y[3:]))
    second = rss((np.column_stack([np.ones(27), z[1:-1], z[:-2]]), z[2:]))
    aic = [27 * np.log(first / 27) + 2 * 3, 27 * np.log(second / 27) + 2 * 4]
    assert both["aic"] == pytest.approx(min(aic), rel=1e-6) and both["p"] == 1 + int(np.argmin(aic))


def test_backtest_scores_all_models_on_the_same_rows(spark):
    rng = np.random.default_rng(3)
    long, short = 100 + rng.normal(size=60).cumsum(), 50 + rng.normal(size=9)
    names = ("total_quantity_kg", "avg_temperature", "total_precipitation", "seasonal_price_index")
    df = series(spark, long).union(series(spark, short, "b")).withColumns({c: F.lit(1.0) for c in names})
    split = S.holdout(S.index_series(df, ["item"], ["year", "month"], fits=True))
    rows = batch.backtest_predictions(split)
    counts = {(r["item"], r["model_type"]): r["count"] for r in rows.groupBy("item", "model_type").count().collect()}
    # The short series has no window of the pooled model.
    assert counts == {("a", m): 12 for m in batch.MODELS.values()}
    assert features.available_features(df, names, limit=4) == list(names)
    with pytest.raises(ValueError):
        features.available_features(df, names, limit=3)


def test_registered_regressors_have_the_default_sizes(spark, monkeypatch):
    from marketlens import catalog

    seen = {}

    def fit_all(split, plans, columns):
        seen.update({name: plan.getStages()[-1] for name, plan in plans.items()})
        raise InterruptedError

    monkeypatch.setattr(catalog.models, "fit_all", fit_all)
    for name in ("train_regressors", "feature_importance", "best_model", "regression_batch"):
        seen.clear()
        with pytest.raises(InterruptedError):
            catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        forest, boost = seen["random_forest"], seen["gradient_boosting"]
        assert (forest.getNumTrees(), forest.getMaxDepth(), boost.getMaxIter(), boost.getMaxDepth()) == (100, 15, 100, 6)
        assert ("linear_regression" in seen) == (name != "feature_importance")


def test_every_order_from_one_matrix_of_lag_products(spark):
    """Coefficients, AIC and choice equal a fit per order and series; no row is repeated."""
    rng = np.random.default_rng(11)
    values = {"walk": 50 + rng.normal(size=80).cumsum(), "short": 9 + rng.normal(size=25)}
    season = 20 + 5 * np.sin(np.arange(90) * 2 * np.pi / 12) + 0.2 * rng.normal(size=90)
    values["season"] = season
    df = series(spark, values["walk"], "walk").union(series(spark, values["short"], "short")).union(series(spark, season, "season"))
    s = S.index_series(df, ["item"], ["year", "month"], fits=True)
    plan = forecast.fit_autoregression(s)
    assert "Generate" not in plan._jdf.queryExecution().executedPlan().toString()
    for row in plan.collect():
        y = values[row["item"]]
        long = len(y) > forecast.SEASONAL_MIN_ROWS
        orders = [o for o in forecast.ORDERS if long or not o.seasonal]
        first = max(k + o.d for o in orders for k in (0, *o.lags))
        fits = []
        for o in orders:
            z = np.diff(y - y.mean(), o.d)
            at = np.arange(first, len(y)) - o.d
            x = np.column_stack([np.ones(len(at)), *[z[at - k] for k in o.lags]])
            coef, rss, *_ = np.linalg.lstsq(x, z[at], rcond=None)
            fits.append((len(at) * np.log(rss[0] / len(at)) + 2 * (x.shape[1] + 1), o, coef))
        aic, order, coef = min(fits, key=lambda f: f[0])
        assert (row["p"], row["d"], row["seasonal"]) == (order.p, order.d, order.seasonal)
        assert row["aic"] == pytest.approx(aic, rel=1e-6)
        np.testing.assert_allclose(row["coef"][1:], coef[1:], atol=1e-6)


@pytest.mark.parametrize("method", ["linear", "boosted"])
def test_recursion_equals_scoring_step_by_step(spark, method):
    rng = np.random.default_rng(2)
    data = []
    for name in "abcde":
        y = 0.5 + 0.3 * np.sin(np.arange(60) / 3 + ord(name)) + 0.02 * rng.normal(size=60)
        data += [(name, yr, m, dt.date(yr, m, 1), float(v), float(v * v)) for (yr, m), v in zip(months(60), y)]
    df = spark.createDataFrame(data, "item string, year bigint, month bigint, ds date, y double, z double")
    s = S.index_series(df, ["item"], ["year", "month"], fits=True)
    pooled = forecast.fit_pooled(S.sequences(s, ["y", "z"], "y", 6), ["y", "z"], 6, method=method, rounds=8, depth=4)
    last = forecast.last_window(s, ["y", "z"], 6)
    got = {(r["item"], r["step"]): r["y_scaled_pred"] for r in forecast.recur_pooled(pooled, last, ["item"], 5).collect()}
    window = {r["item"]: [(w["y"], w["z"]) for w in r["window"]] for r in last.collect()}
    for step in range(1, 6):
        now = spark.createDataFrame(list(window.items()), "item string, window array<struct<y: double, z: double>>")
        for r in pooled.score(now).collect():
            assert got[r["item"], step] == pytest.approx(r["y_scaled_pred"], abs=1e-12)
            window[r["item"]] = [*window[r["item"]][1:], (r["y_scaled_pred"], window[r["item"]][-1][1])]
    assert len(got) == 25


def test_ensemble_of_single_leaves(spark):
    """Constant targets give trees without a split."""
    rows = spark.createDataFrame([("a", i // 12 + 2000, i % 12 + 1, dt.date(i // 12 + 2000, i % 12 + 1, 1), 3.0) for i in range(30)], "item string, year bigint, month bigint, ds date, y double")
    s = S.index_series(rows, ["item"], ["year", "month"], fits=True)
    pooled = forecast.fit_pooled(S.sequences(s, ["y"], "y", 4), ["y"], 4, method="boosted", rounds=3, depth=3)
    assert forecast.read_ensemble(pooled.model).depth == 0
    got = forecast.recur_pooled(pooled, forecast.last_window(s, ["y"], 4), ["item"], 3).collect()
    assert [r["y_scaled_pred"] for r in got] == [3.0] * 3
    with pytest.raises(ValueError):
        forecast.fit_pooled(S.sequences(s, ["y"], "y", 4), ["y"], 4, method="other")
