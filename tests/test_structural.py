"""Trend, months, events and regressors against a plain ridge fit, and with planted effects."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.operators import structural
from marketlens.operators.forecast import Z80
from marketlens.operators.series import Series

SCHEMA = "k string, ds date, year long, month long, y double, avg_temperature double, total_precipitation double, yoy_price_growth_rate double"


def daily(key, seed, y, days=1100):
    """Daily rows; ``y`` makes the value from month number, month, event flags, temperature and noise."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(days):
        ds = dt.date(1996, 2, 3) + dt.timedelta(days=i)
        temperature, rain = float(rng.normal(15, 8)), float(rng.gamma(2, 30))
        t = (ds.year - 1990) * 12 + ds.month - 1
        golden = dt.date(ds.year, 4, 28) <= ds <= dt.date(ds.year, 5, 8)
        rows.append((key, ds, ds.year, ds.month, y(t, ds.month, golden, temperature, rng.normal()), temperature, rain, None))
    return rows


def planted(t, month, golden, temperature, noise):
    return 300 + 0.5 * t + 10 * (month % 3) + 25 * golden + 3 * temperature + 0.2 * noise


def effects(fit, key):
    row = fit.effects.filter(F.col("k") == key).first()
    return np.array(row["_coef"]), row["_sigma"]


@pytest.fixture(scope="module")
def rows(spark):
    made = daily("a", 1, planted) + daily("b", 2, lambda *x: 2 * planted(*x)) + daily("short", 3, planted, 40)
    return structural.with_events(spark.createDataFrame(made, SCHEMA)).cache()


def test_planted_event_and_temperature_are_found(rows):
    fit = structural.fit_structural(rows, ["k"])
    for key, times in (("a", 1), ("b", 2)):
        coef, sigma = effects(fit, key)
        assert coef[structural._FIRST_EVENT + 1] == pytest.approx(25 * times, rel=0.01)
        assert coef[structural._FIRST_REGRESSOR] == pytest.approx(3 * times, rel=0.01)
        assert coef[1] == pytest.approx(0.5 * times, rel=0.02)
        assert sigma == pytest.approx(0.2 * times, rel=0.1)


def test_equals_a_plain_ridge_fit(rows):
    fit = structural.fit_structural(rows, ["k"])
    for key in ("a", "short"):
        data = rows.filter(F.col("k") == key).toPandas()
        scaled = []
        for x in ((data.year - 1990) * 12 + data.month - 1, data.avg_temperature, data.total_precipitation, 0 * data.month):
            scaled.append((x - x.mean()) / (x.std(ddof=0) or 1))
        flags = [(data.month == m) * 1.0 for m in range(1, 13)] + [data[name] * 1.0 for name in structural.event_names()]
        design = np.column_stack([np.ones(len(data)), scaled[0], *flags, *scaled[1:]])
        penalty = np.diag([0.0, 0.0] + [structural.RIDGE] * (design.shape[1] - 2))
        want = design @ np.linalg.solve(design.T @ design + penalty, design.T @ data.y)
        got = fit.predict(rows.filter(F.col("k") == key)).toPandas().sort_values("ds")
        assert np.allclose(got.y_pred, want[np.argsort(data.ds.to_numpy(), kind="stable")], atol=1e-6)
        sigma = np.sqrt(((data.y - want) ** 2).sum() / (len(data) - 1))
        assert np.allclose(got.upper - got.y_pred, Z80 * sigma, rtol=1e-6)


def test_multiplicative_effects_are_factors(spark):
    made = daily("a", 4, lambda t, m, golden, temperature, noise: 200 * 1.002**t * (1.3 if golden else 1) * (1 + 0.05 * (m % 2)))
    made.append(("a", dt.date(1999, 7, 1), 1999, 7, -5.0, 1.0, 1.0, None))
    rows = structural.with_events(spark.createDataFrame(made, SCHEMA))
    coef, _ = effects(structural.fit_structural(rows, ["k"], mode="multiplicative"), "a")
    assert np.exp(coef[structural._FIRST_EVENT + 1]) == pytest.approx(1.3, rel=0.01)
    with pytest.raises(ValueError):
        structural.fit_structural(rows, ["k"], mode="other")


def test_flat_and_tiny_series(spark):
    made = [("one", dt.date(2000, 5, 1), 2000, 5, 7.0, None, None, None)]
    made += [("flat", dt.date(2000, m, 1), 2000, m, 50.0, 10.0, 5.0, 1.0) for m in range(1, 13)]
    made += [("none", dt.date(2000, 5, 1), 2000, 5, None, 1.0, 1.0, 1.0)]
    rows = structural.with_events(spark.createDataFrame(made, SCHEMA))
    got = {(r.k, r.month): r.y_pred for r in structural.fit_structural(rows, ["k"]).predict(rows).collect()}
    assert got["one", 5] == pytest.approx(7.0, abs=0.1)
    assert all(got["flat", m] == pytest.approx(50.0, abs=0.1) for m in range(1, 13))
    assert not any(k == "none" for k, _ in got)


def test_forecast_uses_month_weather_ahead(spark):
    """A value that follows temperature alone is forecast from the temperature of the month."""
    rng = np.random.default_rng(8)
    made = []
    for i in range(72):
        year, month = 1996 + i // 12, i % 12 + 1
        temperature = float(15 - 10 * np.cos(2 * np.pi * month / 12) + rng.normal())
        made.append(("a", dt.date(year, month, 1), year, month, 100 + 4 * temperature, temperature if i % 9 else None, 3.0, None))
    series = Series(spark.createDataFrame(made, SCHEMA).withColumns({"pos": F.lit(0), "n": F.lit(72)}), ("k",), None)
    got = structural.forecast_structural(series, 12).toPandas().sort_values("ds")
    want = [100 + 4 * (15 - 10 * np.cos(2 * np.pi * d.month / 12)) for d in got.ds]
    assert len(got) == 12 and np.abs(got.y_pred - want).max() < 8
    assert (got.lower < got.y_pred).all() and (got.upper > got.y_pred).all()
