import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.operators import series as S

KEYS = ["item", "place"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    data = []
    for item, place, n in [("long", "p", 97), ("long", None, 30), ("short", "q", 2), ("one", "q", 1)]:
        for t in range(n):
            y = 100 + 3 * t + rng.random() * 20 + (900 if t == 40 else 0)
            gap = None if t % 5 in (1, 2) or t < 3 or (n == 97 and 70 < t < 92) else float(t * t % 17)
            data.append((item, place, t, y, gap))
    return spark.createDataFrame(data, "item string, place string, t bigint, y double, g double").repartition(4)


def whole(frame):
    return S.index_series(frame, KEYS, ["t"], fits=True)


def chunked(frame, size=14):
    out = S.index_series(frame, KEYS, ["t"], chunk_rows=size)
    assert out.chunk_rows == size
    return out


def same(a, b, columns):
    names = ["item", "place", "t", *columns]
    def collect(x):
        df = x.df if isinstance(x, S.Series) else x
        return sorted((tuple(r) for r in df.select(*names).collect()), key=lambda r: (r[0], r[1] or "", r[2]))

    left, right = collect(a), collect(b)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        assert x[:3] == y[:3]
        for u, v in zip(x[3:], y[3:]):
            assert (u is None) == (v is None) and (u is None or u == pytest.approx(v, rel=1e-12, abs=1e-9)), (x, y)
    return left


def pandas_groups(frame):
    pdf = frame.toPandas()
    pdf["place"] = pdf["place"].fillna("-")
    return {k: g.sort_values("t").reset_index(drop=True) for k, g in pdf.groupby(["item", "place"])}


def by_key(result):
    out = {}
    for row in result:
        out.setdefault((row[0], row[1] or "-"), []).append(row[3:])
    return out


def test_positions(frame):
    got = same(whole(frame), chunked(frame), ["pos", "n"])
    for rows in by_key(got).values():
        assert [r[0] for r in rows] == list(range(len(rows))) and {r[1] for r in rows} == {len(rows)}


def test_lags_and_moving(frame):
    def build(s):
        s = S.lag_columns(s, "y", {"l1": 1, "l12": 12})
        return S.moving_columns(s, "y", {"m3": 3, "m12": 12}, {"sd": 12})

    got = by_key(same(build(whole(frame)), build(chunked(frame)), ["l1", "l12", "m3", "sd"]))
    for key, g in pandas_groups(frame).items():
        want = pd.DataFrame({"l1": g.y.shift(1), "l12": g.y.shift(12), "m3": g.y.rolling(3, 1).mean(), "sd": g.y.rolling(12, 2).std()})
        np.testing.assert_allclose(np.array(got[key], dtype=float), want.to_numpy(dtype=float), rtol=1e-9)


def test_interpolation_and_fill(frame):
    build = lambda s: S.fill_gaps(S.interpolate_gaps(s, ["g"]), ["g"])
    got = by_key(same(build(whole(frame)), build(chunked(frame)), ["g"]))
    for key, g in pandas_groups(frame).items():
        want = g.g.interpolate(method="linear").ffill().bfill()
        np.testing.assert_allclose(np.array(got[key], dtype=float)[:, 0], want.to_numpy(dtype=float), rtol=1e-9)


def test_leading_gap_stays_after_interpolation(frame):
    got = S.interpolate_gaps(whole(frame), ["g"]).df.filter("item = 'long' and place = 'p' and t < 3")
    assert [r["g"] for r in got.collect()] == [None] * 3


def test_quantiles_match_numpy(frame):
    names = ["q1", "q2", "q3"]
    small = S.quantiles(whole(frame).df, KEYS, "y", (0.25, 0.5, 0.75), names, ["pos"], True)
    large = S.quantiles(chunked(frame).df, KEYS, "y", (0.25, 0.5, 0.75), names, ["pos"], False)
    for got in (small, large):
        values = {(r["item"], r["place"] or "-"): (r["q1"], r["q2"], r["q3"]) for r in got.collect()}
        for key, g in pandas_groups(frame).items():
            np.testing.assert_allclose(values[key], np.quantile(g.y, [0.25, 0.5, 0.75]))


def test_outlier_filter(frame):
    small = S.outlier_filter(whole(frame), ["t"])
    large = S.outlier_filter(chunked(frame), ["t"], fits=False)
    got = by_key(same(small, large, ["y", "n"]))
    for key, g in pandas_groups(frame).items():
        if len(g) >= 20:
            q1, q3 = g.y.quantile([0.25, 0.75])
            ma = g.y.rolling(7, 1).mean()
            bad = (g.y < q1 - 1.5 * (q3 - q1)) | (g.y > q3 + 1.5 * (q3 - q1)) | (((g.y - g.y.mean()) / g.y.std()).abs() > 4) | (((g.y - ma) / ma).abs() > 0.8)
            g = g[~bad]
            want = g.y.rolling(3, 1).mean() if len(g) > 14 else g.y
        else:
            want = g.y
        np.testing.assert_allclose([r[0] for r in got[key]], want.to_numpy(), rtol=1e-9)


def test_repair_smooth_shape_detrend(frame):
    def build(s, fits):
        s = S.shape_features(S.smooth_centred(S.outlier_repair(s, fits=fits)))
        return S.detrend(s)

    columns = ["y", "y_lag3", "y_ma3", "y_ma6", "y_pct_change", "trend", "y_detrended"]
    got = by_key(same(build(whole(frame), True), build(chunked(frame), False), columns))
    for key, g in pandas_groups(frame).items():
        y = g.y.copy()
        q1, q3 = y.quantile([0.25, 0.75])
        y[(y < q1 - 2.5 * (q3 - q1)) | (y > q3 + 2.5 * (q3 - q1))] = y.median()
        if len(y) > 6:
            y = y.rolling(3, center=True).mean().fillna(y)
        blank = pd.Series([np.nan] * len(y))
        want = [y, y.shift(3), y.rolling(3).mean() if len(y) > 6 else blank, y.rolling(6).mean() if len(y) > 6 else blank, y.pct_change()]
        if len(y) > 24:
            slope, base = np.polyfit(np.arange(len(y)), y, 1)
            line = pd.Series(slope * np.arange(len(y)) + base)
            want += [line, y - line]
        else:
            want += [blank, blank]
        np.testing.assert_allclose(np.array(got[key], dtype=float), np.column_stack(want), rtol=1e-7, atol=1e-7)


def test_sequences(frame):
    text = F.concat_ws(",", F.transform("window", lambda w: w["t"].cast("string")))
    build = lambda s: S.sequences(s, ["t"], "y", 12).withColumn("w", text)
    names = ["item", "place", "t", "w", "target"]
    a = sorted(map(tuple, build(whole(frame)).select(*names).fillna("-", ["place"]).collect()))
    b = sorted(map(tuple, build(chunked(frame)).select(*names).fillna("-", ["place"]).collect()))
    assert a == b and len(a) == (97 - 12) + (30 - 12)
    assert all(row[3] == ",".join(str(i) for i in range(row[2] - 12, row[2])) for row in a)


def test_holdout_naive_scale(frame):
    split = S.holdout(whole(frame))
    sizes = {(r["n"], r["train_n"], r["test_n"]) for r in split.df.select("n", "train_n", "test_n").distinct().collect()}
    assert sizes == {(97, 77, 20), (30, 24, 6)}
    naive = {(r["place"], r["t"]): r["y_naive"] for r in S.naive_baseline(split).collect()}
    y = {(r["place"], r["t"]): r["y"] for r in frame.filter("item = 'long'").collect()}
    assert naive == {(p, t): y[p, t - (20 if p else 6)] for (p, t) in naive}
    scaled = S.minmax_scale(split, ["y"]).df.filter("is_train").groupBy(*KEYS).agg(F.min("y_scaled"), F.max("y_scaled"))
    assert all(r[2:] == (0.0, 1.0) for r in map(tuple, scaled.collect()))


def test_naive_uses_last_value_when_training_is_short(spark):
    df = spark.createDataFrame([("a", t, float(t)) for t in range(10)], "item string, t bigint, y double")
    split = S.holdout(S.index_series(df, ["item"], ["t"], fits=True), test_share=0.5, min_test=3)
    split = split.with_df(split.df.withColumn("train_n", F.lit(3)).withColumn("test_n", F.lit(7)).withColumn("is_train", F.col("pos") < 3))
    assert {r["y_naive"] for r in S.naive_baseline(split).collect()} == {2.0}


def test_train_median(frame):
    split = S.holdout(whole(frame))
    filled = {(r["place"], r["t"]): r["g"] for r in S.fill_with_train_median(split, ["g"]).df.collect()}
    pdf = frame.filter("item = 'long' and place = 'p'").toPandas().sort_values("t")
    median = pdf[pdf.t < 77].g.median()
    assert all(filled["p", t] == (median if math.isnan(v) else v) for t, v in zip(pdf.t, pdf.g.astype(float)))
