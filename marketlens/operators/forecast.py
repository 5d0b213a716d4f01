"""Forecasts for all series at once.

Fits are sums over rows, so a long series is combined from many tasks. Only what is left
of a series (its moments, its last values) goes through small Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocabulary as V
from ..functions.numeric import ratio, round_to
from ..session import cut_lineage
from . import ranking
from .aggregates import month_climatology
from .series import Series, last_rows

Z80 = 1.2815515655446004
Z95 = 1.959963984540054


# -- future months --------------------------------------------------------------------


def future_months(df: DataFrame, keys: Sequence[str], months: int, date: str = "ds") -> DataFrame:
    """The ``months`` month starts after the last month of every key."""
    last = df.groupBy(*keys).agg(F.max(date).alias("last_ds"))
    first = F.add_months(F.trunc("last_ds", "MM"), 1)
    steps = F.posexplode(F.sequence(first, F.add_months(first, months - 1), F.expr("interval 1 month")))
    return last.select(*keys, "last_ds", steps.alias("step", "ds")).withColumns(
        {"step": (F.col("step") + 1).cast("bigint"), "month": F.month("ds").cast("bigint")}
    )


def future_regressors(df: DataFrame, keys: Sequence[str], months: int, climate: Sequence[str], level: Sequence[str]) -> DataFrame:
    """Future months with the mean of the calendar month for ``climate`` columns and the
    overall mean for ``level`` columns."""
    ahead = future_months(df, keys, months)
    by_month = month_climatology(df, keys, climate)
    overall = df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in level])
    out = ranking.join_groups(ahead, by_month, [*keys, "month"], "left")
    return ranking.join_groups(out, overall, keys, "left")


def event_days(years: DataFrame, year: str = "year") -> DataFrame:
    """Days covered by each yearly event, one row per event and day."""
    events = F.array(
        *[
            F.struct(
                F.lit(name).alias("event"), F.lit(m).alias("m"), F.lit(d).alias("d"),
                F.lit(before).alias("before"), F.lit(after).alias("after"),
            )
            for name, m, d, before, after in V.CALENDAR_EVENTS
        ]
    )
    dated = years.select(year, F.explode(events).alias("e")).withColumn(
        "day", F.make_date(F.col(year).cast("int"), F.col("e.m"), F.col("e.d"))
    )
    span = F.sequence(F.date_sub("day", F.col("e.before")), F.date_add("day", F.col("e.after")))
    return dated.select("e.event", F.explode(span).alias("ds"))


def event_flags(dates: DataFrame, date: str = "ds") -> DataFrame:
    """0/1 column per event for distinct dates. The event windows are spelled out as days,
    so this is an equality join."""
    years = dates.select(F.year(date).alias("y")).select(
        F.explode(F.array(F.col("y") - 1, F.col("y"), F.col("y") + 1)).alias("year")
    ).distinct()
    days = event_days(years).groupBy("ds").agg(
        *[
            F.max(F.when(F.col("event") == name, 1).otherwise(0)).cast("bigint").alias(f"event_{i}")
            for i, (name, *_) in enumerate(V.CALENDAR_EVENTS, 1)
        ]
    )
    joined = dates.join(days.withColumnRenamed("ds", "_ds"), F.col(date) == F.col("_ds"), "left").drop("_ds")
    return joined.fillna(0, subset=[f"event_{i}" for i in range(1, len(V.CALENDAR_EVENTS) + 1)])


# -- trend and season -----------------------------------------------------------------


def month_number(year: Column, month: Column) -> Column:
    """Months since January 1990."""
    return ((year - 1990) * 12 + month - 1).cast("double")


@dataclass(frozen=True)
class TrendSeason:
    """Fitted line and month effects per key."""

    lines: DataFrame
    effects: DataFrame
    keys: tuple[str, ...]
    mode: str

    def predict(self, rows: DataFrame) -> DataFrame:
        """Add ``y_pred``, ``lower`` and ``upper`` (80 %) to rows with ``year`` and ``month``."""
        out = ranking.join_groups(rows, self.lines, self.keys)
        out = ranking.join_groups(out, self.effects, [*self.keys, "month"], "left")
        t = month_number(F.col("year"), F.col("month"))
        line = F.col("_base") + F.col("_slope") * t
        if self.mode == "multiplicative":
            value = line * F.coalesce("_effect", F.lit(1.0))
        else:
            value = line + F.coalesce("_effect", F.lit(0.0))
        half = F.coalesce("_sd", F.lit(0.0)) * Z80
        return out.withColumns({"y_pred": value, "lower": value - half, "upper": value + half}).drop(
            "_base", "_slope", "_effect", "_sd"
        )


def fit_trend_season(rows: DataFrame, keys: Sequence[str], mode: str = "additive", y: str = "y") -> TrendSeason:
    """Least-squares line over time, mean residual (or ratio) per calendar month, and the
    deviation of what is left.

    All of it follows from number, mean and squares of each month, so the rows are read once and a key
    is reduced to its months before anything is joined.
    """
    if mode not in ("additive", "multiplicative"):
        raise ValueError(f"unknown mode {mode!r}")
    keys = tuple(keys)
    value = F.col(y).cast("double")
    cells = rows.filter(F.col(y).isNotNull()).groupBy(*keys, "year", "month").agg(
        F.count(F.lit(1)).cast("double").alias("_n"), F.avg(value).alias("_y"), F.var_pop(value).alias("_v")
    )
    cells = cut_lineage(cells.withColumn("_t", month_number(F.col("year"), F.col("month"))))
    n, t, mean = F.col("_n"), F.col("_t"), F.col("_y")
    sums = cells.groupBy(*keys).agg(
        F.sum(n).alias("_count"), (F.sum(n * t) / F.sum(n)).alias("_mt"), (F.sum(n * mean) / F.sum(n)).alias("_my"),
        F.sum(n * t * t).alias("_tt"), F.sum(n * t * mean).alias("_ty"), (F.max(t) > F.min(t)).alias("_moves"),
    )
    # With all rows in one month there is no slope; the level is then the mean.
    across = (F.col("_ty") - F.col("_count") * F.col("_mt") * F.col("_my")) / (F.col("_tt") - F.col("_count") * F.col("_mt") * F.col("_mt"))
    lines = sums.withColumn("_slope", F.when(F.col("_moves"), across).otherwise(0.0))
    lines = lines.select(*keys, "_slope", (F.col("_my") - F.col("_slope") * F.col("_mt")).alias("_base"))
    line = F.col("_base") + F.col("_slope") * t
    fitted = ranking.join_groups(cells, lines, keys).withColumn("_line", line)
    rest = ratio("_y", "_line") if mode == "multiplicative" else mean - F.col("_line")
    fitted = fitted.withColumn("_rest", rest)
    known = F.when(F.col("_rest").isNotNull(), n)
    effects = fitted.groupBy(*keys, "month").agg(F.try_divide(F.sum(known * F.col("_rest")), F.sum(known)).alias("_effect"))
    seen = ranking.join_groups(fitted, effects, [*keys, "month"])
    model = F.col("_line") * F.col("_effect") if mode == "multiplicative" else F.col("_line") + F.col("_effect")
    left = mean - model
    moments = seen.groupBy(*keys).agg(
        F.sum(n).alias("_count"), F.sum(n * left).alias("_sum"), F.sum(n * (F.col("_v") + left * left)).alias("_squares")
    )
    square = (F.col("_squares") - F.col("_sum") * F.col("_sum") / F.col("_count")) / (F.col("_count") - 1)
    spread = moments.select(*keys, F.when(F.col("_count") > 1, F.sqrt(F.greatest(square, F.lit(0.0)))).alias("_sd"))
    return TrendSeason(ranking.join_groups(lines, spread, keys), effects, keys, mode)


# -- projection -----------------------------------------------------------------------


def projection(latest: DataFrame, months: int, price: str = "avg_unit_price_yen", noise_seed: int | None = None) -> DataFrame:
    """Base price times a sine over the year times a rise of 2 % per step, with 15 % bounds.

    ``latest`` has one row per key with ``year`` and ``month``. Random noise of 5 % is off
    unless a seed is given.
    """
    start = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
    steps = latest.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(months - 1))))
    ahead = steps.withColumn("prediction_date", F.add_months(start, F.col("step") + 1))
    season = 1.0 + 0.1 * F.sin(F.lit(2 * np.pi) * F.month("prediction_date") / 12)
    value = F.col(price) * season * (1.0 + 0.02 * F.col("step"))
    if noise_seed is not None:
        value = value * (1.0 + 0.05 * F.randn(noise_seed))
    ahead = ahead.withColumn("_p", value)
    return ahead.withColumns(
        {
            "step": (F.col("step") + 1).cast("bigint"),
            "predicted_price": round_to("_p", 2),
            "lower_bound": round_to(F.greatest(F.lit(0.0), F.col("_p") * 0.85), 2),
            "upper_bound": round_to(F.col("_p") * 1.15, 2),
        }
    ).drop("_p")


# -- autoregression -------------------------------------------------------------------


@dataclass(frozen=True)
class Order:
    """Lags of the series differenced ``d`` times; ``seasonal`` adds lag 12."""

    p: int
    d: int
    seasonal: bool = False

    @property
    def lags(self) -> tuple[int, ...]:
        return tuple(range(1, self.p + 1)) + ((12,) if self.seasonal else ())

    @property
    def reach(self) -> int:
        return max((0, *self.lags)) + self.d


ORDERS = (
    Order(1, 1), Order(2, 1), Order(1, 0), Order(2, 0), Order(0, 1), Order(1, 2),
    Order(1, 1, True), Order(0, 1, True), Order(1, 0, True),
)
SEASONAL_MIN_ROWS = 36
_BINOMIAL = {0: (1,), 1: (1, -1), 2: (1, -2, 1)}
_TAIL = max(o.reach for o in ORDERS) + 1
_FIT = T.StructType(
    [
        T.StructField("p", T.IntegerType()),
        T.StructField("d", T.IntegerType()),
        T.StructField("seasonal", T.BooleanType()),
        T.StructField("lags", T.ArrayType(T.IntegerType())),
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("aic", T.DoubleType()),
        T.StructField("sigma", T.DoubleType()),
    ]
)

_STEPS = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("values", "spread")])


def _back(k: int) -> Column:
    return F.col(f"_y{k}")


def _reached(orders: Sequence[Order]) -> list[int]:
    """Rows back whose values the orders use."""
    return sorted({k + i for o in orders for k in (0, *o.lags) for i in range(o.d + 1)})


def _symmetric(flat: np.ndarray) -> np.ndarray:
    """Full matrices from the rows of their upper triangles."""
    size = int((np.sqrt(8 * flat.shape[1] + 1) - 1) / 2)
    out = np.zeros((len(flat), size, size))
    row, column = np.triu_indices(size)
    out[:, row, column] = out[:, column, row] = flat
    return out


def _design(order: Order, back: Sequence[int]) -> np.ndarray:
    """Constant, regressors and target of an order as sums of [1, values ``back`` rows back]."""
    out = np.zeros((2 + len(order.lags), 1 + len(back)))
    out[0, 0] = 1.0
    for i, lag in enumerate((*order.lags, 0), 1):
        for j, weight in enumerate(_BINOMIAL[order.d]):
            out[i, 1 + back.index(lag + j)] = weight
    return out


def _fit_order(gram: np.ndarray, design: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients, AIC (infinite: too few rows) and residual deviation of one order for all series."""
    square = design @ gram @ design.T
    n, k = square[:, 0, 0], len(design) - 1
    xx, xy, yy = square[:, :k, :k], square[:, :k, -1], square[:, -1, -1]
    coef = (np.linalg.pinv(xx, rcond=k * np.finfo(float).eps, hermitian=True) @ xy[:, :, None])[:, :, 0]
    rss = yy - 2 * (coef * xy).sum(1) + ((xx @ coef[:, :, None])[:, :, 0] * coef).sum(1)
    rss = np.maximum(rss, 1e-12 * np.maximum(yy, 1.0))
    enough = n > k + 1
    rows = np.where(enough, n, k + 2)
    aic = np.where(enough, rows * np.log(rss / rows) + 2 * (k + 1), np.inf)
    return coef, aic, np.sqrt(rss / (rows - k))


def _best_order(orders: Sequence[Order], back: Sequence[int]):
    designs = [_design(o, back) for o in orders]

    @F.pandas_udf(_FIT)
    def solve(moments: pd.Series, mean: pd.Series, long: pd.Series) -> pd.DataFrame:
        """The order of smallest AIC for every series. All orders read the series' one matrix of lag
        products, since differences and lags are sums of its columns."""
        gram = _symmetric(np.array(moments.tolist(), dtype=float))
        known = np.isfinite(gram).all(axis=(1, 2))
        gram[~known] = 0
        fits = [_fit_order(gram, design) for design in designs]
        aic = np.array([f[1] for f in fits])
        aic[np.array([o.seasonal for o in orders])[:, None] & ~long.to_numpy(bool)] = np.inf
        aic[:, ~known] = np.inf
        best = aic.argmin(axis=0)
        rows = []
        for i, (at, shift) in enumerate(zip(best, mean)):
            order = orders[at]
            if not np.isfinite(aic[at, i]):
                rows.append((None,) * 7)
                continue
            coef = fits[at][0][i].copy()
            # The constant for values that are not centred; differences have lost the mean anyway.
            coef[0] += shift * (1 - coef[1:].sum()) if order.d == 0 else 0.0
            rows.append((order.p, order.d, order.seasonal, list(order.lags), coef.tolist(), float(aic[at, i]), float(fits[at][2][i])))
        return pd.DataFrame(rows, columns=[f.name for f in _FIT.fields])

    return solve


def _level_weights(coef: Sequence[float], lags: Sequence[int], d: int) -> np.ndarray:
    """Weights of the values 1, 2, ... rows back, differences resolved."""
    poly = np.zeros(max([0, *lags]) + 1)
    poly[0] = 1.0
    poly[list(lags)] = -np.asarray(coef[1:], dtype=float)
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    return -poly[1:]


def _run(weights: np.ndarray, start: np.ndarray, constant: np.ndarray, steps: int) -> np.ndarray:
    """The next values of many recursions at once: a row each of weights, last values and constant."""
    reach = weights.shape[1]
    y = np.concatenate([start, np.zeros((len(start), steps))], axis=1)
    for t in range(start.shape[1], y.shape[1]):
        y[:, t] = constant + (weights * y[:, t - reach : t][:, ::-1]).sum(1)
    return y[:, start.shape[1] :]


@F.pandas_udf(_STEPS)
def _recur(tail: pd.Series, coef: pd.Series, lags: pd.Series, d: pd.Series, steps: pd.Series) -> pd.DataFrame:
    """Run the recursions of all series from their last values; and the standard error of every step in
    units of sigma, from the squared weights of an impulse."""
    size, most = len(tail), int(steps.max()) if len(steps) else 0
    weights, start = np.zeros((size, _TAIL)), np.zeros((size, _TAIL))
    constant = np.zeros(size)
    for i, (values, c, back, diff) in enumerate(zip(tail, coef, lags, d)):
        own = _level_weights(c, [int(k) for k in back], int(diff))
        weights[i, : len(own)], constant[i] = own, c[0]
        start[i, _TAIL - len(values) :] = values
    made = _run(weights, start, constant, most)
    impulse = np.zeros((size, _TAIL))
    impulse[:, -1] = 1.0
    psi = np.concatenate([np.ones((size, 1)), _run(weights, impulse, np.zeros(size), max(most - 1, 0))], axis=1)[:, :most]
    spread = np.sqrt(np.cumsum(psi**2, axis=1))
    cut = [int(k) for k in steps]
    return pd.DataFrame({"values": [m[:k].tolist() for m, k in zip(made, cut)], "spread": [m[:k].tolist() for m, k in zip(spread, cut)]})


def _all_known(back: Sequence[int]) -> Column:
    known = F.lit(True)
    for k in back:
        known = known & _back(k).isNotNull()
    return known


def fit_autoregression(series: Series, source: str = "y", orders: Sequence[Order] = ORDERS, fit_rows: str | None = None) -> DataFrame:
    """Best order per series by AIC, with coefficients, from one aggregation.

    ``fit_rows`` names a boolean column that limits the fit (for backtests). All orders that a series
    admits are fitted to the same rows, those where each of them has its lags, so that their AIC can be
    compared. Values are centred by the mean of the series before they are multiplied. A series keeps one
    matrix of products of its lags, however many orders are tried; no row is repeated.
    """
    keys = list(series.keys)
    need = _reached(orders)
    back = series.over(lambda w: {f"_y{k}": F.lag(source, k).over(w) for k in need}, before=max(need)).df
    rows = back if fit_rows is None else back.filter(F.col(fit_rows))
    points = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("points"), F.avg(_back(0)).alias("_mean"))
    rows = ranking.join_groups(rows, points, keys).withColumns({f"_y{k}": _back(k) - F.col("_mean") for k in need})
    long = F.col("points") > SEASONAL_MIN_ROWS
    rows = rows.filter(_all_known(_reached([o for o in orders if not o.seasonal])) & (~long | _all_known(need)))
    # Lags that only seasonal orders use are not known in short series, which do not try these.
    x = [F.lit(1.0), *[F.coalesce(_back(k), F.lit(0.0)) for k in need]]
    products = F.array(*[F.sum(x[m] * x[k]) for m in range(len(x)) for k in range(m, len(x))])
    grams = rows.groupBy(*keys).agg(products.alias("_moments"))
    known = ranking.join_groups(grams, points, keys)
    solved = known.withColumn("b", _best_order(orders, need)("_moments", "_mean", long)).filter(F.col("b.aic").isNotNull())
    return solved.select(*keys, "points", "b.*")


def _tails(df: DataFrame, keys: Sequence[str], source: str, end: Column) -> DataFrame:
    """The last values before position ``end`` of every series, in order."""
    near = df.filter((F.col("pos") < end) & (F.col("pos") >= end - _TAIL))
    ordered = F.sort_array(F.collect_list(F.struct("pos", F.col(source).alias("v"))))
    return near.groupBy(*keys).agg(F.transform(ordered, lambda s: s["v"]).alias("tail"))


def forecast_autoregression(series: Series, steps: int, source: str = "y") -> DataFrame:
    """Forecasts for the next ``steps`` rows with 95 % bounds that widen with the step."""
    keys = list(series.keys)
    model = fit_autoregression(series, source)
    tails = _tails(series.df, keys, source, F.col("n"))
    joined = ranking.join_groups(model, tails, keys)
    made = joined.withColumn("f", _recur("tail", "coef", "lags", "d", F.lit(steps)))
    out = made.select(*keys, "p", "d", "seasonal", "aic", "sigma", F.posexplode(F.arrays_zip("f.values", "f.spread")).alias("step", "_f"))
    out = out.select("*", F.col("_f.values").alias("y_pred"), F.col("_f.spread").alias("_spread")).drop("_f")
    step = F.col("step") + 1
    half = F.col("sigma") * Z95 * F.col("_spread")
    return out.withColumns(
        {"step": step.cast("bigint"), "lower": F.col("y_pred") - half, "upper": F.col("y_pred") + half}
    ).drop("_spread")


def backtest_autoregression(split: Series, source: str = "y") -> DataFrame:
    """Forecast the test rows of a split from its training rows: keys, ``pos``, ``y_pred``.

    The forecast of a series is made in one piece, so use it with series that the
    calendar bounds.
    """
    keys = list(split.keys)
    model = fit_autoregression(split, source, fit_rows="is_train")
    tails = _tails(split.df, keys, source, F.col("train_n"))
    sizes = split.df.groupBy(*keys).agg(F.max("train_n").alias("train_n"), F.max("test_n").alias("test_n"))
    joined = ranking.join_groups(ranking.join_groups(model, tails, keys), sizes, keys)
    made = joined.withColumn("f", _recur("tail", "coef", "lags", "d", "test_n"))
    out = made.select(*keys, "train_n", F.posexplode("f.values").alias("i", "y_pred"))
    return out.withColumn("pos", (F.col("train_n") + F.col("i")).cast("bigint")).drop("train_n", "i")


# -- pooled recursion -----------------------------------------------------------------


@dataclass(frozen=True)
class Ensemble:
    """A fitted tree ensemble as flat lists over its nodes; a leaf is its own child on both sides."""

    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]
    roots: tuple[int, ...]
    weights: tuple[float, ...]
    depth: int

    def predict(self, features: Column) -> Column:
        """The ensemble's value for an array column, as one expression: every step of the way down a
        tree is a lookup, so nothing grows with the trees but the looked-up lists."""
        whole = lambda values: F.lit(np.array(values, np.int32))
        real = lambda values: F.lit(np.array(values, np.float64))
        feature, threshold = whole(self.feature), real(self.threshold)
        left, right, value = whole(self.left), whole(self.right), real(self.value)

        def down(node: Column, _: Column) -> Column:
            smaller = F.get(features, F.get(feature, node)) <= F.get(threshold, node)
            return F.when(smaller, F.get(left, node)).otherwise(F.get(right, node))

        def leaf(root: Column) -> Column:
            return F.get(value, F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), root, down) if self.depth else root)

        parts = F.zip_with(whole(self.roots), real(self.weights), lambda root, weight: leaf(root) * weight)
        return F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)


_NODE = re.compile(r"^\s*(?:(If) \(feature (\d+) <= (\S+)\)|(Else)|Predict: (\S+)|Tree \d+ \(weight (\S+)\))")


def read_ensemble(model) -> Ensemble:
    """The nodes of a fitted model of regression trees, from its printed form."""
    feature, threshold, left, right, value, roots, weights = ([] for _ in range(7))
    path: list[int] = []  # inner nodes whose right side is not read yet
    for line in model.toDebugString.splitlines():
        found = _NODE.match(line)
        if not found:
            continue
        inner, name, limit, other, result, weight = found.groups()
        if weight:
            roots.append(len(value))
            weights.append(float(weight))
            path = []
            continue
        if other:
            continue
        node = len(value)
        if path:
            above = path[-1]
            if left[above] == above:
                left[above] = node
            else:
                right[above] = node
                path.pop()
        feature.append(int(name) if inner else 0)
        threshold.append(float(limit) if inner else float("inf"))
        value.append(0.0 if inner else float(result))
        left.append(node)
        right.append(node)
        if inner:
            path.append(node)

    def below(node: int) -> int:
        level, reached = [node], 0
        while level := [c for n in level if left[n] != n for c in (left[n], right[n])]:
            reached += 1
        return reached

    depth = max((below(root) for root in roots), default=0)
    return Ensemble(*map(tuple, (feature, threshold, left, right, value, roots, weights)), depth)


@dataclass(frozen=True)
class Pooled:
    """One regression over input windows of all series, with its feature list."""

    model: object
    features: tuple[str, ...]
    length: int

    def score(self, windows: DataFrame) -> DataFrame:
        return self.model.transform(windows.withColumn("_v", array_to_vector(_flat(self.features)))).drop("_v")

    def value(self, window: Column) -> Column:
        """The model's value for a flat window, as one expression."""
        if hasattr(self.model, "treeWeights"):
            return read_ensemble(self.model).predict(window)
        weights = F.lit(self.model.coefficients.toArray())
        products = F.zip_with(window, weights, lambda x, w: x * w)
        return F.aggregate(products, F.lit(float(self.model.intercept)), lambda total, x: total + x)


def _flat(features: Sequence[str]) -> Column:
    return F.flatten(F.transform("window", lambda s: F.array(*[s[c].cast("double") for c in features])))


def fit_pooled(
    windows: DataFrame, features: Sequence[str], length: int, regularisation: float = 0.01, method: str = "linear",
    rounds: int = 20, depth: int = 5, seed: int = 42,
) -> Pooled:
    """Fit on windows with ``window`` and ``target`` columns: a ``linear`` model or ``boosted`` trees."""
    vectors = windows.select(array_to_vector(_flat(features)).alias("_v"), F.col("target").cast("double").alias("target"))
    common = {"featuresCol": "_v", "labelCol": "target", "predictionCol": "y_scaled_pred"}
    if method == "linear":
        learner = LinearRegression(regParam=regularisation, **common)
    elif method == "boosted":
        learner = GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=seed, **common)
    else:
        raise ValueError(f"unknown method {method!r}")
    return Pooled(learner.fit(vectors.dropna()), tuple(features), length)


def recur_pooled(pooled: Pooled, last: DataFrame, keys: Sequence[str], steps: int) -> DataFrame:
    """Feed every prediction back as the newest row, all series at once.

    ``last`` has one row per series with ``window``, its last rows in order. The other
    features of a new row repeat the last ones. The steps are folded inside one
    expression, so the plan does not grow with them.
    """
    width = len(pooled.features)

    def advance(state: Column, _: Column) -> Column:
        window, made = state["w"], state["made"]
        size = F.size(window)
        newest = F.array(pooled.value(window))
        kept = F.slice(window, F.lit(width + 1), size - width)
        rest = F.slice(window, size - width + 2, F.lit(width - 1))
        return F.struct(F.concat(kept, newest, rest).alias("w"), F.concat(made, newest).alias("made"))

    start = F.struct(_flat(pooled.features).alias("w"), F.array().cast("array<double>").alias("made"))
    made = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, advance, lambda state: state["made"])
    return last.select(*keys, F.posexplode(made).alias("step", "y_scaled_pred")).withColumn(
        "step", (F.col("step") + 1).cast("bigint")
    )


def last_window(series: Series, features: Sequence[str], length: int) -> DataFrame:
    """The last ``length`` rows of every series as one ordered window."""
    rows = last_rows(series, length).filter(F.col("n") >= length)
    ordered = F.sort_array(F.collect_list(F.struct("pos", *features)))
    return rows.groupBy(*series.keys).agg(ordered.alias("window"))


# -- prediction rows ------------------------------------------------------------------


def model_version(as_of, points: Column, model: str, suffix: Column | None = None) -> Column:
    """``2001.12_v812r_LS_<suffix>``: month, size of the data, model, suffix."""
    size = (
        F.when(points < 1000, F.concat(F.lit("v"), points.cast("string"), F.lit("r")))
        .when(points < 100000, F.concat(F.lit("v"), F.floor(points / 100).cast("string"), F.lit("h")))
        .otherwise(F.concat(F.lit("v"), F.floor(points / 1000).cast("string"), F.lit("k")))
    )
    code = V.MODEL_CODES.get(model.lower(), model[:2].upper())
    parts = [F.lit(f"{str(as_of)[:4]}.{str(as_of)[5:7]}"), size, F.lit(code)]
    return F.concat_ws("_", *parts, *([suffix] if suffix is not None else []))


