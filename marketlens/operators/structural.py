"""Forecasts from trend, calendar month, yearly events and regressors, for all series at once.

Every row has the same few features: a constant, the month number, one of twelve months, event flags and
regressors. A series is reduced to one Gram matrix of these in one aggregation: rows of one month and
one set of events share their 0/1 features, so per series there is a handful of cells, each with the
moments of the remaining columns. All series of a batch are then solved together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocabulary as V
from . import forecast, ranking
from .series import Series, fill_with_train_median

MONTHS = 12
EVENTS = len(V.CALENDAR_EVENTS)
REGRESSORS = ("avg_temperature", "total_precipitation", "yoy_price_growth_rate")
#: Penalty on month, event and regressor effects, as a count of rows. Regressors are scaled to deviation 1.
RIDGE = 0.01
_FIRST_EVENT = 2 + MONTHS
_FIRST_REGRESSOR = _FIRST_EVENT + EVENTS
_FLAT = 1e-9
_FIT = T.StructType([T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType())])


def event_names() -> list[str]:
    return [f"event_{i}" for i in range(1, EVENTS + 1)]


def with_events(rows: DataFrame, date: str = "ds") -> DataFrame:
    """Add the 0/1 event columns. The joined table has one row per calendar day."""
    days = forecast.event_flags(rows.select(F.col(date).alias("_day")).distinct(), "_day")
    return rows.join(days, F.col(date) == F.col("_day")).drop("_day")


def _gram(cells: pd.Series, regressors: int, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrices of all features and the target, one per series, and the series' indexes of cells."""
    dense = 3 + regressors
    owner = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    flat = [c for some in cells for c in some]
    month = np.array([c["month"] for c in flat], np.int64)
    bits = np.array([c["events"] for c in flat], np.int64)
    upper = np.array([c["moments"] for c in flat], np.float64).reshape(len(flat), -1)
    moments = np.zeros((len(flat), dense, dense))
    row, column = np.triu_indices(dense)
    moments[:, row, column] = moments[:, column, row] = upper
    size = _FIRST_REGRESSOR + regressors + 1
    place = np.array([0, 1, *range(_FIRST_REGRESSOR, size)])
    gram = np.zeros((len(cells), size, size))
    np.add.at(gram, (owner[:, None, None], place[:, None], place[None, :]), moments)
    flags = np.zeros((len(flat), size))
    flags[np.arange(len(flat)), 1 + month] = 1
    for e in range(EVENTS):
        flags[:, _FIRST_EVENT + e] = (bits >> e) & 1
    own = np.arange(2, _FIRST_REGRESSOR)
    count = moments[:, 0, 0]
    np.add.at(gram, (owner[:, None, None], own[:, None], own[None, :]), count[:, None, None] * flags[:, own, None] * flags[:, None, own])
    mixed = flags[:, own, None] * moments[:, :1, :]
    np.add.at(gram, (owner[:, None, None], own[:, None], place[None, :]), mixed)
    np.add.at(gram, (owner[:, None, None], place[:, None], own[None, :]), mixed.transpose(0, 2, 1))
    return gram, np.full(len(cells), ridge)


def _solver(regressors: int, ridge: float):
    @F.pandas_udf(_FIT)
    def solve(cells: pd.Series) -> pd.DataFrame:
        gram, _ = _gram(cells, regressors, ridge)
        size = gram.shape[1] - 1
        count = gram[:, 0, 0]
        # The month number and the regressors are centred and scaled, which is linear in the features.
        scaled = np.array([1, *range(_FIRST_REGRESSOR, size)])
        mean = gram[:, 0, scaled] / count[:, None]
        spread = np.sqrt(np.maximum(gram[:, scaled, scaled] / count[:, None] - mean**2, 0))
        spread = np.where(spread > _FLAT * np.maximum(1, np.abs(mean)), spread, np.inf)
        turn = np.tile(np.eye(size), (len(gram), 1, 1))
        turn[:, scaled, scaled] = 1 / spread
        turn[:, scaled, 0] = -mean / spread
        square = turn @ gram[:, :size, :size] @ turn.transpose(0, 2, 1)
        target = (turn @ gram[:, :size, size, None])[:, :, 0]
        penalised = square.copy()
        diagonal = np.arange(size)
        penalised[:, diagonal[2:], diagonal[2:]] += ridge
        # A column without any spread gets the effect zero.
        penalised[:, diagonal, diagonal] += penalised[:, diagonal, diagonal] == 0
        effect = np.linalg.solve(penalised, target[:, :, None])[:, :, 0]
        rest = gram[:, size, size] - 2 * (effect * target).sum(1) + ((square @ effect[:, :, None])[:, :, 0] * effect).sum(1)
        sigma = np.sqrt(np.maximum(rest, 0) / np.maximum(count - 1, 1))
        coef = (turn.transpose(0, 2, 1) @ effect[:, :, None])[:, :, 0]
        return pd.DataFrame({"coef": coef.tolist(), "sigma": sigma})

    return solve


@dataclass(frozen=True)
class Structural:
    """Fitted effects per key: ``coef`` in the order constant, slope, months, events, regressors."""

    effects: DataFrame
    keys: tuple[str, ...]
    regressors: tuple[str, ...]
    mode: str

    def predict(self, rows: DataFrame) -> DataFrame:
        """Add ``y_pred``, ``lower`` and ``upper`` (80 %) to rows with ``year``, ``month``, events and regressors.
        A regressor that is not known counts as having no effect beyond the mean row's."""
        out = ranking.join_groups(rows, self.effects, self.keys)
        at = lambda i: F.get("_coef", i if isinstance(i, Column) else F.lit(i))
        value = at(0) + at(1) * forecast.month_number(F.col("year"), F.col("month")) + at((F.col("month") + 1).cast("int"))
        for i, name in enumerate(event_names()):
            value = value + at(_FIRST_EVENT + i) * F.col(name)
        for i, name in enumerate(self.regressors):
            value = value + at(_FIRST_REGRESSOR + i) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        half = F.col("_sigma") * forecast.Z80
        shown = {"y_pred": value, "lower": value - half, "upper": value + half}
        if self.mode == "multiplicative":
            shown = {name: F.exp(v) for name, v in shown.items()}
        return out.withColumns(shown).drop("_coef", "_sigma")


def fit_structural(
    rows: DataFrame, keys: Sequence[str], regressors: Sequence[str] = REGRESSORS, mode: str = "additive", y: str = "y", ridge: float = RIDGE
) -> Structural:
    """Effects of trend, month, events and regressors per key.

    ``rows`` have ``year``, ``month`` and the event columns. With ``multiplicative`` the effects are factors:
    the fit is that of the logarithm, and rows without a positive value take no part. A regressor that a
    series does not know at all gets no effect; close other gaps first.
    """
    if mode not in ("additive", "multiplicative"):
        raise ValueError(f"unknown mode {mode!r}")
    value = F.col(y).cast("double")
    used = rows.filter(F.col(y) > 0) if mode == "multiplicative" else rows.filter(F.col(y).isNotNull())
    target = F.ln(value) if mode == "multiplicative" else value
    known = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in regressors]
    x = [F.lit(1.0), forecast.month_number(F.col("year"), F.col("month")), *known, target]
    events = sum((F.col(name).cast("int") * (1 << i) for i, name in enumerate(event_names())), F.lit(0))
    slim = used.select(*keys, F.col("month").cast("int").alias("month"), events.alias("events"), F.array(*x).alias("x"))
    pair = lambda i, j: F.sum(F.get("x", F.lit(i)) * F.get("x", F.lit(j)))
    moments = F.array(*[pair(i, j) for i in range(len(x)) for j in range(i, len(x))])
    cells = slim.groupBy(*keys, "month", "events").agg(moments.alias("moments"))
    # At most twelve months times the sets of events that a month has.
    grams = cells.groupBy(*keys).agg(F.collect_list(F.struct("month", "events", "moments")).alias("cells"))
    solved = grams.withColumn("_f", _solver(len(regressors), ridge)("cells"))
    return Structural(solved.select(*keys, F.col("_f.coef").alias("_coef"), F.col("_f.sigma").alias("_sigma")), tuple(keys), tuple(regressors), mode)


def forecast_structural(series: Series, months: int, regressors: Sequence[str] = REGRESSORS, mode: str = "additive", fits: bool = True) -> DataFrame:
    """Values and 80 % bounds of the next months of every series.

    Gaps of a regressor become its median; ahead, temperature and rain are those of the calendar month,
    growth is the mean of the series, and what no month of the past tells is the median as well.
    """
    keys = list(series.keys)
    whole = series.with_df(series.df.withColumn("is_train", F.lit(True)))
    filled = fill_with_train_median(whole, regressors, fits).df
    fit = fit_structural(with_events(filled), keys, regressors, mode)
    climate = [c for c in regressors if c != "yoy_price_growth_rate"]
    level = [c for c in regressors if c == "yoy_price_growth_rate"]
    ahead = forecast.future_regressors(series.df, keys, months, climate, level)
    middle = filled.groupBy(*keys).agg(*[F.percentile(c, 0.5).alias(f"_m_{c}") for c in regressors]) if regressors else None
    if middle is not None:
        ahead = ranking.join_groups(ahead, middle, keys, "left")
        ahead = ahead.withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in regressors})
    dated = with_events(ahead.withColumn("year", F.year("ds").cast("bigint")))
    return fit.predict(dated).select(*keys, "ds", "y_pred", "lower", "upper")
