"""Forecast errors per group, each in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.numeric import as_col, ratio
from ..functions.rules import below
from .series import Series

TINY = 1e-6
CLIP = 1e-8


def grade(mase) -> Column:
    """Grade by scaled error; an infinite error is the worst, a missing one has none."""
    x = as_col(mase)
    return F.when(x.isNotNull(), below(x, V.MASE_GRADE, "VERY_POOR"))




def metrics(df: DataFrame, keys: Sequence[str], y="y", pred="y_pred", naive="y_naive") -> DataFrame:
    """MAE, MSE, RMSE, MAPE, sMAPE, MASE and R2 against a naive forecast.

    Terms with a near-zero denominator are left out; a measure with no term at all is
    infinite, as is MASE for a perfect naive forecast; R2 of a constant series is -inf.
    """
    a, p, b = as_col(y), as_col(pred), as_col(naive)
    error = F.abs(a - p)
    middle = (F.abs(a) + F.abs(p)) / 2
    infinite = F.lit(float("inf"))
    sums = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"),
        F.avg(error).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.avg(F.when(F.abs(a) > TINY, error / F.abs(a))).alias("_ape"),
        F.avg(F.when(middle > TINY, error / middle)).alias("_sape"),
        F.avg(F.abs(a - b)).alias("_naive"),
        F.sum(error * error).alias("_res"),
        (F.var_pop(a) * F.count(a)).alias("_tot"),
    )
    return sums.select(
        *keys,
        "points",
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        F.coalesce(F.col("_ape") * 100, infinite).alias("mape"),
        F.coalesce(F.col("_sape") * 100, infinite).alias("smape"),
        F.when(F.col("_naive") > TINY, ratio("mae", "_naive")).otherwise(infinite).alias("mase"),
        F.when(F.col("_tot") > TINY, 1 - ratio("_res", "_tot")).otherwise(F.lit(float("-inf"))).alias("r2"),
    )


def metrics_by_steps(split: Series, y: str = "y", pred: str = "y_pred") -> DataFrame:
    """The same measures over the test rows of a split, with clipped denominators. MASE
    scales by the mean step between neighbouring test values, the last one left out."""
    keys = list(split.keys)
    a, p = as_col(y), as_col(pred)
    error = F.abs(a - p)
    inner = (F.col("pos") > F.col("train_n")) & (F.col("pos") < F.col("n") - 1)
    stepped = split.over(lambda w: {"_prev": F.lag(y, 1).over(w)}, before=1).df.filter(~F.col("is_train"))
    clip = F.lit(CLIP)
    sums = stepped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"),
        F.avg(error).alias("mae"),
        F.avg(error * error).alias("mse"),
        (F.avg(error / F.greatest(F.abs(a), clip)) * 100).alias("mape"),
        (F.avg(2 * error / F.greatest(F.abs(a) + F.abs(p), clip)) * 100).alias("smape"),
        F.avg(F.when(inner, F.abs(a - F.col("_prev")))).alias("_step"),
        F.sum(error * error).alias("_res"),
        (F.var_pop(a) * F.count(a)).alias("_tot"),
    )
    scale = F.greatest(F.coalesce(F.col("_step"), F.lit(1.0)), clip)
    return sums.select(
        *keys,
        "points",
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mape",
        "smape",
        F.when(F.col("points") > 1, F.col("mae") / scale).otherwise(F.lit(1.0)).alias("mase"),
        (1 - ratio("_res", "_tot")).alias("r2"),
    )


def regression_metrics(df: DataFrame, keys: Sequence[str], y="y", pred="y_pred") -> DataFrame:
    """MSE, MAE, RMSE and R2 of residuals."""
    a, p = as_col(y), as_col(pred)
    error = F.abs(a - p)
    sums = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("points"),
        F.avg(error * error).alias("mse"),
        F.avg(error).alias("mae"),
        F.sum(error * error).alias("_res"),
        (F.var_pop(a) * F.count(a)).alias("_tot"),
    )
    return sums.select(
        *keys, "points", "mse", "mae", F.sqrt("mse").alias("rmse"), (1 - ratio("_res", "_tot")).alias("r2")
    )
