"""Null-safe arithmetic. All helpers return NULL where the result is undefined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A mean of cents that lies on x.xx5 may come out a few ulps below it, depending on the
# order in which partitions were added. The slack makes such ties round up in any order.
TIE_SLACK = 1e-6


def as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_to(value, places: int) -> Column:
    """Round half away from zero, independent of summation order.

    Infinities, NaN and values so large that a double holds no such digits stay as they are.
    """
    x = as_col(value)
    scale = float(10**places)
    up = F.lit(0.5 + TIE_SLACK)
    # NaN compares as greater than any number.
    return F.when(F.abs(x) >= float(2**52) / scale, x.cast("double")).when(x >= 0, F.floor(x * scale + up) / F.lit(scale)).otherwise(
        F.lit(0.0) - F.floor(up - x * scale) / F.lit(scale)
    )


def ratio(a, b) -> Column:
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def pct_change(now, before, places: int | None = 2) -> Column:
    change = ratio(as_col(now) - as_col(before), before) * 100
    return change if places is None else round_to(change, places)


def zscore(value, mean, stddev, places: int = 2) -> Column:
    return round_to(ratio(as_col(value) - as_col(mean), stddev), places)


def clamp(value, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    x = as_col(value)
    return F.when(x < low, F.lit(low)).when(x > high, F.lit(high)).otherwise(x)


def to_int(value, kind: T.DataType | None = None) -> Column:
    """Text or number to bigint, rounding halves away from zero; bad input gives NULL.

    ``kind`` is the stored type where it is known: whole numbers need no rounding, and text is
    read digit by digit, so text that is not a whole number gives NULL.
    """
    if isinstance(kind, T.StringType):
        return as_col(value).try_cast("bigint")
    if isinstance(kind, T.IntegralType):
        return as_col(value).cast("bigint")
    x = as_col(value).try_cast("double")
    return F.when(x >= 0, F.floor(x + 0.5)).otherwise(-F.floor(0.5 - x))


def to_number(value, default: float | None = None) -> Column:
    x = as_col(value).try_cast("double")
    return x if default is None else F.coalesce(x, F.lit(default))


def unit_price(amount="amount_yen", quantity="quantity_kg") -> Column:
    return ratio(amount, quantity)
