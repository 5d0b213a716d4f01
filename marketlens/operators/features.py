"""Training rows and features for regression."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..session import cut_lineage
from . import ranking

SERIES = ("item_name", "market", "origin")
CATEGORIES = ("major_category", "sub_category")
# Order of the rows of one series: month first; the rest settles equal months.
ROW_ORDER = ("year", "month", "major_category", "sub_category", "profile_category", "item_category")
# Text columns that are encoded, and feature columns in order of preference.
TEXT_COLUMNS = (
    "item_name", "market", "origin", "price_tier", "vegetable_category", "item_seasonality", "seasonality_level",
)
FEATURES = (
    "year", "month",
    "price_lag_1m", "price_lag_3m", "price_lag_12m", "quantity_lag_1m",
    "yoy_price_growth_rate", "mom_price_growth_rate", "price_3month_moving_avg", "price_6month_moving_avg",
    "price_volatility",
    "avg_temperature", "avg_max_temperature", "avg_min_temperature", "total_precipitation", "avg_wind_speed",
    "total_sunshine", "temperature_deviation", "precipitation_deviation",
    "seasonal_price_index", "seasonal_quantity_index",
    "total_quantity_kg", "total_amount_yen",
    "item_name_encoded", "market_encoded", "origin_encoded", "price_tier_encoded", "vegetable_category_encoded",
    "item_seasonality_encoded", "seasonality_level_encoded",
    "item_avg_price", "price_trend",
    "quarter_1", "quarter_2", "quarter_3", "quarter_4",
)
TARGET = "avg_unit_price_yen"


def with_attributes(price_weather: DataFrame, seasonal: DataFrame, items: DataFrame, own: bool = False) -> DataFrame:
    """Prices with seasonal indexes of (item, month) and attributes of the item.

    Both side tables are also keyed by sub-category, so a price row is repeated once per
    sub-category of its item; the two extra columns tell the copies apart. With ``own``
    a price row meets those of its own sub-category only and stays one row.
    """
    profile = seasonal.select(
        "item_name", "month", "seasonal_price_index", "seasonal_quantity_index", "seasonality_level",
        F.col("sub_category").alias("profile_category"),
    )
    item = items.select(
        "item_name", "price_tier", "vegetable_category", F.col("seasonality").alias("item_seasonality"),
        F.col("avg_unit_price_yen").alias("item_avg_price"), F.col("sub_category").alias("item_category"),
    )
    profile, item = profile.withColumnRenamed("item_name", "_p"), item.withColumnRenamed("item_name", "_i")
    profile = profile.withColumnRenamed("month", "_m")
    same_profile = (F.col("item_name") == F.col("_p")) & (F.col("month") == F.col("_m"))
    same_item = F.col("item_name") == F.col("_i")
    if own:
        same_profile &= F.col("sub_category").eqNullSafe(F.col("profile_category"))
        same_item &= F.col("sub_category").eqNullSafe(F.col("item_category"))
    return price_weather.join(profile, same_profile, "left").join(item, same_item, "left").drop("_p", "_m", "_i")


def training_rows(
    price_weather: DataFrame,
    seasonal: DataFrame,
    items: DataFrame,
    low: float = 0.0,
    high: float = 5000.0,
    lags_first: bool = False,
) -> DataFrame:
    """Priced rows with lags 1, 3 and 12 of the price and lag 1 of the quantity; rows
    without a previous row are dropped.

    The published form repeats a price row per sub-category and lags afterwards, so most lags
    are another copy of the row itself. ``lags_first`` takes lags within item, market, origin and
    category, one row a month, before the attributes are joined: no lag holds the target.
    """
    price = F.col(TARGET)
    kept = (price > low) & (price < high) & (F.col("total_quantity_kg") > low)
    if lags_first:
        rows = price_weather.filter(kept)
        w = Window.partitionBy(*SERIES, *CATEGORIES).orderBy("year", "month")
    else:
        rows = with_attributes(price_weather, seasonal, items).filter(kept)
        w = Window.partitionBy(*SERIES).orderBy(*[F.col(c).asc_nulls_first() for c in ROW_ORDER])
    lagged = rows.withColumns(
        {
            "date_key": month_start(),
            "quarter": F.quarter(month_start()).cast("bigint"),
            "price_lag_1m": F.lag(price, 1).over(w),
            "price_lag_3m": F.lag(price, 3).over(w),
            "price_lag_12m": F.lag(price, 12).over(w),
            "quantity_lag_1m": F.lag("total_quantity_kg", 1).over(w),
        }
    ).filter(F.col("price_lag_1m").isNotNull())
    return with_attributes(lagged, seasonal, items, own=True) if lags_first else lagged


def fit_codes(df: DataFrame, columns: Sequence[str], missing: str = "None") -> DataFrame:
    """Code table ``name``, ``value``, ``code``: 0..k-1 per column in the sorted order of its
    values; NULL counts as a text.

    All columns are numbered in one pass over their distinct values; no list of values passes
    through the driver. Save the table with a model, so that later rows get the same codes.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(missing))
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("name"), text(c).alias("value")) for c in columns])).alias("p")
    ).select("p.*")
    numbered = ranking.row_number_over(cut_lineage(pairs.distinct()), "_rn", ["name"], [F.col("value")])
    return numbered.select("name", "value", (F.col("_rn") - 1).alias("code"))


def apply_codes(
    df: DataFrame, codes: DataFrame, columns: Sequence[str], missing: str = "None", unseen: int | None = -1
) -> DataFrame:
    """``<column>_encoded`` by a fitted code table; values that it lacks get ``unseen``."""
    for c in columns:
        own = codes.filter(F.col("name") == c).select(
            F.col("value").alias("_value"), F.col("code").alias("_code")
        )
        df = df.withColumn("_text", F.coalesce(F.col(c).cast("string"), F.lit(missing))).join(
            own, F.col("_text") == F.col("_value"), "left"
        )
        df = df.withColumn(f"{c}_encoded", F.coalesce("_code", F.lit(unseen))).drop("_text", "_value", "_code")
    return df


def encode_ordinal(df: DataFrame, columns: Sequence[str], missing: str = "None") -> DataFrame:
    """Codes fitted on and applied to the same rows."""
    return apply_codes(df, fit_codes(df, columns, missing), columns, missing)


def price_volatility(source: str = TARGET) -> Column:
    """Sample deviation of up to three rows of the series, 0 for one row."""
    w = Window.partitionBy(*SERIES).orderBy(*[F.col(c).asc_nulls_first() for c in ROW_ORDER]).rowsBetween(-2, 0)
    return F.coalesce(F.stddev_samp(source).over(w), F.lit(0.0))


def month_means(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Means of the calendar months, twelve rows at most."""
    return df.groupBy("month").agg(*[F.avg(c).alias(f"_m_{c}") for c in columns])


def deviation_from(df: DataFrame, means: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Difference from the mean of the calendar month, 0 where unknown."""
    # At most twelve rows.
    out = df.join(F.broadcast(means), "month", "left")
    shown = {name: F.coalesce(F.col(c) - F.col(f"_m_{c}"), F.lit(0.0)) for c, name in columns.items()}
    return out.withColumns(shown).drop(*[f"_m_{c}" for c in columns])


def month_deviation(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Difference from the mean of the calendar month of the same rows, 0 where unknown."""
    return deviation_from(df, month_means(df, columns), columns)


def trend_sign(growth: str = "mom_price_growth_rate", limit: float = 5.0) -> Column:
    g = F.coalesce(F.col(growth), F.lit(0.0))
    return F.when(g > limit, 1).when(g < -limit, -1).otherwise(0).cast("bigint")


def quarter_dummies(df: DataFrame, column: str = "quarter") -> DataFrame:
    return df.withColumns({f"{column}_{i}": (F.col(column) == i).cast("bigint") for i in range(1, 5)})


DEVIATIONS = {"avg_temperature": "temperature_deviation", "total_precipitation": "precipitation_deviation"}


@dataclass(frozen=True)
class FeatureState:
    """What features learn from the training rows: code tables and means of the calendar months."""

    codes: DataFrame
    means: DataFrame


def fit_features(rows: DataFrame) -> FeatureState:
    """Code tables of the text columns and month means. Save them with a model that is fitted on the features."""
    return FeatureState(fit_codes(rows, TEXT_COLUMNS), month_means(rows, DEVIATIONS))


def apply_features(rows: DataFrame, state: FeatureState) -> DataFrame:
    """All derived feature columns of ``rows``, by values learnt from other rows.

    Values without a code get -1; in a month without a mean the deviation is 0.
    """
    out = rows.withColumn("price_volatility", price_volatility())
    out = deviation_from(out, state.means, DEVIATIONS)
    out = quarter_dummies(out.withColumn("price_trend", trend_sign()))
    return apply_codes(out, state.codes, TEXT_COLUMNS)


def build_features(rows: DataFrame) -> DataFrame:
    """All derived feature columns, learnt from and applied to the same rows."""
    return apply_features(rows, fit_features(rows))


def available_features(df: DataFrame, wanted: Sequence[str] = FEATURES, limit: int = 50) -> list[str]:
    """The wanted columns that ``df`` has; more than ``limit`` are an error, none is left out in silence."""
    found = [c for c in wanted if c in df.columns]
    if len(found) > limit:
        raise ValueError(f"{len(found)} features, more than the limit of {limit}")
    return found


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def chronological_split(df: DataFrame, test_share: float = 0.2, limit: int = ranking.MAX_GROUP_ROWS) -> DataFrame:
    """Mark the first rows in time order as training rows, over all series together."""
    order = [F.col(c).asc_nulls_first() for c in ("year", "month", *SERIES, *ROW_ORDER[2:])]
    saved = cut_lineage(df)
    numbered = ranking.row_number_over(saved, "_rn", [], order, limit)
    cut = int(saved.count() * (1 - test_share))
    return numbered.withColumn("is_train", F.col("_rn") <= cut).drop("_rn")


def series_frame(price_weather: DataFrame, seasonal: DataFrame, item: str | None = None,
                 market: str | None = None, origin: str | None = None) -> DataFrame:
    """Price series with weather and seasonal indexes, for all items or for a choice."""
    rows = price_weather.filter(F.col(TARGET) > 0)
    for column, value in (("item_name", item), ("market", market), ("origin", origin)):
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    profile = seasonal.select(
        "item_name", "month", "seasonal_price_index", "seasonal_quantity_index",
        F.col("sub_category").alias("profile_category"),
    )
    return rows.join(profile, ["item_name", "month"], "left").select(
        month_start().alias("ds"), "year", "month", *SERIES, "major_category", "sub_category", "profile_category",
        F.col(TARGET).alias("y"), "total_quantity_kg", "total_amount_yen", "yoy_price_growth_rate",
        "mom_price_growth_rate", "price_3month_moving_avg", "avg_temperature", "total_precipitation",
        "avg_wind_speed", "seasonal_price_index", "seasonal_quantity_index",
    )


def merge(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns one frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
