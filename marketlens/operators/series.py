"""Ordered series: positions, lags, moving statistics, gap and outlier repair.

A series is a group of ``keys`` in a total order. ``index_series`` gives every row its
position ``pos`` and the length ``n``, and splits series that are longer than
``chunk_rows`` into chunks. A step that looks ``before`` or ``after`` rows gets these
rows from the neighbouring chunk, so a series that holds a third of all rows is worked
on by many tasks and the values equal those of one window over the whole series.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..session import cut_lineage
from . import ranking

CHUNK_ROWS = 500_000


@dataclass(frozen=True)
class Series:
    """Rows of many series with ``pos``, ``n`` and ``chunk`` columns."""

    df: DataFrame
    keys: tuple[str, ...]
    chunk_rows: int | None  # None: every series is one chunk

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, "chunk").orderBy("pos")

    @property
    def backward(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, "chunk").orderBy(F.desc("pos"))

    def with_df(self, df: DataFrame) -> "Series":
        return replace(self, df=df)

    def add(self, columns: Mapping[str, Column]) -> "Series":
        return self.with_df(self.df.withColumns(dict(columns)))

    def rows(self) -> DataFrame:
        return self.df.drop("pos", "n", "chunk")

    def over(
        self,
        build: Callable[[WindowSpec], Mapping[str, Column]],
        before: int = 0,
        after: int = 0,
    ) -> "Series":
        """Add window columns whose frames reach ``before`` rows back and ``after`` rows on."""
        if self.chunk_rows is None:
            return self.add(build(self.window))
        size = self.chunk_rows
        if max(before, after) > size:
            raise ValueError("a chunk must be at least as long as the frame")
        own = self.df.withColumn("_guest", F.lit(False))
        parts = [own]
        place = F.col("pos") % size
        if before:
            tail = own.filter(place >= size - before).filter(F.col("pos") < F.col("n") - 1)
            parts.append(tail.withColumn("chunk", F.col("chunk") + 1).withColumn("_guest", F.lit(True)))
        if after:
            head = own.filter((place < after) & (F.col("chunk") > 0))
            parts.append(head.withColumn("chunk", F.col("chunk") - 1).withColumn("_guest", F.lit(True)))
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        # The value of a guest row is not used, only its input columns are.
        out = merged.withColumns(dict(build(self.window)))
        return self.with_df(out.filter(~F.col("_guest")).drop("_guest"))


def index_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk_rows: int = CHUNK_ROWS,
    fits: bool | None = None,
) -> Series:
    """Number the rows of every series. ``df`` should be a saved table."""
    keys = tuple(keys)
    by = [F.col(c).asc_nulls_first() for c in order]
    if fits is None:
        fits = ranking.groups_fit(df, keys, chunk_rows)
    if fits:
        window = Window.partitionBy(*keys)
        out = df.withColumns(
            {
                "pos": (F.row_number().over(window.orderBy(*by)) - 1).cast("bigint"),
                "n": F.count(F.lit(1)).over(window).cast("bigint"),
                "chunk": F.lit(0).cast("bigint"),
            }
        )
        return Series(out, keys, None)
    numbered = ranking.row_number_over(df, "_rn", list(keys), by, fits=False)
    sizes = numbered.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    out = ranking.join_groups(numbered, sizes, keys).withColumns(
        {
            "pos": F.col("_rn") - 1,
            "chunk": F.floor((F.col("_rn") - 1) / chunk_rows).cast("bigint"),
        }
    )
    return Series(out.drop("_rn"), keys, chunk_rows)


# -- lags and moving statistics -------------------------------------------------------


def lag_columns(series: Series, source: str, offsets: Mapping[str, int]) -> Series:
    """Values ``k`` rows back (row offset, gaps in the calendar are not filled)."""
    return series.over(
        lambda w: {name: F.lag(source, k).over(w) for name, k in offsets.items()},
        before=max(offsets.values()),
    )


def moving_columns(series: Series, source: str, means: Mapping[str, int], stddevs: Mapping[str, int] = {}) -> Series:
    """Trailing means and sample deviations over up to ``k`` rows; short frames count."""

    def build(w: WindowSpec) -> dict[str, Column]:
        out = {name: F.avg(source).over(w.rowsBetween(1 - k, 0)) for name, k in means.items()}
        out |= {name: F.stddev_samp(source).over(w.rowsBetween(1 - k, 0)) for name, k in stddevs.items()}
        return out

    widest = max([*means.values(), *stddevs.values()])
    return series.over(build, before=widest - 1)


def full_mean(source: str, window: WindowSpec, low: int, high: int) -> Column:
    """Mean of a frame, NULL unless all its rows are there and not NULL."""
    frame = window.rowsBetween(low, high)
    return F.when(F.count(source).over(frame) == high - low + 1, F.avg(source).over(frame))


# -- gaps -----------------------------------------------------------------------------


def _edge_values(series: Series, columns: Sequence[str]) -> Series:
    """Add the nearest known (pos, value) at or before and at or after every row, for all ``columns``:
    ``_prev_<i>`` and ``_next_<i>``. One scan in each direction serves any number of columns."""
    count = range(len(columns))
    known = {f"_known_{i}": F.when(F.col(c).isNotNull(), F.struct("pos", F.col(c).alias("v"))) for i, c in enumerate(columns)}
    df = series.df.withColumns(known)
    # Looking ahead is done over the reversed order: a frame that grows by one row per row
    # costs one pass, one that shrinks would be summed up anew for every row.
    upto = lambda i, w: F.last(f"_known_{i}", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumns({f"_prev_{i}": upto(i, series.window) for i in count})
    df = df.withColumns({f"_next_{i}": upto(i, series.backward) for i in count})
    if series.chunk_rows is not None:
        # One row per chunk: what the chunks before and after it can hand over.
        keys = list(series.keys)
        ends = df.groupBy(*keys, "chunk").agg(
            *[F.max(f"_known_{i}").alias(f"_last_{i}") for i in count], *[F.min(f"_known_{i}").alias(f"_first_{i}") for i in count]
        )
        chunks = Window.partitionBy(*keys)
        before = lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        carry = ends.select(
            *keys,
            "chunk",
            *[before(f"_last_{i}", chunks.orderBy("chunk")).alias(f"_carry_prev_{i}") for i in count],
            *[before(f"_first_{i}", chunks.orderBy(F.desc("chunk"))).alias(f"_carry_next_{i}") for i in count],
        )
        df = ranking.join_groups(df, carry, [*keys, "chunk"])
        sides = [f"{side}_{i}" for side in ("prev", "next") for i in count]
        df = df.withColumns({f"_{x}": F.coalesce(f"_{x}", f"_carry_{x}") for x in sides}).drop(*[f"_carry_{x}" for x in sides])
    return series.with_df(df.drop(*known))


def _closed(series: Series, columns: Sequence[str], value: Callable[[str, int], Column]) -> Series:
    """Every column by ``value`` of its name and number, from its edges."""
    if not columns:
        return series
    edges = _edge_values(series, columns)
    df = edges.df.withColumns({c: value(c, i) for i, c in enumerate(columns)})
    return edges.with_df(df.drop(*[f"_{side}_{i}" for side in ("prev", "next") for i in range(len(columns))]))


def fill_gaps(series: Series, columns: Sequence[str]) -> Series:
    """Carry the last known value forward, then the first known one backward."""
    return _closed(series, columns, lambda c, i: F.coalesce(F.col(c), F.col(f"_prev_{i}.v"), F.col(f"_next_{i}.v")))


def _between(name: str, i: int) -> Column:
    before, after = F.col(f"_prev_{i}"), F.col(f"_next_{i}")
    share = (F.col("pos") - before["pos"]) / (after["pos"] - before["pos"])
    line = before["v"] + (after["v"] - before["v"]) * share
    return (
        F.when(F.col(name).isNotNull(), F.col(name))
        .when(before.isNotNull() & after.isNotNull(), line)
        .otherwise(before["v"])
    )


def interpolate_gaps(series: Series, columns: Sequence[str]) -> Series:
    """Linear by position between known neighbours; carried on after the last known value.

    Leading gaps stay, for ``fill_gaps`` to close.
    """
    return _closed(series, columns, _between)


def close_gaps(series: Series, columns: Sequence[str]) -> Series:
    """Interpolate, then carry what is known to the ends: both from one scan in each direction."""
    return _closed(series, columns, lambda c, i: F.coalesce(_between(c, i), F.col(f"_next_{i}.v")))


# -- order statistics -----------------------------------------------------------------


def quantiles(series_df: DataFrame, keys: Sequence[str], source: str, shares: Sequence[float], names: Sequence[str],
              tie_keys: Sequence[str], fits: bool) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key.

    Long groups are sorted by range over all tasks and the neighbours of each wanted
    position are picked out; short ones use the built-in aggregate.
    """
    known = series_df.filter(F.col(source).isNotNull())
    if fits:
        both = F.percentile(source, F.array(*[F.lit(s) for s in shares]))
        picked = known.groupBy(*keys).agg(both.alias("_q"))
        return picked.select(*keys, *[F.col("_q")[i].alias(name) for i, name in enumerate(names)])
    order = [F.col(source).asc(), *[F.col(k).asc_nulls_first() for k in tie_keys]]
    ranked = ranking.row_number_over(known, "_rn", list(keys), order, fits=False)
    sizes = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    joined = ranking.join_groups(ranked, sizes, keys)
    parts = []
    for i, share in enumerate(shares):
        target = (F.col("_m") - 1) * F.lit(share)
        low, high = F.floor(target), F.ceil(target)
        weight = target - low
        at = F.col("_rn") - 1
        term = F.when(at == low, F.col(source) * (1 - weight)).otherwise(0.0) + F.when(
            at == high, F.col(source) * weight
        ).otherwise(0.0)
        parts.append(F.sum(term).alias(names[i]))
    return joined.groupBy(*keys).agg(*parts)


# -- outliers -------------------------------------------------------------------------


def outlier_filter(
    series: Series,
    order: Sequence[str],
    source: str = "y",
    min_rows: int = 20,
    iqr_factor: float = 1.5,
    max_z: float = 4.0,
    max_deviation: float = 0.8,
    smooth_above: int = 14,
    fits: bool = True,
) -> Series:
    """Drop outliers of series with at least ``min_rows`` rows, then smooth the rest.

    A row goes when it lies outside the quartile fence, more than ``max_z`` deviations
    from the mean, or more than ``max_deviation`` from its 7-row mean. Series with more
    than ``smooth_above`` rows left get a trailing 3-row mean.
    """
    keys = list(series.keys)
    fence = quantiles(series.df, keys, source, (0.25, 0.75), ("_q1", "_q3"), ["pos"], fits)
    moments = series.df.groupBy(*keys).agg(F.avg(source).alias("_mean"), F.stddev_samp(source).alias("_sd"))
    marked = series.over(lambda w: {"_ma7": F.avg(source).over(w.rowsBetween(-6, 0))}, before=6)
    y = F.col(source)
    spread = (F.col("_q3") - F.col("_q1")) * iqr_factor
    outside = (y < F.col("_q1") - spread) | (y > F.col("_q3") + spread)
    far = F.abs(ratio(y - F.col("_mean"), "_sd")) > max_z
    off = F.abs(ratio(y - F.col("_ma7"), "_ma7")) > max_deviation
    drop = F.coalesce(outside, F.lit(False)) | F.coalesce(far, F.lit(False)) | F.coalesce(off, F.lit(False))
    judged = ranking.join_groups(ranking.join_groups(marked.df, fence, keys, "left"), moments, keys)
    kept = (
        judged.filter((F.col("n") < min_rows) | ~drop)
        .withColumn("_before", F.col("n"))
        .drop("_q1", "_q3", "_mean", "_sd", "_ma7", "pos", "n", "chunk")
    )
    if series.chunk_rows is not None:
        kept = cut_lineage(kept)
    again = index_series(kept, keys, order, series.chunk_rows or CHUNK_ROWS, fits=series.chunk_rows is None)
    smoothed = again.over(lambda w: {"_ma3": F.avg(source).over(w.rowsBetween(-2, 0))}, before=2)
    use = (F.col("_before") >= min_rows) & (F.col("n") > smooth_above)
    return smoothed.with_df(
        smoothed.df.withColumn(source, F.when(use, F.col("_ma3")).otherwise(F.col(source))).drop("_ma3", "_before")
    )


def outlier_repair(series: Series, source: str = "y", iqr_factor: float = 2.5, fits: bool = True) -> Series:
    """Replace values outside the quartile fence by the median of the series."""
    keys = list(series.keys)
    fence = quantiles(series.df, keys, source, (0.25, 0.5, 0.75), ("_q1", "_q2", "_q3"), ["pos"], fits)
    spread = (F.col("_q3") - F.col("_q1")) * iqr_factor
    y = F.col(source)
    bad = (y < F.col("_q1") - spread) | (y > F.col("_q3") + spread)
    df = ranking.join_groups(series.df, fence, keys, "left").withColumn(source, F.when(bad, F.col("_q2")).otherwise(y))
    return series.with_df(df.drop("_q1", "_q2", "_q3"))


# -- smoothing and features -----------------------------------------------------------


def smooth_centred(series: Series, source: str = "y", longer_than: int = 6) -> Series:
    """Centred 3-row mean; ends and short series keep their values."""
    out = series.over(lambda w: {"_mid": full_mean(source, w, -1, 1)}, before=1, after=1)
    value = F.when(F.col("n") > longer_than, F.coalesce(F.col("_mid"), F.col(source))).otherwise(F.col(source))
    return out.with_df(out.df.withColumn(source, value).drop("_mid"))


def shape_features(series: Series, source: str = "y") -> Series:
    """Lags 1 and 3, full trailing means of 3 and 6, relative change."""

    def build(w: WindowSpec) -> dict[str, Column]:
        long = F.col("n") > 6
        return {
            f"{source}_lag1": F.lag(source, 1).over(w),
            f"{source}_lag3": F.lag(source, 3).over(w),
            f"{source}_ma3": F.when(long, full_mean(source, w, -2, 0)),
            f"{source}_ma6": F.when(long, full_mean(source, w, -5, 0)),
        }

    out = series.over(build, before=5)
    change = ratio(source, f"{source}_lag1") - 1
    return out.add({f"{source}_pct_change": change})


def detrend(series: Series, source: str = "y", longer_than: int = 24) -> Series:
    """Least-squares line over the position, as ``trend`` and ``<source>_detrended``."""
    keys = list(series.keys)
    x = F.col("pos").cast("double")
    line = series.df.groupBy(*keys).agg(
        F.regr_slope(source, x).alias("_slope"), F.regr_intercept(source, x).alias("_base")
    )
    trend = F.when(F.col("n") > longer_than, F.col("_slope") * x + F.col("_base"))
    df = ranking.join_groups(series.df, line, keys).withColumn("trend", trend)
    df = df.withColumn(f"{source}_detrended", F.col(source) - F.col("trend"))
    return series.with_df(df.drop("_slope", "_base"))


def repair(series: Series, columns: Sequence[str], source: str = "y", fits: bool = True) -> Series:
    """A series ready for a model: outliers repaired, gaps of ``columns`` closed, smoothed, with lags, trailing
    means, change and trend, whose own gaps are filled from their neighbours at the end."""
    closed = close_gaps(outlier_repair(series, source, fits=fits), columns)
    shaped = detrend(shape_features(smooth_centred(closed, source), source), source)
    made = [f"{source}_{c}" for c in ("lag1", "lag3", "ma3", "ma6", "pct_change", "detrended")]
    return fill_gaps(shaped, [*made, "trend"])


def sequences(series: Series, features: Sequence[str], target: str, length: int) -> DataFrame:
    """Input windows of ``length`` rows with the value that follows; only full windows."""

    def build(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-length, -1)
        return {"window": F.collect_list(F.struct(*features)).over(frame)}

    out = series.over(build, before=length)
    return out.df.filter(F.col("pos") >= length).withColumn("target", F.col(target)).drop("chunk")


def last_rows(series: Series, count: int) -> DataFrame:
    return series.df.filter(F.col("pos") >= F.col("n") - count)


def holdout(series: Series, test_share: float = 0.2, min_total: int = 10, min_train: int = 5, min_test: int = 3) -> Series:
    """Mark the first ``1 - test_share`` of every series as training rows.

    Series too short to judge are dropped. ``train_n`` and ``test_n`` are added.
    """
    cut = F.floor(F.col("n") * F.lit(1 - test_share)).cast("bigint")
    df = series.df.withColumn("train_n", cut).withColumn("test_n", F.col("n") - cut)
    df = df.filter((F.col("n") >= min_total) & (F.col("train_n") >= min_train) & (F.col("test_n") >= min_test))
    return series.with_df(df.withColumn("is_train", F.col("pos") < F.col("train_n")))


def naive_baseline(split: Series, source: str = "y") -> DataFrame:
    """Test rows with the naive forecast: the last ``test_n`` training values in order,
    or the last training value where the training part is shorter than that."""
    keys = list(split.keys)
    train = split.df.filter("is_train")
    shifted = train.select(
        *keys,
        (F.col("pos") + F.col("test_n")).alias("pos"),
        F.col(source).alias("_shifted"),
    )
    last = train.filter(F.col("pos") == F.col("train_n") - 1).select(*keys, F.col(source).alias("_last"))
    naive = F.when(F.col("train_n") >= F.col("test_n"), F.col("_shifted")).otherwise(F.col("_last"))
    test = split.df.filter(~F.col("is_train"))
    test = ranking.join_groups(test, shifted, [*keys, "pos"], "left")
    test = ranking.join_groups(test, last, keys, "left")
    return test.withColumn("y_naive", naive).drop("_shifted", "_last")


def minmax_scale(split: Series, columns: Sequence[str]) -> Series:
    """Scale to [0, 1] with the range of the training rows; constant columns give 0."""
    keys = list(split.keys)
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}")]
    ranges = split.df.filter("is_train").groupBy(*keys).agg(*aggs)
    df = ranking.join_groups(split.df, ranges, keys, "left")
    for c in columns:
        width = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        width = F.when(width == 0, F.lit(1.0)).otherwise(width)
        df = df.withColumn(f"{c}_scaled", (F.col(c) - F.col(f"_lo_{c}")) / width)
    return split.with_df(df.drop(*[f"_lo_{c}" for c in columns], *[f"_hi_{c}" for c in columns]))


def fill_with_train_median(split: Series, columns: Sequence[str], fits: bool = True) -> Series:
    """Missing regressor values become the median of the training rows."""
    keys = list(split.keys)
    df = split.df
    for c in columns:
        med = quantiles(split.df.filter("is_train"), keys, c, (0.5,), ("_median",), ["pos"], fits)
        df = ranking.join_groups(df, med, keys, "left").withColumn(c, F.coalesce(F.col(c), F.col("_median"))).drop("_median")
    return split.with_df(df)
