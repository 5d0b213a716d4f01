"""Latest rows, ranks and row numbers that stay spread over many tasks.

Ranks by a value are counted: a group's counts per value and their running sums tell how
many rows are in front. Other row numbers use a window while a group is small, which is
measured; beyond the limit the rows are sorted by range over all tasks and numbered from
per-partition offsets, which gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

MAX_GROUP_ROWS = 2_000_000
_LOCAL_BITS = 33


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """One row per key: the one with the greatest ``newest`` (NULL counts as smallest).

    An aggregate instead of a window: copies of one key are combined before the shuffle,
    so a key with very many copies does not fill one task.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(*newest)).alias("_row")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the one with the smallest ``order``."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def groups_fit(df: DataFrame, keys: Sequence[str], limit: int = MAX_GROUP_ROWS) -> bool:
    """True when no group of ``keys`` (or the whole frame, if none) exceeds ``limit`` rows.

    Only one number reaches the driver. Call it on a saved table, not on a long plan.
    """
    if not keys:
        return df.limit(limit + 1).count() <= limit
    top = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return (top or 0) <= limit


def global_index(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Dense 0-based position in a total order, without a single-task window.

    ``order`` must be unique per row. Rows are range-partitioned and sorted; the sorted
    partitions are saved with their ids, so the counts and the positions come from one result.
    The offsets have one row per shuffle partition, hence the broadcast.
    """
    # Row number inside a sorted partition: the low bits of the built-in id.
    tagged = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    tagged = tagged.withColumn("_part", F.shiftright("_id", _LOCAL_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + local)
        .drop("_part", "_id", "_offset")
    )


def join_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-group values back to the rows; a NULL key matches a NULL key."""
    renamed = groups.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(renamed, condition, how).drop(*[f"_k_{k}" for k in keys])


def _first_index(indexed: DataFrame, keys: Sequence[str], index: str, name: str) -> DataFrame:
    return join_groups(indexed, indexed.groupBy(*keys).agg(F.min(index).alias(name)), keys)


def row_number_over(
    df: DataFrame,
    name: str,
    partition: Sequence[str],
    order: Sequence[Column],
    limit: int = MAX_GROUP_ROWS,
    fits: bool | None = None,
) -> DataFrame:
    """``ROW_NUMBER``; ``order`` must break all ties."""
    if fits is None:
        fits = groups_fit(df, partition, limit)
    if fits:
        window = Window.partitionBy(*partition).orderBy(*order) if partition else Window.orderBy(*order)
        return df.withColumn(name, F.row_number().over(window).cast("bigint"))
    keys = [F.col(k).asc() for k in partition]
    indexed = global_index(df, [*keys, *order], "_idx")
    if not partition:
        return indexed.withColumn(name, F.col("_idx") + 1).drop("_idx")
    return (
        _first_index(indexed, partition, "_idx", "_first")
        .withColumn(name, F.col("_idx") - F.col("_first") + 1)
        .drop("_idx", "_first")
    )


def _before(source: DataFrame, partition: Sequence[str], order: Sequence[Column], value: Sequence[str]) -> DataFrame:
    """Rows of a group in front of each distinct ``value``, from the group's counts per value."""
    counts = source.groupBy(*partition, *value).agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_rows").over(ahead), F.lit(0))).drop("_rows")


def number_by_value(
    df: DataFrame, name: str, partition: Sequence[str], value: Mapping[str, Column], ties: Sequence[Column], source: DataFrame | None = None
) -> DataFrame:
    """``ROW_NUMBER`` by the leading columns ``value`` (column: its order), then ``ties``, which must settle the rest.

    Rows in front of a value are a running sum over counts per value, so only the distinct values of a
    group are ordered together, two numbers each; rows are ordered among those of equal value. ``source`` is
    a saved table with the same rows, if counting ``df`` would make it twice.
    """
    keys = [*partition, *value]
    before = _before(df if source is None else source, partition, list(value.values()), list(value))
    own = Window.partitionBy(*keys).orderBy(*ties)
    out = join_groups(df, before, keys)
    return out.withColumn(name, (F.col("_before") + F.row_number().over(own)).cast("bigint")).drop("_before")


def rank_over(df: DataFrame, name: str, partition: Sequence[str], value: str, descending: bool, source: DataFrame | None = None) -> DataFrame:
    """``RANK`` by one value, with gaps: one more than the rows with a value in front. NULL counts as the smallest."""
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    out = join_groups(df, _before(df if source is None else source, partition, [order], [value]), [*partition, value])
    return out.withColumn(name, (F.col("_before") + 1).cast("bigint")).drop("_before")


def dense_key(df: DataFrame, name: str, order: Sequence[str], limit: int = MAX_GROUP_ROWS) -> DataFrame:
    """Surrogate key 1..n over distinct rows, NULLs first."""
    saved = cut_lineage(df)
    return row_number_over(saved, name, [], [F.col(c).asc_nulls_first() for c in order], limit)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
