"""Declarative data tests. A failing row is a row that breaks a check; none means pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..session import cut_lineage


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter("copies > 1")


def null_check(column: str) -> Column:
    return F.col(column).isNull()


def values_check(column: str, allowed: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(list(allowed))


def range_check(column: str, low: float | None = None, high: float | None = None) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return F.coalesce(bad, F.lit(False))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(null_check(column))


def accepted_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    return df.filter(values_check(column, allowed))


def accepted_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.filter(range_check(column, low, high))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value is missing in the parent; NULLs pass."""
    keys = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


@dataclass(frozen=True)
class Checks:
    """Checks of one table, by column. ``parents`` name the table and column that a column refers to."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    values: Mapping[str, Sequence] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    parents: Mapping[str, tuple[str, str]] = field(default_factory=dict)


_RESULT = "table_name string, check string, column_name string, failures bigint"


def row_tests(checks: Checks) -> list[tuple[str, str, Column]]:
    """Kind, column and failing condition of the checks that look at one row at a time."""
    tests = [("not_null", c, null_check(c)) for c in checks.not_null]
    tests += [("accepted_values", c, values_check(c, v)) for c, v in checks.values.items()]
    return tests + [("accepted_range", c, range_check(c, *b)) for c, b in checks.ranges.items()]


def saved_and_counted(df: DataFrame, table: str, checks: Checks) -> tuple[DataFrame, list[tuple[str, str, str, int]]]:
    """``df`` written once, and the failing rows of its row-level checks, counted by the same job."""
    tests = row_tests(checks)
    if not tests:
        return cut_lineage(df), []
    counts = Observation()
    saved = cut_lineage(df.observe(counts, *[F.count_if(bad).alias(f"t{i}") for i, (_, _, bad) in enumerate(tests)]))
    found = counts.get
    return saved, [(table, kind, column, int(found[f"t{i}"])) for i, (kind, column, _) in enumerate(tests)]


def key_failures(tables: Mapping[str, DataFrame], checks: Mapping[str, Checks]) -> DataFrame:
    """Failing rows of the checks that compare rows: repeated values, and values that the parent lacks.

    All columns of all tables go into one count of (table, check, column, value); each table is read once.
    Values are combined in each task first, so a very common value is a few rows afterwards.
    """
    wanted: dict[str, list[Column]] = {name: [] for name in tables}

    def value(table: str, kind: str, column: str, source: str, parent: bool) -> Column:
        return F.struct(
            F.lit(table).alias("table_name"), F.lit(kind).alias("check"), F.lit(column).alias("column_name"),
            F.col(source).cast("string").alias("value"), F.lit(parent).alias("parent"),
        )

    for name, own in checks.items():
        if name not in tables:
            continue
        wanted[name] += [value(name, "unique", c, c, False) for c in own.unique]
        for column, (parent, parent_column) in own.parents.items():
            wanted[name].append(value(name, "relationships", column, column, False))
            wanted[parent].append(value(name, "relationships", column, parent_column, True))
    listed = [df.select(F.explode(F.array(*wanted[name])).alias("v")).select("v.*") for name, df in tables.items() if wanted[name]]
    asked = [(n, "unique", c, 0) for n in checks if n in tables for c in checks[n].unique]
    asked += [(n, "relationships", c, 0) for n in checks if n in tables for c in checks[n].parents]
    every = next(iter(tables.values())).sparkSession.createDataFrame(asked, _RESULT)
    if not listed:
        return every
    values = reduce(DataFrame.unionByName, listed).filter(F.col("value").isNotNull())
    names = ["table_name", "check", "column_name"]
    counted = values.groupBy(*names, "value").agg(F.count_if(~F.col("parent")).alias("rows"), F.max("parent").alias("known"))
    repeated = F.when(F.col("rows") > 1, 1).otherwise(0)
    orphans = F.when(F.col("known"), 0).otherwise(F.col("rows"))
    failing = counted.groupBy(*names).agg(F.sum(F.when(F.col("check") == "unique", repeated).otherwise(orphans)).alias("failures"))
    # A table without rows has no counts, and no failures.
    return every.unionByName(failing).groupBy(*names).agg(F.max("failures").cast("bigint").alias("failures"))


def run_checks(df: DataFrame, table: str, checks: Checks, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Failing rows per check of one table."""
    return run_suite({table: lambda _: df} | {name: (lambda _, p=p: p) for name, p in (parents or {}).items()}, {table: checks})


def run_suite(tables: Mapping[str, Callable[[dict[str, DataFrame]], DataFrame]], checks: Mapping[str, Checks]) -> DataFrame:
    """Failing rows per table and check.

    ``tables`` are built in order, each from the saved ones before it, so what several of them read is
    scanned once. Row-level checks are counted while a table is written; the others by ``key_failures``.
    """
    saved: dict[str, DataFrame] = {}
    rows: list[tuple[str, str, str, int]] = []
    none = Checks()
    for name, build in tables.items():
        saved[name], counted = saved_and_counted(build(saved), name, checks.get(name, none))
        rows += counted
    compared = key_failures(saved, {name: checks.get(name, none) for name in saved})
    if not rows:
        return compared
    return next(iter(saved.values())).sparkSession.createDataFrame(rows, _RESULT).unionByName(compared)


def content_score(df: DataFrame) -> DataFrame:
    """``max(0, 100 - 50 * share of null cells - 30 * share of repeated rows)``; 0 if empty.

    Equal rows are counted together first, NULLs being equal, so copies of one row are
    combined before the shuffle.
    """
    columns = df.columns
    nulls = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("bigint") for c in columns])
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    sums = groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") * nulls), F.lit(0)).alias("null_cells"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("repeated_rows"),
    )
    missing = ratio("null_cells", F.col("rows") * len(columns))
    repeated = ratio("repeated_rows", "rows")
    score = F.greatest(F.lit(0.0), 100 - missing * 50 - repeated * 30)
    return sums.withColumn("score", F.when(F.col("rows") > 0, score).otherwise(F.lit(0.0)))
