import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators import ranking


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(5)
    # One group holds most rows; many prices are equal; one key is NULL.
    data = [
        ("a" if i % 5 else rng.choice(["b", "c", None]), i, float(rng.randint(1, 6)))
        for i in range(400)
    ]
    return spark.createDataFrame(data, "g string, id bigint, price double").repartition(5)


def test_global_index_is_dense_and_sorted(sales):
    got = ranking.global_index(sales, [F.col("price").desc(), F.col("id")], "idx").orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(400))
    assert [(-r["price"], r["id"]) for r in got] == sorted((-r["price"], r["id"]) for r in got)


@pytest.mark.parametrize("partition", [["g"], []])
def test_row_number_same_on_both_paths(sales, rows, partition):
    order = [F.col("price").desc(), F.col("id")]
    small = ranking.row_number_over(sales, "rn", partition, order)
    large = ranking.row_number_over(sales, "rn", partition, order, limit=10)
    assert rows(small.select("id", "rn"), "id") == rows(large.select("id", "rn"), "id")


@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_a_window(sales, rows, descending):
    data = sales.withColumn("price", F.when(F.col("id") % 7 != 0, F.col("price")))
    order = F.col("price").desc_nulls_last() if descending else F.col("price").asc_nulls_first()
    window = data.withColumn("rk", F.rank().over(Window.partitionBy("g").orderBy(order)))
    assert rows(ranking.rank_over(data, "rk", ["g"], "price", descending).select("id", "rk"), "id") == rows(window.select("id", "rk"), "id")


@pytest.mark.parametrize("partition", [["g"], []])
def test_number_by_value_equals_a_window(sales, rows, partition):
    """Ties in the value, NULL groups and NULL values."""
    data = sales.withColumns({"price": F.when(F.col("id") % 7 != 0, F.col("price")), "day": F.col("id") % 3})
    value = {"price": F.col("price").desc(), "day": F.col("day").asc()}
    window = Window.partitionBy(*partition).orderBy(*value.values(), F.col("id").desc())
    got = ranking.number_by_value(data, "rn", partition, value, [F.col("id").desc()])
    assert rows(got.select("id", "rn"), "id") == rows(data.select("id", F.row_number().over(window).alias("rn")), "id")
    assert got.columns == [*data.columns, "rn"]


def test_groups_fit(sales):
    assert ranking.groups_fit(sales, ["g"], 400)
    assert not ranking.groups_fit(sales, ["g"], 100)
    assert not ranking.groups_fit(sales, [], 399)


def test_latest_and_best_per_key(spark, rows):
    df = spark.createDataFrame(
        [("x", 1, None), ("x", 2, 5), ("x", 3, 7), ("y", 4, None), (None, 5, 1)], "k string, id int, t int"
    )
    latest = ranking.latest_per_key(df, ["k"], [F.col("t")])
    assert rows(latest, "k") == [(None, 5, 1), ("x", 3, 7), ("y", 4, None)]
    best = ranking.best_per_key(df, ["k"], [F.coalesce("t", F.lit(99))])
    assert rows(best, "k") == [(None, 5, 1), ("x", 2, 5), ("y", 4, None)]


def test_join_groups_matches_null_keys(spark, rows):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    assert rows(ranking.join_groups(left, right, ["k"]), "v") == [("a", 1, 10), (None, 2, 20)]


def test_dense_key_puts_null_first(spark, rows):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "m string")
    assert rows(ranking.dense_key(df, "k", ["m"]).select("m", "k"), "k") == [(None, 1), ("a", 2), ("b", 3)]
