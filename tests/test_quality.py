import pytest
from pyspark.sql import functions as F

from marketlens.operators import quality as Q
from marketlens.plans import checks


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, "a", 5.0), (1, "b", -1.0), (2, None, None), (None, "z", 11.0), (None, "a", 10.0)], "k int, c string, v double")


def test_single_checks(table, rows):
    assert rows(Q.unique(table, "k")) == [(1, 2)]
    assert Q.not_null(table, "c").count() == 1
    assert rows(Q.accepted_values(table, "c", ["a", "b"]).select("c")) == [("z",)]
    assert rows(Q.accepted_range(table, "v", 0, 10).select("v"), "v") == [(-1.0,), (11.0,)]
    assert rows(Q.accepted_range(table, "v", high=10).select("v")) == [(11.0,)]
    parent = table.sparkSession.createDataFrame([(1,), (None,)], "id int")
    assert rows(Q.relationships(table, "k", parent, "id").select("k")) == [(2,)]


def test_suite_in_one_pass(table, rows):
    suite = Q.Checks(unique=("k",), not_null=("k", "c"), values={"c": ["a"]}, ranges={"v": (0, None)})
    got = {(r["check"], r["column_name"]): r["failures"] for r in Q.run_checks(table, "t", suite).collect()}
    assert got == {("unique", "k"): 1, ("not_null", "k"): 2, ("not_null", "c"): 1, ("accepted_values", "c"): 2, ("accepted_range", "v"): 1}


def test_content_score(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), (None, None)], "x string, y int")
    row = Q.content_score(df).first()
    assert (row["rows"], row["null_cells"], row["repeated_rows"]) == (4, 4, 1)
    assert row["score"] == pytest.approx(100 - 50 * 4 / 8 - 30 / 4)
    assert Q.content_score(df.filter(F.lit(False))).first()["score"] == 0.0


def test_every_table_is_declared():
    names = set(checks.declared(2020, 2030))
    assert len(names) == 14 and {"price_movement", "mart_dashboard", "dim_time"} <= names


def test_suite_reads_each_table_once_and_finds_orphans(spark, tmp_path):
    """Later tables are built from saved ones; all key checks are one count."""
    spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("z", -1)], "k string, v long").write.parquet(str(tmp_path / "t"))
    built = []

    def child(saved):
        built.append(sorted(saved))
        return saved["t"].withColumn("k", F.when(F.col("k") == "z", "missing").otherwise(F.col("k")))

    suite = {"t": lambda _: spark.read.parquet(str(tmp_path / "t")), "parent": lambda saved: saved["t"].select("k"), "child": child, "none": lambda saved: saved["t"].limit(0)}
    rules = {
        "t": Q.Checks(unique=("k", "v"), ranges={"v": (0, None)}, not_null=("k",)),
        "child": Q.Checks(unique=("k",), parents={"k": ("parent", "k")}),
        "none": Q.Checks(unique=("k",), not_null=("k",), parents={"k": ("parent", "k")}),
    }
    got = {(r["table_name"], r["check"], r["column_name"]): r["failures"] for r in Q.run_suite(suite, rules).collect()}
    assert built == [["parent", "t"]]
    assert got == {
        ("t", "unique", "k"): 1, ("t", "unique", "v"): 0, ("t", "accepted_range", "v"): 1, ("t", "not_null", "k"): 1,
        ("child", "unique", "k"): 1, ("child", "relationships", "k"): 1,
        ("none", "unique", "k"): 0, ("none", "not_null", "k"): 0, ("none", "relationships", "k"): 0,
    }
