import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "part supplier nation lineitem orders events pages documents".split()
QUICK = ("price_trend", "stg_weather_dedup", "dim_location", "fact_predictions", "file_links", "run_report", "latest_metadata", "month_slices", "forecast_trend_regressors", "forecast_autoregressive", "model_bundle")


def test_registry():
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) >= 85
    # Fits and recursions have no SQL form.
    from marketlens.catalog import QUERIES

    assert set(QUERIES) - set(oracle) == {
        "forecast_recursive_boosted", "backtest", "prediction_batch",
        "train_regressors", "feature_importance", "best_model", "regression_batch",
    }


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = db.sql(entry.oracle_sql()[name])
    names = list(result.columns)
    df = entry.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    key = lambda row: tuple((v is None, v if v is not None else 0) for v in row)
    ours = sorted((tuple(r) for r in df.select(*names).collect()), key=key)
    assert ours == sorted(result.fetchall(), key=key)
