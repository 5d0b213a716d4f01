"""Model bundles: what is saved can score rows that were not there when it was fitted."""

import datetime as dt

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from marketlens.operators import features, models
from marketlens.sources import bundles


@pytest.fixture(scope="module")
def split(spark):
    rows = []
    for i in range(240):
        month = i % 12 + 1
        row = {c: float((i * 7 + k * 13) % 29 + 1) for k, c in enumerate(features.FEATURES) if not c.endswith("_encoded")}
        row |= {c: f"{c}{i % 3}" for c in features.TEXT_COLUMNS}
        row |= {"year": 1999 + i // 80, "month": month, "quarter": (month + 2) // 3, "avg_unit_price_yen": 100.0 + i % 17 + 5 * (i % 3)}
        row |= {"major_category": "m", "sub_category": "s", "profile_category": "s", "item_category": f"{i:04d}", "is_train": i < 200}
        drop = ("price_volatility", "temperature_deviation", "precipitation_deviation", "price_trend", "quarter_1", "quarter_2", "quarter_3", "quarter_4")
        rows.append({k: v for k, v in row.items() if k not in drop})
    return spark.createDataFrame(rows).cache()


@pytest.fixture(scope="module")
def saved(split, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("bundles"))
    state = features.fit_features(split.filter("is_train"))
    built = features.apply_features(split, state)
    names = features.available_features(built)
    plan = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="raw"), LinearRegression(featuresCol="raw", labelCol=features.TARGET, predictionCol="y_pred", regParam=0.1)])
    fitted = models.fit_all(built, {"linear_regression": plan}, [*names, features.TARGET])
    bundles.save_bundle(base, "199912", fitted, state, names, built, dt.date(1999, 12, 1))
    bundles.save_bundle(base, "200001", fitted, state, names, built, dt.date(2000, 1, 1))
    return base, fitted, built, names


def test_manifest_and_latest(spark, saved):
    base, _, built, names = saved
    assert bundles.latest(spark, base) == "200001"
    row = bundles.load_bundle(spark, base, "199912").manifest
    assert (row["train_rows"], row["test_rows"], row["train_end"], row["test_start"]) == (200, 40, "2001-12", "2001-01")
    assert row["features"] == names and row["code_rows"] == 21 and row["best_model"] == "linear_regression"


def test_new_session_scores_rows_with_unseen_values(spark, split, saved):
    base, fitted, built, _ = saved
    bundle = bundles.load_bundle(spark.newSession(), base)
    test = split.filter("NOT is_train")
    want = {r.item_category: r.y_pred for r in fitted["linear_regression"].transform(built).select("item_category", "y_pred").collect()}
    for r in bundle.score(test).select("item_category", "y_pred").collect():
        assert r.y_pred == pytest.approx(want[r.item_category], abs=20)
    new = test.withColumns({"market": F.lit("never seen"), "month": F.lit(13)})
    scored = bundle.score(new)
    assert scored.count() == test.count()
    assert {r[0] for r in scored.select("market_encoded").distinct().collect()} == {-1}
    assert {r[0] for r in scored.select("temperature_deviation").distinct().collect()} == {0.0}


def test_unfinished_and_damaged_versions(spark, saved, tmp_path):
    import pathlib
    import shutil

    base = str(tmp_path / "copy")
    shutil.copytree(saved[0], base)
    manifest = pathlib.Path(base, "200001", "manifest")
    manifest.rename(tmp_path / "manifest")
    assert bundles.latest(spark, base) == "199912"
    with pytest.raises(ValueError, match="no finished version"):
        bundles.load_bundle(spark, base, "200001")
    files = bundles.load_bundle(spark, base).manifest["files"]
    assert bundles.damaged(spark, f"{base}/199912", files).count() == 0
    part = next(pathlib.Path(base, "199912", "codes").glob("part-*"))
    data = bytearray(part.read_bytes())
    data[len(data) // 2] ^= 1
    part.write_bytes(bytes(data))
    for check in pathlib.Path(base, "199912", "codes").glob(".part-*.crc"):
        check.unlink()
    assert [r.state for r in bundles.damaged(spark, f"{base}/199912", files).collect()] == ["changed"]
    with pytest.raises(ValueError, match="damaged"):
        bundles.load_bundle(spark, base, "199912")
