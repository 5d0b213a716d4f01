import datetime as dt
import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from marketlens.plans import control, report
from marketlens.sources import files, links, schemas, sinks, stations


def test_trades_csv_round_trip(spark, tmp_path, rows):
    header = ",".join(schemas.TRADES.fieldNames())
    line = "2020/1,202001,2020,1,1,大田,1,野菜,2,葉茎,10,キャベツ,5,愛知,国内,12,3400"
    (tmp_path / "a.csv").write_text(f"{header}\n{line}\n", encoding="utf-8")
    df = files.read_trades(spark, str(tmp_path))
    assert df.schema == schemas.TRADES
    assert rows(df.select("year", "item_name", "quantity_kg", "amount_yen")) == [(2020, "キャベツ", 12, 3400)]


def test_market_file_headers_and_numbers(spark, rows):
    df = spark.createDataFrame([("2020", "キャベツ", "12", "x"), ("2020", "キャベツ", None, "7")], "`年` string, `品目名称` string, `数量(kg)` string, `金額(円)` string")
    got = files.clean_market_file(df)
    assert got.columns == ["year", "item_name", "quantity_kg", "amount_yen"]
    assert rows(got.select("quantity_kg", "amount_yen"), "quantity_kg") == [(0.0, 7.0), (12.0, 0.0)]


def test_weather_export(spark, tmp_path):
    body = "a\nb\nc\nd\ne\n年,月,日,時,気温,降水量,相対湿度,風速,風向,日照時間\n2020,1,2,3,4.5,0.0,60,1.5,90,0.1\n2020,1,2,24,x,1.0,61,1.5,90,\n"
    (tmp_path / "weather_hourly_44132_202001.csv").write_bytes(body.encode("shift_jis"))
    df = files.read_weather_export(spark, str(tmp_path), stations.stations(spark), F.lit("2020-02-01").cast("timestamp"))
    assert df.columns == schemas.WEATHER.fieldNames()
    first, second = df.orderBy("hour").collect()
    assert (first["station_id"], first["station_name"], first["temperature"], first["observation_datetime"]) == ("44132", "東京", 4.5, dt.datetime(2020, 1, 2, 3))
    assert (second["temperature"], second["sunshine"], second["observation_datetime"]) == (None, None, None)


def test_links(spark, rows):
    html = (
        '<a href="/documents/d/shijou/y2020meisai">2020年</a> <A class="x" href="/documents/d/shijou/y202103meisai_20210401.xlsx"><b> 3月 </b></A>'
        '<a href="/documents/d/shijou/y202103other">no</a><a href="/pre/documents/d/shijou/y2020meisai">no</a><a href="/documents/d/shijou/y202004meisai">4</a>'
    )
    found = links.extract_links(spark.createDataFrame([(html,)], "html string"))
    assert rows(found.select("year", "month", "kind", "link_text"), "year", "month") == [(2020, None, "y", "2020年"), (2020, 4, "y", "4"), (2021, 3, "y", "3月")]
    kept = links.drop_superseded(found)
    assert rows(kept.select("year", "month"), "year") == [(2020, None), (2021, 3)]
    assert rows(links.select_files(found, "latest-only").select("year", "month")) == [(2021, 3)]
    assert links.select_files(found, "backfill", start=2021, end=2021).count() == 1
    assert links.select_files(found, "all").count() == 3
    with pytest.raises(ValueError):
        links.select_files(found, "some")
    manifest = spark.createDataFrame([("2020.csv",)], "filename string")
    assert rows(links.pending(kept, manifest).select("filename")) == [("202103.csv",)]
    assert links.pending(kept, manifest, force=True).count() == 2


def test_month_slices_and_grid(spark, rows):
    df = spark.createDataFrame([(dt.date(2020, 1, 15), dt.date(2020, 3, 10)), (dt.date(2020, 5, 2), dt.date(2020, 5, 1))], "start_date date, end_date date")
    slices = links.month_slices(df).select("slice_start", "slice_end")
    assert [(str(a), str(b)) for a, b in rows(slices, "slice_start")] == [("2020-01-15", "2020-01-31"), ("2020-02-01", "2020-02-29"), ("2020-03-01", "2020-03-10")]
    assert links.task_grid(stations.stations(spark, "current"), slices).count() == 15


@pytest.mark.parametrize("coverage, count, first", [("all", 47, "47412"), ("agriculture", 14, "47412"), ("current", 5, "44132")])
def test_stations(spark, coverage, count, first):
    df = stations.stations(spark, coverage)
    assert df.count() == count and df.filter("priority = 1").first()["station_id"] == first
    with pytest.raises(ValueError):
        stations.stations(spark, "none")


def test_replace_partitions_keeps_other_periods(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, 2020, 1), (2, 2020, 2)], "v int, year int, month int")
    sinks.replace_partitions(old, path, ["year", "month"])
    sinks.replace_partitions(spark.createDataFrame([(9, 2020, 2)], "v int, year int, month int"), path, ["year", "month"])
    assert rows(spark.read.parquet(path).select("v", "month"), "month") == [(1, 1), (9, 2)]


def test_append_export_daily_cluster(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, dt.datetime(2020, 1, 1, 5)), ("b", 2, dt.datetime(2020, 1, 2, 5))], "k string, v int, t timestamp")
    for _ in range(2):
        sinks.append_log(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    sinks.export_csv(df, str(tmp_path / "csv"), ["k"])
    assert sorted(p.name for p in (tmp_path / "csv").glob("k=*")) == ["k=a", "k=b"]
    sinks.write_daily(df, str(tmp_path / "day"), "t")
    assert sorted(p.name for p in (tmp_path / "day").glob("partition_day=*")) == ["partition_day=2020-01-01", "partition_day=2020-01-02"]
    sinks.write_clustered(df, str(tmp_path / "cl"), ["k", "v"])
    assert spark.read.parquet(str(tmp_path / "cl")).count() == 2
    sinks.write_summary(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    sinks.materialize(df, "some_view", "view")
    assert spark.table("some_view").count() == 2
    with pytest.raises(ValueError):
        sinks.materialize(df, "x", "stream")
    listed = sinks.object_sizes(sinks.list_objects(spark, str(tmp_path / "cl")))
    assert listed.first()["bucket"] == "cl"


def test_model_save_and_load(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)], "x double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression()]).fit(df)
    day = dt.date(2021, 5, 3)
    assert sinks.save_model(model, str(tmp_path), day).endswith("202105")
    loaded = sinks.load_model(str(tmp_path), day)
    assert loaded.transform(df).filter("abs(prediction - label) > 1e-6").count() == 0


def test_metadata_newest(spark, rows):
    predictions = spark.createDataFrame([("a", "LSTM"), ("b", "LSTM")], "item_name string, model_type string")
    new, old = (sinks.metadata_rows(predictions, dt.date(2021, m, 1)) for m in (5, 4))
    assert json.loads(new.first()["json"])["items_covered"] == ["a", "b"]
    assert rows(sinks.latest_metadata(new.unionByName(old))) == [("202105", "2021-05-01T00:00:00", 2, "LSTM", 2)]


@pytest.mark.parametrize("day, month, expected", [("2021-12-05", None, (2022, 1)), ("2021-05-05", None, (2021, 6)), ("2021-05-05", 3, (2022, 3)), ("2021-05-05", 5, (2021, 5))])
def test_target_month(day, month, expected):
    assert report.target_month(dt.date.fromisoformat(day), month) == expected


def test_confidence_bands(spark):
    df = spark.createDataFrame([(19.9, 0.1), (20.0, 0.1), (200.0, 0.1), (0.0, 0.512), (None, -0.5)], "model_mae double, model_r2 double")
    assert [r[0] for r in df.select(report.confidence_percent()).collect()] == [95.0, 85.0, 40.0, 51.0, 0.0]


@pytest.mark.parametrize("status, known, word", [("failure", True, "ERROR"), ("success", True, "空です"), ("unknown", False, "準備中"), ("unknown", True, "準備できていません")])
def test_empty_message(status, known, word):
    assert word in report.empty_text(1, status, known)


def test_message_without_predictions(spark):
    top = spark.createDataFrame([], "item_name string, model_type string, predicted_price double, confidence_pct double, model_mae double, sort_price double, sort_confidence double, sort_r2 double")
    movers = spark.createDataFrame([], "item_name string, price_volatility double, kind string")
    info = spark.createDataFrame([], "version string, created_at string, items_covered bigint")
    row = report.message(top, movers, info, 2).first()
    assert row["items"] == 0 and "準備中" in row["ranking_text"] and row["seasonal_text"] == "" and row["model_text"] == ""


@pytest.mark.parametrize("usage, level", [(94.9, "CRITICAL"), (95.0, "EMERGENCY"), (80.0, "CRITICAL"), (60.0, "WARNING"), (59.9, "NORMAL"), (150.0, "EMERGENCY")])
def test_usage_levels(spark, usage, level):
    rows_ = control.usage_rows(spark.createDataFrame([(usage,)], "current_usage double"), "s", "r", 100.0, "2021-01-01")
    row = rows_.first()
    assert row["alert_level"] == level and row["usage_percentage"] == min(usage, 100.0) and row["remaining"] == pytest.approx(max(0.0, 100.0 - usage))
    assert control.alerts(rows_).count() == (level != "NORMAL")
    assert control.usage_log(rows_).columns == schemas.USAGE_LOG.fieldNames()


@pytest.mark.parametrize("need, safe, word", [(1.0, True, "Safe"), (40.0, True, "caution"), (60.0, False, "exceed")])
def test_safety_gate(spark, need, safe, word):
    row = control.safety_gate(spark.createDataFrame([(40.0,)], "current_usage double"), need, 100.0).first()
    assert row["safe"] == safe and word in row["reason"]


def test_links_in_all_quote_forms(spark):
    from marketlens.sources import links

    html = "<a href='/f/y2020&amp;x'>one</a> <a class=b href=/f/y2021&x>two</a> <a href=\"/f/y2022&x\">three</a>"
    found = links.extract_links(spark.createDataFrame([(html,)], "html string"), r"/f/(y)(\d{4})(\d{2})?&x", "http://h")
    assert {(r["year"], r["url"]) for r in found.collect()} == {(2020, "http://h/f/y2020&x"), (2021, "http://h/f/y2021&x"), (2022, "http://h/f/y2022&x")}


@pytest.mark.parametrize(("count", "files", "share"), [(3, 512, 1 / 4), (4, 256, 2 / 5)])
def test_filters_on_any_cluster_column_skip_files(spark, tmp_path, count, files, share):
    """A filter for one value of any of the columns is admitted by a small share of the files. With 2 ** k
    files, each of c columns is halved about k / c times; files do not end at the halves exactly."""
    import pathlib

    import pyarrow.parquet as pq

    columns = ["item", "market", "day", "price"]
    df = spark.range(60_000, numPartitions=4).selectExpr(
        "concat('i', lpad(cast(rand(1) * 97 as int), 3, '0')) AS item", "concat('m', cast(rand(2) * 60 as int)) AS market",
        "date_add(date'1999-01-01', cast(rand(3) * 900 as int)) AS day", "IF(rand(5) < 0.01, NULL, rand(4) * rand(6) * 900) AS price",
    )
    df.write.parquet(str(tmp_path / "raw"))
    saved = spark.read.parquet(str(tmp_path / "raw"))
    sinks.write_clustered(saved, str(tmp_path / "out"), columns[:count], files=files)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.columns == saved.columns and out.exceptAll(saved).count() == 0 and out.count() == 60_000
    found = [pq.read_metadata(f) for f in pathlib.Path(tmp_path, "out").glob("*.parquet")]
    assert len(found) > 0.8 * files
    for i, name in enumerate(columns[:count]):
        stats = [m.row_group(g).column(i).statistics for m in found for g in range(m.num_row_groups)]
        values = [r[0] for r in saved.filter(f"{name} IS NOT NULL").select(name).sample(0.002, 3).collect()]
        admitted = [sum(s.has_min_max and s.min <= v <= s.max for s in stats) for v in values]
        assert sum(admitted) / len(admitted) <= len(found) * share, name


def test_cluster_columns_with_few_values(spark, tmp_path):
    df = spark.createDataFrame([(None, "x"), (None, "x"), (1, "x")], "a int, b string")
    sinks.write_clustered(df, str(tmp_path / "t"), ["a", "b"], files=4)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    sinks.write_clustered(df.limit(0), str(tmp_path / "e"), ["a", "b"], files=4)
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "e")).count() == 0
