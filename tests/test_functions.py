import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.functions import dates, numeric, rules, text
from marketlens.functions import vocabulary as V
from marketlens.plans import marts
from marketlens.sources import files


def one(spark, column, value=None, kind="double"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "value, places, expected",
    [(1.005, 2, 1.01), (0.285, 2, 0.29), (-1.005, 2, -1.01), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.0, 2, 0.0), (None, 2, None),
     ((0.1 + 0.2 + 0.3) / 4 + 0.005 - 0.15, 2, 0.01)],
)
def test_round_half_away_from_zero(spark, value, places, expected):
    assert one(spark, numeric.round_to("x", places), value) == expected


def test_round_has_no_negative_zero(spark):
    assert str(one(spark, numeric.round_to("x", 2), -0.001)) == "0.0"


def test_ratio_and_change_are_null_safe(spark):
    df = spark.createDataFrame([(6.0, 4.0), (1.0, 0.0), (None, 2.0), (3.0, None)], "a double, b double")
    got = df.select(numeric.ratio("a", "b"), numeric.pct_change("a", "b")).collect()
    assert [tuple(r) for r in got] == [(1.5, 50.0), (None, None), (None, None), (None, None)]


@pytest.mark.parametrize("value, expected", [("2.5", 3), ("-2.5", -3), ("7", 7), ("x", None), (None, None)])
def test_to_int(spark, value, expected):
    assert one(spark, numeric.to_int("x"), value, "string") == expected


@pytest.mark.parametrize("value, expected", [(-3.0, -1.0), (0.5, 0.5), (1.7, 1.0), (None, None)])
def test_clamp(spark, value, expected):
    assert one(spark, numeric.clamp("x", -1.0, 1.0), value) == expected


def test_blanks(spark):
    assert one(spark, text.trim_blanks("x"), "　 Ab c　 ", "string") == "Ab c"
    assert one(spark, text.strip_blanks("x"), "野　菜 ", "string") == "野菜"
    assert one(spark, text.letters_digits("x"), "トマト（大）-1!", "string") == "トマト大1"
    assert one(spark, text.strip_suffix("x", "県府道都"), "青森県", "string") == "青森"


@pytest.mark.parametrize("value, expected", [("2001-02-03", dt.date(2001, 2, 3)), ("2001-02-03 04:05:06", dt.date(2001, 2, 3)), ("bad", None), (None, None)])
def test_parse_date(spark, value, expected):
    assert one(spark, dates.parse_date("x"), value, "string") == expected


def test_next_month(spark):
    assert one(spark, dates.next_month("2001-12-15")) == dt.date(2002, 1, 1)


def test_rules_first_match_and_null(spark):
    df = spark.createDataFrame([(3.5,), (2.0,), (1.6,), (1.5,), (None,)], "z double")
    got = [r[0] for r in df.select(rules.above("z", V.ANOMALY_STATUS, "正常範囲")).collect()]
    assert got == ["異常値", "監視対象", "監視対象", "正常範囲", "正常範囲"]
    rain = spark.createDataFrame([(151.0,), (150.0,), (75.0,), (None,)], "x double")
    got = [r[0] for r in rain.select(rules.above("x", V.RAIN_CLASS, "少雨", V.UNKNOWN)).collect()]
    assert got == ["多雨", "普通", "少雨", "不明"]


@pytest.mark.parametrize("days, expected", [(25, "COMPLETE"), (15, "PARTIAL"), (14, "INSUFFICIENT"), (None, "INSUFFICIENT")])
def test_weather_cover(spark, days, expected):
    assert one(spark, rules.at_least("x", V.WEATHER_COVER, "INSUFFICIENT"), days, "bigint") == expected


@pytest.mark.parametrize("days, expected", [(30, "SHORT_TERM"), (31, "MEDIUM_TERM"), (90, "MEDIUM_TERM"), (91, "LONG_TERM")])
def test_horizon(spark, days, expected):
    assert one(spark, rules.at_most("x", V.HORIZON, "LONG_TERM"), days, "bigint") == expected


def test_relative_zone(spark):
    df = spark.createDataFrame([(130.0, 100.0), (110.0, 100.0), (85.0, 100.0), (70.0, 100.0), (1.0, None)], "p double, b double")
    zone = rules.relative("p", "b", [(1.2, "A"), (1.05, "B")], [(0.8, "D"), (0.9, "C")], "-")
    assert [r[0] for r in df.select(zone).collect()] == ["A", "B", "C", "D", "-"]


def test_pattern_modes(spark):
    df = spark.createDataFrame([("10, 11, 12",), ("9, 4, 5",), ("10, 9, 11",), ("7, 1, 2",)], "m string")
    as_text = [r[0] for r in df.select(marts.season_pattern("m")).collect()]
    by_month = [r[0] for r in df.select(marts.season_pattern("m", "month")).collect()]
    assert as_text == ["冬野菜", "春野菜", "冬野菜", "夏野菜"]
    assert by_month == ["冬野菜", "春野菜", "秋野菜", "夏野菜"]


def test_observation_time_hour_24_is_null(spark):
    df = spark.createDataFrame([(2001, 2, 3, 23), (2001, 2, 3, 24), (2001, 2, 30, 1)], "year int, month int, day int, hour int")
    got = [r[0] for r in df.select(F.date_format(files.observation_time(), "yyyy-MM-dd HH")).collect()]
    assert got == ["2001-02-03 23", None, None]


def test_rounding_keeps_what_has_no_such_digits(spark):
    values = [float("inf"), float("-inf"), 1e14, -1e19, 12.345, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(numeric.round_to("x", 2)).collect()] == [float("inf"), float("-inf"), 1e14, -1e19, 12.35, None]
    assert [r[0] for r in df.select(numeric.round_to("x", 6)).collect()][2:4] == [1e14, -1e19]
    nan = spark.createDataFrame([(float("nan"),)], "x double").select(numeric.round_to("x", 4)).first()[0]
    assert nan != nan


def test_text_is_read_as_a_whole_number_or_not_at_all(spark):
    df = spark.createDataFrame([("12.7",), ("9007199254740993",), (" 5 ",), ("x",)], "x string")
    assert [r[0] for r in df.select(numeric.to_int("x", df.schema["x"].dataType)).collect()] == [None, 9007199254740993, 5, None]
