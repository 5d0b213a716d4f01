"""Domain tables derived from the order, part, event and page tables of a data folder.

All mappings are plain arithmetic on the keys, so they can be restated in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as V

# Names given to the eight product words, 25 nations and five regions.
ITEM_NAMES = {
    "plate": "キャベツ", "rod": "トマト", "ring": "じゃがいも", "bolt": "玉ねぎ",
    "widget": "にんじん", "gear": "大根", "gizmo": "ほうれん草", "anvil": "しいたけ",
}
ORIGIN_NAMES = (
    "北海道", "青森県", "岩手県", "茨城県", "栃木県", "群馬県", "埼玉県", "千葉県", "東京都",
    "神奈川県", "長野県", "静岡県", "愛知県", "京都", "大阪府", "兵庫県", "和歌山県", "広島県",
    "徳島県", "高知県", "福岡県", "宮崎県", "鹿児島県", "外国（中国）", "その他",
)
MARKET_NAMES = ("豊洲", "大田", "北足立", "葛西", "淀橋")
MODEL_NAMES = ("PROPHET", " lstm ", "arima", "RANDOM_FOREST", "gradient_boosting", "LINEAR_REGRESSION", "XGBOOST")
AS_OF = "2001-12-01"
START_YEAR = 1997


# Columns that are used, with their stored types, so that no job has to look them up.
COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double,"
    " l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "pages": "page_id bigint, html string",
    "documents": "doc_id bigint, lang string, source string, n_chars bigint",
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """One trade per order line; part, supplier, nation and region give item and place.

    The joins have no hint: Spark broadcasts a side only when its size is below the
    session limit, and sorts both sides otherwise.
    """
    word = F.split_part("p_name", F.lit(" "), F.lit(2))
    names = F.create_map(*[F.lit(x) for kv in ITEM_NAMES.items() for x in kv])
    # Names are made on the small sides, once per part and per nation.
    part = read(spark, folder, "part").select(
        "p_partkey", word.alias("item_code"), F.element_at(names, word).alias("item_name")
    )
    place = F.col("n_nationkey")
    nation = read(spark, folder, "nation").select(
        "n_nationkey",
        F.col("n_regionkey").cast("string").alias("market_code"),
        _pick(MARKET_NAMES, F.col("n_regionkey")).alias("market"),
        place.cast("string").alias("origin_code"),
        _pick(ORIGIN_NAMES, place).alias("origin"),
        F.when(place == 23, "外国").otherwise("国内").alias("domestic_foreign"),
    )
    # Joined one by one: the size of a plain table is known, that of a join is only guessed.
    rows = (
        read(spark, folder, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(read(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    year, month = F.year("l_shipdate").cast("bigint"), F.month("l_shipdate").cast("bigint")
    order, key = F.col("l_orderkey"), F.col("l_partkey")
    whole = lambda c: F.floor(F.col(c) + 0.5)
    return rows.select(
        F.concat_ws("/", year.cast("string"), month.cast("string")).alias("year_month_slash"),
        F.concat(year.cast("string"), F.lpad(month.cast("string"), 2, "0")).alias("year_month_num"),
        year.alias("year"),
        month.alias("month"),
        "market_code",
        "market",
        F.lit("1").alias("major_category_code"),
        F.when(key % 10 == 0, "果　実").when(key % 3 == 0, "野　菜").when(key % 3 == 1, "野 菜").otherwise("野菜").alias("major_category"),
        (key % 4).cast("string").alias("sub_category_code"),
        F.when(key % 20 == 1, F.lit(None)).when(key % 4 == 2, "加工").otherwise("生鮮").alias("sub_category"),
        "item_code",
        "item_name",
        "origin_code",
        "origin",
        "domestic_foreign",
        F.when(order % 97 == 0, F.lit(0)).otherwise(whole("l_quantity")).cast("bigint").alias("quantity_kg"),
        F.when(order % 89 != 0, whole("l_extendedprice")).cast("bigint").alias("amount_yen"),
    )


def weather_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """One observation per order, at one of 47 stations."""
    orders = read(spark, folder, "orders")
    key = F.col("o_orderkey")
    station = F.col("o_custkey") % len(V.STATIONS)
    when = F.timestamp_seconds(F.unix_timestamp("o_orderdate") + (key % 24) * 3600)
    return orders.select(
        _pick([s[0] for s in V.STATIONS], station).alias("station_id"),
        F.when(key % 50 != 7, _pick([s[1] for s in V.STATIONS], station)).alias("station_name"),
        when.alias("observation_datetime"),
        ((key * 7) % 420 / 10.0 - 6.05).alias("temperature"),
        ((key * 11) % 1010 / 10.0).alias("humidity"),
        F.when(key % 13 != 0, (key * 5) % 97 / 10.0).alias("precipitation"),
        ((key * 3) % 123 / 10.0).alias("wind_speed"),
        ((key * 17) % 3610 / 10.0).alias("wind_direction"),
        F.when(key % 2 == 0, (key % 11) / 10.0).alias("sunshine"),
        F.timestamp_seconds(key).alias("created_at"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw forecasts: the item's mean price of a month times a factor, one year ahead,
    for seven model names and two generation times, with some bad and missing values."""
    from ..functions.numeric import round_to, unit_price

    price = unit_price()
    monthly = (
        trades(spark, folder)
        .filter((F.col("quantity_kg") > 0) & (F.col("amount_yen") > 0) & price.between(1, 10000))
        .groupBy("item_name", "item_code", "year", "month")
        .agg(round_to(F.avg(price), 2).alias("p"), F.count(F.lit(1)).cast("bigint").alias("c"))
    )
    rows = monthly.withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(len(MODEL_NAMES) - 1)))).withColumn(
        "g", F.explode(F.sequence(F.lit(0), F.lit(1)))
    )
    m, g, c = F.col("m").cast("bigint"), F.col("g").cast("bigint"), F.col("c")
    base = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
    target = F.add_months(base, 12)
    model = _pick(MODEL_NAMES, F.col("m"))
    h = c * 31 + F.col("month") * 7 + m * 13 + g * 5
    p = F.col("p")
    text = lambda d: F.date_format(d, "yyyy-MM-dd")
    return rows.select(
        F.concat_ws("_", "item_code", F.col("m").cast("string"), F.col("g").cast("string"), F.date_format(target, "yyyyMM")).alias("prediction_id"),
        F.when(h % 53 == 0, "not a date").otherwise(text(target)).alias("prediction_date"),
        F.year(target).cast("string").alias("prediction_year"),
        F.month(target).cast("string").alias("prediction_month"),
        F.concat(text(F.date_add(base, (g * 3 + m).cast("int"))), F.lit(" 06:30:00")).alias("prediction_generated_at"),
        F.concat(F.lit("　"), "item_name", F.lit(" ")).alias("item_name"),
        F.when(h % 3 == 0, F.lit(None)).otherwise(" 大田　").alias("market"),
        F.when(h % 4 == 0, F.lit(None)).otherwise("青森県").alias("origin"),
        model.alias("model_type"),
        F.when(h % 5 != 0, F.concat(F.lit("v"), F.col("m").cast("string"))).alias("model_version"),
        (p * (F.lit(0.7) + (h % 8) * 0.1)).cast("string").alias("predicted_price"),
        F.when(h % 6 != 0, p * 0.65).alias("lower_bound_price"),
        F.when(h % 7 != 0, p * 1.6).alias("upper_bound_price"),
        F.when(h % 9 != 0, (h % 4) * 0.1 + 0.6).alias("confidence_interval"),
        (h % 40 + 6).cast("string").alias("training_data_points"),
        text(F.add_months(base, -24)).alias("training_period_start"),
        text(base).alias("training_period_end"),
        F.when(h % 11 == 0, 0.0).when(h % 10 != 0, p).alias("last_actual_price"),
        text(base).alias("last_actual_date"),
        F.when(h % 8 != 0, (h % 250) * 1.25).alias("model_mae"),
        ((h % 250) * 3.5).alias("model_mse"),
        ((h % 250) * 1.75).alias("model_rmse"),
        F.when(h % 12 != 0, (h % 48) / 10.0 - 2.4).cast("string").alias("model_r2"),
        F.when(h % 14 != 0, (h % 7) / 10.0 + 0.35).alias("data_quality_score"),
        F.lit("MEDIUM").alias("prediction_reliability"),
        F.concat(text(base), F.lit(" 07:00:00")).alias("created_at"),
        F.when(h % 2 == 0, F.concat(text(base), F.lit(" 08:00:00"))).alias("updated_at"),
    )


def job_log(spark: SparkSession, folder: str) -> DataFrame:
    """Query jobs from the event stream."""
    events = read(spark, folder, "events")
    return events.select(
        F.col("ts").alias("creation_time"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), "QUERY").otherwise("LOAD").alias("job_type"),
        F.when(F.col("event_id") % 17 == 0, "RUNNING").otherwise("DONE").alias("state"),
        F.when(F.col("user_id") % 5 == 0, "other").otherwise("market").alias("project_id"),
        F.when(F.col("event_id") % 19 != 0, F.floor(F.col("value") * 1e7)).cast("bigint").alias("total_bytes_processed"),
    )


def stored_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Object listing: one stored page per row."""
    return read(spark, folder, "pages").select(
        F.concat(F.lit("bucket-"), (F.col("page_id") % 4).cast("string")).alias("bucket"),
        F.when(F.col("page_id") % 29 != 0, F.length("html").cast("bigint") * 1024).alias("length"),
    )


def link_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages whose links to words with ``t`` are turned into links to market files."""
    page = F.col("page_id")
    month = F.when(page % 13 == 0, "").otherwise(F.lpad((page % 13).cast("string"), 2, "0"))
    target = F.concat(
        F.lit('href="/documents/d/shijou/y'),
        (F.lit(1995) + (page % 40)).cast("string"),
        month,
        F.when(page % 2 == 0, 'meisai.xlsx"').otherwise('meisai_20240131"'),
    )
    html = F.regexp_replace(F.col("html"), F.lit('href="/t[^"]*"'), target)
    return read(spark, folder, "pages").select("page_id", html.alias("html"))


def ingest_results(spark: SparkSession, folder: str) -> DataFrame:
    """Load results: one per order, read as one file each."""
    orders = read(spark, folder, "orders")
    key = F.col("o_orderkey")
    failed = key % 11 == 0
    return orders.select(
        (~failed).alias("success"),
        F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("_"), key.cast("string"), F.lit(".csv")).alias("filename"),
        F.when(failed, "load error").when(F.col("o_orderstatus") == "F", "skipped").otherwise("processed").alias("message"),
        F.when(failed, F.lit(0)).otherwise(F.col("o_custkey")).cast("bigint").alias("records_processed"),
        F.when(key % 7 != 0, (key % 1000) / 10.0).alias("data_quality_score"),
    )


def model_records(spark: SparkSession, folder: str) -> DataFrame:
    """Saved-model records: one JSON text per document source and length class."""
    docs = read(spark, folder, "documents")
    grouped = docs.groupBy(F.floor(F.col("n_chars") / 200).cast("bigint").alias("k")).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.sort_array(F.collect_set("lang")).alias("model_types"),
        F.sort_array(F.collect_set("source")).alias("items_covered"),
    )
    created = F.concat(F.lit("2001-"), F.lpad((F.col("k") % 12 + 1).cast("string"), 2, "0"), F.lit("-01T00:00:00"))
    return grouped.select(
        created.alias("created_at"),
        F.to_json(
            F.struct(
                F.lpad(F.col("k").cast("string"), 6, "0").alias("version"),
                created.alias("created_at"),
                "total_predictions",
                "model_types",
                "items_covered",
            )
        ).alias("json"),
    )
