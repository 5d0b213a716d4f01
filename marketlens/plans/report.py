"""Reports: cheapest items, volatile items, message text, coverage of predictions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.numeric import as_col, round_to
from ..functions.rules import below, classify
from ..operators.ranking import best_per_key, top_rows

NO_MAE = 999.0


def target_month(as_of: dt.date, month: int | None = None) -> tuple[int, int]:
    """The next month, or the next time the given month comes."""
    if month is None:
        return (as_of.year + 1, 1) if as_of.month == 12 else (as_of.year, as_of.month + 1)
    return (as_of.year + 1 if month < as_of.month else as_of.year), month


def confidence_percent(mae="model_mae", r2="model_r2") -> Column:
    """From the error bands where the error is known, else from R2, else 0."""
    m, fit = as_col(mae), as_col(r2)
    value = classify([(m > 0, below(m, V.MAE_CONFIDENCE, 40).cast("double")), (fit >= 0, fit * 100)], F.lit(0.0))
    return round_to(value, 0)


def model_order() -> list[Column]:
    """Small error first, then high R2, then the preferred model, then the newest run."""
    mae, model = F.col("model_mae"), F.col("model_type")
    preferred = classify([(model == name, place) for name, place in V.MODEL_PREFERENCE.items()], 4)
    return [
        F.when(mae > 0, mae).otherwise(F.lit(NO_MAE)).alias("o1"),
        F.coalesce(-F.col("model_r2"), F.lit(float("inf"))).alias("o2"),
        preferred.alias("o3"),
        (-F.unix_seconds("prediction_generated_at")).alias("o4"),
        F.col("prediction_key").alias("o5"),
    ]


def cheapest(
    facts: DataFrame,
    year: int,
    month: int,
    min_confidence: float = 0.7,
    min_points: int = 24,
    count: int = 10,
    models: tuple[str, ...] = ("PROPHET", "LSTM", "ARIMA"),
    min_decrease: float | None = None,
) -> DataFrame:
    """Cheapest items of a month, each with its best model.

    ``min_decrease`` keeps only items at least that share below their last price.
    """
    price, last = F.col("predicted_price"), F.col("last_actual_price")
    rows = facts.filter(
        (F.col("prediction_year") == year)
        & (F.col("prediction_month") == month)
        & (F.col("confidence_interval") >= min_confidence)
        & F.col("prediction_reliability").isin("HIGH", "MEDIUM")
        & (F.col("training_data_points") >= min_points)
        & (price > 0)
        & ~F.col("item_name").contains("その他")
        & F.col("model_type").isin(list(models))
    )
    if min_decrease is not None:
        rows = rows.filter(price <= last * (1 - min_decrease))
    best = best_per_key(rows, ["item_name"], model_order())
    top = top_rows(best, [price.asc(), F.desc("confidence_interval"), F.desc("model_r2"), F.col("item_name")], count)
    return top.select(
        "item_name",
        "model_type",
        round_to(price, 0).alias("predicted_price"),
        round_to(last, 0).alias("current_price"),
        F.lit(None).cast("double").alias("price_change_pct"),
        confidence_percent().alias("confidence_pct"),
        "prediction_reliability",
        round_to(F.coalesce("model_mae", F.lit(NO_MAE)), 1).alias("model_mae"),
        "training_data_points",
        "prediction_date",
        F.to_date("prediction_generated_at").alias("generated_date"),
        price.alias("sort_price"),
        F.col("confidence_interval").alias("sort_confidence"),
        F.col("model_r2").alias("sort_r2"),
    )


def volatile_items(seasonal: DataFrame, month: int, min_points: int = 1, count: int = 5) -> DataFrame:
    """The items whose price varies most in a calendar month, and those that vary least."""
    stats = (
        seasonal.filter(F.col("month") == month)
        .groupBy("item_name")
        .agg(
            round_to(F.avg("avg_monthly_price"), 0).alias("historical_avg_price"),
            F.count(F.lit(1)).alias("data_points"),
            round_to(F.stddev_samp("avg_monthly_price"), 0).alias("price_volatility"),
        )
        .filter(F.col("data_points") >= min_points)
    )
    first = [F.col("price_volatility").desc_nulls_last(), F.col("item_name").asc()]
    last = [F.col("price_volatility").asc_nulls_first(), F.col("item_name").desc()]
    return top_rows(stats, first, count).withColumn("kind", F.lit("volatile")).unionByName(
        top_rows(stats, last, count).withColumn("kind", F.lit("stable"))
    )


def empty_text(month: int, status: str, model_available: bool) -> str:
    """Message when there is no prediction for the month, by state of the batch."""
    name = f"{month:02d}月"
    # Message texts.
    if status == "failure":
        return f"*{name}の価格予測処理でエラーが発生しました* [ERROR]\n\n次回の処理実行をお待ちください。"
    if status == "success":
        return (
            f"*{name}の価格予測データが空です*\n\nML予測は成功しましたが、dbt変換でエラーが発生している可能性があります。\n"
            "データエンジニアに確認を依頼してください。"
        )
    if not model_available:
        return f"*{name}の価格予測データはまだ準備中です* 🔄\n\nML予測処理の完了をお待ちください。"
    return f"*{name}の野菜価格予測データが準備できていません*\n\n予測処理の完了をお待ちください。"


# Texts of the message.
MESSAGE = {
    "error": " | 予測誤差 ",
    "yen": "円",
    "good": " (良好)",
    "place": "位: ",
    "price": "円/kg\n　予測精度: ",
    "model": "\n*予測モデル情報*\nバージョン: ",
    "items": " | 対象品目: ",
    "updated": "品目 | 更新: ",
    "header": "AI予測による{}の野菜価格ランキング（安い順）\n\n",
    "title": "{}の安い野菜TOP10",
    "movers": "*{}によく変動する野菜*: ",
    "comma": "、",
}


def _whole(value: str) -> Column:
    return F.col(value).cast("bigint").cast("string")


def message(
    top: DataFrame, movers: DataFrame, metadata: DataFrame, month: int, status: str = "unknown"
) -> DataFrame:
    """One row: header, ranking text, seasonal line and model line."""
    name = f"{month:02d}月"
    order = Window.orderBy("sort_price", F.desc("sort_confidence"), F.desc("sort_r2"), "item_name")
    # At most ten rows reach this window.
    placed = top.withColumn("place", F.row_number().over(order))
    error = F.when(
        F.col("model_mae") != NO_MAE,
        F.concat(
            F.lit(MESSAGE["error"]), F.col("model_mae").cast("string"), F.lit(MESSAGE["yen"]),
            F.when(F.col("model_mae") < 50, F.lit(MESSAGE["good"])).otherwise(""),
        ),
    ).otherwise("")
    line = F.concat(
        F.lit("**"), F.col("place").cast("string"), F.lit(MESSAGE["place"]), "item_name", F.lit("** - "), _whole("predicted_price"),
        F.lit(MESSAGE["price"]), _whole("confidence_pct"), F.lit("% | "), "model_type", error, F.lit("\n\n"),
    )
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda s: s["t"]), "")
    ranking = placed.agg(
        joined(F.struct("place", line.alias("t"))).alias("lines"), F.count(F.lit(1)).alias("items")
    )
    three = movers.filter("kind = 'volatile'").orderBy(F.col("price_volatility").desc_nulls_last(), "item_name").limit(3)
    names = three.agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct((-F.col("price_volatility")).alias("v"), "item_name"))),
                lambda s: s["item_name"],
            ),
            MESSAGE["comma"],
        )
    )
    model = metadata.agg(
        F.max(
            F.concat(
                F.lit(MESSAGE["model"]), "version", F.lit(MESSAGE["items"]), F.col("items_covered").cast("string"),
                F.lit(MESSAGE["updated"]), F.substring("created_at", 1, 10),
            )
        )
    )
    parts = ranking.select(
        "items", "lines", names.scalar().alias("names"), model.scalar().alias("model_text")
    )
    full = F.concat(F.lit(MESSAGE["header"].format(name)), "lines")
    missing = F.when(
        F.col("model_text").isNull(), F.lit(empty_text(month, status, False))
    ).otherwise(F.lit(empty_text(month, status, True)))
    return parts.select(
        F.lit(MESSAGE["title"].format(name)).alias("title"),
        "items",
        F.when(F.col("items") > 0, full).otherwise(missing).alias("ranking_text"),
        F.when(F.col("names") != "", F.concat(F.lit(MESSAGE["movers"].format(name)), "names")).otherwise("").alias("seasonal_text"),
        F.coalesce("model_text", F.lit("")).alias("model_text"),
    )


def prediction_counts(predictions: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    return predictions.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def batch_counts(predictions: DataFrame) -> DataFrame:
    """Rows per model and per month label, with the covered span."""
    by_model = prediction_counts(predictions.select(F.col("model_type").alias("label")), ["label"], "predictions")
    label = F.concat(F.date_format("prediction_date", "yyyy年MM"), F.lit("月"))
    by_month = prediction_counts(predictions.select(label.alias("label")), ["label"], "predictions")
    return by_model.withColumn("kind", F.lit("model")).unionByName(by_month.withColumn("kind", F.lit("month")))


def coverage(raw: DataFrame, mart: DataFrame, first_year: int) -> DataFrame:
    """Prediction rows per month in the raw table and in the fact table, and what lacks."""
    keys = ["prediction_year", "prediction_month"]
    typed = lambda df: df.select(*[F.col(k).cast("bigint").alias(k) for k in keys]).filter(
        F.col("prediction_year") >= first_year
    )
    both = prediction_counts(typed(raw), keys, "raw_rows").join(
        prediction_counts(typed(mart), keys, "mart_rows"), keys, "full"
    )
    return both.withColumn(
        "state",
        classify(
            [(F.col("mart_rows").isNull(), "missing in mart"), (F.col("raw_rows").isNull(), "missing in raw"),
             (F.col("mart_rows") < F.col("raw_rows"), "partly filtered")],
            "complete",
        ),
    )
