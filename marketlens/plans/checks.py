"""Declared data tests of the staging views and the tables.

Year bounds depend on the period under analysis and are arguments.
"""

from __future__ import annotations

from ..functions import vocabulary as V
from ..operators.quality import Checks

_MONTH = (1, 12)
_SEASONS = ["春", "夏", "秋", "冬"]
_DEMAND = ["夏野菜需要期", "冬野菜需要期", "春端境期", "秋端境期", "通常期"]
_REGIONS = ["北海道", "東北", "関東", "中部", "近畿", "中国", "四国", "九州・沖縄", "輸入", "不明"]
_TRENDS = ["PRICE_INCREASE", "PRICE_DECREASE", "PRICE_STABLE"]
_HORIZONS = ["SHORT_TERM", "MEDIUM_TERM", "LONG_TERM"]
_TRUST = ["HIGH", "MEDIUM", "LOW", "VERY_LOW"]
_VOLATILITY = ["高変動", "中変動", "低変動", "安定"]
_FROM_ZERO = (0, None)


def declared(first_year: int, last_year: int) -> dict[str, Checks]:
    """Checks by table name. Columns, lists and bounds."""
    years = (first_year, last_year)
    return {
        "stg_trades": Checks(
            not_null=("year", "month", "market", "major_category", "item_name", "quantity_kg", "amount_yen"),
            values={"major_category": ["野菜"]},
            ranges={"month": _MONTH, "quantity_kg": _FROM_ZERO, "amount_yen": _FROM_ZERO},
        ),
        "stg_weather": Checks(
            not_null=("station_id", "station_name", "observation_datetime", "observation_date", "observation_year",
                      "observation_month", "observation_day", "observation_hour"),
            ranges={"humidity": (0, 100), "precipitation": _FROM_ZERO, "wind_speed": _FROM_ZERO, "wind_direction": (0, 360),
                    "sunshine": _FROM_ZERO, "observation_month": _MONTH, "observation_day": (1, 31), "observation_hour": (0, 23)},
        ),
        "stg_predictions": Checks(
            not_null=("prediction_id", "prediction_date", "prediction_year", "prediction_month", "prediction_generated_at",
                      "item_name", "model_type", "model_version", "predicted_price", "training_data_points", "created_at"),
            values={"model_type": V.MODEL_TYPES, "prediction_reliability": _TRUST},
            ranges={"prediction_year": years, "prediction_month": _MONTH, "predicted_price": (1, 100000),
                    "lower_bound_price": (-50000, 100000), "upper_bound_price": (-10000, 100000), "confidence_interval": (0, 1),
                    "training_data_points": (1, 300000), "last_actual_price": (-50000, 100000), "model_mae": _FROM_ZERO,
                    "model_mse": _FROM_ZERO, "model_rmse": _FROM_ZERO, "model_r2": (-1, 1), "data_quality_score": (0, 1)},
        ),
        "fact_predictions": Checks(
            unique=("prediction_key",),
            not_null=("prediction_key", "prediction_date", "prediction_year", "prediction_month", "prediction_quarter",
                      "prediction_season", "prediction_generated_at", "forecast_horizon_days", "item_name", "market", "origin",
                      "model_type", "model_version", "predicted_price", "training_data_points", "created_at", "updated_at"),
            values={"prediction_season": _SEASONS, "model_type": V.MODEL_TYPES, "prediction_reliability": _TRUST,
                    "prediction_horizon_type": _HORIZONS, "predicted_price_trend": _TRENDS},
            ranges={"prediction_year": years, "prediction_month": _MONTH, "prediction_quarter": (1, 4),
                    "forecast_horizon_days": (-3650, 10950), "predicted_price": (1, 50000), "lower_bound_price": (-50000, 100000),
                    "upper_bound_price": (-10000, 100000), "prediction_range": _FROM_ZERO, "confidence_interval": (0, 1),
                    "training_data_points": (1, 300000), "training_period_days": (365, None), "last_actual_price": (-10000, 100000),
                    "prediction_lead_time_days": (1, None), "model_mae": _FROM_ZERO, "model_mse": _FROM_ZERO,
                    "model_rmse": _FROM_ZERO, "model_r2": (-1, 1), "data_quality_score": (0, 1),
                    "predicted_price_change_pct": (-95, 500)},
        ),
        "mart_dashboard": Checks(
            not_null=("prediction_date", "item_name", "model_type", "predicted_price", "dashboard_updated_at"),
            values={"predicted_price_trend": _TRENDS, "prediction_horizon_type": _HORIZONS, "prediction_reliability": _TRUST,
                    "prediction_category": ["大幅上昇予測", "上昇予測", "安定予測", "下落予測", "大幅下落予測"],
                    "overall_confidence": ["高信頼度", "中信頼度", "低信頼度"]},
            ranges={"predicted_price": (1, 50000), "lower_bound_price": (-50000, 100000), "upper_bound_price": (-10000, 100000),
                    "prediction_range": _FROM_ZERO, "confidence_interval": (0, 1), "predicted_price_change_pct": (-95, 500),
                    "last_actual_price": (-10000, 100000), "data_quality_score": (0.5, 1), "model_accuracy_rank": (1, None),
                    "increase_consensus_pct": (0, 100), "decrease_consensus_pct": (0, 100), "stable_consensus_pct": (0, 100)},
        ),
        "dim_market": Checks(unique=("market_key",), not_null=("market_key", "market")),
        "dim_station": Checks(
            unique=("station_key",), not_null=("station_key", "station_id", "station_name", "is_agriculture_priority", "region")
        ),
        "fact_weather_daily": Checks(
            not_null=("observation_date", "observation_year", "observation_month", "observation_day", "station_id", "station_key"),
            ranges={"observation_month": _MONTH, "observation_day": (1, 31), "avg_humidity": (0, 100),
                    "max_precipitation_1h": _FROM_ZERO, "total_precipitation": _FROM_ZERO, "avg_wind_speed": _FROM_ZERO,
                    "max_wind_speed": _FROM_ZERO, "total_sunshine": _FROM_ZERO},
            parents={"station_key": ("dim_station", "station_key")},
        ),
        "dim_location": Checks(
            unique=("location_key",),
            not_null=("location_key", "origin_name", "prefecture", "region", "is_agriculture_priority", "has_weather_data"),
            values={"region": _REGIONS},
        ),
        "dim_time": Checks(
            unique=("time_key",),
            not_null=("time_key", "year", "month", "season_japanese", "quarter", "fiscal_year", "vegetable_demand_period"),
            values={"season_japanese": _SEASONS, "vegetable_demand_period": _DEMAND},
            ranges={"year": years, "month": _MONTH, "quarter": (1, 4)},
        ),
        "dim_item": Checks(
            unique=("item_key",),
            not_null=("item_key", "item_name", "major_category", "price_tier", "vegetable_category", "seasonality",
                      "storage_durability", "is_frequent_item"),
            values={"price_tier": ["高級品", "中級品", "一般品", "低価格品"],
                    "vegetable_category": [*V.ITEM_CATEGORY, V.ITEM_CATEGORY_DEFAULT],
                    "seasonality": [*V.ITEM_SEASON, V.ITEM_SEASON_DEFAULT],
                    "storage_durability": [*V.ITEM_STORAGE, V.ITEM_STORAGE_DEFAULT]},
            ranges={"avg_unit_price_yen": _FROM_ZERO},
        ),
        "mart_price_weather": Checks(
            not_null=("year", "month", "item_name", "market", "origin", "origin_prefecture", "total_amount_yen", "avg_unit_price_yen"),
            values={"price_trend_category": ["高値圏", "安値圏", "通常圏"],
                    "precipitation_category": ["多雨", "普通", "少雨", "不明"],
                    "temperature_category": ["暑い", "普通", "寒い", "不明"],
                    "weather_data_quality": ["COMPLETE", "PARTIAL", "INSUFFICIENT"]},
            ranges={"month": _MONTH, "total_amount_yen": _FROM_ZERO, "avg_unit_price_yen": _FROM_ZERO,
                    "price_3month_moving_avg": _FROM_ZERO, "price_6month_moving_avg": _FROM_ZERO, "total_precipitation": _FROM_ZERO},
        ),
        "mart_seasonal": Checks(
            not_null=("item_name", "month", "season", "vegetable_demand_period", "vegetable_category", "seasonality_pattern",
                      "avg_monthly_price", "price_rank_high_to_low", "quantity_rank_high_to_low", "seasonality_strength"),
            values={"season": _SEASONS, "vegetable_demand_period": _DEMAND,
                    "vegetable_category": [*V.ITEM_CATEGORY_SEASONAL, V.ITEM_CATEGORY_DEFAULT],
                    "seasonality_pattern": ["春野菜", "夏野菜", "秋野菜", "冬野菜", "通年野菜"],
                    "seasonality_level": ["高季節性", "中季節性", "低季節性", "季節性なし"],
                    "price_volatility_level": _VOLATILITY},
            ranges={"month": _MONTH, "avg_monthly_price": _FROM_ZERO, "seasonal_quantity_index": _FROM_ZERO,
                    "price_rank_high_to_low": (1, 12), "quantity_rank_high_to_low": (1, 12), "seasonality_strength": _FROM_ZERO},
        ),
        "price_movement": Checks(
            unique=("price_movement_key",),
            not_null=("price_movement_key", "year", "month", "price_date", "item_name", "market", "origin", "avg_unit_price_yen"),
            values={"price_trend_direction": ["上昇トレンド", "下降トレンド", "横這い", "不安定"],
                    "price_range_category": ["高値圏", "やや高値", "適正圏", "やや安値", "安値圏"],
                    "volatility_level": _VOLATILITY,
                    "price_anomaly_status": ["異常値", "要注意", "監視対象", "正常範囲"],
                    "short_term_movement": ["急激変動", "大幅変動", "通常変動", "微小変動"],
                    "data_quality_level": ["HIGH", "MEDIUM", "LOW", "INSUFFICIENT"]},
            ranges={"month": _MONTH, "avg_unit_price_yen": _FROM_ZERO, "price_3month_ma": _FROM_ZERO, "price_6month_ma": _FROM_ZERO,
                    "price_12month_ma": _FROM_ZERO, "price_volatility_12m": _FROM_ZERO},
        ),
    }
