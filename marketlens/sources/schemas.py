"""Fixed schemas of the raw tables and of the small control tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "l": T.LongType(),
    "d": T.DoubleType(),
    "date": T.DateType(),
    "ts": T.TimestampType(),
    "b": T.BooleanType(),
    "i": T.IntegerType(),
    "as": T.ArrayType(T.StringType()),
}


def schema(spec: str) -> T.StructType:
    """``"name:type"`` pairs; a trailing ``!`` marks a required column."""
    fields = []
    for part in spec.split():
        name, kind = part.rstrip("!").split(":")
        fields.append(T.StructField(name, _TYPES[kind], not part.endswith("!")))
    return T.StructType(fields)


TRADES = schema(
    "year_month_slash:s year_month_num:s year:l month:l market_code:s market:s major_category_code:s"
    " major_category:s sub_category_code:s sub_category:s item_code:s item_name:s origin_code:s origin:s"
    " domestic_foreign:s quantity_kg:l amount_yen:l"
)
WEATHER = schema(
    "year:l month:l day:l hour:l precipitation:d temperature:d humidity:d wind_direction:d wind_speed:d"
    " sunshine:d station_id:s! station_name:s region:s observation_datetime:ts! created_at:ts"
)
PREDICTIONS = schema(
    "prediction_id:s prediction_date:date prediction_year:l prediction_month:l prediction_generated_at:ts"
    " item_name:s market:s origin:s model_type:s model_version:s predicted_price:d lower_bound_price:d"
    " upper_bound_price:d confidence_interval:d training_data_points:l training_period_start:date"
    " training_period_end:date last_actual_price:d last_actual_date:date model_mae:d model_mse:d"
    " model_rmse:d model_r2:d model_mape:d model_smape:d model_mase:d data_quality_score:d"
    " prediction_reliability:s created_at:ts updated_at:ts"
)
STATIONS = schema("station_id:s station_name:s region:s priority:i")
USAGE_LOG = schema(
    "usage_date:date service_name:s resource_type:s usage_amount:d usage_unit:s free_tier_limit:d"
    " usage_percentage:d cost_usd:d check_time:ts"
)
MODEL_METADATA = schema(
    "version:s created_at:s total_predictions:l model_types:as items_covered:as environment:s"
)
