"""Plain SQL with the same meaning as the registered queries, for a row-by-row check.

Every query is one statement over the driver's tables. Shared steps are named subqueries;
``sql`` puts the ones a query needs in front of it.
"""

from __future__ import annotations

import re

from .functions import vocabulary as V
from .sources import tables as S

STEPS: dict[str, str] = {}


def step(name: str, text: str) -> None:
    STEPS[name] = text.strip()


def sql(body: str) -> str:
    """Prefix ``body`` with the steps it uses, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\bt_\w+", text)):
            if word in STEPS and word not in needed:
                needed.add(word)
                visit(STEPS[word])

    visit(body)
    listed = [f"{name} AS (\n{STEPS[name]}\n)" for name in STEPS if name in needed]
    # A step that names itself is recursive.
    looped = any(re.search(rf"\b{name}\b", STEPS[name]) for name in needed)
    return (("WITH RECURSIVE " if looped else "WITH ") + ",\n".join(listed) + "\n" if listed else "") + body.strip()


# -- expressions ----------------------------------------------------------------------


def r(x: str, n: int) -> str:
    p = f"1e{n}"
    return (
        f"(CASE WHEN ({x}) >= 0 THEN floor(({x}) * {p} + 0.500001::DOUBLE) / {p}"
        f" ELSE 0::DOUBLE - floor(0.500001::DOUBLE - ({x}) * {p}) / {p} END)"
    )


def div(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def pct(a: str, b: str, n: int = 2) -> str:
    return r(f"{div(f'({a}) - ({b})', b)} * 100", n)


def q(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value + "'" if isinstance(value, str) else str(value)


def steps_case(x: str, steps, default, op: str = ">", null_label: str | None = None) -> str:
    lines = [f"WHEN {x} {op} {bound} THEN {q(label)}" for bound, label in steps]
    if null_label:
        lines.append(f"WHEN {x} IS NULL THEN {q(null_label)}")
    return f"(CASE {' '.join(lines)} ELSE {q(default)} END)"


def member_case(x: str, groups, default=None) -> str:
    lines = [f"WHEN {x} IN ({', '.join(q(m) for m in members)}) THEN {q(label)}" for label, members in groups.items()]
    return f"(CASE {' '.join(lines)} ELSE {q(default)} END)"


def words_case(x: str, groups, default) -> str:
    lines = [
        "WHEN " + " OR ".join(f"contains({x}, {q(w)})" for w in words) + f" THEN {q(label)}"
        for label, words in groups.items()
    ]
    return f"(CASE {' '.join(lines)} ELSE {q(default)} END)"


def mapping_case(x: str, table) -> str:
    return "(CASE " + " ".join(f"WHEN {x} = {q(k)} THEN {q(v)}" for k, v in table.items()) + " END)"


def relative_case(x: str, base: str, ups, downs, default: str) -> str:
    lines = [f"WHEN {x} > {base} * {f}::DOUBLE THEN {q(l)}" for f, l in ups]
    lines += [f"WHEN {x} < {base} * {f}::DOUBLE THEN {q(l)}" for f, l in downs]
    return f"(CASE {' '.join(lines)} ELSE {q(default)} END)"


def listed(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


# -- source tables --------------------------------------------------------------------

step("t_trades", f"""
SELECT year(l_shipdate)::BIGINT AS year, month(l_shipdate)::BIGINT AS month,
       {listed(S.MARKET_NAMES)}[n_regionkey + 1] AS market,
       CASE WHEN l_partkey % 10 = 0 THEN '果　実' WHEN l_partkey % 3 = 0 THEN '野　菜'
            WHEN l_partkey % 3 = 1 THEN '野 菜' ELSE '野菜' END AS major_category,
       CASE WHEN l_partkey % 20 = 1 THEN NULL WHEN l_partkey % 4 = 2 THEN '加工' ELSE '生鮮' END AS sub_category,
       split_part(p_name, ' ', 2) AS item_code,
       {mapping_case("split_part(p_name, ' ', 2)", S.ITEM_NAMES)} AS item_name,
       {listed(S.ORIGIN_NAMES)}[n_nationkey + 1] AS origin,
       CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE round(l_quantity) END::BIGINT AS quantity_kg,
       CASE WHEN l_orderkey % 89 <> 0 THEN round(l_extendedprice) END::BIGINT AS amount_yen
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey
""")
step("t_stg", """
SELECT year, month, market, regexp_replace(major_category, '[ 　]+', '', 'g') AS major_category,
       sub_category, item_code, item_name, origin, quantity_kg, amount_yen
FROM t_trades WHERE regexp_replace(major_category, '[ 　]+', '', 'g') = '野菜'
""")
step("t_valid", """
SELECT *, amount_yen::DOUBLE / quantity_kg AS up FROM t_stg
WHERE quantity_kg > 0 AND amount_yen > 0 AND item_name IS NOT NULL
""")
step("t_weather", f"""
SELECT {listed([s[0] for s in V.STATIONS])}[o_custkey % 47 + 1] AS station_id,
       CASE WHEN o_orderkey % 50 <> 7 THEN {listed([s[1] for s in V.STATIONS])}[o_custkey % 47 + 1] END AS station_name,
       o_orderdate + to_hours((o_orderkey % 24)::INTEGER) AS observation_datetime,
       (o_orderkey * 7) % 420 / 10::DOUBLE - 6.05::DOUBLE AS temperature,
       (o_orderkey * 11) % 1010 / 10::DOUBLE AS humidity,
       CASE WHEN o_orderkey % 13 <> 0 THEN (o_orderkey * 5) % 97 / 10::DOUBLE END AS precipitation,
       (o_orderkey * 3) % 123 / 10::DOUBLE AS wind_speed,
       (o_orderkey * 17) % 3610 / 10::DOUBLE AS wind_direction,
       CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 11) / 10::DOUBLE END AS sunshine,
       o_orderkey AS created
FROM orders
""")
step("t_stg_weather", f"""
SELECT station_id, station_name, observation_datetime,
       {r('temperature', 1)} AS temperature, {r('humidity', 1)} AS humidity, {r('precipitation', 1)} AS precipitation,
       {r('wind_speed', 1)} AS wind_speed, {r('wind_direction', 1)} AS wind_direction, {r('sunshine', 1)} AS sunshine,
       observation_datetime::DATE AS observation_date, year(observation_datetime)::BIGINT AS observation_year,
       month(observation_datetime)::BIGINT AS observation_month, day(observation_datetime)::BIGINT AS observation_day,
       hour(observation_datetime)::BIGINT AS observation_hour
FROM t_weather WHERE station_name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY station_id, observation_datetime ORDER BY created DESC) = 1
""")
step("t_base_predictions", f"""
SELECT item_name, item_code, year, month, {r('avg(up)', 2)} AS p, count(*) AS c
FROM (SELECT item_name, item_code, year, month, amount_yen::DOUBLE / quantity_kg AS up FROM t_trades
      WHERE quantity_kg > 0 AND amount_yen > 0) WHERE up BETWEEN 1 AND 10000
GROUP BY item_name, item_code, year, month
""")
step("t_predictions", f"""
SELECT item_code || '_' || m || '_' || g || '_' || strftime(target, '%Y%m') AS prediction_id,
       CASE WHEN h % 53 = 0 THEN 'not a date' ELSE strftime(target, '%Y-%m-%d') END AS prediction_date,
       year(target)::BIGINT AS prediction_year, month(target)::BIGINT AS prediction_month,
       base + to_days((g * 3 + m)::INTEGER) + INTERVAL 390 MINUTE AS prediction_generated_at,
       '　' || item_name || ' ' AS item_name,
       CASE WHEN h % 3 = 0 THEN NULL ELSE ' 大田　' END AS market,
       CASE WHEN h % 4 = 0 THEN NULL ELSE '青森県' END AS origin,
       {listed(S.MODEL_NAMES)}[m + 1] AS model_type,
       CASE WHEN h % 5 <> 0 THEN 'v' || m END AS model_version,
       p * (0.7::DOUBLE + (h % 8) * 0.1::DOUBLE) AS predicted_price,
       CASE WHEN h % 6 <> 0 THEN p * 0.65::DOUBLE END AS lower_bound_price,
       CASE WHEN h % 7 <> 0 THEN p * 1.6::DOUBLE END AS upper_bound_price,
       CASE WHEN h % 9 <> 0 THEN (h % 4) * 0.1::DOUBLE + 0.6::DOUBLE END AS confidence_interval,
       h % 40 + 6 AS training_data_points,
       (base - INTERVAL 24 MONTH)::DATE AS training_period_start, base AS training_period_end,
       CASE WHEN h % 11 = 0 THEN 0::DOUBLE WHEN h % 10 <> 0 THEN p END AS last_actual_price,
       base AS last_actual_date,
       CASE WHEN h % 8 <> 0 THEN (h % 250) * 1.25::DOUBLE END AS model_mae,
       (h % 250) * 3.5::DOUBLE AS model_mse, (h % 250) * 1.75::DOUBLE AS model_rmse,
       CASE WHEN h % 12 <> 0 THEN (h % 48) / 10::DOUBLE - 2.4::DOUBLE END AS model_r2,
       CASE WHEN h % 14 <> 0 THEN (h % 7) / 10::DOUBLE + 0.35::DOUBLE END AS data_quality_score,
       'MEDIUM' AS prediction_reliability,
       base + INTERVAL 7 HOUR AS created_at,
       CASE WHEN h % 2 = 0 THEN base + INTERVAL 8 HOUR END AS updated_at
FROM (SELECT *, c * 31 + month * 7 + m * 13 + g * 5 AS h, make_date(year, month, 1) AS base,
             (make_date(year, month, 1) + INTERVAL 12 MONTH)::DATE AS target
      FROM t_base_predictions, range(7) AS a(m), range(2) AS b(g))
""")
step("t_stg_predictions", f"""
SELECT * REPLACE (
  try_cast(prediction_date AS DATE) AS prediction_date,
  trim(upper(item_name), ' 　') AS item_name, trim(market, ' 　') AS market, trim(origin, ' 　') AS origin,
  upper(trim(model_type)) AS model_type, coalesce(model_version, '1.0') AS model_version,
  {r('predicted_price', 2)} AS predicted_price, {r('lower_bound_price', 2)} AS lower_bound_price,
  {r('upper_bound_price', 2)} AS upper_bound_price, {r('last_actual_price', 2)} AS last_actual_price,
  {r('model_mae', 2)} AS model_mae, {r('model_mse', 2)} AS model_mse, {r('model_rmse', 2)} AS model_rmse,
  CASE WHEN model_r2 IS NOT NULL THEN greatest(-1::DOUBLE, least(1::DOUBLE, {r('model_r2', 3)})) END AS model_r2)
FROM t_predictions
WHERE try_cast(prediction_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '{S.AS_OF}' + INTERVAL 36 MONTH
  AND predicted_price > 0 AND predicted_price < 10000
  AND upper(trim(model_type)) IN ({', '.join(q(m) for m in V.MODEL_TYPES)})
  AND training_data_points >= 12 AND (model_r2 IS NULL OR model_r2 BETWEEN -10 AND 2)
""")

# -- dimensions -----------------------------------------------------------------------

_regions: dict[str, list[str]] = {}
_pref_regions: dict[str, list[str]] = {}
for _, _name, _code, _region in V.PREFECTURES:
    _regions.setdefault(_region, []).append(_code)
    _pref_regions.setdefault(_region, []).append(_name)
_pref_regions[V.IMPORTED] = [V.IMPORTED]

step("t_dim_market", """
SELECT market, row_number() OVER (ORDER BY market NULLS FIRST) AS market_key FROM (SELECT DISTINCT market FROM t_stg)
""")
step("t_dim_station", f"""
SELECT row_number() OVER (ORDER BY station_name, station_id) AS station_key, station_id, station_name,
       station_id IN ({', '.join(q(s) for s in V.AGRICULTURE_STATIONS)}) AS is_agriculture_priority,
       {member_case('station_id', _regions, V.STATION_REGION_DEFAULT)} AS region,
       {mapping_case('station_id', V.MAIN_CROPS)} AS major_crops
FROM (SELECT DISTINCT station_id, station_name FROM t_stg_weather)
""")


def location_sql(corrected: bool) -> str:
    renamed = {} if corrected else V.PREFECTURE_AS_PUBLISHED
    groups = {renamed.get(name, name): (word,) for word, name, _, _ in V.PREFECTURES}
    groups[V.IMPORTED] = V.IMPORT_WORDS
    cleaned = "regexp_replace(upper(origin), '[県府道都]$', '')"
    text = "upper(origin)" if corrected else cleaned
    codes = {name: code for _, name, code, _ in V.PREFECTURES}
    return f"""
SELECT location_key, origin_name, cleaned_origin, prefecture, station_id,
       {mapping_case('station_id', V.STATION_NAMES)} AS station_name,
       prefecture IN ({', '.join(q(p) for p in V.PRIORITY_PREFECTURES)}) AS is_agriculture_priority,
       {member_case('prefecture', _pref_regions, V.UNKNOWN)} AS region, station_id IS NOT NULL AS has_weather_data
FROM (SELECT *, {mapping_case('prefecture', codes)} AS station_id
      FROM (SELECT row_number() OVER (ORDER BY origin) AS location_key, origin AS origin_name,
                   {cleaned} AS cleaned_origin, {words_case(text, groups, V.UNKNOWN)} AS prefecture
            FROM (SELECT DISTINCT origin FROM t_stg
                  WHERE origin <> '' AND NOT contains(origin, 'その他') AND NOT contains(origin, '計'))))
"""


step("t_dim_location", location_sql(False))


step("t_item", """
SELECT item_name, major_category, sub_category, count(*) AS transaction_count, avg(up) AS mean, stddev_samp(up) AS sd,
       min(up) AS low, max(up) AS high, sum(quantity_kg)::BIGINT AS total_quantity_kg, sum(amount_yen)::BIGINT AS total_amount_yen
FROM t_valid GROUP BY item_name, major_category, sub_category
""")
step("t_dim_item", f"""
SELECT row_number() OVER (ORDER BY item_name, major_category, sub_category NULLS FIRST) AS item_key,
       item_name, major_category, sub_category, transaction_count,
       {r('mean', 2)} AS avg_unit_price_yen, {r('sd', 2)} AS price_volatility,
       {r('low', 2)} AS min_unit_price_yen, {r('high', 2)} AS max_unit_price_yen, total_quantity_kg, total_amount_yen,
       {steps_case('mean', V.PRICE_TIER, V.PRICE_TIER_DEFAULT, '>=')} AS price_tier,
       {steps_case(div('sd', 'mean'), V.PRICE_STABILITY, '安定')} AS price_stability,
       {steps_case('total_quantity_kg', V.VOLUME_TIER, V.VOLUME_TIER_DEFAULT, '>=')} AS volume_tier,
       {words_case('item_name', V.ITEM_CATEGORY, V.ITEM_CATEGORY_DEFAULT)} AS vegetable_category,
       {words_case('item_name', V.ITEM_SEASON, V.ITEM_SEASON_DEFAULT)} AS seasonality,
       {words_case('item_name', V.ITEM_STORAGE, V.ITEM_STORAGE_DEFAULT)} AS storage_durability,
       {words_case('item_name', V.ITEM_USAGE, V.ITEM_USAGE_DEFAULT)} AS cooking_usage,
       {r(div('high - low', 'mean'), 2)} AS price_range_ratio, {r(div('sd', 'mean'), 2)} AS coefficient_of_variation,
       transaction_count >= 10 AS is_frequent_item, coalesce(mean > 0 AND sd > 0, false) AS has_price_data,
       upper(item_name) AS item_name_upper, regexp_replace(item_name, '[^\\p{{L}}\\p{{N}}]', '', 'g') AS item_name_clean,
       {words_case('item_name', V.ITEM_SEASON, V.ITEM_SEASON_DEFAULT)} <> '{V.ITEM_SEASON_DEFAULT}' AS has_seasonality
FROM t_item
""")


def time_sql(months: str, as_of: str) -> str:
    def lead(offset: int) -> str:
        return f"{'lag' if offset < 0 else 'lead'}(time_key, {abs(offset)}) OVER (ORDER BY time_key)"

    return f"""
SELECT *, {lead(-12)} AS previous_year_same_month_key, {lead(-1)} AS previous_month_key,
       {lead(1)} AS next_month_key, {lead(12)} AS next_year_same_month_key
FROM (SELECT row_number() OVER (ORDER BY year, month) AS time_key, year, month,
       strftime(d, '%Y-%m-%d') AS month_start_date, strftime(last_day(d), '%Y-%m-%d') AS month_end_date,
       strftime(d, '%Y%m') AS year_month_str, year || '/' || month AS year_month_slash, strftime(d, '%Y-%m') AS year_month_dash,
       {member_case('month', V.SEASON_JA)} AS season_japanese, {member_case('month', V.SEASON_EN)} AS season_english,
       {member_case('month', V.SEASON_NUMBER)}::BIGINT AS season_number, quarter(d)::BIGINT AS quarter,
       {member_case('month', V.CROP_SEASON)} AS agricultural_season, month || '月' AS month_name_japanese,
       monthname(d) AS month_name_english, left(monthname(d), 3) AS month_abbr,
       CASE WHEN month >= 4 THEN year ELSE year - 1 END AS fiscal_year,
       {member_case('month', V.FISCAL_QUARTER)}::BIGINT AS fiscal_quarter,
       {member_case('month', V.DEMAND_CALENDAR, V.DEMAND_DEFAULT)} AS vegetable_demand_period,
       year = year(DATE '{as_of}') AS is_current_year, year = year(DATE '{as_of}') - 1 AS is_previous_year,
       d <= DATE '{as_of}' AS is_historical
      FROM (SELECT *, make_date(year, month, 1) AS d FROM ({months})))
"""


step("t_dim_time", time_sql("SELECT DISTINCT year, month FROM t_trades", S.AS_OF))


# -- weather --------------------------------------------------------------------------

step("t_daily", """
SELECT observation_date, observation_year, observation_month, observation_day, w.station_id,
       avg(temperature) AS avg_temperature, max(temperature) AS max_temperature, min(temperature) AS min_temperature,
       avg(humidity) AS avg_humidity, max(precipitation) AS max_precipitation_1h, sum(precipitation) AS total_precipitation,
       avg(wind_speed) AS avg_wind_speed, max(wind_speed) AS max_wind_speed, sum(sunshine) AS total_sunshine, any_value(station_key) AS station_key
FROM t_stg_weather w JOIN t_dim_station s ON w.station_id = s.station_id
GROUP BY observation_date, observation_year, observation_month, observation_day, w.station_id
""")
step("t_weather_monthly", f"""
SELECT observation_year AS year, observation_month AS month, {r('avg(avg_temperature)', 1)} AS avg_temperature,
       {r('avg(max_temperature)', 1)} AS avg_max_temperature, {r('avg(min_temperature)', 1)} AS avg_min_temperature,
       {r('avg(avg_humidity)', 1)} AS avg_humidity, {r('sum(total_precipitation)', 1)} AS total_precipitation,
       {r('avg(avg_wind_speed)', 1)} AS avg_wind_speed, {r('avg(total_sunshine)', 1)} AS total_sunshine,
       count(DISTINCT observation_date) AS weather_observation_days
FROM t_daily WHERE station_key IN (SELECT station_key FROM t_dim_station WHERE station_name IN ('東京', '熊谷', '千葉'))
GROUP BY 1, 2
""")

# -- prices ---------------------------------------------------------------------------

_SERIES_WINDOW = "PARTITION BY item_name, market, origin ORDER BY year, month, major_category, sub_category NULLS FIRST"
_TIES = "item_name, market, origin, major_category, sub_category NULLS FIRST"

step("t_monthly", f"""
SELECT year, month, item_name, market, origin, major_category, sub_category,
       sum(quantity_kg)::BIGINT AS total_quantity_kg, sum(amount_yen)::BIGINT AS total_amount_yen,
       {r('avg(up)', 2)} AS avg_unit_price_yen, count(*) AS transaction_count
FROM t_valid GROUP BY ALL
""")
step("t_trend", f"""
SELECT * EXCLUDE (ma3, ma6),
       {pct('total_amount_yen', 'prev_year_amount_yen')} AS yoy_amount_growth_rate,
       {pct('avg_unit_price_yen', 'prev_year_unit_price_yen')} AS yoy_price_growth_rate,
       {pct('total_quantity_kg', 'prev_year_quantity_kg')} AS yoy_quantity_growth_rate,
       {pct('total_amount_yen', 'prev_month_amount_yen')} AS mom_amount_growth_rate,
       {pct('avg_unit_price_yen', 'prev_month_unit_price_yen')} AS mom_price_growth_rate,
       {pct('avg_unit_price_yen', 'ma3')} AS price_deviation_from_3m_avg,
       {relative_case('avg_unit_price_yen', 'ma3', [(1.1, '高値圏')], [(0.9, '安値圏')], '通常圏')} AS price_trend_category,
       {r('ma3', 2)} AS price_3month_moving_avg, {r('ma6', 2)} AS price_6month_moving_avg
FROM (SELECT *, lag(total_amount_yen, 12) OVER s AS prev_year_amount_yen, lag(avg_unit_price_yen, 12) OVER s AS prev_year_unit_price_yen,
             lag(total_quantity_kg, 12) OVER s AS prev_year_quantity_kg, lag(total_amount_yen) OVER s AS prev_month_amount_yen,
             lag(avg_unit_price_yen) OVER s AS prev_month_unit_price_yen,
             avg(avg_unit_price_yen) OVER (s ROWS 2 PRECEDING) AS ma3, avg(avg_unit_price_yen) OVER (s ROWS 5 PRECEDING) AS ma6
      FROM t_monthly WINDOW s AS ({_SERIES_WINDOW}))
""")
_short = {name: (name,) for name in V.SHORT_PREFECTURES}
step("t_price_weather", f"""
SELECT p.* EXCLUDE (transaction_count), {words_case('origin', _short, V.SHORT_PREFECTURE_DEFAULT)} AS origin_prefecture,
       row_number() OVER (PARTITION BY p.year, p.month ORDER BY avg_unit_price_yen DESC, {_TIES}) AS monthly_price_rank,
       w.* EXCLUDE (year, month),
       {steps_case('total_precipitation', V.RAIN_CLASS, '少雨', null_label=V.UNKNOWN)} AS precipitation_category,
       {steps_case('avg_temperature', V.HEAT_CLASS, '寒い', null_label=V.UNKNOWN)} AS temperature_category,
       {steps_case('weather_observation_days', V.WEATHER_COVER, 'INSUFFICIENT', '>=')} AS weather_data_quality
FROM t_trend p LEFT JOIN t_weather_monthly w ON p.year = w.year AND p.month = w.month
""")
step("t_prices", f"""
SELECT year, month, item_name, market, origin, major_category, sub_category,
       {r('avg(up)', 2)} AS avg_unit_price_yen, {r('min(up)', 2)} AS min_unit_price_yen, {r('max(up)', 2)} AS max_unit_price_yen,
       {r('stddev_samp(up)', 2)} AS price_stddev, sum(quantity_kg)::BIGINT AS total_quantity_kg,
       sum(amount_yen)::BIGINT AS total_amount_yen, count(*) AS transaction_count
FROM t_valid WHERE up BETWEEN 1 AND 10000 GROUP BY ALL
""")
step("t_moving", f"""
SELECT *, lag(avg_unit_price_yen, 1) OVER s AS prev_month_price, lag(avg_unit_price_yen, 3) OVER s AS prev_3month_price,
       lag(avg_unit_price_yen, 6) OVER s AS prev_6month_price, lag(avg_unit_price_yen, 12) OVER s AS prev_year_price,
       avg(avg_unit_price_yen) OVER (s ROWS 2 PRECEDING) AS ma3, avg(avg_unit_price_yen) OVER (s ROWS 5 PRECEDING) AS ma6,
       avg(avg_unit_price_yen) OVER (s ROWS 11 PRECEDING) AS ma12, stddev_samp(avg_unit_price_yen) OVER (s ROWS 11 PRECEDING) AS sd12,
       avg(avg_unit_price_yen) OVER (i ROWS 11 PRECEDING) AS item_ma12,
       stddev_samp(avg_unit_price_yen) OVER (i ROWS 11 PRECEDING) AS item_sd12
FROM t_prices WINDOW s AS ({_SERIES_WINDOW}),
     i AS (PARTITION BY item_name ORDER BY year, month, market, origin, major_category, sub_category NULLS FIRST)
""")


def _z(x: str, mean: str, sd: str) -> str:
    return r(div(f"{x} - {mean}", sd), 2)


step("t_measures", f"""
SELECT *, {pct('avg_unit_price_yen', 'prev_month_price')} AS mom_price_change_pct,
       {pct('avg_unit_price_yen', 'prev_3month_price')} AS q3m_price_change_pct,
       {pct('avg_unit_price_yen', 'prev_6month_price')} AS q6m_price_change_pct,
       {pct('avg_unit_price_yen', 'prev_year_price')} AS yoy_price_change_pct,
       {pct('avg_unit_price_yen', 'ma3')} AS deviation_from_3m_ma_pct,
       {pct('avg_unit_price_yen', 'ma6')} AS deviation_from_6m_ma_pct,
       {pct('avg_unit_price_yen', 'ma12')} AS deviation_from_12m_ma_pct,
       {_z('avg_unit_price_yen', 'ma12', 'sd12')} AS price_zscore_12m,
       {_z('avg_unit_price_yen', 'item_ma12', 'item_sd12')} AS item_price_zscore_12m,
       {r(div('sd12', 'ma12'), 3)} AS price_volatility_12m
FROM t_moving
""")
step("t_movement", f"""
SELECT row_number() OVER (ORDER BY year, month, {_TIES}) AS price_movement_key, year, month,
       strftime(make_date(year, month, 1), '%Y-%m-%d') AS price_date, item_name, market, origin, major_category, sub_category,
       avg_unit_price_yen, min_unit_price_yen, max_unit_price_yen, price_stddev, total_quantity_kg, total_amount_yen, transaction_count,
       prev_month_price, prev_3month_price, prev_6month_price, prev_year_price,
       {r('ma3', 2)} AS price_3month_ma, {r('ma6', 2)} AS price_6month_ma, {r('ma12', 2)} AS price_12month_ma,
       mom_price_change_pct, q3m_price_change_pct, q6m_price_change_pct, yoy_price_change_pct,
       deviation_from_3m_ma_pct, deviation_from_6m_ma_pct, deviation_from_12m_ma_pct,
       price_zscore_12m, item_price_zscore_12m, price_volatility_12m,
       CASE WHEN ma3 > ma6 AND ma6 > ma12 THEN '上昇トレンド' WHEN ma3 < ma6 AND ma6 < ma12 THEN '下降トレンド'
            WHEN abs(deviation_from_6m_ma_pct) <= 5 THEN '横這い' ELSE '不安定' END AS price_trend_direction,
       {relative_case('avg_unit_price_yen', 'ma12', [(1.2, '高値圏'), (1.1, 'やや高値')], [(0.8, '安値圏'), (0.9, 'やや安値')], '適正圏')} AS price_range_category,
       {steps_case('price_volatility_12m', V.VOLATILITY_LEVEL, '安定')} AS volatility_level,
       {steps_case('abs(price_zscore_12m)', V.ANOMALY_STATUS, '正常範囲')} AS price_anomaly_status,
       {steps_case('abs(mom_price_change_pct)', V.SHORT_MOVE, '微小変動')} AS short_term_movement,
       {steps_case('abs(item_price_zscore_12m)', V.ITEM_STATUS, '品目内正常')} AS item_relative_status,
       row_number() OVER (PARTITION BY item_name, year, month ORDER BY avg_unit_price_yen DESC, {_TIES}) AS monthly_price_rank_within_item,
       row_number() OVER (PARTITION BY year, month ORDER BY avg_unit_price_yen DESC, {_TIES}) AS monthly_overall_price_rank,
       {r('max_unit_price_yen - min_unit_price_yen', 2)} AS monthly_price_range,
       {r(div('max_unit_price_yen - min_unit_price_yen', 'avg_unit_price_yen') + ' * 100', 2)} AS monthly_price_range_pct,
       CASE WHEN transaction_count >= 10 AND price_stddev IS NOT NULL THEN 'HIGH' WHEN transaction_count >= 5 THEN 'MEDIUM'
            WHEN transaction_count >= 2 THEN 'LOW' ELSE 'INSUFFICIENT' END AS data_quality_level
FROM t_measures WHERE year >= {S.START_YEAR}
""")

# -- seasonal -------------------------------------------------------------------------

step("t_season_base", f"""
SELECT item_name, major_category, sub_category, year, month, origin, sum(quantity_kg)::BIGINT AS total_quantity_kg,
       sum(amount_yen)::BIGINT AS total_amount_yen, {r('avg(up)', 2)} AS avg_unit_price_yen, count(*) AS transaction_count
FROM t_valid GROUP BY ALL
""")
step("t_profile", f"""
SELECT item_name, major_category, sub_category, month, {r('avg(total_quantity_kg)', 1)} AS avg_monthly_quantity,
       {r('avg(total_amount_yen)', 1)} AS avg_monthly_amount, {r('avg(avg_unit_price_yen)', 2)} AS avg_monthly_price,
       {r('stddev_samp(avg_unit_price_yen)', 2)} AS monthly_price_stddev, min(avg_unit_price_yen) AS historical_min_price,
       max(avg_unit_price_yen) AS historical_max_price, count(DISTINCT year) AS years_with_data,
       sum(transaction_count)::BIGINT AS total_transactions,
       {r(div('stddev_samp(total_quantity_kg)', 'avg(total_quantity_kg)'), 3)} AS quantity_cv,
       {r(div('stddev_samp(avg_unit_price_yen)', 'avg(avg_unit_price_yen)'), 3)} AS price_cv
FROM t_season_base GROUP BY 1, 2, 3, 4
""")
step("t_annual", f"""
SELECT item_name, major_category, sub_category, {r('avg(avg_unit_price_yen)', 2)} AS annual_avg_price,
       {r('stddev_samp(avg_unit_price_yen)', 2)} AS annual_price_stddev, sum(total_quantity_kg)::BIGINT AS annual_total_quantity,
       sum(total_amount_yen)::BIGINT AS annual_total_amount, count(DISTINCT year || '-' || month) AS months_with_data,
       count(DISTINCT year) AS years_available
FROM t_season_base GROUP BY 1, 2, 3
""")
step("t_season_index", f"""
SELECT *, {pct('avg_monthly_price', 'annual_avg_price')} AS seasonal_price_index,
       {r(div('avg_monthly_quantity', div('annual_total_quantity', 'months_with_data')) + ' * 100', 1)} AS seasonal_quantity_index,
       row_number() OVER (PARTITION BY item_name ORDER BY avg_monthly_price DESC, major_category, sub_category, month) AS price_rank_high_to_low,
       row_number() OVER (PARTITION BY item_name ORDER BY avg_monthly_quantity DESC, major_category, sub_category, month) AS quantity_rank_high_to_low,
       {member_case('month', V.SEASON_JA)} AS season, {member_case('month', V.DEMAND_SEASONAL, V.DEMAND_DEFAULT)} AS vegetable_demand_period
FROM t_profile JOIN t_annual USING (item_name, major_category, sub_category)
""")
_top = lambda order: f"array_to_string(list_slice(list(month::VARCHAR ORDER BY {order}, month), 1, 3), ', ')"
step("t_peaks", f"""
SELECT item_name, major_category, sub_category, {_top('avg_monthly_quantity DESC')} AS peak_supply_months,
       {_top('avg_monthly_price DESC')} AS peak_price_months, {_top('avg_monthly_price')} AS low_price_months,
       {r('avg(price_cv)', 3)} AS seasonality_strength,
       max(avg_monthly_price) FILTER (quantity_rank_high_to_low <= 3) AS peak_supply_max_price,
       min(avg_monthly_price) FILTER (quantity_rank_high_to_low <= 3) AS peak_supply_min_price
FROM t_season_index GROUP BY 1, 2, 3
""")
_patterns = {"夏野菜": "678", "冬野菜": ("12", "1", "2"), "春野菜": "345", "秋野菜": ("9", "10", "11")}
step("t_seasonal", f"""
SELECT i.* EXCLUDE (annual_total_quantity, annual_total_amount), peak_supply_months, peak_price_months, low_price_months,
       seasonality_strength, peak_supply_max_price, peak_supply_min_price,
       {words_case('item_name', V.ITEM_CATEGORY_SEASONAL, V.ITEM_CATEGORY_DEFAULT)} AS vegetable_category,
       {words_case('peak_supply_months', _patterns, '通年野菜')} AS seasonality_pattern,
       {steps_case('seasonality_strength', V.SEASONALITY_LEVEL, '季節性なし')} AS seasonality_level,
       {steps_case('price_cv', V.VOLATILITY_LEVEL, '安定')} AS price_volatility_level
FROM t_season_index i JOIN t_peaks USING (item_name, major_category, sub_category)
""")

# -- predictions ----------------------------------------------------------------------

_low = "coalesce(lower_bound_price, predicted_price * 0.8::DOUBLE)"
_high = "coalesce(upper_bound_price, predicted_price * 1.2::DOUBLE)"
_score = "coalesce(data_quality_score, 0.7::DOUBLE)"
_horizon = "date_diff('day', prediction_generated_at::DATE, prediction_date)"
step("t_fact_predictions", f"""
SELECT sha256(concat_ws('#', prediction_id, item_name, model_type, coalesce(market, ''), coalesce(origin, ''),
              strftime(prediction_date, '%Y-%m-%d'), strftime(prediction_generated_at, '%Y-%m-%d %H:%M:%S'))) AS prediction_key,
       prediction_date, prediction_year, prediction_month, quarter(prediction_date)::BIGINT AS prediction_quarter,
       {member_case('month(prediction_date)', V.SEASON_JA)} AS prediction_season, prediction_generated_at,
       {_horizon} AS forecast_horizon_days, item_name, coalesce(market, 'ALL_MARKETS') AS market,
       coalesce(origin, 'ALL_ORIGINS') AS origin, model_type, model_version, predicted_price,
       {r(_low, 2)} AS lower_bound_price, {r(_high, 2)} AS upper_bound_price, {r(f'{_high} - {_low}', 2)} AS prediction_range,
       coalesce(confidence_interval, 0.8::DOUBLE) AS confidence_interval, training_data_points, training_period_start, training_period_end,
       date_diff('day', training_period_start, training_period_end) AS training_period_days,
       last_actual_price, last_actual_date, date_diff('day', last_actual_date, prediction_date) AS prediction_lead_time_days,
       coalesce(model_mae, 0) AS model_mae, coalesce(model_mse, 0) AS model_mse, coalesce(model_rmse, 0) AS model_rmse,
       coalesce(model_r2, 0) AS model_r2, {_score} AS data_quality_score,
       {steps_case(_score, V.RELIABILITY, 'VERY_LOW', '>=')} AS prediction_reliability,
       {steps_case(_horizon, V.HORIZON, 'LONG_TERM', '<=')} AS prediction_horizon_type,
       {relative_case('predicted_price', 'last_actual_price', [(1.1, 'PRICE_INCREASE')], [(0.9, 'PRICE_DECREASE')], 'PRICE_STABLE')} AS predicted_price_trend,
       {pct('predicted_price', 'last_actual_price')} AS predicted_price_change_pct,
       created_at, coalesce(updated_at, TIMESTAMP '{S.AS_OF} 00:00:00') AS updated_at
FROM t_stg_predictions WHERE training_data_points >= 12 AND {_horizon} <= 1095
""")
step("t_latest", """
SELECT * FROM t_fact_predictions
QUALIFY row_number() OVER (PARTITION BY item_name, prediction_date, model_type ORDER BY prediction_generated_at DESC, prediction_key DESC) = 1
""")
step("t_summary", f"""
SELECT * FROM t_latest WHERE prediction_date BETWEEN DATE '{S.AS_OF}' AND DATE '{S.AS_OF}' + INTERVAL 12 MONTH
""")
step("t_actual", f"""
SELECT item_name, year, month, avg(avg_unit_price_yen) AS actual_price, sum(total_quantity_kg)::BIGINT AS actual_quantity,
       count(*) AS market_count, make_date(year, month, 1) AS actual_date
FROM t_monthly WHERE year >= {S.START_YEAR} GROUP BY item_name, year, month
""")
step("t_accuracy", """
SELECT item_name, model_type, count(*) AS prediction_count, avg(model_mae) AS avg_mae, avg(model_rmse) AS avg_rmse,
       avg(model_r2) AS avg_r2, avg((prediction_reliability = 'HIGH')::INT) AS high_reliability_ratio
FROM t_summary GROUP BY 1, 2
""")
_share = lambda label: f"avg((predicted_price_trend = '{label}')::INT)"
step("t_consensus", f"""
SELECT item_name, prediction_month, count(DISTINCT model_type) AS model_count, avg(predicted_price) AS avg_predicted_price,
       min(predicted_price) AS min_predicted_price, max(predicted_price) AS max_predicted_price,
       stddev_samp(predicted_price) AS price_prediction_std, {_share('PRICE_INCREASE')} AS increase_consensus,
       {_share('PRICE_DECREASE')} AS decrease_consensus, {_share('PRICE_STABLE')} AS stable_consensus
FROM t_summary GROUP BY 1, 2
""")
step("t_dashboard", f"""
SELECT s.prediction_date, s.prediction_year, s.prediction_month, prediction_quarter, prediction_season, s.item_name, s.model_type,
       predicted_price, lower_bound_price, upper_bound_price, prediction_range, confidence_interval, predicted_price_trend,
       predicted_price_change_pct, last_actual_price, last_actual_date,
       {r('actual_price', 2)} AS comparable_actual_price, actual_date AS comparable_actual_date,
       {pct('predicted_price', 'actual_price')} AS vs_previous_year_pct, prediction_horizon_type, forecast_horizon_days,
       prediction_lead_time_days, prediction_reliability, data_quality_score, model_mae, model_rmse, model_r2, training_data_points,
       model_count AS total_models_for_item, {r('avg_predicted_price', 2)} AS item_month_avg_prediction,
       {r('min_predicted_price', 2)} AS item_month_min_prediction, {r('max_predicted_price', 2)} AS item_month_max_prediction,
       {r('price_prediction_std', 2)} AS item_month_prediction_std, {r('increase_consensus * 100', 1)} AS increase_consensus_pct,
       {r('decrease_consensus * 100', 1)} AS decrease_consensus_pct, {r('stable_consensus * 100', 1)} AS stable_consensus_pct,
       rank() OVER (PARTITION BY s.item_name ORDER BY avg_mae NULLS FIRST) AS model_accuracy_rank,
       rank() OVER (PARTITION BY s.prediction_month ORDER BY predicted_price DESC) AS monthly_price_rank,
       {relative_case('predicted_price', 'last_actual_price', [(1.2, '大幅上昇予測'), (1.1, '上昇予測')], [(0.8, '大幅下落予測'), (0.9, '下落予測')], '安定予測')} AS prediction_category,
       CASE WHEN prediction_reliability = 'HIGH' AND data_quality_score >= 0.8::DOUBLE THEN '高信頼度'
            WHEN prediction_reliability IN ('HIGH', 'MEDIUM') AND data_quality_score >= 0.6::DOUBLE THEN '中信頼度' ELSE '低信頼度' END AS overall_confidence,
       prediction_generated_at, TIMESTAMP '{S.AS_OF} 00:00:00' AS dashboard_updated_at
FROM t_summary s LEFT JOIN t_actual a ON a.item_name = s.item_name AND a.month = s.prediction_month AND a.year + 1 = s.prediction_year
     LEFT JOIN t_accuracy m ON m.item_name = s.item_name AND m.model_type = s.model_type
     LEFT JOIN t_consensus c ON c.item_name = s.item_name AND c.prediction_month = s.prediction_month
WHERE data_quality_score >= 0.5::DOUBLE AND training_data_points >= 12
""")


def show(table: str, dates=(), times=(), rounded=(), where: str = "") -> str:
    """Whole result with dates and times as text and the named doubles rounded."""
    parts = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
    parts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times]
    parts += [f"{r(c, 6)} AS {c}" for c in rounded]
    replaced = f" REPLACE ({', '.join(parts)})" if parts else ""
    return sql(f"SELECT *{replaced} FROM {table} {where}")


_PRED_DATES = ("prediction_date", "training_period_start", "training_period_end", "last_actual_date")
_PRED_TIMES = ("prediction_generated_at", "created_at", "updated_at")

ORACLE: dict[str, str] = {
    "price_trend": sql("SELECT * FROM t_trend"),
    "stg_trades": sql("SELECT * EXCLUDE (item_code) FROM t_stg"),
    "stg_weather_dedup": show("t_stg_weather", ("observation_date",), ("observation_datetime",)),
    "stg_predictions": show("t_stg_predictions", _PRED_DATES, _PRED_TIMES, ("confidence_interval", "data_quality_score")),
    "dim_market": sql("SELECT * FROM t_dim_market"),
    "dim_station": sql("SELECT * FROM t_dim_station"),
    "dim_location": sql("SELECT * FROM t_dim_location"),
    "dim_location_corrected": sql(location_sql(True)),
    "dim_time": sql("SELECT * FROM t_dim_time"),
    "dim_item": sql("SELECT * FROM t_dim_item"),
    "fact_weather_daily": show(
        "t_daily", ("observation_date",), (),
        ("avg_temperature", "avg_humidity", "total_precipitation", "avg_wind_speed", "total_sunshine"),
    ),
    "weather_monthly": sql("SELECT * FROM t_weather_monthly"),
    "mart_price_weather": sql("SELECT * FROM t_price_weather"),
    "monthly_prices": sql("SELECT * FROM t_prices"),
    "price_movement": sql("SELECT * FROM t_movement"),
    "price_anomaly": sql("""
SELECT price_anomaly_status, item_relative_status, count(*) AS series_months, min(price_zscore_12m) AS lowest_zscore,
       max(price_zscore_12m) AS highest_zscore FROM t_movement GROUP BY 1, 2
"""),
    "seasonal_month_profile": sql("SELECT * FROM t_profile"),
    "seasonal_annual_profile": sql("SELECT * FROM t_annual"),
    "seasonal_peaks": sql("SELECT * FROM t_peaks"),
    "mart_seasonal": sql("SELECT * FROM t_seasonal"),
    "fact_predictions": show("t_fact_predictions", _PRED_DATES, _PRED_TIMES, ("confidence_interval", "data_quality_score")),
    "latest_prediction": show("t_latest", _PRED_DATES, _PRED_TIMES, ("confidence_interval", "data_quality_score")),
    "model_accuracy": show("t_accuracy", (), (), ("avg_mae", "avg_rmse", "avg_r2", "high_reliability_ratio")),
    "prediction_consensus": show(
        "t_consensus", (), (),
        ("avg_predicted_price", "price_prediction_std", "increase_consensus", "decrease_consensus", "stable_consensus"),
    ),
    "prev_year_compare": sql(f"""
SELECT s.prediction_key, s.item_name, s.prediction_year, s.prediction_month, predicted_price,
       {r('actual_price', 6)} AS actual_price, {pct('predicted_price', 'actual_price')} AS vs_previous_year_pct
FROM t_summary s LEFT JOIN t_actual a ON a.item_name = s.item_name AND a.month = s.prediction_month AND a.year + 1 = s.prediction_year
"""),
    "mart_dashboard": show(
        "t_dashboard", ("prediction_date", "last_actual_date", "comparable_actual_date"),
        ("prediction_generated_at", "dashboard_updated_at"), ("confidence_interval", "data_quality_score"),
    ),
}

# -- data tests -----------------------------------------------------------------------


_CHECKED = {
    "stg_trades": "t_stg", "stg_weather": "t_stg_weather", "stg_predictions": "t_stg_predictions",
    "dim_market": "t_dim_market", "dim_station": "t_dim_station", "fact_weather_daily": "t_daily",
}
_CHECKED_MARTS = {
    "dim_location": "t_dim_location", "dim_time": "t_dim_time", "dim_item": "t_dim_item",
    "fact_predictions": "t_fact_predictions", "mart_price_weather": "t_price_weather", "mart_seasonal": "t_seasonal",
    "price_movement": "t_movement", "mart_dashboard": "t_dashboard",
}


def checks_sql(names: dict[str, str]) -> str:
    """Every declared check of the named tables as its own counting query."""
    from .plans.checks import declared

    rows = []
    for table, checks in declared(1996, 2002).items():
        if table not in names:
            continue

        def count(kind: str, column: str, condition: str) -> None:
            rows.append(
                f"SELECT '{table}' AS table_name, '{kind}' AS \"check\", '{column}' AS column_name,"
                f" count(*) AS failures FROM {names[table]} WHERE {condition}"
            )

        for c in checks.not_null:
            count("not_null", c, f"{c} IS NULL")
        for c, allowed in checks.values.items():
            count("accepted_values", c, f"{c} NOT IN ({', '.join(q(v) for v in allowed)})")
        for c, (low, high) in checks.ranges.items():
            parts = [f"{c} < {low}"] if low is not None else []
            parts += [f"{c} > {high}"] if high is not None else []
            count("accepted_range", c, " OR ".join(parts))
        for c in checks.unique:
            rows.append(
                f"SELECT '{table}', 'unique', '{c}', count(*) FROM"
                f" (SELECT {c} FROM {names[table]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            )
    if "fact_weather_daily" in names:
        rows.append(
            "SELECT 'fact_weather_daily', 'relationships', 'station_key', count(*) FROM t_daily"
            " WHERE station_key NOT IN (SELECT station_key FROM t_dim_station)"
        )
    return sql("\nUNION ALL ".join(rows))


_stg_columns = ["year", "month", "market", "major_category", "sub_category", "item_name", "origin", "quantity_kg", "amount_yen"]
ORACLE |= {
    "dq_unique": sql("""
SELECT observation, count(*) AS copies
FROM (SELECT station_id || '@' || strftime(observation_datetime, '%Y-%m-%d %H') AS observation FROM t_weather)
GROUP BY observation HAVING count(*) > 1
"""),
    "dq_not_null": sql("SELECT * EXCLUDE (item_code) FROM t_stg WHERE amount_yen IS NULL"),
    "dq_accepted_values": sql("""
SELECT year, month, item_name, major_category, quantity_kg FROM t_trades WHERE major_category NOT IN ('野菜', '野 菜', '野　菜')
"""),
    "dq_accepted_range": show("t_stg_weather", ("observation_date",), ("observation_datetime",), where="WHERE humidity < 0 OR humidity > 100"),
    "dq_relationships": sql(
        "SELECT * EXCLUDE (item_code) FROM t_stg WHERE contains(origin, 'その他') OR contains(origin, '計')"
    ),
    "dq_summary": checks_sql(_CHECKED),
    "content_score": sql(f"""
SELECT rows, null_cells, repeated_rows, {r(f'100 - null_cells::DOUBLE / (rows * {len(_stg_columns)}) * 50 - repeated_rows::DOUBLE / rows * 30', 6)} AS score
FROM (SELECT count(*) AS rows, sum({' + '.join(f'({c} IS NULL)::INT' for c in _stg_columns)})::BIGINT AS null_cells,
             (count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_stg_columns)} FROM t_stg)))::BIGINT AS repeated_rows
      FROM t_stg)
"""),
}

ORACLE["dq_summary_marts"] = checks_sql(_CHECKED_MARTS)

# -- reports and control --------------------------------------------------------------

_mae_band = steps_case("model_mae", V.MAE_CONFIDENCE, 40, "<")
step("t_cheapest", f"""
SELECT *, row_number() OVER (ORDER BY raw_price, confidence_interval DESC, r2 DESC, item_name) AS place FROM (
SELECT item_name, model_type, predicted_price AS raw_price, {r('predicted_price', 0)} AS predicted_price,
       {r('last_actual_price', 0)} AS current_price, NULL::DOUBLE AS price_change_pct,
       {r(f'CASE WHEN model_mae > 0 THEN {_mae_band}::DOUBLE WHEN model_r2 >= 0 THEN model_r2 * 100 ELSE 0 END', 0)} AS confidence_pct,
       prediction_reliability, {r('model_mae', 1)} AS model_mae, training_data_points,
       strftime(prediction_date, '%Y-%m-%d') AS prediction_date, strftime(prediction_generated_at, '%Y-%m-%d') AS generated_date,
       confidence_interval, model_r2 AS r2
FROM t_fact_predictions
WHERE prediction_year = 2002 AND prediction_month = 1 AND confidence_interval >= 0.7::DOUBLE
  AND prediction_reliability IN ('HIGH', 'MEDIUM') AND training_data_points >= 24 AND predicted_price > 0
  AND NOT contains(item_name, 'その他') AND model_type IN ('PROPHET', 'LSTM', 'ARIMA')
QUALIFY row_number() OVER (PARTITION BY item_name ORDER BY CASE WHEN model_mae > 0 THEN model_mae ELSE 999 END, model_r2 DESC,
        CASE model_type WHEN 'LSTM' THEN 1 WHEN 'PROPHET' THEN 2 WHEN 'ARIMA' THEN 3 ELSE 4 END,
        prediction_generated_at DESC, prediction_key) = 1)
QUALIFY place <= 10
""")
step("t_month_spread", f"""
SELECT item_name, {r('avg(avg_monthly_price)', 0)} AS historical_avg_price, count(*) AS data_points,
       {r('stddev_samp(avg_monthly_price)', 0)} AS price_volatility
FROM t_seasonal WHERE month = 1 GROUP BY item_name HAVING count(*) >= 1
""")
step("t_movers", """
(SELECT *, 'volatile' AS kind FROM t_month_spread ORDER BY price_volatility DESC NULLS LAST, item_name LIMIT 5)
UNION ALL (SELECT *, 'stable' AS kind FROM t_month_spread ORDER BY price_volatility NULLS FIRST, item_name DESC LIMIT 5)
""")
step("t_records", """
SELECT '2001-' || lpad((k % 12 + 1)::VARCHAR, 2, '0') || '-01T00:00:00' AS created_at, lpad(k::VARCHAR, 6, '0') AS version, *
FROM (SELECT floor(n_chars / 200)::BIGINT AS k, count(*) AS total_predictions,
             array_to_string(list_sort(list(DISTINCT lang)), ',') AS model_types, count(DISTINCT source) AS items_covered
      FROM documents GROUP BY 1)
""")
step("t_newest_record", """
SELECT version, created_at, total_predictions, model_types, items_covered FROM t_records ORDER BY created_at DESC, version DESC LIMIT 1
""")
_line = (
    "'**' || place || '位: ' || item_name || '** - ' || predicted_price::BIGINT || '円/kg' || chr(10) || '　予測精度: ' ||"
    " confidence_pct::BIGINT || '% | ' || model_type || CASE WHEN model_mae <> 999 THEN ' | 予測誤差 ' || model_mae || '円' ||"
    " CASE WHEN model_mae < 50 THEN ' (良好)' ELSE '' END ELSE '' END || chr(10) || chr(10)"
)
step("t_usage", f"""
SELECT coalesce(sum(floor(value * 1e7)::BIGINT) FILTER (event_id % 19 <> 0), 0)::DOUBLE / 1073741824 AS gb FROM events
WHERE ts::DATE >= DATE '2024-01-01' AND event_type IN ('view', 'click', 'purchase') AND event_id % 17 <> 0 AND user_id % 5 <> 0
""")
step("t_objects", """
SELECT 'bucket-' || page_id % 4 AS bucket, CASE WHEN page_id % 29 <> 0 THEN length(html) * 1024 END AS length FROM pages
""")
_level = lambda x: steps_case(x, V.ALERT_LEVEL, "NORMAL", ">=")


def _usage_row(gb: str, service: str, resource: str, limit: float, source: str) -> str:
    p = f"({gb} / {limit}::DOUBLE * 100)"
    return (
        f"SELECT '{service}' AS service, '{resource}' AS resource_type, {r(gb, 6)} AS current_usage, {limit}::DOUBLE AS limit_gb,"
        f" 'GB' AS unit, {r(f'least(100::DOUBLE, {p})', 6)} AS usage_percentage, {_level(p)} AS alert_level,"
        f" {r(f'greatest(0::DOUBLE, {limit}::DOUBLE - {gb})', 6)} AS remaining, '2024-01-31' AS check_date FROM {source}"
    )


_storage = "(SELECT coalesce(sum(length), 0)::DOUBLE / 1073741824 AS gb FROM t_objects)"
_gate = lambda need: (
    f"SELECT {r('p', 6)} AS projected_percentage, p < 95 AS safe, CASE WHEN p >= 95 THEN 'Processing would exceed 95% of free tier limit (' ||"
    f" {r('p', 1)} || '%)' WHEN p >= 80 THEN 'Proceeding with caution - ' || {r('p', 1)} || '% usage projected'"
    f" ELSE 'Safe to proceed - ' || {r('p', 1)} || '% usage projected' END AS reason, {need}::DOUBLE AS required_gb"
    f" FROM (SELECT (gb + {need}::DOUBLE) / 1024 * 100 AS p FROM t_usage)"
)
step("t_results", """
SELECT o_orderkey % 11 <> 0 AS success, strftime(o_orderdate, '%Y%m') || '_' || o_orderkey || '.csv' AS filename,
       CASE WHEN o_orderkey % 11 = 0 THEN 'load error' WHEN o_orderstatus = 'F' THEN 'skipped' ELSE 'processed' END AS message,
       CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE o_custkey END AS records_processed,
       CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 1000) / 10::DOUBLE ELSE 0 END AS score
FROM orders
""")

# -- files ----------------------------------------------------------------------------

step("t_links", """
SELECT page_id, try_cast(substr(href, 22, 4) AS BIGINT) AS year, try_cast(nullif(m, '') AS BIGINT) AS month, 'y' AS kind,
       'https://www.shijou.metro.tokyo.lg.jp' || href AS url, trim(regexp_replace(body, '<[^>]*>', '', 'g')) AS link_text
FROM (SELECT page_id, CASE WHEN page_id % 13 = 0 THEN '' ELSE lpad((page_id % 13)::VARCHAR, 2, '0') END AS m,
             '/documents/d/shijou/y' || (1995 + page_id % 40) || CASE WHEN page_id % 13 = 0 THEN '' ELSE lpad((page_id % 13)::VARCHAR, 2, '0') END
             || CASE WHEN page_id % 2 = 0 THEN 'meisai.xlsx' ELSE 'meisai_20240131' END AS href,
             unnest(regexp_extract_all(html, '<a href="/t[^"]*">([^<]*)</a>', 1)) AS body
      FROM pages)
""")
step("t_files", "SELECT DISTINCT year, month, kind, url FROM t_links")
step("t_named_files", """
SELECT *, year || coalesce(lpad(month::VARCHAR, 2, '0'), '') || '.csv' AS filename FROM t_files
""")

ORACLE |= {
    "cheapest_top10": sql("SELECT * EXCLUDE (place, raw_price, confidence_interval, r2) FROM t_cheapest"),
    "volatile_items": sql("SELECT * FROM t_movers"),
    "report_message": sql(f"""
SELECT '01月の安い野菜TOP10' AS title, count(*) AS items,
       'AI予測による01月の野菜価格ランキング（安い順）' || chr(10) || chr(10) || string_agg({_line}, '' ORDER BY place) AS ranking_text,
       (SELECT '*01月によく変動する野菜*: ' || string_agg(item_name, '、' ORDER BY price_volatility DESC, item_name)
        FROM (SELECT * FROM t_movers WHERE kind = 'volatile' ORDER BY price_volatility DESC NULLS LAST, item_name LIMIT 3)) AS seasonal_text,
       (SELECT chr(10) || '*予測モデル情報*' || chr(10) || 'バージョン: ' || version || ' | 対象品目: ' || items_covered || '品目 | 更新: ' || left(created_at, 10)
        FROM t_newest_record) AS model_text
FROM t_cheapest
"""),
    "coverage_diagnosis": sql("""
SELECT prediction_year, prediction_month, raw_rows, mart_rows,
       CASE WHEN mart_rows IS NULL THEN 'missing in mart' WHEN raw_rows IS NULL THEN 'missing in raw'
            WHEN mart_rows < raw_rows THEN 'partly filtered' ELSE 'complete' END AS state
FROM (SELECT prediction_year, prediction_month, count(*) AS raw_rows FROM t_predictions WHERE prediction_year >= 1996 GROUP BY 1, 2)
FULL JOIN (SELECT prediction_year, prediction_month, count(*) AS mart_rows FROM t_fact_predictions WHERE prediction_year >= 1996 GROUP BY 1, 2)
USING (prediction_year, prediction_month)
"""),
    "batch_counts": sql("""
SELECT model_type AS label, count(*) AS predictions, 'model' AS kind FROM t_fact_predictions GROUP BY 1
UNION ALL SELECT strftime(prediction_date, '%Y年%m月'), count(*), 'month' FROM t_fact_predictions GROUP BY 1
"""),
    "usage_month": sql(f"SELECT {r('gb', 6)} AS current_usage FROM t_usage"),
    "usage_rows": sql(
        _usage_row("gb", "warehouse", "query_processing", 1024.0, "t_usage")
        + " UNION ALL " + _usage_row("gb", "storage", "total_storage", 5.0, _storage)
    ),
    "usage_alerts": sql(
        "SELECT alert_level AS level, service, resource_type AS resource, usage_percentage, service || ' ' || resource_type || ' usage is ' || "
        + r("usage_percentage", 1) + " || '% of free tier limit' AS message FROM ("
        + " UNION ALL ".join(_usage_row("gb", "warehouse", f"quota_{n}", float(n), "t_usage") for n in (20, 60, 90, 110, 1024))
        + ") WHERE alert_level <> 'NORMAL'"
    ),
    "safety_gate": sql(" UNION ALL ".join(_gate(need) for need in (0.01, 800.0, 1000.0))),
    "run_report": sql(f"""
SELECT count(*) AS total, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed,
       count(*) FILTER (success AND message = 'skipped') AS skipped, count(*) FILTER (success AND message = 'processed') AS processed,
       coalesce(sum(records_processed) FILTER (success), 0)::BIGINT AS records, {r('avg(score) FILTER (success)', 6)} AS mean_quality,
       (SELECT string_agg(line, '; ' ORDER BY line) FROM
          (SELECT filename || ': ' || message AS line FROM t_results WHERE NOT success ORDER BY 1 LIMIT 5)) AS first_failures
FROM t_results
"""),
    "file_links": sql("SELECT * FROM t_links"),
    "files_superseded": sql("""
SELECT * FROM t_files f WHERE month IS NULL OR NOT EXISTS (SELECT 1 FROM t_files y WHERE y.month IS NULL AND y.year = f.year)
"""),
    "files_select": sql("""
(SELECT *, 'latest-only' AS mode FROM t_files ORDER BY year DESC, coalesce(month, 0) DESC, url LIMIT 1)
UNION ALL SELECT *, 'backfill' FROM t_files WHERE year BETWEEN 1996 AND 2001
"""),
    "files_pending": sql("""
SELECT * FROM t_named_files WHERE filename NOT IN (SELECT DISTINCT year || lpad(month::VARCHAR, 2, '0') || '.csv' FROM t_trades)
"""),
    "month_slices": sql("""
SELECT station_id, strftime(lo, '%Y-%m-%d') AS start_date, strftime(hi, '%Y-%m-%d') AS end_date,
       strftime(greatest(m, lo), '%Y-%m-%d') AS slice_start, strftime(least(last_day(m), hi), '%Y-%m-%d') AS slice_end
FROM (SELECT *, unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH))::DATE AS m
      FROM (SELECT station_id, min(observation_date) AS lo, max(observation_date) AS hi FROM t_stg_weather GROUP BY 1))
"""),
    "station_catalogue": sql(
        "SELECT station_id, station_name, region, priority, coverage, observations FROM (VALUES "
        + ", ".join(
            f"({q(code)}, {q(name)}, {q(block)}, {rank}, {q(coverage)})"
            for coverage, codes in (("all", [s[0] for s in V.STATIONS]), ("agriculture", V.AGRICULTURE_STATIONS), ("current", V.CURRENT_STATIONS))
            for rank, code in enumerate(codes, 1)
            for known, name, block in V.STATIONS
            if known == code
        )
        + ") AS s(station_id, station_name, region, priority, coverage)"
        " LEFT JOIN (SELECT station_id, count(*) AS observations FROM t_stg_weather GROUP BY 1) USING (station_id)"
    ),
    "object_sizes": sql(f"""
SELECT bucket, count(*) AS objects, {r('coalesce(sum(length), 0)::DOUBLE / 1073741824', 6)} AS size_gb FROM t_objects GROUP BY bucket
"""),
    "latest_metadata": sql("SELECT * FROM t_newest_record"),
    "target_items": sql("""
SELECT item_name, count(*) AS data_points, min(year) AS start_year, max(year) AS end_year FROM t_monthly WHERE year >= 1997
GROUP BY 1 HAVING count(*) >= 24 ORDER BY data_points DESC, item_name LIMIT 20
"""),
}

# -- series ---------------------------------------------------------------------------

_ROWS = "year, month, market, origin, major_category, sub_category NULLS FIRST, profile_category NULLS FIRST"
step("t_series", """
SELECT strftime(make_date(p.year, p.month, 1), '%Y-%m-%d') AS ds, p.year, p.month, p.item_name, market, origin, p.major_category, p.sub_category,
       s.sub_category AS profile_category, avg_unit_price_yen AS y, total_quantity_kg, total_amount_yen, yoy_price_growth_rate,
       mom_price_growth_rate, price_3month_moving_avg, avg_temperature, total_precipitation, avg_wind_speed,
       seasonal_price_index, seasonal_quantity_index
FROM t_price_weather p LEFT JOIN t_seasonal s ON p.item_name = s.item_name AND p.month = s.month
WHERE avg_unit_price_yen > 0
""")
step("t_by_item", f"""
SELECT *, row_number() OVER (PARTITION BY item_name ORDER BY {_ROWS}) - 1 AS pos, count(*) OVER (PARTITION BY item_name) AS n FROM t_series
""")
step("t_by_market", f"""
SELECT *, row_number() OVER (PARTITION BY item_name, market, origin ORDER BY {_ROWS}) - 1 AS pos,
       count(*) OVER (PARTITION BY item_name, market, origin) AS n FROM t_series
""")
_KEYS = "item_name, market, origin, sub_category, profile_category, year, month, pos"
_I = "PARTITION BY item_name ORDER BY pos"
step("t_quartiles", """
SELECT item_name, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median, quantile_cont(y, 0.75) AS q3,
       avg(y) AS mean, stddev_samp(y) AS sd FROM t_by_item GROUP BY 1
""")
step("t_without_outliers", f"""
SELECT * EXCLUDE (pos, n), row_number() OVER ({_I}) - 1 AS pos, count(*) OVER (PARTITION BY item_name) AS n, n AS before
FROM (SELECT *, avg(y) OVER ({_I} ROWS 6 PRECEDING) AS ma7 FROM t_by_item) JOIN t_quartiles USING (item_name)
WHERE n < 20 OR NOT (y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1) OR coalesce(abs((y - mean) / nullif(sd, 0)) > 4, false)
                     OR abs((y - ma7) / nullif(ma7, 0)) > 0.8)
""")


def _edges(c: str) -> str:
    """Neighbours of a gap: position and value of the last known row before and the first after."""
    known = f"CASE WHEN {c} IS NOT NULL THEN pos END"
    return (
        f"last_value({c} IGNORE NULLS) OVER f AS {c}_pv, first_value({c} IGNORE NULLS) OVER b AS {c}_nv,"
        f" last_value({known} IGNORE NULLS) OVER f AS {c}_pp, first_value({known} IGNORE NULLS) OVER b AS {c}_np"
    )


def _line_between(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_pp IS NOT NULL AND {c}_np IS NOT NULL"
        f" THEN {c}_pv + ({c}_nv - {c}_pv) * ((pos - {c}_pp)::DOUBLE / ({c}_np - {c}_pp)) ELSE {c}_pv END"
    )


_GAPS = ("avg_temperature", "yoy_price_growth_rate")
step("t_edges", f"""
SELECT *, {', '.join(_edges(c) for c in _GAPS)} FROM t_by_item
WINDOW f AS ({_I} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS ({_I} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
""")
# All columns of a series repaired, step by step.
_REPAIRED = (
    "y", "total_quantity_kg", "total_amount_yen", "yoy_price_growth_rate", "mom_price_growth_rate", "price_3month_moving_avg",
    "avg_temperature", "total_precipitation", "avg_wind_speed", "seasonal_price_index", "seasonal_quantity_index",
)
_frames = f"WINDOW f AS ({_I} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS ({_I} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
step("t_fenced", """
SELECT t.* REPLACE (CASE WHEN y < q1 - 2.5 * (q3 - q1) OR y > q3 + 2.5 * (q3 - q1) THEN median ELSE y END AS y)
FROM t_by_item t JOIN t_quartiles USING (item_name)
""")
step("t_closed", f"""
SELECT item_name, market, origin, sub_category, profile_category, year, month, pos, n, {', '.join(f'coalesce({_line_between(c)}, {c}_nv) AS {c}' for c in _REPAIRED)}
FROM (SELECT *, {', '.join(_edges(c) for c in _REPAIRED)} FROM t_fenced {_frames})
""")
step("t_smoothed", f"""
SELECT * REPLACE (CASE WHEN n > 6 AND pos > 0 AND pos < n - 1 THEN avg(y) OVER ({_I} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) ELSE y END AS y) FROM t_closed
""")
step("t_shaped", f"""
SELECT t.*, lag(y, 1) OVER ({_I}) AS y_lag1, lag(y, 3) OVER ({_I}) AS y_lag3,
       CASE WHEN n > 6 AND pos >= 2 THEN avg(y) OVER ({_I} ROWS 2 PRECEDING) END AS y_ma3,
       CASE WHEN n > 6 AND pos >= 5 THEN avg(y) OVER ({_I} ROWS 5 PRECEDING) END AS y_ma6, y / nullif(lag(y, 1) OVER ({_I}), 0) - 1 AS y_pct_change,
       CASE WHEN n > 24 THEN slope * pos + base END AS trend, CASE WHEN n > 24 THEN y - (slope * pos + base) END AS y_detrended
FROM t_smoothed t JOIN (SELECT item_name, regr_slope(y, pos) AS slope, regr_intercept(y, pos) AS base FROM t_smoothed GROUP BY 1) USING (item_name)
""")
_SHAPES = ("y_lag1", "y_lag3", "y_ma3", "y_ma6", "y_pct_change", "trend", "y_detrended")
step("t_split", """
SELECT *, n - train_n AS test_n, pos < train_n AS is_train FROM (SELECT *, floor(n * (1 - 0.2)::DOUBLE)::BIGINT AS train_n FROM t_by_item)
WHERE n >= 10 AND train_n >= 5 AND n - train_n >= 3
""")
step("t_market_split", """
SELECT *, n - train_n AS test_n, pos < train_n AS is_train FROM (SELECT *, floor(n * (1 - 0.2)::DOUBLE)::BIGINT AS train_n FROM t_by_market)
WHERE n >= 10 AND train_n >= 5 AND n - train_n >= 3
""")
step("t_market_naive", """
SELECT t.*, CASE WHEN t.train_n >= t.test_n THEN a.y ELSE z.y END AS y_naive
FROM t_market_split t
LEFT JOIN t_market_split a ON a.item_name = t.item_name AND a.market = t.market AND a.origin = t.origin AND a.is_train AND a.pos = t.pos - t.test_n
LEFT JOIN t_market_split z ON z.item_name = t.item_name AND z.market = t.market AND z.origin = t.origin AND z.pos = t.train_n - 1
WHERE NOT t.is_train
""")
step("t_judged", """
SELECT t.*, m.y_pred, a.y AS y_naive, b.y AS y_before
FROM t_split t JOIN (SELECT item_name, avg(y) AS y_pred FROM t_split WHERE is_train GROUP BY 1) m USING (item_name)
LEFT JOIN t_split a ON a.item_name = t.item_name AND a.pos = t.pos - t.test_n
LEFT JOIN t_split b ON b.item_name = t.item_name AND b.pos = t.pos - 1
WHERE NOT t.is_train
""")
step("t_measured", f"""
SELECT item_name, count(*) AS points, avg(abs(y - y_pred)) AS mae, avg((y - y_pred) ** 2) AS mse, sqrt(avg((y - y_pred) ** 2)) AS rmse,
       avg(abs((y - y_pred) / y)) FILTER (abs(y) > 1e-6) * 100 AS mape,
       avg(abs(y - y_pred) / ((abs(y) + abs(y_pred)) / 2)) * 100 AS smape,
       avg(abs(y - y_pred)) / avg(abs(y - y_naive)) AS mase, 1 - sum((y - y_pred) ** 2) / (var_pop(y) * count(*)) AS r2
FROM t_judged GROUP BY 1
""")
step("t_measured_steps", """
SELECT item_name, count(*) AS points, avg(abs(y - y_pred)) AS mae, avg((y - y_pred) ** 2) AS mse, sqrt(avg((y - y_pred) ** 2)) AS rmse,
       avg(abs(y - y_pred) / greatest(abs(y), 1e-8)) * 100 AS mape,
       avg(2 * abs(y - y_pred) / greatest(abs(y) + abs(y_pred), 1e-8)) * 100 AS smape,
       avg(abs(y - y_pred)) / avg(abs(y - y_before)) FILTER (pos > train_n AND pos < n - 1) AS mase,
       1 - sum((y - y_pred) ** 2) / (var_pop(y) * count(*)) AS r2
FROM t_judged GROUP BY 1
""")


def cols(*names: str, n: int = 6) -> str:
    return ", ".join(f"{r(c, n)} AS {c}" for c in names)


def _shown(table: str, expressions: dict[str, str], extra: str = "") -> str:
    inner = ", ".join(f"{e} AS {c}" for c, e in expressions.items())
    more = f", {extra}" if extra else ""
    return sql(f"SELECT {_KEYS}{more}, {cols(*expressions)} FROM (SELECT {_KEYS}{more}, {inner} FROM {table})")


_w = lambda f, k: f"{f}(y) OVER ({_I} ROWS {k - 1} PRECEDING)"
_lag = lambda k, c="y": f"lag({c}, {k}) OVER ({_I})"
_full = lambda k: f"CASE WHEN n > 6 AND pos >= {k - 1} THEN {_w('avg', k)} END"
_measures = cols("mae", "rmse", "mape", "smape", "mase", "r2", n=4) + ", " + cols("mse", n=2)

ORACLE |= {
    "series_extract": sql("SELECT * FROM t_series"),
    "lag_matrix": _shown("t_by_item", {"y": "y"} | {f"y_lag_{k}": _lag(k) for k in (1, 3, 6, 12)}),
    "moving_stats": _shown(
        "t_by_item", {"y": "y"} | {f"y_ma_{k}": _w("avg", k) for k in (3, 6, 12)} | {"y_sd_12": _w("stddev_samp", 12)}
    ),
    "quartiles": sql(f"SELECT item_name, {cols('q1', 'median', 'q3')} FROM t_quartiles"),
    "outlier_filter": _shown(
        "t_without_outliers", {"y": f"CASE WHEN before >= 20 AND n > 14 THEN {_w('avg', 3)} ELSE y END"}, "n"
    ),
    "outlier_repair": _shown(
        "(SELECT * FROM t_by_item JOIN t_quartiles USING (item_name))",
        {"y": "CASE WHEN y < q1 - 2.5 * (q3 - q1) OR y > q3 + 2.5 * (q3 - q1) THEN median ELSE y END"},
    ),
    "interpolate_gaps": _shown("t_edges", {c: _line_between(c) for c in _GAPS}),
    "fill_gaps": _shown("t_edges", {c: f"coalesce({c}, {c}_pv, {c}_nv)" for c in _GAPS}),
    "repaired_series": _shown(
        f"(SELECT *, {', '.join(_edges(c) for c in _SHAPES)} FROM t_shaped {_frames})",
        {c: c for c in _REPAIRED} | {c: f"coalesce({c}, {c}_pv, {c}_nv)" for c in _SHAPES},
    ),
    "smooth_series": _shown(
        "t_by_item",
        {"y": f"CASE WHEN n > 6 AND pos > 0 AND pos < n - 1 THEN avg(y) OVER ({_I} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) ELSE y END"},
    ),
    "shape_features": _shown(
        "t_by_item",
        {"y": "y", "y_lag1": _lag(1), "y_lag3": _lag(3), "y_ma3": _full(3), "y_ma6": _full(6), "y_pct_change": f"y / {_lag(1)} - 1"},
    ),
    "detrend": _shown(
        "(SELECT t.*, CASE WHEN n > 24 THEN slope * pos + base END AS line FROM t_by_item t JOIN"
        " (SELECT item_name, regr_slope(y, pos) AS slope, regr_intercept(y, pos) AS base FROM t_by_item GROUP BY 1) USING (item_name))",
        {"y": "y", "trend": "line", "y_detrended": "y - line"},
    ),
    "sequences": sql(f"""
SELECT {_KEYS}, y AS target, array_to_string(ys, ',') AS prices, array_to_string(qs, ',') AS quantities
FROM (SELECT *, list(y) OVER w AS ys, list(total_quantity_kg) OVER w AS qs FROM t_by_market
      WINDOW w AS (PARTITION BY item_name, market, origin ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
WHERE pos >= 12
"""),
    "last_rows": sql(f"SELECT {_KEYS}, y FROM t_by_market WHERE pos >= n - 12"),
    "holdout_split": sql(f"SELECT {_KEYS}, train_n, test_n, is_train FROM t_split"),
    "naive_baseline": sql(f"SELECT {_KEYS}, y, y_naive FROM t_market_naive"),
    "minmax_scale": _shown(
        """(SELECT t.*, ylo, yhi, qlo, qhi FROM t_split t JOIN (SELECT item_name, min(y) AS ylo, max(y) AS yhi,
            min(total_quantity_kg) AS qlo, max(total_quantity_kg) AS qhi FROM t_split WHERE is_train GROUP BY 1) USING (item_name))""",
        {"y_scaled": "(y - ylo) / (yhi - ylo)", "total_quantity_kg_scaled": "(total_quantity_kg - qlo)::DOUBLE / (qhi - qlo)"},
    ),
    "train_median_fill": _shown(
        """(SELECT t.*, m FROM t_split t JOIN (SELECT item_name, median(yoy_price_growth_rate) AS m FROM t_split WHERE is_train GROUP BY 1)
            USING (item_name))""",
        {"yoy_price_growth_rate": "coalesce(yoy_price_growth_rate, m)"},
    ),
    "accuracy_metrics": sql(f"SELECT item_name, points, {_measures} FROM t_measured"),
    "accuracy_metrics_diff": sql(f"SELECT item_name, points, {_measures} FROM t_measured_steps"),
    "grade": sql(f"SELECT item_name, {r('mase', 6)} AS mase, {steps_case('mase', V.MASE_GRADE, 'VERY_POOR', '<')} AS grade FROM t_measured"),
}

# -- forecasts ------------------------------------------------------------------------

step("t_ahead", """
SELECT item_name, (date_trunc('month', last_ds) + to_months(step::INTEGER))::DATE AS ds, step
FROM (SELECT item_name, max(ds::DATE) AS last_ds FROM t_series GROUP BY 1), range(1, 7) AS a(step)
""")
step("t_fit", """
SELECT *, (year - 1990) * 12 + month - 1 AS t FROM t_series
""")
step("t_line", "SELECT item_name, regr_slope(y, t) AS slope, regr_intercept(y, t) AS base FROM t_fit GROUP BY 1")


Z80 = 1.2815515655446004


def trend_sql(mode: str) -> str:
    rest = "y / (base + slope * t)" if mode == "multiplicative" else "y - (base + slope * t)"
    model = "((base + slope * t) * effect)" if mode == "multiplicative" else "((base + slope * t) + effect)"
    z = Z80
    return sql(f"""
SELECT item_name, strftime(ds, '%Y-%m-%d') AS ds, {r('v', 4)} AS y_pred, {r(f'v - sd * {z}::DOUBLE', 4)} AS lower, {r(f'v + sd * {z}::DOUBLE', 4)} AS upper
FROM (
  SELECT item_name, ds, {model} AS v, sd
  FROM (SELECT *, (year(ds) - 1990) * 12 + month(ds) - 1 AS t FROM t_ahead) a JOIN t_line USING (item_name)
  JOIN (SELECT item_name, month, avg({rest}) AS effect FROM t_fit JOIN t_line USING (item_name) GROUP BY 1, 2) e
       ON e.item_name = a.item_name AND e.month = month(ds)
  JOIN (SELECT item_name, stddev_samp(y - {model}) AS sd
        FROM t_fit JOIN t_line USING (item_name)
        JOIN (SELECT item_name, month, avg({rest}) AS effect FROM t_fit JOIN t_line USING (item_name) GROUP BY 1, 2) USING (item_name, month)
        GROUP BY 1) s ON s.item_name = a.item_name)
""").replace("SELECT item_name, ds, ((base", "SELECT a.item_name, ds, ((base")


step("t_newest_price", """
SELECT item_name, year, month, avg_unit_price_yen FROM t_monthly
QUALIFY row_number() OVER (PARTITION BY item_name ORDER BY year DESC, month DESC, market DESC, origin DESC, major_category DESC, sub_category DESC NULLS LAST) = 1
""")
step("t_days", """
SELECT DISTINCT observation_date AS ds FROM t_stg_weather
""")


def _event(i: int) -> str:
    _, m, d, before, after = V.CALENDAR_EVENTS[i - 1]
    tests = [
        f"ds BETWEEN make_date(year(ds) + {k}, {m}, {d}) - {before} AND make_date(year(ds) + {k}, {m}, {d}) + {after}"
        for k in (-1, 0, 1)
    ]
    return f"CASE WHEN {' OR '.join(tests)} THEN 1 ELSE 0 END::BIGINT AS event_{i}"


# Trend, months, events and regressors: ridge normal equations, solved by elimination.
_REG = ("avg_temperature", "total_precipitation", "yoy_price_growth_rate")
_REG_SIZE = 2 + 12 + len(V.CALENDAR_EVENTS) + len(_REG)
_reg_flags = ", ".join(_event(i) for i in range(1, len(V.CALENDAR_EVENTS) + 1))
_reg_scaled = lambda c: f"CASE WHEN sd_{c} > 1e-9::DOUBLE * greatest(1, abs(mean_{c})) THEN ({c} - mean_{c}) / sd_{c} ELSE 0 END"
_reg_list = (
    f"[1::DOUBLE, {_reg_scaled('t')}, " + ", ".join(f"(month = {m})::INT::DOUBLE" for m in range(1, 13)) + ", "
    + ", ".join(f"event_{i}::DOUBLE" for i in range(1, len(V.CALENDAR_EVENTS) + 1)) + ", " + ", ".join(_reg_scaled(c) for c in _REG) + "]"
)
step("t_reg_middle", f"SELECT item_name, {', '.join(f'median({c}) AS m_{c}' for c in _REG)} FROM t_series GROUP BY 1")
step("t_reg_rows", f"""
SELECT item_name, month, (year - 1990) * 12 + month - 1 AS t, y, {_reg_flags}, {', '.join(f'coalesce({c}, m_{c}, 0)::DOUBLE AS {c}' for c in _REG)}
FROM (SELECT * REPLACE (ds::DATE AS ds) FROM t_series) JOIN t_reg_middle USING (item_name)
""")
step("t_reg_scale", f"""
SELECT item_name, {', '.join(f'avg({c}) AS mean_{c}, stddev_pop({c}) AS sd_{c}' for c in ('t', *_REG))} FROM t_reg_rows GROUP BY 1
""")
step("t_reg_products", f"""
SELECT item_name, i, j, sum(f[i] * f[j]) AS s
FROM (SELECT item_name, list_append({_reg_list}, y) AS f FROM t_reg_rows JOIN t_reg_scale USING (item_name)),
     range(1, {_REG_SIZE + 2}) AS a(i), range(1, {_REG_SIZE + 2}) AS b(j)
GROUP BY ALL
""")
step("t_reg_gram", """
SELECT item_name, list(line ORDER BY i) AS g FROM (SELECT item_name, i, list(s ORDER BY j) AS line FROM t_reg_products GROUP BY 1, 2) GROUP BY 1
""")
_eliminate = (
    "list_transform(m, lambda line, i: CASE WHEN i = k + 1 THEN list_transform(line, lambda x: x / line[k + 1])"
    " ELSE list_transform(line, lambda x, j: x - line[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END)"
)
step("t_reg_solve", f"""
SELECT item_name, 0 AS k, list_transform(g[1:{_REG_SIZE}], lambda line, i: list_transform(line, lambda x, j:
  CASE WHEN i = j AND i > 2 THEN x + 0.01::DOUBLE WHEN i = j AND x = 0 THEN 1 ELSE x END)) AS m
FROM t_reg_gram
UNION ALL
SELECT item_name, k + 1, {_eliminate} FROM t_reg_solve WHERE k < {_REG_SIZE}
""")
step("t_reg_fit", f"""
SELECT item_name, c, sqrt(greatest(0, g[{_REG_SIZE + 1}][{_REG_SIZE + 1}] - 2 * list_dot_product(c, g[{_REG_SIZE + 1}][1:{_REG_SIZE}])
  + list_dot_product(c, list_transform(g[1:{_REG_SIZE}], lambda line: list_dot_product(line[1:{_REG_SIZE}], c)))) / greatest(g[1][1] - 1, 1)) AS sigma
FROM (SELECT item_name, list_transform(m, lambda line: line[{_REG_SIZE + 1}]) AS c FROM t_reg_solve WHERE k = {_REG_SIZE}) JOIN t_reg_gram USING (item_name)
""")
step("t_reg_ahead", f"""
SELECT a.item_name, ds, month(ds) AS month, (year(ds) - 1990) * 12 + month(ds) - 1 AS t, {_reg_flags},
       coalesce(temperature, m_avg_temperature, 0) AS avg_temperature, coalesce(rain, m_total_precipitation, 0) AS total_precipitation,
       coalesce(growth, m_yoy_price_growth_rate, 0) AS yoy_price_growth_rate
FROM t_ahead a JOIN t_reg_middle USING (item_name)
LEFT JOIN (SELECT item_name, month, avg(avg_temperature) AS temperature, avg(total_precipitation) AS rain FROM t_series GROUP BY 1, 2) c
     ON c.item_name = a.item_name AND c.month = month(a.ds)
LEFT JOIN (SELECT item_name, avg(yoy_price_growth_rate) AS growth FROM t_series GROUP BY 1) l ON l.item_name = a.item_name
""")

# Autoregression: the nine orders side by side, each solved by elimination, then step by step.
_AR = "item_name, market, origin"
step("t_ar_lags", f"""
SELECT *, {', '.join(f'lag(y0, {k}) OVER (PARTITION BY {_AR} ORDER BY pos) AS y{k}' for k in (1, 2, 3, 12, 13))}
FROM (SELECT {_AR}, pos, n AS points, mean, y - mean AS y0 FROM (SELECT *, avg(y) OVER (PARTITION BY {_AR}) AS mean FROM t_by_market))
""")
step("t_ar_orders", f"""
SELECT {_AR}, points, mean, unnest(range(9)) AS o,
       unnest([[1, y1 - y2, y0 - y1], [1, y1 - y2, y2 - y3, y0 - y1], [1, y1, y0], [1, y1, y2, y0], [1, y0 - y1], [1, y1 - 2 * y2 + y3, y0 - 2 * y1 + y2],
               [1, y1 - y2, y12 - y13, y0 - y1], [1, y12 - y13, y0 - y1], [1, y1, y12, y0]]) AS f
FROM t_ar_lags WHERE y3 IS NOT NULL AND (points <= 36 OR y13 IS NOT NULL)
""")
step("t_ar_gram", f"""
SELECT {_AR}, points, mean, o, size, list(line ORDER BY i) AS g FROM (
  SELECT {_AR}, points, mean, o, size, i, list(s ORDER BY j) AS line FROM (
    SELECT {_AR}, points, mean, o, len(f) AS size, i, j, sum(f[i] * f[j]) AS s
    FROM t_ar_orders, range(1, 5) AS a(i), range(1, 5) AS b(j)
    WHERE i <= len(f) AND j <= len(f) AND (o < 6 OR points > 36) GROUP BY ALL)
  GROUP BY ALL)
GROUP BY ALL
""")
step("t_ar_solve", f"""
SELECT {_AR}, o, size, 0 AS k, g[1:size - 1] AS m FROM t_ar_gram WHERE g[1][1] > size
UNION ALL
SELECT {_AR}, o, size, k + 1, {_eliminate} FROM t_ar_solve WHERE k < size - 1
""")
step("t_ar_best", f"""
SELECT *, [1, 2, 1, 2, 0, 1, 1, 0, 1][o + 1] AS p, [1, 1, 0, 0, 1, 2, 1, 1, 0][o + 1] AS d, o >= 6 AS seasonal,
       [[1], [1, 2], [1], [1, 2], []::INT[], [1], [1, 12], [12], [1, 12]][o + 1] AS lags, n * ln(rss / n) + 2 * size AS aic, sqrt(rss / (n - size + 1)) AS sigma
FROM (SELECT *, g[1][1] AS n, greatest(g[size][size] - 2 * list_dot_product(c, g[size][1:size - 1])
               + list_dot_product(c, list_transform(g[1:size - 1], lambda line: list_dot_product(line[1:size - 1], c))), 1e-12 * greatest(g[size][size], 1)) AS rss
      FROM (SELECT {_AR}, o, list_transform(m, lambda line: line[size]) AS c FROM t_ar_solve WHERE k = size - 1) JOIN t_ar_gram USING ({_AR}, o))
QUALIFY row_number() OVER (PARTITION BY {_AR} ORDER BY aic, o) = 1
""")
_ar_back = "CASE d WHEN 0 THEN h[-k] WHEN 1 THEN h[-k] - h[-k - 1] ELSE h[-k] - 2 * h[-k - 1] + h[-k - 2] END"
_ar_next = (
    lambda h, base: f"list_append({h}, {base} + coalesce(list_sum(list_transform(lags, lambda k, i: c[i + 1] * ({_ar_back.replace('h[', h + '[')}))), 0)"
    f" + CASE d WHEN 0 THEN 0 WHEN 1 THEN {h}[-1] ELSE 2 * {h}[-1] - {h}[-2] END)"
)
step("t_ar_steps", f"""
SELECT b.*, 0 AS step, h, list_append(list_transform(range(16), lambda x: 0::DOUBLE), 1::DOUBLE) AS e,
       c[1] + CASE WHEN d = 0 THEN mean * (1 - coalesce(list_sum(c[2:]), 0)) ELSE 0 END AS base
FROM t_ar_best b JOIN (SELECT {_AR}, list(y ORDER BY pos) AS h FROM t_by_market WHERE pos >= n - 16 GROUP BY ALL) USING ({_AR})
UNION ALL
SELECT * REPLACE (step + 1 AS step, {_ar_next('h', 'base')} AS h, {_ar_next('e', '0')} AS e) FROM t_ar_steps WHERE step < 6
""")
step("t_ar_values", """
SELECT *, h[-1] AS v, 1.959963984540054::DOUBLE * sigma * sqrt(list_sum(list_transform(e[17:16 + step], lambda x: x * x))) AS half FROM t_ar_steps WHERE step > 0
""")

# One regression over the last twelve rows of all series: ridge on standardised features, then step by step.
_POOL = ("y", "total_quantity_kg", "avg_temperature", "total_precipitation", "seasonal_price_index")
_POOL_SIZE = 12 * len(_POOL)
step("t_pool_ranges", f"""
SELECT {_AR}, {', '.join(f'min(coalesce({c}, 0)::DOUBLE) AS lo_{c}, max(coalesce({c}, 0)::DOUBLE) AS hi_{c}' for c in _POOL)} FROM t_by_market GROUP BY ALL
""")
step("t_pool_rows", f"""
SELECT {_AR}, pos, n, {', '.join(f'(coalesce({c}, 0)::DOUBLE - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE hi_{c} - lo_{c} END AS s_{c}' for c in _POOL)}
FROM t_by_market JOIN t_pool_ranges USING ({_AR})
""")
step("t_pool_windows", f"""
SELECT *, flatten(list([{', '.join(f's_{c}' for c in _POOL)}]) OVER (PARTITION BY {_AR} ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)) AS f FROM t_pool_rows
""")
step("t_pool_gram", f"""
SELECT list(line ORDER BY i) AS g FROM (
  SELECT i, list(s ORDER BY j) AS line FROM (
    SELECT i, j, sum(f[i] * f[j]) / count(*) AS s
    FROM (SELECT list_concat([1::DOUBLE], f, [s_y]) AS f FROM t_pool_windows WHERE pos >= 12), range(1, {_POOL_SIZE + 3}) AS a(i), range(1, {_POOL_SIZE + 3}) AS b(j)
    GROUP BY ALL)
  GROUP BY 1)
""")
step("t_pool_spread", f"""
SELECT g, list_transform(range(2, {_POOL_SIZE + 3}), lambda i: sqrt(greatest(g[i][i] - g[1][i] ** 2, 0))) AS sd FROM t_pool_gram
""")
step("t_pool_solve", f"""
SELECT 0 AS k, list_transform(range(1, {_POOL_SIZE + 1}), lambda i: list_transform(range(1, {_POOL_SIZE + 2}), lambda j:
  CASE WHEN sd[i] = 0 OR sd[j] = 0 THEN 0 ELSE (g[i + 1][j + 1] - g[1][i + 1] * g[1][j + 1]) / (sd[i] * sd[j]) END
  + CASE WHEN i = j THEN 0.01::DOUBLE / sd[{_POOL_SIZE + 1}] ELSE 0 END)) AS m
FROM t_pool_spread
UNION ALL
SELECT k + 1, {_eliminate} FROM t_pool_solve WHERE k < {_POOL_SIZE}
""")
step("t_pool_fit", f"""
SELECT c, g[1][{_POOL_SIZE + 2}] - list_dot_product(c, g[1][2:{_POOL_SIZE + 1}]) AS base
FROM (SELECT g, list_transform(m, lambda line, i: CASE WHEN sd[i] = 0 THEN 0 ELSE line[{_POOL_SIZE + 1}] * sd[{_POOL_SIZE + 1}] / sd[i] END) AS c
      FROM t_pool_solve, t_pool_spread WHERE k = {_POOL_SIZE})
""")
step("t_pool_steps", f"""
SELECT {_AR}, 0 AS step, flatten(list([{', '.join(f's_{c}' for c in _POOL)}] ORDER BY pos)) AS w, NULL::DOUBLE AS v FROM t_pool_rows WHERE n >= 12 AND pos >= n - 12 GROUP BY ALL
UNION ALL
SELECT {_AR}, step + 1, list_concat(w[{len(_POOL) + 1}:], [v_next], w[{_POOL_SIZE - len(_POOL) + 2}:]), v_next
FROM (SELECT *, base + list_dot_product(c, w) AS v_next FROM t_pool_steps, t_pool_fit WHERE step < 6)
""")

# -- regression features --------------------------------------------------------------

_MARKET_ROWS = "year, month, major_category, sub_category NULLS FIRST, profile_category NULLS FIRST, item_category NULLS FIRST"
_TRAIN_WINDOW = f"PARTITION BY item_name, market, origin ORDER BY {_MARKET_ROWS}"
step("t_training", f"""
SELECT * FROM (
SELECT *, strftime(make_date(year, month, 1), '%Y-%m-%d') AS date_key, quarter(make_date(year, month, 1))::BIGINT AS quarter,
       lag(avg_unit_price_yen, 1) OVER w AS price_lag_1m, lag(avg_unit_price_yen, 3) OVER w AS price_lag_3m,
       lag(avg_unit_price_yen, 12) OVER w AS price_lag_12m, lag(total_quantity_kg, 1) OVER w AS quantity_lag_1m
FROM (SELECT p.*, s.seasonal_price_index, s.seasonal_quantity_index, s.seasonality_level, s.sub_category AS profile_category,
             i.price_tier, i.vegetable_category, i.seasonality AS item_seasonality, i.avg_unit_price_yen AS item_avg_price,
             i.sub_category AS item_category
      FROM t_price_weather p LEFT JOIN t_seasonal s ON p.item_name = s.item_name AND p.month = s.month
           LEFT JOIN t_dim_item i ON p.item_name = i.item_name
      WHERE p.avg_unit_price_yen > 0 AND p.avg_unit_price_yen < 5000 AND p.total_quantity_kg > 0)
WINDOW w AS ({_TRAIN_WINDOW})) WHERE price_lag_1m IS NOT NULL
""")
step("t_own", """
SELECT p.*, s.seasonal_price_index, s.seasonal_quantity_index, s.seasonality_level, s.sub_category AS profile_category,
       i.price_tier, i.vegetable_category, i.seasonality AS item_seasonality, i.avg_unit_price_yen AS item_avg_price,
       i.sub_category AS item_category
FROM (SELECT *, strftime(make_date(year, month, 1), '%Y-%m-%d') AS date_key, quarter(make_date(year, month, 1))::BIGINT AS quarter,
             lag(avg_unit_price_yen, 1) OVER w AS price_lag_1m, lag(avg_unit_price_yen, 3) OVER w AS price_lag_3m,
             lag(avg_unit_price_yen, 12) OVER w AS price_lag_12m, lag(total_quantity_kg, 1) OVER w AS quantity_lag_1m
      FROM t_price_weather WHERE avg_unit_price_yen > 0 AND avg_unit_price_yen < 5000 AND total_quantity_kg > 0
      WINDOW w AS (PARTITION BY item_name, market, origin, major_category, sub_category ORDER BY year, month)) p
LEFT JOIN t_seasonal s ON p.item_name = s.item_name AND p.month = s.month AND p.sub_category IS NOT DISTINCT FROM s.sub_category
LEFT JOIN t_dim_item i ON p.item_name = i.item_name AND p.sub_category IS NOT DISTINCT FROM i.sub_category
WHERE price_lag_1m IS NOT NULL
""")
step("t_own_split", """
SELECT *, row_number() OVER (ORDER BY year, month, item_name, market, origin, major_category, sub_category NULLS FIRST,
                             profile_category NULLS FIRST, item_category NULLS FIRST)
            <= floor((SELECT count(*) FROM t_own) * (1 - 0.2)::DOUBLE) AS is_train
FROM t_own
""")
_TEXTS = ("item_name", "market", "origin", "price_tier", "vegetable_category", "item_seasonality", "seasonality_level")
_NUMBERS = (
    "price_lag_1m", "price_lag_3m", "price_lag_12m", "quantity_lag_1m", "yoy_price_growth_rate", "mom_price_growth_rate",
    "price_3month_moving_avg", "price_6month_moving_avg", "avg_temperature", "avg_max_temperature", "avg_min_temperature",
    "total_precipitation", "avg_wind_speed", "total_sunshine", "seasonal_price_index", "seasonal_quantity_index",
    "total_quantity_kg", "total_amount_yen", "item_avg_price",
)
# Year, month, volatility, two deviations, trend, four quarters and the encoded texts are never NULL.
step("t_own_complete", f"SELECT * FROM t_own_split WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _NUMBERS)}")
_TKEYS = "item_name, market, origin, year, month, major_category, sub_category, profile_category, item_category"
_code = lambda c: f"dense_rank() OVER (ORDER BY coalesce({c}, 'None')) - 1 AS {c}_encoded"

_size = lambda n: f"CASE WHEN {n} < 1000 THEN 'v' || {n} || 'r' WHEN {n} < 100000 THEN 'v' || floor({n} / 100)::BIGINT || 'h' ELSE 'v' || floor({n} / 1000)::BIGINT || 'k' END"
step("t_batch", f"""
SELECT item_name || '_' || lower(model_type) || '_' || strftime(d, '%Y%m') || '_ts' AS prediction_id, item_name, model_type,
       '2001.12_' || {_size('n')} || '_' || code || '_' || item_name AS model_version, strftime(d, '%Y-%m-%d') AS prediction_date,
       n AS training_data_points, 0.8::DOUBLE AS confidence_interval
FROM (SELECT item_name, n, (date_trunc('month', last_ds) + to_months(step::INTEGER))::DATE AS d
      FROM (SELECT item_name, max(ds::DATE) AS last_ds, count(*) AS n FROM t_without_outliers GROUP BY 1), range(1, 7) AS a(step) WHERE n >= 24),
     (VALUES ('PROPHET', 'PR'), ('ARIMA', 'AR'), ('LSTM', 'LS')) AS m(model_type, code)
UNION ALL
SELECT item_name || '_linear_regression_' || strftime(d, '%Y%m') || '_ml', item_name, 'LINEAR_REGRESSION',
       '2001.12_' || {_size('n')} || '_LR_ML', strftime(d, '%Y-%m-%d'), n, 0.7::DOUBLE
FROM (SELECT item_name, (make_date(year, month, 1) + to_months(step::INTEGER))::DATE AS d FROM t_newest_price, range(1, 7) AS a(step)),
     (SELECT count(*) AS n FROM t_own_complete)
""")

ORACLE |= {
    "forecast_trend_seasonal": trend_sql("additive"),
    "forecast_trend_multiplicative": trend_sql("multiplicative"),
    "forecast_trend_regressors": sql(f"""
SELECT item_name, strftime(ds, '%Y-%m-%d') AS ds, {r('v', 4)} AS y_pred, {r(f'v - sigma * {Z80}::DOUBLE', 4)} AS lower, {r(f'v + sigma * {Z80}::DOUBLE', 4)} AS upper
FROM (SELECT item_name, ds, sigma, list_dot_product(c, {_reg_list}) AS v FROM t_reg_ahead JOIN t_reg_scale USING (item_name) JOIN t_reg_fit USING (item_name))
"""),
    "forecast_autoregressive": sql(f"""
SELECT {_AR}, p::BIGINT AS p, d::BIGINT AS d, seasonal, {r('aic', 4)} AS aic, {r('sigma', 4)} AS sigma, step::BIGINT AS step,
       {r('v', 4)} AS y_pred, {r('v - half', 4)} AS lower, {r('v + half', 4)} AS upper
FROM t_ar_values
"""),
    "forecast_recursive": sql(f"""
SELECT {_AR}, strftime((date_trunc('month', last_ds) + to_months(step::INTEGER))::DATE, '%Y-%m-%d') AS ds, {r('v * (hi_y - lo_y) + lo_y', 4)} AS y_pred,
       NULL::DOUBLE AS lower, NULL::DOUBLE AS upper, 'LSTM' AS model_type
FROM t_pool_steps JOIN t_pool_ranges USING ({_AR}) JOIN (SELECT {_AR}, max(ds::DATE) AS last_ds FROM t_by_market GROUP BY ALL) USING ({_AR}) WHERE step > 0
"""),
    "forecast_projection": sql(f"""
SELECT item_name, step, strftime(d, '%Y-%m-%d') AS prediction_date, {r('p', 2)} AS predicted_price,
       {r('greatest(0, p * 0.85::DOUBLE)', 2)} AS lower_bound, {r('p * 1.15::DOUBLE', 2)} AS upper_bound
FROM (SELECT *, avg_unit_price_yen * (1 + 0.1::DOUBLE * sin(2 * pi() * month(d) / 12)) * (1 + 0.02::DOUBLE * (step - 1)) AS p
      FROM (SELECT *, (make_date(year, month, 1) + to_months(step::INTEGER))::DATE AS d FROM t_newest_price, range(1, 7) AS a(step)))
"""),
    "future_months": sql("""
SELECT item_name, market, origin, strftime(last_ds, '%Y-%m-%d') AS last_ds, step, strftime(d, '%Y-%m-%d') AS ds, month(d)::BIGINT AS month
FROM (SELECT *, (date_trunc('month', last_ds) + to_months(step::INTEGER))::DATE AS d
      FROM (SELECT item_name, market, origin, max(ds::DATE) AS last_ds FROM t_series GROUP BY 1, 2, 3), range(1, 7) AS a(step))
"""),
    "climatology": sql(f"""
SELECT a.item_name, strftime(last_ds, '%Y-%m-%d') AS last_ds, step, strftime(a.ds, '%Y-%m-%d') AS ds, month(a.ds)::BIGINT AS month,
       {cols('avg_temperature', 'total_precipitation', 'total_quantity_kg')}
FROM t_ahead a JOIN (SELECT item_name, max(ds::DATE) AS last_ds, avg(total_quantity_kg) AS total_quantity_kg FROM t_series GROUP BY 1) USING (item_name)
LEFT JOIN (SELECT item_name, month, avg(avg_temperature) AS avg_temperature, avg(total_precipitation) AS total_precipitation
           FROM t_series GROUP BY 1, 2) c ON c.item_name = a.item_name AND c.month = month(a.ds)
"""),
    "event_calendar": sql(f"SELECT strftime(ds, '%Y-%m-%d') AS ds, {', '.join(_event(i) for i in (1, 2, 3, 4))} FROM t_days"),
    "training_features": sql("SELECT * FROM t_training"),
    "training_features_lags_first": sql("SELECT * FROM t_own"),
    "encode_categories": sql(f"""
SELECT *, {', '.join(_code(c) for c in ('item_name', 'market', 'origin', 'sub_category'))}
FROM (SELECT DISTINCT item_name, market, origin, sub_category FROM t_stg)
"""),
    "feature_deviation": sql(f"""
SELECT {_TKEYS}, {cols('price_volatility', 'temperature_deviation', 'precipitation_deviation')},
       (CASE WHEN mom_price_growth_rate > 5 THEN 1 WHEN mom_price_growth_rate < -5 THEN -1 ELSE 0 END)::BIGINT AS price_trend
FROM (SELECT *, coalesce(stddev_samp(avg_unit_price_yen) OVER (w ROWS 2 PRECEDING), 0) AS price_volatility,
             coalesce(avg_temperature - avg(avg_temperature) OVER m, 0) AS temperature_deviation,
             coalesce(total_precipitation - avg(total_precipitation) OVER m, 0) AS precipitation_deviation
      FROM t_training WINDOW w AS ({_TRAIN_WINDOW}), m AS (PARTITION BY month))
"""),
    "quarter_dummies": sql(f"""
SELECT {_TKEYS}, quarter, {', '.join(f'(quarter = {i})::BIGINT AS quarter_{i}' for i in (1, 2, 3, 4))} FROM t_training
"""),
    "backtest_status": sql(f"""
SELECT {_AR}, model_type, n AS points, CASE WHEN fit THEN train_n END AS train_points,
       CASE WHEN NOT fit OR (model_type = 'LSTM' AND n <= 12) THEN 0 WHEN n > 12 THEN n - greatest(train_n, 12) ELSE n - train_n END AS scored_rows,
       CASE WHEN NOT fit OR (model_type = 'LSTM' AND n <= 12) THEN 'too short' ELSE 'scored' END AS status
FROM (SELECT *, n >= 10 AND train_n >= 5 AND n - train_n >= 3 AS fit
      FROM (SELECT DISTINCT {_AR}, n, floor(n * (1 - 0.2)::DOUBLE)::BIGINT AS train_n FROM t_by_market)),
     (VALUES ('PROPHET'), ('ARIMA'), ('LSTM')) AS m(model_type)
"""),
    "prediction_union": sql("SELECT * FROM t_batch"),
    "batch_metadata": sql("""
SELECT model_type, count(*) AS predictions, count(DISTINCT item_name) AS items, count(DISTINCT prediction_date) AS months,
       count(DISTINCT model_version) AS versions, count(DISTINCT prediction_id) AS ids, '200112' AS version, '2001-12-01T00:00:00' AS created_at,
       (SELECT count(*) FROM t_batch) AS total_predictions, (SELECT string_agg(DISTINCT model_type, ',' ORDER BY model_type) FROM t_batch) AS model_types,
       (SELECT count(DISTINCT item_name) FROM t_batch) AS items_covered
FROM t_batch GROUP BY model_type
"""),
    "ordered_months": sql(f"""
SELECT year, month, item_name, market, origin, major_category, sub_category, {r('avg_unit_price_yen', 6)} AS avg_unit_price_yen,
       row_number() OVER (ORDER BY year, month, item_name NULLS FIRST, market NULLS FIRST, origin NULLS FIRST, major_category NULLS FIRST, sub_category NULLS FIRST) - 1 AS position
FROM t_monthly
"""),
    "calendar_years": sql(time_sql("""
SELECT year, month FROM (SELECT unnest(range((SELECT min(year) FROM t_trades), (SELECT max(year) FROM t_trades) + 2)) AS year),
                        (SELECT unnest(range(1, 13)) AS month)""", S.AS_OF)),
    "load_tasks": sql("""
SELECT strftime(a, '%Y-%m-%d') AS start_date, strftime(z, '%Y-%m-%d') AS end_date, strftime(greatest(m, a), '%Y-%m-%d') AS slice_start,
       strftime(least(last_day(m), z), '%Y-%m-%d') AS slice_end, station_id, region
FROM (SELECT a, z, unnest(generate_series(date_trunc('month', a), z, INTERVAL 1 MONTH))::DATE AS m
      FROM (SELECT min(observation_date)::DATE AS a, max(observation_date)::DATE AS z FROM t_stg_weather)), t_dim_station
"""),
    "series_chosen": sql("""
SELECT * FROM t_series WHERE item_name = (SELECT min(item_name) FROM t_stg) AND market = (SELECT max(market) FROM t_stg)
"""),
    "model_bundle": sql(f"""
SELECT '200112' AS version, 'linear_regression' AS best_model, {10 + len(_NUMBERS) + len(_TEXTS)}::BIGINT AS features,
       (SELECT {' + '.join(f"count(DISTINCT coalesce({c}, 'None'))" for c in _TEXTS)} FROM t_own_split WHERE is_train) AS code_rows,
       count(*) FILTER (is_train) AS train_rows, count(*) FILTER (NOT is_train) AS test_rows,
       strftime(max(make_date(year, month, 1)) FILTER (is_train), '%Y-%m') AS train_end,
       strftime(min(make_date(year, month, 1)) FILTER (NOT is_train), '%Y-%m') AS test_start, count(*) FILTER (NOT is_train) AS scored_rows
FROM t_own_complete
"""),
    "chronological_split": sql(f"""
SELECT {_TKEYS}, avg_unit_price_yen,
       row_number() OVER (ORDER BY year, month, item_name, market, origin, major_category, sub_category NULLS FIRST,
                          profile_category NULLS FIRST, item_category NULLS FIRST)
         <= floor((SELECT count(*) FROM t_training) * (1 - 0.2)::DOUBLE) AS is_train
FROM t_training
"""),
}
