"""The raw readings of ``standins`` in DuckDB's SQL."""

SENT = """
sent_{n} AS (
  SELECT event_id, user_id, event_type, ts, floor(value * 4) / 4 AS v,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, attempt,
         event_id * 2 + attempt AS reading_id,
         CASE WHEN event_id % 997 <> 0 THEN 'H' || user_id END AS household_id,
         ts + attempt * INTERVAL 1 HOUR AS reading_timestamp
  FROM (SELECT *, unnest(CASE WHEN event_id % {n} = 0 THEN [0, 1] ELSE [0] END) AS attempt FROM events))
"""

RAW = {
    "energy_usage": SENT.format(n=10) + """,
raw_energy_usage AS (
  SELECT reading_id, household_id,
    CASE WHEN event_id % 211 = 0 THEN '2024/01/05' ELSE strftime(ts, '%d-%m-%Y %H:%M') END AS "timestamp",
    reading_timestamp,
    CASE WHEN event_id % 53 = 0 THEN 'n/a' WHEN event_id % 59 <> 0 THEN CAST(220 + k % 20 AS VARCHAR) END AS voltage_reading,
    CAST(k * 0.25::DOUBLE AS VARCHAR) AS current_reading,
    CASE WHEN event_id % 61 = 0 THEN '-1' ELSE CAST(v AS VARCHAR) END AS active_power_kw,
    CASE WHEN event_id % 67 = 0 THEN 'NaN' ELSE CAST(k * 0.5::DOUBLE AS VARCHAR) END AS reactive_power_kvar,
    CAST(v + attempt AS VARCHAR) AS energy_usage_kwh,
    CASE WHEN event_id % 71 <> 0 THEN CAST(44 + k % 23 AS VARCHAR) END AS frequency_hz,
    CASE WHEN event_id % 73 = 0 THEN '1.25' ELSE CAST((k % 5) * 0.25::DOUBLE AS VARCHAR) END AS load_factor,
    CAST(v * 2 AS VARCHAR) AS peak_demand_kw,
    CAST(v AS VARCHAR) AS offpeak_demand_kw,
    CAST(v * 4 AS VARCHAR) AS daily_consumption_kwh,
    '  ' || lower(r_name) || ' ' AS region_name,
    ' ' || upper(replace(n_name, '_', ' ')) AS city_name,
    event_type || ' ' AS meter_type,
    lower(c_mktsegment) AS customer_category,
    'zone-' || (n_nationkey % 4) AS grid_zone
  FROM sent_10 JOIN customer ON c_custkey = user_id
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
""",
    "weather_stream": SENT.format(n=8) + """,
raw_weather_stream AS (
  SELECT reading_id, household_id, date_trunc('minute', ts) + CASE WHEN event_id % 9 = 0 THEN INTERVAL 7 MINUTE ELSE INTERVAL 0 MINUTE END AS "timestamp",
    reading_timestamp,
    CASE WHEN event_id % 31 <> 0 THEN CAST(k % 40 - 5 AS DOUBLE) END AS temperature_celsius,
    CAST(k AS DOUBLE) AS humidity_percent,
    k * 0.5::DOUBLE AS wind_speed_kmh,
    v + attempt AS rainfall_mm,
    CASE WHEN event_id % 37 = 0 THEN -1::DOUBLE ELSE 950::DOUBLE + k END AS pressure_hpa,
    CASE WHEN event_id % 41 = 0 THEN 'NaN'::DOUBLE ELSE k * 4::DOUBLE END AS solar_radiation,
    CAST(k % 20 AS DOUBLE) AS dew_point,
    CAST(k % 12 AS DOUBLE) AS uv_index,
    k * 0.25::DOUBLE AS visibility_km,
    CAST(k AS DOUBLE) AS cloud_cover_percent,
    ' REGION ' || (user_id % 5) AS weather_region,
    'city ' || (user_id % 25) || ' ' AS weather_city,
    'st-' || (user_id % 7) AS weather_station,
    ' climate-' || (user_id % 3) AS climate_zone,
    ['sunny', 'Rainy ', ' cloudy', 'WINDY'][k % 4 + 1] AS condition_type
  FROM sent_8)
""",
    "device_metrics": """
raw_device_metrics AS (
  SELECT 'H' || l_suppkey AS household_id, l_shipdate AS reading_timestamp,
    CAST(q * 10 AS VARCHAR) AS runtime_hours,
    CASE WHEN q = 13 THEN 'off' ELSE CAST(q * 0.25::DOUBLE AS VARCHAR) END AS device_power_kw,
    CAST(p_size * 100 AS VARCHAR) AS motor_speed_rpm,
    CASE WHEN l_orderkey % 47 = 0 THEN '1.25' ELSE CAST((q % 5) * 0.25::DOUBLE AS VARCHAR) END AS efficiency_ratio,
    CASE WHEN q <> 17 THEN CAST(q AS VARCHAR) END AS energy_draw_kwh,
    CAST(p_size AS VARCHAR) AS heat_output,
    CAST(p_size * 0.5::DOUBLE AS VARCHAR) AS cooling_load,
    '230' AS device_voltage,
    CAST(q * 0.5::DOUBLE AS VARCHAR) AS device_current,
    CAST(l_orderkey % 60 - 3 AS VARCHAR) AS device_temperature,
    lower(p_type) || ' ' AS device_category,
    '  ' || upper(p_brand) AS device_brand,
    CASE WHEN l_linenumber % 2 = 0 THEN ' ' || lower(p_brand) || '-' || (p_size % 10)
         ELSE upper(p_brand) || '-' || (p_size % 10) END AS device_model,
    ['ok', ' Due', 'repair '][l_linenumber % 3 + 1] AS maintenance_status,
    CASE WHEN l_linestatus = 'O' THEN ' north wing' ELSE 'SOUTH wing ' END AS installation_region
  FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lineitem) JOIN part ON p_partkey = l_partkey)
""",
    "grid_load": """
raw_grid_load AS (
  SELECT 'H' || l_partkey AS household_id, l_shipdate AS reading_timestamp,
    CAST(11000 + q AS VARCHAR) AS grid_voltage,
    CASE WHEN q = 7 THEN '' ELSE CAST(q * 2 AS VARCHAR) END AS grid_current,
    CAST(q * 8 AS VARCHAR) AS grid_load_kw,
    CASE WHEN l_orderkey % 83 = 0 THEN '-0.25' ELSE CAST(q * 0.25::DOUBLE AS VARCHAR) END AS transformer_load,
    CAST(CASE WHEN l_orderkey % 89 = 0 THEN 100.25::DOUBLE ELSE q * 2::DOUBLE END AS VARCHAR) AS line_loss_percent,
    CAST(q - 25 AS VARCHAR) AS load_variation,
    CAST((q - 25) * 0.25::DOUBLE AS VARCHAR) AS frequency_variation,
    CAST(500 + q AS VARCHAR) AS grid_capacity_kw,
    CASE WHEN q <> 23 THEN CAST(q * 8 + l_linenumber - 4 AS VARCHAR) END AS demand_forecast_kw,
    CAST(20 - q AS VARCHAR) AS reserve_margin,
    ' grid ' || (l_suppkey % 5) AS grid_region,
    CASE WHEN l_linenumber % 2 = 0 THEN 'sub ' || (l_suppkey % 10)
         ELSE 'SUB ' || (l_suppkey % 10) || ' ' END AS substation_name,
    'f-' || (l_linenumber % 3) AS feeder_line,
    'zone ' || (l_suppkey % 4) AS distribution_zone,
    CASE WHEN l_linestatus = 'O' THEN 'NORTHERN power' ELSE ' southern GRID' END AS grid_operator
  FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lineitem))
""",
    "tariff_metrics": """
raw_tariff_metrics AS (
  SELECT o_orderkey AS reading_id, 'H' || o_custkey AS household_id,
    CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-m%m')
         ELSE ' ' || strftime(o_orderdate, '%Y-M%m') END AS billing_cycle,
    o_orderdate AS reading_timestamp,
    CAST((p % 40) * 0.25::DOUBLE AS VARCHAR) AS unit_rate,
    CAST((p % 80) * 0.25::DOUBLE AS VARCHAR) AS peak_rate,
    CAST((p % 20) * 0.25::DOUBLE AS VARCHAR) AS offpeak_rate,
    CASE WHEN o_orderkey % 43 <> 0 THEN '50' END AS fixed_charge,
    CAST(p % 1000 AS VARCHAR) AS tax_amount,
    CASE WHEN o_orderkey % 19 = 0 THEN 'none' ELSE CAST(p % 100 AS VARCHAR) END AS subsidy_amount,
    CAST(p AS VARCHAR) AS monthly_bill,
    CAST(p % 700 AS VARCHAR) AS billing_units,
    CASE WHEN o_orderkey % 97 = 0 THEN '-5' ELSE CAST(p % 50 AS VARCHAR) END AS late_fee,
    CAST(o_orderkey % 3 AS VARCHAR) AS adjustment_amount,
    'REGION ' || (o_custkey % 5) AS tariff_region,
    ' city ' || (o_custkey % 25) AS tariff_city,
    lower(o_orderpriority) || ' ' AS tariff_plan_type,
    'provider ' || lower(o_orderstatus) AS utility_provider
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS p FROM orders))
""",
}
