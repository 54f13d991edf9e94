"""Raw readings in the shape of the five domain tables, derived from the given tables.

The given tables hold no household readings, so each domain table is computed from
one of them, row for row, with the faults the refine step has to deal with: copies
sent twice, unreadable numbers and times, nulls, NaN, values out of range, padded
and mixed-case text. Measures are multiples of 1/4, which both engines add exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.operators.skew import spread_join

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sent(spark: SparkSession, sf_dir: str, resend_every: int) -> DataFrame:
    """Events as readings; every n-th one arrives a second time, an hour later."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
        (F.floor(F.col("value") * 4) / 4).alias("v"),
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
        F.explode(
            F.when(F.col("event_id") % resend_every == 0, F.array(F.lit(0), F.lit(1)))
            .otherwise(F.array(F.lit(0)))
        ).alias("attempt"),
    )
    return events.withColumns(
        {
            "reading_id": F.col("event_id") * 2 + F.col("attempt"),
            "household_id": F.expr("CASE WHEN event_id % 997 <> 0 THEN concat('H', user_id) END"),
            "reading_timestamp": F.expr("ts + make_dt_interval(0, attempt)"),
        }
    )


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "n_nationkey", "n_name", "r_name")
    )


def energy_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = spread_join(
        _sent(spark, sf_dir, 10), households(spark, sf_dir), ["user_id"], ["event_id"], "inner"
    )
    return readings.selectExpr(
        "reading_id",
        "household_id",
        "CASE WHEN event_id % 211 = 0 THEN '2024/01/05' "
        "ELSE date_format(ts, 'dd-MM-yyyy HH:mm') END AS timestamp",
        "reading_timestamp",
        "CASE WHEN event_id % 53 = 0 THEN 'n/a' WHEN event_id % 59 <> 0 "
        "THEN cast(220 + k % 20 AS string) END AS voltage_reading",
        "cast(k * 0.25D AS string) AS current_reading",
        "CASE WHEN event_id % 61 = 0 THEN '-1' ELSE cast(v AS string) END AS active_power_kw",
        "CASE WHEN event_id % 67 = 0 THEN 'NaN' ELSE cast(k * 0.5D AS string) END AS reactive_power_kvar",
        "cast(v + attempt AS string) AS energy_usage_kwh",
        "CASE WHEN event_id % 71 <> 0 THEN cast(44 + k % 23 AS string) END AS frequency_hz",
        "CASE WHEN event_id % 73 = 0 THEN '1.25' ELSE cast((k % 5) * 0.25D AS string) END AS load_factor",
        "cast(v * 2 AS string) AS peak_demand_kw",
        "cast(v AS string) AS offpeak_demand_kw",
        "cast(v * 4 AS string) AS daily_consumption_kwh",
        "concat('  ', lower(r_name), ' ') AS region_name",
        "concat(' ', upper(replace(n_name, '_', ' '))) AS city_name",
        "concat(event_type, ' ') AS meter_type",
        "lower(c_mktsegment) AS customer_category",
        "concat('zone-', n_nationkey % 4) AS grid_zone",
    )


def weather_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _sent(spark, sf_dir, 8)
        .selectExpr(
            "reading_id",
            "household_id",
            # Some stations report for another minute, so some readings have no weather.
            "date_trunc('minute', ts) + make_dt_interval(0, 0, if(event_id % 9 = 0, 7, 0)) AS timestamp",
            "reading_timestamp",
            "CASE WHEN event_id % 31 <> 0 THEN cast(k % 40 - 5 AS double) END AS temperature_celsius",
            "cast(k AS double) AS humidity_percent",
            "k * 0.5D AS wind_speed_kmh",
            "v + attempt AS rainfall_mm",
            "CASE WHEN event_id % 37 = 0 THEN -1D ELSE 950D + k END AS pressure_hpa",
            "CASE WHEN event_id % 41 = 0 THEN double('NaN') ELSE k * 4D END AS solar_radiation",
            "cast(k % 20 AS double) AS dew_point",
            "cast(k % 12 AS double) AS uv_index",
            "k * 0.25D AS visibility_km",
            "cast(k AS double) AS cloud_cover_percent",
            "concat(' REGION ', user_id % 5) AS weather_region",
            "concat('city ', user_id % 25, ' ') AS weather_city",
            "concat('st-', user_id % 7) AS weather_station",
            "concat(' climate-', user_id % 3) AS climate_zone",
            "element_at(array('sunny', 'Rainy ', ' cloudy', 'WINDY'), k % 4 + 1) AS condition_type",
        )
    )


def device_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {"p_partkey": F.col("l_partkey"), "q": F.col("l_quantity").cast("int")}
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return spread_join(lines, parts, ["p_partkey"], ["l_orderkey"], "inner").selectExpr(
        "concat('H', l_suppkey) AS household_id",
        "cast(l_shipdate AS timestamp) AS reading_timestamp",
        "cast(q * 10 AS string) AS runtime_hours",
        "CASE WHEN q = 13 THEN 'off' ELSE cast(q * 0.25D AS string) END AS device_power_kw",
        "cast(p_size * 100 AS string) AS motor_speed_rpm",
        "CASE WHEN l_orderkey % 47 = 0 THEN '1.25' ELSE cast((q % 5) * 0.25D AS string) END AS efficiency_ratio",
        "CASE WHEN q <> 17 THEN cast(q AS string) END AS energy_draw_kwh",
        "cast(p_size AS string) AS heat_output",
        "cast(p_size * 0.5D AS string) AS cooling_load",
        "cast(230 AS string) AS device_voltage",
        "cast(q * 0.5D AS string) AS device_current",
        "cast(l_orderkey % 60 - 3 AS string) AS device_temperature",
        "concat(lower(p_type), ' ') AS device_category",
        "concat('  ', upper(p_brand)) AS device_brand",
        "CASE WHEN l_linenumber % 2 = 0 THEN concat(' ', lower(p_brand), '-', p_size % 10) "
        "ELSE concat(upper(p_brand), '-', p_size % 10) END AS device_model",
        "element_at(array('ok', ' Due', 'repair '), l_linenumber % 3 + 1) AS maintenance_status",
        "CASE WHEN l_linestatus = 'O' THEN ' north wing' ELSE 'SOUTH wing ' END AS installation_region",
    )


def grid_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("int"))
    return lines.selectExpr(
        "concat('H', l_partkey) AS household_id",
        "cast(l_shipdate AS timestamp) AS reading_timestamp",
        "cast(11000 + q AS string) AS grid_voltage",
        "CASE WHEN q = 7 THEN '' ELSE cast(q * 2 AS string) END AS grid_current",
        "cast(q * 8 AS string) AS grid_load_kw",
        "CASE WHEN l_orderkey % 83 = 0 THEN '-0.25' ELSE cast(q * 0.25D AS string) END AS transformer_load",
        "cast(CASE WHEN l_orderkey % 89 = 0 THEN 100.25D ELSE q * 2D END AS string) AS line_loss_percent",
        "cast(q - 25 AS string) AS load_variation",
        "cast((q - 25) * 0.25D AS string) AS frequency_variation",
        "cast(500 + q AS string) AS grid_capacity_kw",
        "CASE WHEN q <> 23 THEN cast(q * 8 + l_linenumber - 4 AS string) END AS demand_forecast_kw",
        "cast(20 - q AS string) AS reserve_margin",
        "concat(' grid ', l_suppkey % 5) AS grid_region",
        "CASE WHEN l_linenumber % 2 = 0 THEN concat('sub ', l_suppkey % 10) "
        "ELSE concat('SUB ', l_suppkey % 10, ' ') END AS substation_name",
        "concat('f-', l_linenumber % 3) AS feeder_line",
        "concat('zone ', l_suppkey % 4) AS distribution_zone",
        "CASE WHEN l_linestatus = 'O' THEN 'NORTHERN power' ELSE ' southern GRID' END AS grid_operator",
    )


def tariff_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "p", F.floor("o_totalprice").cast("long")
    )
    return orders.selectExpr(
        "o_orderkey AS reading_id",
        "concat('H', o_custkey) AS household_id",
        "CASE WHEN o_orderkey % 2 = 0 THEN date_format(o_orderdate, \"yyyy-'m'MM\") "
        "ELSE concat(' ', date_format(o_orderdate, \"yyyy-'M'MM\")) END AS billing_cycle",
        "cast(o_orderdate AS timestamp) AS reading_timestamp",
        "cast((p % 40) * 0.25D AS string) AS unit_rate",
        "cast((p % 80) * 0.25D AS string) AS peak_rate",
        "cast((p % 20) * 0.25D AS string) AS offpeak_rate",
        "CASE WHEN o_orderkey % 43 <> 0 THEN '50' END AS fixed_charge",
        "cast(p % 1000 AS string) AS tax_amount",
        "CASE WHEN o_orderkey % 19 = 0 THEN 'none' ELSE cast(p % 100 AS string) END AS subsidy_amount",
        "cast(p AS string) AS monthly_bill",
        "cast(p % 700 AS string) AS billing_units",
        "CASE WHEN o_orderkey % 97 = 0 THEN '-5' ELSE cast(p % 50 AS string) END AS late_fee",
        "cast(o_orderkey % 3 AS string) AS adjustment_amount",
        "concat('REGION ', o_custkey % 5) AS tariff_region",
        "concat(' city ', o_custkey % 25) AS tariff_city",
        "concat(lower(o_orderpriority), ' ') AS tariff_plan_type",
        "concat('provider ', lower(o_orderstatus)) AS utility_provider",
    )


RAW = {
    "energy_usage": energy_usage,
    "weather_stream": weather_stream,
    "device_metrics": device_metrics,
    "grid_load": grid_load,
    "tariff_metrics": tariff_metrics,
}
