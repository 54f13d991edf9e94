"""Gold: staging views, dimensions, the energy fact and the summary marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake import specs
from voltlake.functions.columns import date_key, hash_key
from voltlake.operators.asof import as_of
from voltlake.operators.dedup import latest_per_key
from voltlake.operators.scd import scd2_history
from voltlake.operators.skew import spread_join
from voltlake.specs import TableSpec

HOUSEHOLD_ATTRIBUTES = (
    "region_name", "city_name", "meter_type", "customer_category", "grid_zone",
)
WEATHER_ATTRIBUTES = (
    "weather_region", "weather_city", "weather_station", "climate_zone", "condition_type",
)


def staging(silver: DataFrame, spec: TableSpec) -> DataFrame:
    """Active rows with the surrogate key first; readings with a time get a ``date_key``."""
    columns = [F.col(c) for c in (spec.surrogate, *spec.key, *spec.measures)]
    columns += [F.col(c) for c in spec.text if c not in spec.key]
    if "timestamp" in spec.key:
        columns.append(date_key(F.col("timestamp")).alias("date_key"))
    return silver.filter("record_status = 'ACTIVE'").select(*columns)


def dim_date(readings: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Every calendar day from the first to the last reading."""
    span = readings.agg(F.min(ts).cast("date").alias("first"), F.max(ts).cast("date").alias("last"))
    days = span.filter("first IS NOT NULL").select(
        F.explode(F.sequence("first", "last")).alias("date")
    )
    weekday = F.weekday("date") + 1
    return days.select(
        date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        weekday.alias("iso_weekday"),
        (weekday >= 6).alias("is_weekend"),
    )


def dim_household(energy: DataFrame) -> DataFrame:
    """One row per household with the attributes of its newest reading."""
    rows = energy.filter("household_id IS NOT NULL").select(
        "household_id", "timestamp", *HOUSEHOLD_ATTRIBUTES
    )
    newest = latest_per_key(rows, ["household_id"], ["timestamp"])
    return newest.select(
        hash_key("household_id").alias("household_key"),
        "household_id",
        *HOUSEHOLD_ATTRIBUTES,
        F.col("timestamp").alias("last_reading"),
    )


def dim_weather(weather: DataFrame) -> DataFrame:
    distinct = weather.select(*WEATHER_ATTRIBUTES).distinct()
    return distinct.withColumn("weather_profile_key", hash_key(*WEATHER_ATTRIBUTES))


def _attributes(silver: DataFrame, spec: TableSpec) -> DataFrame:
    # Silver holds one row per natural key, so the dimension is a projection.
    return silver.select(
        spec.surrogate, *spec.key, *[c for c in spec.text if c not in spec.key]
    )


def dim_device(device: DataFrame) -> DataFrame:
    return _attributes(device, specs.DEVICE_METRICS)


def dim_grid(grid: DataFrame) -> DataFrame:
    return _attributes(grid, specs.GRID_LOAD)


def dim_tariff(tariff: DataFrame) -> DataFrame:
    return _attributes(tariff, specs.TARIFF_METRICS)


def household_profile(device: DataFrame, grid: DataFrame, tariff: DataFrame) -> DataFrame:
    """Device, grid and tariff totals, one row per household.

    The three tables are stacked and summed up in one aggregation: one shuffle of
    partial sums instead of three aggregations and two joins.
    """
    stacked = (
        device.select("household_id", "device_key", "device_power_kw", "efficiency_ratio")
        .unionByName(
            grid.select("household_id", "grid_key", "grid_load_kw", "grid_capacity_kw"),
            allowMissingColumns=True,
        )
        .unionByName(
            tariff.select("household_id", "tariff_key", "monthly_bill", "unit_rate"),
            allowMissingColumns=True,
        )
    )
    return (
        stacked.filter("household_id IS NOT NULL")
        .groupBy("household_id")
        .agg(
            F.count("device_key").alias("n_devices"),
            F.sum("device_power_kw").alias("devices_power_kw"),
            F.avg("efficiency_ratio").alias("avg_device_efficiency"),
            F.count("grid_key").alias("n_feeders"),
            F.sum("grid_load_kw").alias("feeders_load_kw"),
            F.sum("grid_capacity_kw").alias("feeders_capacity_kw"),
            F.count("tariff_key").alias("n_billing_cycles"),
            F.sum("monthly_bill").alias("billed_amount"),
            F.avg("unit_rate").alias("avg_unit_rate"),
        )
    )


def energy_readings(energy: DataFrame) -> DataFrame:
    """The fact's own columns; what the summaries and dashboards need of it."""
    return energy.select(
        "energy_key",
        hash_key("household_id").alias("household_key"),
        "household_id", "timestamp",
        date_key(F.col("timestamp")).alias("date_key"),
        (F.year("timestamp") * 100 + F.month("timestamp")).cast("int").alias("month_key"),
        *HOUSEHOLD_ATTRIBUTES,
        "energy_usage_kwh", "active_power_kw", "peak_demand_kw", "offpeak_demand_kw",
        "daily_consumption_kwh", "load_factor",
    )


def with_weather(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather of the same household and time; the key is unique on both sides."""
    conditions = weather.select(
        "household_id", "timestamp", "weather_key",
        hash_key(*WEATHER_ATTRIBUTES).alias("weather_profile_key"),
        "condition_type", "temperature_celsius", "humidity_percent", "solar_radiation",
    )
    return readings.join(conditions, ["household_id", "timestamp"], "left")


def fact_energy(
    energy: DataFrame,
    weather: DataFrame,
    device: DataFrame,
    grid: DataFrame,
    tariff: DataFrame,
    published: bool = False,
) -> DataFrame:
    """One row per (household, timestamp) of the energy readings.

    Devices, feeders and tariffs have no time, so they are summed per household
    first. A household may own a large part of the readings: with ``published`` inputs its
    share is counted on the energy table and the join spread; otherwise Spark splits it.
    """
    observed = with_weather(energy_readings(energy), weather)
    profile = household_profile(device, grid, tariff)
    return spread_join(
        observed, profile, ["household_id"], ["timestamp"], "left",
        counted=energy.select("household_id") if published else None,
    )


TARIFF_TERMS = ("tariff_plan_type", "unit_rate", "peak_rate", "offpeak_rate")


def tariff_history(tariff: DataFrame, published: bool = False) -> DataFrame:
    """Type 2 history of every household's plan and rates, by the time of its bills. Of bills of one
    time the one with the largest cycle and terms counts."""
    timed = tariff.filter("household_id IS NOT NULL AND reading_timestamp IS NOT NULL")
    return scd2_history(
        timed, ["household_id"], "reading_timestamp", list(TARIFF_TERMS),
        tie_break=["billing_cycle", *TARIFF_TERMS],
        counted=timed.select("household_id") if published else None,
    )


def with_tariff(readings: DataFrame, history: DataFrame, published: bool = False) -> DataFrame:
    """Readings with the terms that held for their household at their time, and since when."""
    terms = history.select("household_id", "effective_from", F.col("effective_from").alias("tariff_since"), *TARIFF_TERMS)
    return as_of(
        readings, terms, ["household_id"], "timestamp", "effective_from", ["tariff_since", *TARIFF_TERMS],
        counted=readings.select("household_id") if published else None,
    )


def _usage_columns() -> list:
    return [
        F.count(F.lit(1)).alias("n_readings"),
        F.sum("energy_usage_kwh").alias("total_kwh"),
        F.avg("energy_usage_kwh").alias("avg_kwh"),
        F.max("energy_usage_kwh").alias("max_kwh"),
        F.max("peak_demand_kw").alias("peak_kw"),
        F.count_distinct("household_id").alias("n_households"),
    ]


def daily_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date_key", "region_name").agg(*_usage_columns())


def monthly_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("month_key", "region_name").agg(*_usage_columns())


def yearly_summary(fact: DataFrame) -> DataFrame:
    year = F.expr("date_key div 10000").cast("int").alias("year")
    return fact.groupBy(year, "region_name").agg(*_usage_columns())


def executive_dashboard(fact: DataFrame) -> DataFrame:
    """Key figures per region and category, with subtotals and the grand total.

    The readings are summed per household first, so the rollup repeats household rows
    and not readings. ``level`` is 0 for detail, 1 for a region, 3 for the total.
    """
    per_household = fact.groupBy("region_name", "customer_category", "household_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("energy_usage_kwh").alias("_kwh"),
        F.max("peak_demand_kw").alias("_peak"),
    )
    return per_household.rollup("region_name", "customer_category").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("_n").alias("n_readings"),
        F.sum("_kwh").alias("total_kwh"),
        (F.sum("_kwh") / F.sum("_n")).alias("avg_kwh"),
        F.max("_peak").alias("peak_kw"),
        F.count_distinct("household_id").alias("n_households"),
    )
