"""Dashboard queries and forecast-ready features over the Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GOOD_STATUS = "OK"


def consumption_by_segment(fact: DataFrame) -> DataFrame:
    """Total and average usage by region, by city, by category and overall.

    Summed per combination first; the grouping sets only see the combinations.
    """
    segments = ["region_name", "city_name", "customer_category"]
    combined = fact.groupBy(*segments).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("energy_usage_kwh").alias("_kwh")
    )
    return combined.groupingSets([[s] for s in segments] + [[]], *segments).agg(
        F.grouping_id().cast("int").alias("grouping"),
        F.sum("_n").alias("n_readings"),
        F.sum("_kwh").alias("total_kwh"),
        (F.sum("_kwh") / F.sum("_n")).alias("avg_kwh"),
    )


def weather_impact(fact: DataFrame) -> DataFrame:
    """How usage moves with temperature, per weather condition."""
    return (
        fact.filter("condition_type IS NOT NULL")
        .groupBy("condition_type")
        .agg(
            F.count(F.lit(1)).alias("n_readings"),
            F.avg("energy_usage_kwh").alias("avg_kwh"),
            F.avg("temperature_celsius").alias("avg_temperature"),
            # Null, not an error, where one of the two never changes.
            F.try_divide(
                F.covar_pop("temperature_celsius", "energy_usage_kwh"),
                F.stddev_pop("temperature_celsius") * F.stddev_pop("energy_usage_kwh"),
            ).alias("correlation"),
            F.regr_slope("energy_usage_kwh", "temperature_celsius").alias("kwh_per_degree"),
        )
    )


def device_health(device: DataFrame) -> DataFrame:
    attention = F.count_if(F.col("maintenance_status") != GOOD_STATUS)
    return device.groupBy("device_category", "device_brand").agg(
        F.count(F.lit(1)).alias("n_devices"),
        F.avg("runtime_hours").alias("avg_runtime"),
        F.avg("efficiency_ratio").alias("avg_efficiency"),
        F.max("device_temperature").alias("max_temperature"),
        attention.alias("n_need_maintenance"),
        (attention / F.count(F.lit(1))).alias("maintenance_share"),
    )


def worst_devices(device: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` least efficient devices of each brand; longer runtime is worse on a tie."""
    order = Window.partitionBy("device_brand").orderBy(
        F.col("efficiency_ratio").asc(),
        F.col("runtime_hours").desc(),
        F.col("household_id").asc_nulls_last(),
        F.col("device_model").asc_nulls_last(),
    )
    return (
        device.select("device_brand", "household_id", "device_model", "efficiency_ratio", "runtime_hours")
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= n)
    )


def billing_analytics(tariff: DataFrame, households: DataFrame) -> DataFrame:
    """Revenue per plan, region and customer category, with its share of the whole.

    Bills are summed per household and plan before the households are looked up.
    """
    amounts = ("monthly_bill", "tax_amount", "late_fee", "subsidy_amount")
    per_household = tariff.groupBy("household_id", "tariff_plan_type", "tariff_region").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(a).alias(a) for a in amounts]
    )
    categories = households.select("household_id", "customer_category")
    grouped = (
        per_household.join(categories, "household_id", "left")
        .groupBy("tariff_plan_type", "tariff_region", "customer_category")
        .agg(
            F.sum("_n").alias("n_bills"),
            F.sum("monthly_bill").alias("billed"),
            F.sum("tax_amount").alias("tax"),
            F.sum("late_fee").alias("late_fees"),
            F.sum("subsidy_amount").alias("subsidies"),
        )
        .withColumn("revenue", F.expr("billed + tax + late_fees - subsidies"))
    )
    total = tariff.agg(
        F.sum(F.expr("monthly_bill + tax_amount + late_fee - subsidy_amount"))
    ).scalar()
    return grouped.withColumn("revenue_share", F.col("revenue") / total)


def forecast_features(fact: DataFrame) -> DataFrame:
    """Usage per household and day with lags, a 7-row mean and calendar flags.

    The windows run over days, so a household has at most one row per calendar day
    in them, however many readings it sent.
    """
    daily = (
        fact.filter("household_id IS NOT NULL AND timestamp IS NOT NULL")
        .groupBy("household_id", F.to_date("timestamp").alias("date"))
        .agg(F.sum("energy_usage_kwh").alias("kwh"), F.count(F.lit(1)).alias("n_readings"))
    )
    by_day = Window.partitionBy("household_id").orderBy("date")
    weekday = F.weekday("date") + 1
    return daily.select(
        "household_id", "date", "kwh", "n_readings",
        F.lag("kwh", 1).over(by_day).alias("kwh_lag_1"),
        F.lag("kwh", 7).over(by_day).alias("kwh_lag_7"),
        F.avg("kwh").over(by_day.rowsBetween(-6, 0)).alias("kwh_mean_7"),
        weekday.alias("iso_weekday"),
        (weekday >= 6).alias("is_weekend"),
        F.month("date").alias("month"),
    )


def forecast_error(grid: DataFrame) -> DataFrame:
    """Demand forecast against measured load, per distribution zone."""
    error = F.col("demand_forecast_kw") - F.col("grid_load_kw")
    return grid.groupBy("distribution_zone").agg(
        F.count(F.lit(1)).alias("n_feeders"),
        F.avg("grid_load_kw").alias("avg_load_kw"),
        F.avg(error).alias("mean_error_kw"),
        F.avg(F.abs(error)).alias("mean_abs_error_kw"),
        F.max(F.abs(error)).alias("max_abs_error_kw"),
    )
