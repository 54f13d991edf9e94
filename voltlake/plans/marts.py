"""Daily, monthly and yearly usage out of one table of states that can be added up.

A state holds what the readings of one day, region and range of 32,768 households come to: sums,
maxima, and the households themselves as the bits of a bitmap, by their dense numbers. Days
add up to months and months to years without a look at the readings, distinct households included.
States lie in a folder per day; a refresh recomputes the days a batch touches and replaces only
their folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.operators.numbering import number_new, numbers
from voltlake.sources.readers import path_exists

DAY = ("month_key", "date_key")
UNDATED = 0  # the day and month of readings without a time
HOUSEHOLD_NUMBERS = "household_numbers"
USAGE_STATES = "usage_states"

STATES = (
    "region_name STRING, bucket LONG, n_readings LONG, total_kwh DOUBLE, max_kwh DOUBLE, "
    "peak_kw DOUBLE, households BINARY, month_key INT, date_key INT"
)


def _day(column: str) -> Column:
    return F.coalesce(column, F.lit(UNDATED))


def usage_states(readings: DataFrame, household_numbers: DataFrame) -> DataFrame:
    """States of ``readings`` (see :func:`voltlake.plans.gold.energy_readings`).

    Readings are summed per day and household before they meet the numbers and the other
    households of their range; readings without a household are a range of their own.
    """
    per_household = (
        readings.groupBy(*[_day(c).alias(c) for c in DAY], "region_name", "household_id")
        .agg(
            F.count(F.lit(1)).alias("n_readings"),
            F.sum("energy_usage_kwh").alias("total_kwh"),
            F.max("energy_usage_kwh").alias("max_kwh"),
            F.max("peak_demand_kw").alias("peak_kw"),
        )
        .join(household_numbers, "household_id", "left")
    )
    return per_household.groupBy(*DAY, "region_name", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.sum("n_readings").alias("n_readings"),
        F.sum("total_kwh").alias("total_kwh"),
        F.max("max_kwh").alias("max_kwh"),
        F.max("peak_kw").alias("peak_kw"),
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("households"),
    )


def _write(states: DataFrame, path: str) -> None:
    """Replaces the folders of the days in ``states`` and leaves all others alone."""
    (
        states.hint("rebalance", *DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY)
        .parquet(path)
    )


def read_states(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/{USAGE_STATES}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATES)
    return spark.read.schema(STATES).parquet(path)


def touched_days(rows: DataFrame) -> DataFrame:
    """The days of ``rows``: one row per calendar day at most."""
    return rows.select(*[_day(c).alias(c) for c in DAY]).distinct()


def refresh_states(readings: DataFrame, days: DataFrame | None, root: str) -> None:
    """Recomputes the states of ``days`` (month_key, date_key; see :func:`touched_days`) from all
    ``readings`` and publishes them below ``root``. A day that has no reading left gets an empty state.
    None stands for all days of ``readings``.

    ``readings`` should be partitioned by month_key: the days then prune what is read of it.
    """
    spark = readings.sparkSession
    if days is None:
        known = number_new(spark, f"{root}/{HOUSEHOLD_NUMBERS}", readings, "household_id")
        _write(usage_states(readings, known), f"{root}/{USAGE_STATES}")
        return
    # Says that few days are wanted, so that Spark prunes partitions by them as it runs.
    days = days.filter(F.col("date_key") >= UNDATED)
    keyed = readings.withColumns({f"_{c}": _day(c) for c in DAY})
    wanted = days.select(*[F.col(c).alias(f"_{c}") for c in DAY])
    rows = keyed.join(wanted, [f"_{c}" for c in DAY], "left_semi").select(readings.columns)
    known = number_new(spark, f"{root}/{HOUSEHOLD_NUMBERS}", rows, "household_id")
    states = usage_states(rows, known)
    emptied = days.join(states, list(DAY), "left_anti").select(
        *DAY, *[F.lit(None).cast(f.dataType).alias(f.name) for f in states.schema if f.name not in (*DAY, "n_readings")],
        F.lit(0).cast("long").alias("n_readings"),
    )
    _write(states.unionByName(emptied), f"{root}/{USAGE_STATES}")


def household_numbers(spark: SparkSession, root: str) -> DataFrame:
    return numbers(spark, f"{root}/{HOUSEHOLD_NUMBERS}", "household_id")


def _rolled_up(states: DataFrame, name: str, period: Column) -> DataFrame:
    """States of a period: days of one range of households first, then the ranges."""
    used = states.filter("n_readings > 0")
    per_bucket = used.groupBy(F.nullif(period, F.lit(UNDATED)).alias(name), "region_name", "bucket").agg(
        F.sum("n_readings").alias("n"),
        F.sum("total_kwh").alias("total"),
        F.max("max_kwh").alias("max_kwh"),
        F.max("peak_kw").alias("peak_kw"),
        F.bitmap_or_agg("households").alias("households"),
    )
    return per_bucket.groupBy(name, "region_name").agg(
        F.sum("n").alias("n_readings"),
        F.sum("total").alias("total_kwh"),
        (F.sum("total") / F.sum("n")).alias("avg_kwh"),
        F.max("max_kwh").alias("max_kwh"),
        F.max("peak_kw").alias("peak_kw"),
        F.sum(F.bitmap_count("households")).alias("n_households"),
    )


def daily_summary(states: DataFrame) -> DataFrame:
    return _rolled_up(states, "date_key", F.col("date_key"))


def monthly_summary(states: DataFrame) -> DataFrame:
    return _rolled_up(states, "month_key", F.col("month_key"))


def yearly_summary(states: DataFrame) -> DataFrame:
    return _rolled_up(states, "year", F.expr("date_key div 10000").cast("int"))
