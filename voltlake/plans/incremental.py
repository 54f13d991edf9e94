"""Silver and the usage marts kept up to date batch by batch, equal to a rebuild of everything.

Silver's state is the winning copy of every key before it is filled and validated: a copy that fails the
ranges still hides older ones, as it does in a rebuild. The state is partitioned by what
follows from the key, by month where the key has a time and else by a hash, and a batch touches only the
partitions its keys fall into. Silver and the rejects are projections of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.functions.columns import hash_key
from voltlake.operators import refine as R
from voltlake.operators.merge import merge_into, read_table
from voltlake.plans import gold, marts
from voltlake.specs import SPECS, TableSpec

PART = "part"
BUCKETS = 256  # partitions of a table whose key has no time


def state_path(root: str, spec: TableSpec) -> str:
    return f"{root}/silver/state/{spec.name}"


def partition_of(spec: TableSpec, buckets: int = BUCKETS) -> Column:
    if "timestamp" in spec.key:
        month = F.year("timestamp") * 100 + F.month("timestamp")
        return F.coalesce(month, F.lit(marts.UNDATED)).cast("int")
    return F.pmod(hash_key(*spec.key), F.lit(buckets)).cast("int")


def merge_batch(
    spark: SparkSession, bronze: DataFrame, spec: TableSpec, root: str, buckets: int = BUCKETS
) -> DataFrame:
    """Brings Bronze rows into the state of a Silver table; returns the partitions touched."""
    prepared = R.standardise(R.convert_types(bronze, spec), spec)
    return merge_into(
        spark, state_path(root, spec), prepared.withColumn(PART, partition_of(spec, buckets)),
        spec.key, spec.recency, [PART],
    )


def state(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    return read_table(spark, state_path(root, spec))


def silver(state_rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Silver of a state, as :func:`voltlake.operators.refine.refine` gives it of all of Bronze."""
    valid = R.validate(R.fill_measures(state_rows, spec), spec)
    return R.add_audit_columns(R.add_key(valid, spec)).drop(PART)


def rejected(state_rows: DataFrame, spec: TableSpec) -> DataFrame:
    tagged = R.tag_failures(R.fill_measures(state_rows, spec), spec)
    return tagged.filter(F.size("failed_rules") > 0).drop(PART)


def refresh_usage(spark: SparkSession, root: str, months: DataFrame) -> None:
    """Recomputes the usage states of the days in the touched ``months`` of energy readings.

    Only these months are read; a day whose readings have all become invalid gets an empty state.
    """
    spec = SPECS["energy_usage"]
    rows = state(spark, spec, root).withColumn("month_key", F.col(PART))
    wanted = months.filter(F.col(PART) >= marts.UNDATED)
    here = rows.join(wanted, PART, "left_semi")
    readings = gold.energy_readings(silver(here, spec))
    days = here.select(
        F.col(PART).alias("month_key"),
        F.coalesce(F.date_format("timestamp", "yyyyMMdd").cast("int"), F.lit(marts.UNDATED)).alias("date_key"),
    ).distinct()
    marts.refresh_states(readings, days, f"{root}/gold")
