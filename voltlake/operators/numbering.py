"""Dense numbers for keys, kept from one run to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltlake.session import stored
from voltlake.sources.readers import path_exists


def numbers(spark: SparkSession, path: str, key: str, kind: str = "string") -> DataFrame:
    """(key, number) of all keys numbered so far."""
    schema = f"{key} {kind}, number long"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def number_new(spark: SparkSession, path: str, rows: DataFrame, key: str) -> DataFrame:
    """Gives every key of ``rows`` that has none the next number, from 1 on without gaps, and
    returns the whole table. Null is no key.

    New keys are dealt out in ranges and numbered within them, from where the ranges before
    leave off; only one row per range meets in one place. One run at a time may number a table.
    """
    known = numbers(spark, path, key, rows.schema[key].dataType.simpleString())
    new = rows.select(key).filter(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")
    cut = stored(new.repartitionByRange(key).withColumn("_range", F.spark_partition_id()), "new-keys")
    if cut.isEmpty():
        return known
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    used = known.agg(F.coalesce(F.max("number"), F.lit(0))).scalar()
    numbered = cut.join(F.broadcast(ranges), "_range").select(
        key, (used + F.col("_before") + within).cast("long").alias("number")
    )
    # The keys lie in a table of their own, and the files that hold the largest number so far stay as they are.
    numbered.write.mode("append").parquet(path)
    return numbers(spark, path, key, rows.schema[key].dataType.simpleString())
