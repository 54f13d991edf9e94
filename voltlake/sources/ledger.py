"""Which raw files a table has taken, so that no file is loaded twice.

A load notes its files as pending before it writes, with its batch id, and as done after. If it breaks
off in between, its batch id in the table tells whether the write was complete; so a load that
is started again neither skips a file nor doubles one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.sources.readers import path_exists

FILE = ("file", "n_bytes", "modified")
LEDGER = "file STRING, n_bytes LONG, modified TIMESTAMP, batch_id STRING"


def listed(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path`` with size and time, without reading them. A missing path raises."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("path").alias("file"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified")
    )


def entries(spark: SparkSession, ledger: str, state: str) -> DataFrame:
    """The files noted as "pending" or "done"."""
    path = f"{ledger}/{state}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def taken(spark: SparkSession, ledger: str, holds: Callable[[str], bool]) -> DataFrame:
    """Files the table has: those of loads that ended, and of loads that broke off after their
    write. ``holds`` says whether the table has rows of a batch; it is asked about the latter only."""
    done = entries(spark, ledger, "done")
    ended = done.select("batch_id").distinct()
    open_ = entries(spark, ledger, "pending").join(ended, "batch_id", "left_anti")
    written = [r.batch_id for r in open_.select("batch_id").distinct().collect() if holds(r.batch_id)]
    return done.unionByName(open_.filter(F.col("batch_id").isin(written))) if written else done


def unseen(spark: SparkSession, ledger: str, path: str, holds: Callable[[str], bool]) -> DataFrame:
    """Files below ``path`` that are not taken. A file that has changed since counts as another."""
    return listed(spark, path).join(taken(spark, ledger, holds).select(*FILE), list(FILE), "left_anti")


def note(spark: SparkSession, ledger: str, state: str, files: DataFrame, batch_id: str) -> None:
    """Adds ``files`` to the ledger as "pending" or "done"."""
    rows = files.select(*FILE, F.lit(batch_id).alias("batch_id"))
    rows.coalesce(1).write.mode("append").parquet(f"{ledger}/{state}")
