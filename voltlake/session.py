"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

# Settings the jobs in this package were planned for. Sizes that depend on the
# cluster (executors, memory, shuffle partitions) stay with whoever submits.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def build_session(app: str = "voltlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with this package's defaults; ``conf`` holds full setting names and wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """New folder for one job's written tables, below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a local session without
    that setting falls back to a temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="voltlake-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """The same rows as a table in the shared folder: computed once, and read again from there
    by every use and after a lost executor."""
    path = work_dir(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def side_by_side(
    spark: SparkSession, tasks: Mapping[str, Callable[[], Result]], at_once: int = 8
) -> dict[str, Result]:
    """Runs independent Spark jobs at the same time, so that one's last tasks do not idle
    the cluster. All of them finish; then the first failure, if any, is raised."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in tasks.items()
        }
    return {name: job.result() for name, job in running.items()}
