"""Audited loading into Bronze, and the layer schemas and audit table it needs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.sources import ledger, readers, snapshots
from voltlake.specs import TableSpec

LAYERS = ("bronze", "silver", "gold")

# Names and types of the audit columns.
AUDIT_SCHEMA = (
    "process_name STRING, source_file STRING, target_table STRING, records_processed LONG, "
    "status STRING, error_message STRING, log_timestamp TIMESTAMP"
)


def create_layers(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """One schema per layer, each with its own folder below ``root``."""
    names = []
    for layer in LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{prefix}{layer}` LOCATION '{root}/{layer}'")
        names.append(f"{prefix}{layer}")
    return names


def create_audit_table(spark: SparkSession, name: str, location: str) -> None:
    """The audit log as a catalog table.

    Each process appends in its own subfolder, so loads that run side by side do not
    share a commit folder; the table reads all of them.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({AUDIT_SCHEMA}) USING parquet "
        f"OPTIONS (recursiveFileLookup 'true') LOCATION '{location}'"
    )


def append_audit(
    spark: SparkSession,
    location: str,
    process: str,
    source_file: str,
    target_table: str,
    n_rows: int,
    error: str | None = None,
) -> None:
    outcome = (n_rows, "FAILED" if error else "SUCCESS", error)
    append_outcomes(spark, location, process, source_file, target_table, [outcome])


def append_outcomes(
    spark: SparkSession,
    location: str,
    process: str,
    source_file: str,
    target_table: str,
    outcomes: Sequence[tuple[int, str, str | None]],
) -> None:
    """One audit row for each (rows, status, message), in one write."""
    if not outcomes:
        return
    rows = [(process, source_file, target_table, *outcome) for outcome in outcomes]
    columns = AUDIT_SCHEMA.rsplit(",", 1)[0]
    (
        spark.createDataFrame(rows, columns)
        .withColumn("log_timestamp", F.current_timestamp())
        .coalesce(1)
        .write.mode("append")
        .parquet(f"{location}/{process}")
    )


def read_audit(spark: SparkSession, location: str) -> DataFrame:
    return (
        spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", True).parquet(location)
    )


def audited(
    spark: SparkSession,
    load: Callable[[], int],
    audit_location: str,
    process: str,
    source_file: str,
    target_table: str,
) -> int:
    """Runs ``load``, which returns its rows, and records the outcome; a failure is raised again."""
    try:
        n_rows = load()
    except Exception as failure:
        append_audit(
            spark, audit_location, process, source_file, target_table, 0,
            str(failure) or type(failure).__name__,
        )
        raise
    append_audit(spark, audit_location, process, source_file, target_table, n_rows)
    return n_rows


def audited_load(
    spark: SparkSession,
    read: Callable[[], DataFrame],
    table_path: str,
    audit_location: str,
    process: str,
    source_file: str,
    target_table: str,
    mode: str = "append",
) -> int:
    """Publishes what ``read`` returns and records the outcome; a failure is raised again.

    The row count comes from the write, so the source is read once.
    """
    return audited(
        spark, lambda: snapshots.publish(spark, read(), table_path, mode)[1], audit_location,
        process, source_file, target_table,
    )


def ingest(
    spark: SparkSession,
    spec: TableSpec,
    raw_path: str,
    root: str,
    batch_id: str | None = None,
) -> int:
    """Appends what is new in a raw Parquet file or folder to the Bronze table of ``spec``.

    Files that the ledger has, by path, size and time, are left alone: loading a folder again
    adds the files that have come since, and 0 rows if there are none.
    """
    batch_id = batch_id or str(uuid.uuid4())
    bronze, ledger_at = bronze_path(root, spec), ledger_path(root, spec)

    def load() -> int:
        # As many paths as Spark lists on the driver to read a folder.
        files = ledger.unseen(spark, ledger_at, raw_path, partial(_holds, spark, bronze)).collect()
        if not files:
            return 0
        entries = spark.createDataFrame(files, ledger.LEDGER.rsplit(",", 1)[0])
        ledger.note(spark, ledger_at, "pending", entries, batch_id)
        raw = readers.read_files(spark, raw_path, [f.file for f in files])
        _, n_rows = snapshots.publish(spark, readers.with_lineage(raw, batch_id), bronze)
        ledger.note(spark, ledger_at, "done", entries, batch_id)
        return n_rows

    return audited(
        spark, load, audit_path(root), spec.process,
        raw_path.rstrip("/").rsplit("/", 1)[-1], f"bronze.{spec.bronze_name}",
    )


def _holds(spark: SparkSession, bronze: str, batch_id: str) -> bool:
    if not snapshots.versions(spark, bronze):
        return False
    rows = snapshots.read_snapshot(spark, bronze).select("batch_id")
    return not rows.filter(F.col("batch_id") == batch_id).isEmpty()


def loaded_batches(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """batch_id of every load that the Bronze table holds."""
    holds = partial(_holds, spark, bronze_path(root, spec))
    return ledger.taken(spark, ledger_path(root, spec), holds).select("batch_id").distinct()


def bronze_path(root: str, spec: TableSpec) -> str:
    return f"{root}/bronze/{spec.bronze_name}"


def ledger_path(root: str, spec: TableSpec) -> str:
    return f"{root}/bronze/ledger/{spec.name}"


def silver_path(root: str, spec: TableSpec) -> str:
    return f"{root}/silver/{spec.name}"


def gold_path(root: str, name: str) -> str:
    return f"{root}/gold/{name}"


def audit_path(root: str) -> str:
    return f"{root}/bronze/audit_log"
