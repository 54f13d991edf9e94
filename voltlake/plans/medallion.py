"""Bronze, Silver and Gold in one run: ``python -m voltlake.plans.medallion RAW_DIR ROOT``."""

from __future__ import annotations

import sys
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.operators import quality
from voltlake.operators.refine import refine, rejects, unreadable
from voltlake.operators.scd import scd2_history
from voltlake.plans import analytics, gold, incremental, marts
from voltlake.session import build_session, side_by_side, stored
from voltlake.sources import catalog, loading, readers, snapshots
from voltlake.specs import GOLD_TABLES, RETENTION_HOURS, SPECS, TableSpec


def convert_csv(spark: SparkSession, csv_dir: str, raw_dir: str) -> None:
    """CSV files or folders named after the tables, to the Parquet files Bronze loads."""
    side_by_side(
        spark,
        {
            name: partial(
                readers.csv_to_parquet, spark, f"{csv_dir}/{name}.csv", f"{raw_dir}/{spec.raw_file}",
                spec.raw_types,
            )
            for name, spec in SPECS.items()
        },
    )


def run_bronze(spark: SparkSession, raw_dir: str, root: str) -> dict[str, int]:
    """Loads the five raw files. Every load is audited; a failed one is raised at the end."""
    batch_id = str(uuid.uuid4())
    return side_by_side(
        spark,
        {
            name: partial(loading.ingest, spark, spec, f"{raw_dir}/{spec.raw_file}", root, batch_id)
            for name, spec in SPECS.items()
        },
    )


def refresh_silver(spark: SparkSession, spec: TableSpec, root: str) -> int:
    """Rebuilds one Silver table from its Bronze table as a new version, and beside it the table
    of the rows left out, with the rules each broke."""
    bronze = snapshots.read_snapshot(spark, loading.bronze_path(root, spec))
    path = loading.silver_path(root, spec)
    if spec.ranges:
        snapshots.publish(spark, rejects(bronze, spec), rejects_path(root, spec), "overwrite")
    if spec.timestamps:
        snapshots.publish(spark, unreadable(bronze, spec), f"{rejects_path(root, spec)}_unreadable", "overwrite")
    rules = [
        *quality.must_have(spec.surrogate), quality.must_be_one_of("record_status", ["ACTIVE"]),
        *quality.must_have("household_id", severity=quality.WARN),
    ]
    tests = write_tests(root, f"silver.{spec.name}", rules)
    return snapshots.publish(
        spark, refine(bronze, spec), path, "overwrite", counts=tests.counts, judge=tests.judge
    )[1]


def write_tests(root: str, table: str, rules: list[quality.Rule]) -> quality.WriteTests:
    # Tables are written side by side, so each has its folder.
    return quality.WriteTests(table, rules, f"{root}/quality/results/{table}", f"{root}/quality/failures/{table}")


def test_results(spark: SparkSession, root: str) -> DataFrame:
    """What the tests within writes have found so far: one row per test and write."""
    found = spark.read.schema(quality.RESULTS).option("recursiveFileLookup", True)
    return found.parquet(f"{root}/quality/results")


BUCKETED = ("energy_usage", "weather_stream")  # joined on their whole key


def rejects_path(root: str, spec: TableSpec) -> str:
    return f"{root}/rejects/{spec.name}"


def run_silver(spark: SparkSession, root: str) -> dict[str, int]:
    return side_by_side(
        spark, {name: partial(refresh_silver, spark, spec, root) for name, spec in SPECS.items()}
    )


def maintain(spark: SparkSession, spec: TableSpec, root: str, retain_hours: float) -> None:
    """Clusters a Silver table on its columns, then clears expired versions.

    Clustering writes full-size files, so a compaction before it would be work twice.
    """
    path = loading.silver_path(root, spec)
    snapshots.cluster(spark, path, spec.cluster_by)
    snapshots.expire(spark, path, retain_hours)


def maintain_silver(spark: SparkSession, root: str, retain_hours: float = RETENTION_HOURS) -> None:
    side_by_side(
        spark,
        {name: partial(maintain, spark, spec, root, retain_hours) for name, spec in SPECS.items()},
    )


def silver_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {
        name: snapshots.read_snapshot(spark, loading.silver_path(root, spec))
        for name, spec in SPECS.items()
    }


def catalog_silver(spark: SparkSession, root: str) -> None:
    """Energy and weather as catalog tables, bucketed alike by household and time, so that the
    joins of Gold find them dealt out already."""
    paths = {name: loading.silver_path(root, SPECS[name]) for name in BUCKETED}
    buckets = catalog.buckets_for(max(snapshots.table_bytes(spark, path) for path in paths.values()))
    side_by_side(
        spark,
        {
            name: partial(
                catalog.publish_bucketed, snapshots.read_snapshot(spark, path), f"silver.{name}",
                f"{root}/silver/bucketed/{name}", SPECS[name].key, buckets,
            )
            for name, path in paths.items()
        },
    )


def run_gold(spark: SparkSession, root: str) -> dict[str, int]:
    """Publishes the dimensions and the fact, then the marts from the published fact."""
    s = silver_tables(spark, root) | {name: spark.table(f"silver.{name}") for name in BUCKETED}
    energy, weather, device, grid, tariff = (s[name] for name in SPECS)

    def publish(name: str, df: DataFrame, partition_by: tuple[str, ...] = (), must_have: tuple[str, ...] = ()) -> int:
        path = loading.gold_path(root, name)
        tests = write_tests(root, f"gold.{name}", quality.must_have(*must_have))
        more = {"counts": tests.counts, "judge": tests.judge} if must_have else {}
        return snapshots.publish(spark, df, path, "overwrite", partition_by, **more)[1]

    written = side_by_side(
        spark,
        {
            "dim_date": lambda: publish("dim_date", gold.dim_date(energy)),
            "dim_household": lambda: publish("dim_household", gold.dim_household(energy)),
            "dim_weather": lambda: publish("dim_weather", gold.dim_weather(weather)),
            "dim_device": lambda: publish("dim_device", gold.dim_device(device)),
            "dim_grid": lambda: publish("dim_grid", gold.dim_grid(grid)),
            "dim_tariff": lambda: publish("dim_tariff", gold.dim_tariff(tariff)),
            "fact_energy": lambda: publish(
                "fact_energy", gold.fact_energy(energy, weather, device, grid, tariff, published=True),
                ("month_key",), ("energy_key", "household_key"),
            ),
        },
    )
    fact = snapshots.read_snapshot(spark, loading.gold_path(root, "fact_energy"))
    # Days that were there before and have no reading any more are recomputed as well.
    days = marts.touched_days(fact).union(marts.touched_days(marts.read_states(spark, f"{root}/gold")))
    marts.refresh_states(fact, stored(days.distinct(), "days"), f"{root}/gold")
    dashboard = {"executive_dashboard": lambda: publish("executive_dashboard", gold.executive_dashboard(fact))}
    return written | publish_usage(spark, root) | side_by_side(spark, dashboard)


def publish_usage(spark: SparkSession, root: str) -> dict[str, int]:
    """Daily, monthly and yearly usage, out of the days' states alone."""
    states = marts.read_states(spark, f"{root}/gold")
    frames = {
        "daily_summary": marts.daily_summary(states),
        "monthly_summary": marts.monthly_summary(states),
        "yearly_summary": marts.yearly_summary(states),
    }
    return side_by_side(
        spark,
        {
            name: lambda name=name, df=df: snapshots.publish(
                spark, df, loading.gold_path(root, name), "overwrite"
            )[1]
            for name, df in frames.items()
        },
    )


def run_analytics(spark: SparkSession, root: str) -> dict[str, int]:
    """Publishes histories, dashboards and features from the published tables. They may be empty."""
    silver = silver_tables(spark, root)
    fact, households = (
        snapshots.read_snapshot(spark, loading.gold_path(root, name)) for name in ("fact_energy", "dim_household")
    )
    readings = gold.energy_readings(silver["energy_usage"])
    with_weather = gold.with_weather(readings, silver["weather_stream"])
    timed = silver["energy_usage"].filter("household_id IS NOT NULL AND timestamp IS NOT NULL")
    tariffs = gold.tariff_history(silver["tariff_metrics"], published=True)
    frames = {
        "household_history": scd2_history(
            timed, ["household_id"], "timestamp", list(gold.HOUSEHOLD_ATTRIBUTES), counted=timed
        ),
        "tariff_history": tariffs,
        "readings_with_tariff": gold.with_tariff(readings, tariffs, published=True),
        "worst_devices": analytics.worst_devices(silver["device_metrics"]),
        "forecast_error": analytics.forecast_error(silver["grid_load"]),
        "consumption_by_segment": analytics.consumption_by_segment(fact),
        "weather_impact": analytics.weather_impact(with_weather),
        "device_health": analytics.device_health(silver["device_metrics"]),
        "billing_analytics": analytics.billing_analytics(silver["tariff_metrics"], households),
        "forecast_features": analytics.forecast_features(fact),
    }
    return side_by_side(
        spark,
        {
            name: lambda name=name, df=df: snapshots.publish(
                spark, df, loading.gold_path(root, name), "overwrite"
            )[1]
            for name, df in frames.items()
        },
    )


def column_tests(spark: SparkSession, root: str) -> DataFrame:
    """Unique natural keys in Silver, and households of the fact in their dimension."""
    silver = silver_tables(spark, root)
    fact, households = (
        snapshots.read_snapshot(spark, loading.gold_path(root, name)) for name in ("fact_energy", "dim_household")
    )
    checks = [quality.unique(silver[name], spec.key) for name, spec in SPECS.items()]
    checks.append(quality.unique(fact, ["household_id", "timestamp"]))
    checks.append(quality.relationships(fact, "household_id", households))
    return quality.run_checks(checks)


def run_gates(spark: SparkSession, root: str) -> dict[str, int]:
    """Every table of every layer and the audit log must hold rows, and the column tests pass."""
    tables = {
        f"bronze.{spec.bronze_name}": snapshots.read_snapshot(spark, loading.bronze_path(root, spec))
        for spec in SPECS.values()
    }
    tables |= {f"silver.{name}": df for name, df in silver_tables(spark, root).items()}
    tables |= {f"silver.{name}": spark.table(f"silver.{name}") for name in BUCKETED}
    tables |= {
        f"gold.{name}": snapshots.read_snapshot(spark, loading.gold_path(root, name))
        for name in GOLD_TABLES
    }
    quality.require_not_empty(loading.read_audit(spark, loading.audit_path(root)), "bronze.audit_log")
    counts = quality.require_rows(tables)
    quality.require_passed(column_tests(spark, root))
    return counts


def _merged_path(root: str, spec: TableSpec) -> str:
    return f"{incremental.state_path(root, spec)}_merged"


def refresh_table(spark: SparkSession, spec: TableSpec, raw_dir: str, root: str) -> int:
    """Loads the new files of one table and merges every batch that its state has not taken yet,
    a batch of a refresh that broke off included. Returns the rows loaded."""
    n_rows = loading.ingest(spark, spec, f"{raw_dir}/{spec.raw_file}", root)
    merged_at = _merged_path(root, spec)
    batches = loading.loaded_batches(spark, spec, root)
    if readers.path_exists(spark, merged_at):
        batches = batches.join(spark.read.schema("batch_id STRING").parquet(merged_at), "batch_id", "left_anti")
    new = [r.batch_id for r in batches.collect()]  # the loads since the last refresh
    if new:
        bronze = snapshots.read_snapshot(spark, loading.bronze_path(root, spec))
        parts = incremental.merge_batch(spark, bronze.filter(F.col("batch_id").isin(new)), spec, root)
        if spec.name == "energy_usage":
            incremental.refresh_usage(spark, root, parts)
        marks = spark.createDataFrame([(b,) for b in new], "batch_id STRING")
        marks.coalesce(1).write.mode("append").parquet(merged_at)
    return n_rows


def refresh(spark: SparkSession, raw_dir: str, root: str) -> dict[str, int]:
    """Takes the files that have come since: Bronze by the ledger, Silver's states partition by partition,
    the usage marts day by day. What it gives equals a run over all files; dimensions, the
    fact and the dashboards are left to :func:`run`. Returns the rows loaded into each table."""
    loading.create_layers(spark, root)
    loaded = side_by_side(
        spark, {name: partial(refresh_table, spark, spec, raw_dir, root) for name, spec in SPECS.items()}
    )
    publish_usage(spark, root)
    return loaded


def run(spark: SparkSession, raw_dir: str, root: str) -> dict[str, int]:
    loading.create_layers(spark, root)
    loading.create_audit_table(spark, "bronze.audit_log", loading.audit_path(root))
    run_bronze(spark, raw_dir, root)
    run_silver(spark, root)
    maintain_silver(spark, root)
    catalog_silver(spark, root)
    run_gold(spark, root)
    run_analytics(spark, root)
    return run_gates(spark, root)


if __name__ == "__main__":
    if len(sys.argv) not in (3, 4) or sys.argv[3:] not in ([], ["refresh"]):
        sys.exit("usage: python -m voltlake.plans.medallion RAW_DIR ROOT [refresh]")
    job = refresh if sys.argv[3:] else run
    for table, rows in job(build_session(), sys.argv[1], sys.argv[2]).items():
        print(f"{table}\t{rows}")
