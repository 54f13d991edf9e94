"""One DataFrame per query name; every query reads its tables whole."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import standins
from catalogue.standins import RAW, TABLES, table
from voltlake.functions import columns as C
from voltlake.operators import merge, quality, refine as R, scd
from voltlake.operators.dedup import latest_per_key
from voltlake.plans import analytics, gold, incremental, marts
from voltlake.session import side_by_side, stored, work_dir
from voltlake.sources import catalog, loading, readers, snapshots
from voltlake.specs import SPECS
from voltlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# Hash keys and clock columns differ between engines or runs; queries leave them out.
HASH_KEYS = (
    "energy_key", "weather_key", "device_key", "grid_key", "tariff_key", "household_key",
    "weather_profile_key",
)


def _plain(df: DataFrame) -> DataFrame:
    """Zoned timestamps as plain ones, which is how the given tables store them."""
    zoned = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def _compared(df: DataFrame) -> DataFrame:
    return _plain(df.drop("silver_ingestion_time", *HASH_KEYS))


# --- Bronze


def _raw_file(spark: SparkSession, sf_dir: str, name: str, root: str) -> str:
    path = f"{root}/raw/{SPECS[name].raw_file}"
    RAW[name](spark, sf_dir).write.parquet(path)
    return path


def ingest(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Raw Parquet through the audited load; lineage is reported as right or wrong."""
    spec, root = SPECS[name], work_dir(spark, "ingest")
    loading.ingest(spark, spec, _raw_file(spark, sf_dir, name, root), root)
    bronze = snapshots.read_snapshot(spark, loading.bronze_path(root, spec))
    lineage = (
        F.col("source_file").contains(f"/{spec.raw_file}/")
        & F.col("batch_id").isNotNull()
        & F.col("bronze_ingestion_time").isNotNull()
    )
    return _plain(
        bronze.withColumn("has_lineage", lineage).drop(
            "source_file", "batch_id", "bronze_ingestion_time"
        )
    )


def ingest_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.with_lineage(table(spark, sf_dir, "events"), "run-1")
    name = F.element_at(F.split("source_file", "/"), -1)
    return df.groupBy(name.alias("source_name"), "batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("bronze_ingestion_time").alias("n_load_times"),
    )


def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.with_row_ids(table(spark, sf_dir, "orders"))
    return df.select("row_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids")
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads every given table with an audit row each, then reads the catalog table."""
    root = work_dir(spark, "audit")
    prefix = f"voltlake_{root[-8:]}_"
    bronze = loading.create_layers(spark, root, prefix)[0]
    location = loading.audit_path(root)
    loading.create_audit_table(spark, f"{bronze}.audit_log", location)
    side_by_side(
        spark,
        {
            name: partial(
                loading.audited_load, spark, partial(table, spark, sf_dir, name),
                f"{root}/bronze/{name}", location, f"Ingest_{name}", f"{name}.parquet", f"bronze.{name}",
            )
            for name in TABLES
        },
    )
    spark.catalog.refreshTable(f"{bronze}.audit_log")
    return spark.table(f"{bronze}.audit_log").drop("log_timestamp")


def audit_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One good and one unreadable source; the failure is audited with 0 rows."""
    root = work_dir(spark, "audit")
    location = loading.audit_path(root)
    for name in ("events", "events_missing"):
        try:
            loading.audited_load(
                spark, partial(table, spark, sf_dir, name), f"{root}/bronze/events", location,
                f"Ingest_{name}", f"{name}.parquet", "bronze.events",
            )
        except Exception:  # raised again by the load, after its audit row
            pass
    return loading.read_audit(spark, location).select(
        "process_name", "records_processed", "status",
        F.col("error_message").isNotNull().alias("has_error"),
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, root = table(spark, sf_dir, "customer"), work_dir(spark, "csv")
    source.write.option("header", True).csv(f"{root}/csv")
    readers.csv_to_parquet(spark, f"{root}/csv", f"{root}/parquet", source.schema)
    return readers.read_parquet(spark, f"{root}/parquet")


def schema_evolution_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with different columns into one table."""
    part, root = table(spark, sf_dir, "part"), work_dir(spark, "evolve")
    snapshots.publish(spark, part.select("p_partkey", "p_name", "p_size"), f"{root}/part")
    snapshots.publish(spark, part.select("p_brand", "p_partkey", "p_retailprice"), f"{root}/part")
    return snapshots.read_snapshot(spark, f"{root}/part")


def schema_evolution_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in three loads whose columns widen: int, long, decimal; float, double; date, timestamp;
    a struct that gains a field."""
    path = f"{work_dir(spark, 'evolve')}/part"
    part = table(spark, sf_dir, "part")
    loads = [
        (0, "int", "float", "DATE '2024-01-02'", "named_struct('n', int(p_size))"),
        (1, "long", "double", "TIMESTAMP '2024-01-02 03:04:05'", "named_struct('n', bigint(p_size), 'b', p_brand)"),
        (2, "decimal(22,2)", "int", "DATE '2024-01-03'", "named_struct('n', int(p_size))"),
    ]
    for k, size, price, day, nested in loads:
        rows = part.filter(F.col("p_partkey") % 3 == k).selectExpr(
            "p_partkey", f"cast(p_size AS {size}) AS size", f"cast(p_size * 0.5D AS {price}) AS price",
            f"{day} AS day", f"{nested} AS nested",
        )
        snapshots.publish(spark, rows, path)
    found = snapshots.read_snapshot(spark, path)
    return _plain(
        found.select(
            "p_partkey", F.col("size").cast("double").alias("size"), "price", "day",
            F.col("nested.n").alias("n"), F.col("nested.b").alias("b"),
        )
    )


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV lines, some too short and some without a readable balance: the lines set aside."""
    root = work_dir(spark, "csv")
    line = F.concat_ws(
        ",", "c_custkey",
        F.when(F.col("c_custkey") % 11 == 0, F.lit("none")).otherwise(F.col("c_acctbal").cast("string")),
        F.when(F.col("c_custkey") % 13 != 0, F.col("c_mktsegment")),
    )
    # A thousand lines to a file, each of which begins with its header.
    names = F.lit("c_custkey,c_acctbal,c_mktsegment")
    files = table(spark, sf_dir, "customer").groupBy(F.expr("c_custkey div 1000").alias("file")).agg(
        F.concat_ws("\n", names, F.sort_array(F.collect_list(line))).alias("value")
    )
    files.write.partitionBy("file").text(f"{root}/csv")
    schema = T.StructType().add("c_custkey", T.LongType()).add("c_acctbal", T.DoubleType())
    readers.csv_to_parquet(spark, f"{root}/csv/*", f"{root}/good", schema, f"{root}/rejects")
    return spark.read.parquet(f"{root}/rejects").select("reason", "record")


def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of weather readings loaded as they come, and their folder once more: rows of each load."""
    spec, root = SPECS["weather_stream"], work_dir(spark, "ledger")
    raw = RAW[spec.name](spark, sf_dir)
    path, loads = f"{root}/raw/{spec.raw_file}", []
    for k in range(3):
        raw.filter(F.pmod("reading_id", F.lit(3)) == k).write.mode("append").parquet(path)
        loads.append((f"load {k}", loading.ingest(spark, spec, path, root)))
    loads.append(("again", loading.ingest(spark, spec, path, root)))
    bronze = snapshots.read_snapshot(spark, loading.bronze_path(root, spec))
    return spark.createDataFrame(loads, "name STRING, n_rows LONG").unionByName(
        bronze.agg(F.lit("bronze").alias("name"), F.count(F.lit(1)).alias("n_rows"))
    )


# --- Silver


def silver_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw energy readings in three batches, one of them twice, merged into Silver's state."""
    spec, root = SPECS["energy_usage"], work_dir(spark, "merge")
    raw = stored(RAW[spec.name](spark, sf_dir), "raw")
    for k in (2, 0, 1, 0):
        batch = raw.filter(F.pmod(F.xxhash64("reading_id"), F.lit(3)) == k)
        incremental.merge_batch(spark, batch, spec, root)
    return _compared(incremental.silver(incremental.state(spark, spec, root), spec))


def silver(spark: SparkSession, sf_dir: str, name: str, **options: bool) -> DataFrame:
    return R.refine(RAW[name](spark, sf_dir), SPECS[name], **options)


def refined(spark: SparkSession, sf_dir: str, name: str, **options: bool) -> DataFrame:
    return _compared(silver(spark, sf_dir, name, **options))


def rejected(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = R.rejects(RAW[name](spark, sf_dir), SPECS[name])
    return _plain(df.withColumn("failed_rules", F.array_join("failed_rules", ",")))


def unreadable_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw energy readings whose time cannot be read, each with the reason."""
    found = R.unreadable(RAW["energy_usage"](spark, sf_dir), SPECS["energy_usage"])
    return found.select("reading_id", "household_id", "timestamp", F.array_join("failed_rules", ",").alias("failed_rules"))


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = [
        R.reject_counts(RAW[name](spark, sf_dir), spec).withColumn("table_name", F.lit(name))
        for name, spec in SPECS.items()
        if spec.ranges
    ]
    return readers.append_evolving(counted)


def cast_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.get_json_object("props", "$.k")
    df = table(spark, sf_dir, "events").withColumns(
        {"k_text": text, "bad_text": F.concat(text, F.col("event_type"))}
    )
    return df.select(
        "event_id", C.to_double("k_text").alias("k"), C.to_double("bad_text").alias("unreadable")
    )


def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec_pattern = SPECS["energy_usage"].timestamps["timestamp"]
    df = table(spark, sf_dir, "events").withColumns(
        {
            "good": F.date_format("ts", spec_pattern),
            "bad": F.date_format("ts", "yyyy-MM-dd HH:mm"),
        }
    )
    return _plain(
        df.select(
            "event_id",
            C.to_timestamp("good", spec_pattern).alias("parsed"),
            C.to_timestamp("bad", spec_pattern).alias("unreadable"),
        )
    )


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.expr("nullif(l_discount, 0)").alias("l_discount"),
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
    )
    return lines.fillna({"l_discount": 0.0, "l_tax": 0.0})


def validate_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    rules = [C.within("l_quantity", 5, 45), C.within("l_discount", 0.02, None)]
    return lines.filter(C.all_of(rules))


def standardise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("p_name"),
        F.concat(F.lit(" "), F.lower("p_type")).alias("p_type"),
        F.concat(F.lower("p_brand"), F.lit("\t ")).alias("p_brand"),
    )
    return parts.select(
        "p_partkey", C.title_text("p_name").alias("name"), C.upper_text("p_type").alias("type"),
        C.upper_text("p_brand").alias("brand"),
    )


def surrogate_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash keys against natural keys: whole pairs of lineitem, nulls in either part included,
    and every row of the five Silver tables."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr("nullif(l_partkey, 7)").alias("a"), F.expr("nullif(l_suppkey, 7)").alias("b")
    )
    pairs = lines.distinct().withColumns(
        {"key": C.hash_key("a", "b"), "plain": F.xxhash64("a", "b")}
    )
    same = F.col("a").isNotNull() & F.col("b").isNotNull()

    def counted(df: DataFrame, name: str, key: str, plain) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("n_natural"),
            F.count_distinct(key).alias("n_keys"),
            plain.cast("long").alias("n_plain_kept"),
        ).select(F.lit(name).alias("table_name"), "n_natural", "n_keys", "n_plain_kept")

    found = counted(pairs, "lineitem", "key", F.count_if(same & (F.col("key") == F.col("plain"))))
    for name, spec in SPECS.items():
        rows = silver(spark, sf_dir, name)
        found = found.unionByName(counted(rows, name, spec.surrogate, F.max(F.lit(None))))
    return found


def sequence_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = R.add_key(RAW["weather_stream"](spark, sf_dir), SPECS["weather_stream"], sequence=True)
    return df.select("weather_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("weather_key").alias("n_keys")
    )


def null_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SPECS["weather_stream"]
    filled = R.fill_measures(RAW[spec.name](spark, sf_dir), spec, keep_flags=True)
    return filled.select(
        "reading_id", "temperature_celsius", "temperature_celsius_was_null",
        "solar_radiation", "solar_radiation_was_null",
    )


# --- Versioned tables


def _orders_by_year(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Orders published in three appends and one overwrite of everything."""
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    path = f"{root}/orders"
    for condition in (year <= 1996, year.between(1997, 1998), year >= 1999):
        snapshots.publish(spark, orders.filter(condition), path)
    snapshots.publish(spark, orders.withColumn("o_late", F.col("o_orderstatus") == "F"), path, "overwrite")
    return path


def snapshot_version0(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_by_year(spark, sf_dir, work_dir(spark, "versions"))
    return snapshots.read_snapshot(spark, path, 0)


def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_by_year(spark, sf_dir, work_dir(spark, "versions"))
    return snapshots.read_snapshot(spark, path)


def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_by_year(spark, sf_dir, work_dir(spark, "versions"))
    return snapshots.history(spark, path).select("version", "operation", "n_rows")


PIECE_BYTES = 16 << 20  # of the table's files, for one piece of each append


def _lines_in_pieces(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Lineitem published in three appends of many pieces; their number grows with the table, so that a
    task does not."""
    path = f"{work_dir(spark, label)}/lineitem"
    lines = table(spark, sf_dir, "lineitem")
    pieces = max(8, math.ceil(snapshots.files_bytes(spark, lines.inputFiles()) / PIECE_BYTES))
    for flag in ("A", "N", "R"):
        part = lines.filter(F.col("l_returnflag") == flag).repartition(pieces, "l_orderkey", "l_linenumber")
        snapshots.publish(spark, part, path)
    return path


def compact_same_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _lines_in_pieces(spark, sf_dir, "compact")
    snapshots.compact(spark, path)
    return snapshots.read_snapshot(spark, path)


def zorder_same_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _lines_in_pieces(spark, sf_dir, "zorder")
    snapshots.cluster(spark, path, ["l_partkey", "l_shipdate"], target_bytes=1 << 20)
    return snapshots.read_snapshot(spark, path)


def _files_met(df: DataFrame, column: str, low: int, high: int) -> int:
    """Files whose range of ``column`` meets low..high: those that a filter has to read."""
    ranges = df.groupBy(F.input_file_name().alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return ranges.filter((F.col("low") <= high) & (F.col("high") >= low)).count()


def layout_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What compaction and clustering do to the files of lineitem: how many there are, and whether a
    tenth of the parts, and a tenth of the suppliers, are found in fewer than all."""
    path = _lines_in_pieces(spark, sf_dir, "layout")
    parts = table(spark, sf_dir, "lineitem").agg(F.max("l_partkey"), F.max("l_suppkey")).first()
    loaded = snapshots.read_snapshot(spark, path)
    rows = [("loaded", *_layout(loaded, parts))]
    # Small files stand in for large ones.
    target = max(1, snapshots.table_bytes(spark, path) // 16)
    snapshots.cluster(spark, path, ["l_partkey", "l_suppkey"], target_bytes=target)
    rows.append(("clustered", *_layout(snapshots.read_snapshot(spark, path), parts)))
    snapshots.compact(spark, path)
    rows.append(("compacted", *_layout(snapshots.read_snapshot(spark, path), parts)))
    return spark.createDataFrame(rows, "state STRING, n_rows LONG, one_file BOOLEAN, prunes BOOLEAN")


def _layout(lines: DataFrame, largest) -> tuple[int, bool, bool]:
    files = len(lines.inputFiles())
    met = [_files_met(lines, c, 1, max(1, top // 10)) for c, top in zip(("l_partkey", "l_suppkey"), largest)]
    return lines.count(), files == 1, max(met) <= 0.6 * files


def expire_same_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _lines_in_pieces(spark, sf_dir, "expire")
    snapshots.publish(spark, table(spark, sf_dir, "lineitem"), path, "overwrite")
    snapshots.expire(spark, path, retain_hours=0)
    return snapshots.read_snapshot(spark, path)


# --- Gates and tests


def gate_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts({name: table(spark, sf_dir, name) for name in TABLES})


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    energy = RAW["energy_usage"](spark, sf_dir)
    return quality.not_null(energy, "household_id", "voltage_reading", "meter_type")


def dq_in_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tests of raw energy readings that run in the write itself, and how many failing rows they kept."""
    root = work_dir(spark, "tested")
    rules = [
        *quality.must_have("household_id", "voltage_reading", severity=quality.WARN),
        quality.must_be_one_of("meter_type", ["click ", "view ", "error "], severity=quality.WARN),
        *quality.must_have("reading_id"),
    ]
    tests = quality.WriteTests("energy_usage", rules, f"{root}/results", f"{root}/failures")
    raw = RAW["energy_usage"](spark, sf_dir)
    snapshots.publish(spark, raw, f"{root}/table", counts=tests.counts, judge=tests.judge)
    kept = spark.read.schema(quality.FAILURES).parquet(f"{root}/failures")
    n_kept = kept.groupBy("check").agg(F.count(F.lit(1)).alias("n_kept"))
    results = spark.read.schema(quality.RESULTS).parquet(f"{root}/results")
    return results.join(n_kept, "check", "left").fillna(0, ["n_kept"])


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(
        [
            quality.unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
            quality.unique(table(spark, sf_dir, "orders"), ["o_orderkey"]),
        ]
    )


def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(
        [
            quality.accepted_values(table(spark, sf_dir, "orders"), "o_orderstatus", ["O", "F"]),
            quality.accepted_values(
                table(spark, sf_dir, "events"), "event_type",
                ["click", "view", "error", "purchase", "signup"],
            ),
        ]
    )


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return quality.run_checks(
        [
            quality.relationships(table(spark, sf_dir, "orders"), "o_custkey", rich, "c_custkey"),
            quality.relationships(
                table(spark, sf_dir, "lineitem"), "l_partkey", table(spark, sf_dir, "part"), "p_partkey"
            ),
        ]
    )


# --- Gold


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _compared(gold.staging(silver(spark, sf_dir, name), SPECS[name]))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_date(silver(spark, sf_dir, "energy_usage"))


def dim_household(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(gold.dim_household(silver(spark, sf_dir, "energy_usage")))


def dim_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(gold.dim_weather(silver(spark, sf_dir, "weather_stream")))


def dim_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(gold.dim_device(silver(spark, sf_dir, "device_metrics")))


def dim_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(gold.dim_grid(silver(spark, sf_dir, "grid_load")))


def dim_tariff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(gold.dim_tariff(silver(spark, sf_dir, "tariff_metrics")))


def fact_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = gold.fact_energy(*[silver(spark, sf_dir, name) for name in SPECS])
    return _compared(fact.withColumn("has_weather", F.col("weather_key").isNotNull()))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.energy_readings(silver(spark, sf_dir, "energy_usage"))


def _over_readings(build: Callable[[DataFrame], DataFrame]) -> Query:
    """A summary that needs no columns of the fact beyond the readings themselves."""
    return lambda spark, sf_dir: build(_readings(spark, sf_dir))


def bucketed_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with their weather, from catalog tables that are bucketed alike."""
    root = work_dir(spark, "bucketed")
    layer = loading.create_layers(spark, root, f"voltlake_{root[-8:]}_")[1]
    energy, weather = (
        catalog.publish_bucketed(silver(spark, sf_dir, n), f"{layer}.{n}", f"{root}/{n}", SPECS[n].key, 8)
        for n in ("energy_usage", "weather_stream")
    )
    joined = gold.with_weather(gold.energy_readings(energy), weather)
    return _compared(joined.withColumn("has_weather", F.col("weather_key").isNotNull()))


def _arrived_late() -> Column:
    """Readings from the 20th on, and some late ones of the 3rd, so that an old day changes too."""
    day = F.dayofmonth("timestamp")
    return F.coalesce((day >= 20) | ((day == 3) & (F.col("meter_type") == "CLICK")), F.lit(False))


def _refreshed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage states of the readings before the 20th, refreshed by the days of the later ones."""
    root = work_dir(spark, "marts")
    readings = stored(_readings(spark, sf_dir), "readings", ("month_key",))
    before, batch = readings.filter(~_arrived_late()), readings.filter(_arrived_late())
    marts.refresh_states(before, None, root)
    marts.refresh_states(readings, marts.touched_days(batch), root)
    return marts.read_states(spark, root)


def incremental_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_summary(_refreshed_states(spark, sf_dir))


def monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months out of the published days alone."""
    return marts.monthly_summary(_refreshed_states(spark, sf_dir))


def yearly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.yearly_summary(_refreshed_states(spark, sf_dir))


ORDER_HISTORY = {
    "key": ["o_custkey"],
    "ts": "o_orderdate",
    "tracked": ["o_orderstatus", "o_orderpriority"],
    "tie_break": ["o_orderkey"],
}


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return scd.scd2_history(orders, **ORDER_HISTORY, counted=orders)


def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of the orders up to 1999, then the rest: newer orders and some late ones."""
    orders = table(spark, sf_dir, "orders")
    late = (F.col("o_orderpriority") == "1-URGENT") & (F.month("o_orderdate") == 5)
    in_batch = (F.year("o_orderdate") >= 2000) | late
    path = f"{work_dir(spark, 'scd2')}/customer_status"
    snapshots.publish(spark, scd.scd2_history(orders.filter(~in_batch), **ORDER_HISTORY), path)
    before = snapshots.read_snapshot(spark, path)
    return scd.scd2_refresh(before, orders.filter(in_batch), orders, **ORDER_HISTORY)


SNAPSHOT_YEARS = range(1995, 2002)


def scd2_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History by a snapshot of each year's customers, with the state of their last order in it:
    who does not order in a year vanishes and may come back."""
    orders = table(spark, sf_dir, "orders")
    root, states = work_dir(spark, "scd2"), ["o_orderstatus", "o_orderpriority"]
    dimension = spark.createDataFrame(
        [], "o_custkey LONG, o_orderstatus STRING, o_orderpriority STRING, effective_from DATE, "
        "effective_to DATE, is_current BOOLEAN, last_seen DATE",
    )
    for year in SNAPSHOT_YEARS:
        placed = orders.filter(F.year("o_orderdate") == year)
        snapshot = latest_per_key(
            placed.select("o_custkey", *states, "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate", "o_orderkey"]
        )
        after = scd.scd2_snapshot(dimension, snapshot, ["o_custkey"], states, date(year, 12, 31))
        # Each history is published before the next snapshot is met with it.
        path = f"{root}/history-{year}"
        after.write.parquet(path)
        dimension = spark.read.schema(dimension.schema).parquet(path)
    return dimension


def _tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver tariffs with their bills dealt over the month of the readings."""
    tariff = silver(spark, sf_dir, "tariff_metrics")
    hours = F.pmod(F.unix_date(F.col("reading_timestamp").cast("date")) * 7, F.lit(720))
    moved = F.expr("TIMESTAMP '2024-01-01 00:00:00'") + F.make_dt_interval(hours=hours)
    return tariff.withColumn("reading_timestamp", moved)


def tariff_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.tariff_history(_tariffs(spark, sf_dir)))


def fact_tariff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading with the tariff that held at its time."""
    found = gold.with_tariff(_readings(spark, sf_dir), gold.tariff_history(_tariffs(spark, sf_dir)))
    return _compared(found.select("household_id", "timestamp", "energy_usage_kwh", "tariff_since", *gold.TARIFF_TERMS))


# --- Dashboards and features


def weather_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = silver(spark, sf_dir, "weather_stream")
    impact = analytics.weather_impact(gold.with_weather(_readings(spark, sf_dir), weather))
    return impact.withColumns(
        {c: F.round(c, 8) for c in ("correlation", "kwh_per_degree")}
    )


def device_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.device_health(silver(spark, sf_dir, "device_metrics"))


def worst_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.worst_devices(silver(spark, sf_dir, "device_metrics"))


def billing_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    households = gold.dim_household(silver(spark, sf_dir, "energy_usage"))
    return analytics.billing_analytics(silver(spark, sf_dir, "tariff_metrics"), households)


def forecast_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.forecast_error(silver(spark, sf_dir, "grid_load"))


# --- Streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return jobs.stream_files(spark, sf_dir, schema, glob="events.parquet")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "stream")
    stream = jobs.lineage(_event_stream(spark, sf_dir), "run-1")
    jobs.run_to_files(stream, f"{root}/bronze", f"{root}/checkpoint")
    landed = spark.read.parquet(f"{root}/bronze")
    name = F.element_at(F.split("source_file", "/"), -1)
    return landed.withColumn("source_name", name).drop("source_file", "bronze_ingestion_time")


def _arrivals(
    spark: SparkSession, rows: DataFrame, ts: str, root: str, job, times: int = 3, sink=jobs.run_to_files
) -> int:
    """Runs a streaming job over ``rows`` as they arrive: in ``times`` stretches of event time, a
    run after each. Returns the rows left out as late.

    The rows are worked out and written once; a run sees the folders of the stretches up to its own."""
    first, last = rows.agg(F.min(ts), F.max(ts)).first()
    late, schema = 0, rows.schema
    if first == last:  # no stretches, or no rows
        for k in range(times):
            rows.write.parquet(f"{root}/raw/arrival={k}")
    else:
        step, arrival = (last - first) / times, F.lit(0)
        for k in range(1, times):
            arrival = F.when(F.col(ts) >= F.lit(first + k * step), k).otherwise(arrival)
        sent = rows.filter(F.col(ts).isNotNull()).withColumn("arrival", arrival)
        sent.write.partitionBy("arrival").parquet(f"{root}/raw")
    for k in range(times):
        here = ",".join(map(str, range(k + 1)))
        stream = jobs.stream_files(spark, f"{root}/raw/arrival={{{here}}}", schema, glob="*.parquet")
        late += sink(job(stream), f"{root}/out", f"{root}/checkpoint")
    return late


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which every fifth is sent again an hour later, each kept once."""
    root = work_dir(spark, "stream")
    sent = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.when(F.col("event_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    ).withColumn("sent_at", F.expr("ts + make_dt_interval(0, again)")).drop("again", "ts")
    late = _arrivals(
        spark, sent, "sent_at", root,
        lambda stream: jobs.first_per_key(jobs.with_event_time(stream, "sent_at"), ["event_id"]).drop("sent_at"),
    )
    if late:
        raise quality.QualityError(f"{late} rows came too late")
    return spark.read.parquet(f"{root}/out")


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather as it arrives through the refine steps; readings of which another copy may
    still come stay in the state."""
    spec, root = SPECS["weather_stream"], work_dir(spark, "stream")
    raw = RAW[spec.name](spark, sf_dir)
    late = _arrivals(spark, raw, "reading_timestamp", root, lambda s: jobs.refine_stream(s, spec))
    if late:
        raise quality.QualityError(f"{late} rows came too late")
    return _compared(readers.read_parquet(spark, f"{root}/out"))


def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days the watermark has passed; the last, still open day stays in the state. Values are
    added as decimals, which have one sum whatever the order."""
    root = work_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select(
        "event_type", F.col("value").cast("decimal(18,6)").alias("kwh"), F.col("ts").cast("timestamp").alias("ts")
    )
    late = _arrivals(
        spark, events, "ts", root,
        lambda s: jobs.daily_usage(jobs.with_event_time(s, "ts"), ["event_type"], "kwh", "ts"),
    )
    if late:
        raise quality.QualityError(f"{late} rows came too late")
    return spark.read.parquet(f"{root}/out").withColumns(
        {c: F.col(c).cast("double") for c in ("total_value", "peak_value")}
    )


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage of every day as far as it has arrived, the open one included: each run replaces the days
    that have got more readings."""
    root = work_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select(
        "event_type", F.col("value").cast("decimal(18,6)").alias("kwh"), F.col("ts").cast("timestamp").alias("ts")
    )

    def daily(stream: DataFrame) -> DataFrame:
        usage = jobs.daily_usage(jobs.with_event_time(stream, "ts"), ["event_type"], "kwh", "ts")
        return usage.withColumn("month_key", F.date_format("day", "yyyyMM").cast("int"))

    def sink(stream: DataFrame, path: str, checkpoint: str) -> int:
        return jobs.run_upsert(stream, path, checkpoint, ["day", "event_type"], ["month_key"])

    late = _arrivals(spark, events, "ts", root, daily, sink=sink)
    if late:
        raise quality.QualityError(f"{late} rows came too late")
    return merge.read_table(spark, f"{root}/out").select(
        "day", "event_type", "n_readings", *[F.col(c).cast("double").alias(c) for c in ("total_value", "peak_value")]
    )


def stream_silver_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather as it arrives, merged into Silver's state: every key once, none held back."""
    spec, root = SPECS["weather_stream"], work_dir(spark, "stream")

    def sink(stream: DataFrame, path: str, checkpoint: str) -> int:
        return jobs.run_silver(stream, spec, path, checkpoint)

    raw = RAW[spec.name](spark, sf_dir)
    _arrivals(spark, raw, "reading_timestamp", root, lambda stream: stream, sink=sink)
    return _compared(incremental.silver(incremental.state(spark, spec, f"{root}/out"), spec))


def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of two streams: one that takes the events, and after them those of the first day once
    more, which are too late; and one that cannot write."""
    root = work_dir(spark, "stream")
    location = loading.audit_path(root)
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first_day = events.agg(F.min("ts").cast("date")).scalar()
    late = events.filter(F.col("ts").cast("date") == first_day)
    for k, rows in enumerate((events, late)):
        rows.write.parquet(f"{root}/raw/arrival={k}")
        stream = jobs.with_event_time(jobs.stream_files(spark, f"{root}/raw/*", events.schema, glob="*.parquet"), "ts")
        unique = jobs.first_per_key(stream, ["event_id"])
        jobs.run_to_files(
            unique, f"{root}/out", f"{root}/checkpoint",
            jobs.Audit(location, "Stream_events", "events", "bronze.events"),
        )
    broken = jobs.stream_files(spark, f"{root}/raw/*", events.schema, glob="*.parquet").withColumn(
        "value", F.raise_error(F.lit("disk full")).cast("double")
    )
    try:
        jobs.run_to_files(
            broken, f"{root}/broken", f"{root}/broken-checkpoint",
            jobs.Audit(location, "Stream_broken", "events", "bronze.broken"),
        )
    except Exception:  # raised again by the job, after its audit row
        pass
    return (
        loading.read_audit(spark, location)
        .groupBy("process_name", "target_table", "status")
        .agg(
            F.sum("records_processed").alias("n_rows"),
            F.max(F.coalesce(F.col("error_message").contains("disk full"), F.lit(False))).alias("says_why"),
        )
    )


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "daily_summary": _over_readings(gold.daily_summary),
        "monthly_summary": _over_readings(gold.monthly_summary),
        "yearly_summary": _over_readings(gold.yearly_summary),
    }
    for name in SPECS:
        found[f"ingest_{name}"] = partial(ingest, name=name)
        found[f"silver_{name}"] = partial(refined, name=name)
        found[f"stg_{name}"] = partial(staged, name=name)
        if SPECS[name].ranges:
            found[f"rejects_{name}"] = partial(rejected, name=name)
    for name in ("device_metrics", "grid_load", "tariff_metrics"):
        found[f"silver_{name}_raw_key_text"] = partial(refined, name=name, raw_key_text=True)
    found |= {
        f.__name__: f
        for f in (
            ingest_lineage, row_ids, audit_log, audit_failure, csv_roundtrip,
            schema_evolution_append, schema_evolution_types, csv_rejects, load_ledger, silver_merged, reject_counts, cast_measures, parse_timestamp,
            dedup_latest, fill_nulls, validate_ranges, standardise_text, surrogate_key_check,
            sequence_key_check, null_flags, snapshot_version0, snapshot_latest,
            snapshot_history, compact_same_rows, zorder_same_rows, expire_same_rows,
            layout_files, dq_in_write, unreadable_times, bucketed_weather,
            gate_row_counts, dq_not_null, dq_unique, dq_accepted, dq_relationships, dim_date,
            dim_household, dim_weather, dim_device, dim_grid, dim_tariff, fact_energy,
            incremental_mart, monthly_rollup, yearly_rollup, scd2_history, scd2_incremental, scd2_snapshots,
            tariff_history, fact_tariff, weather_impact, device_health,
            worst_devices, billing_analytics, forecast_error, stream_ingest, stream_dedup,
            stream_silver, stream_daily, stream_upsert, stream_silver_merged, stream_audit,
        )
    }
    found |= {
        "executive_dashboard": _over_readings(gold.executive_dashboard),
        "consumption_by_segment": _over_readings(analytics.consumption_by_segment),
        "forecast_features": _over_readings(analytics.forecast_features),
    }
    return found
