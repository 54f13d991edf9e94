import pytest
from fixtures import raw
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.plans import medallion
from voltlake.session import work_dir
from voltlake.sources import ledger, loading, readers, snapshots
from voltlake.specs import GOLD_TABLES, SPECS


@pytest.fixture
def root(spark):
    return work_dir(spark, "load")


def audit(spark, root):
    return loading.read_audit(spark, loading.audit_path(root)).orderBy("log_timestamp").collect()


def test_ingest_adds_lineage_and_one_success_row(spark, root):
    spec = SPECS["energy_usage"]
    path = f"{root}/raw/{spec.raw_file}"
    raw(spark, spec.name, {}, {}, {}).write.parquet(path)
    assert loading.ingest(spark, spec, path, root, "b1") == 3
    assert loading.ingest(spark, spec, path, root) == 0
    raw(spark, spec.name, {}, {}).write.mode("append").parquet(path)
    assert loading.ingest(spark, spec, path, root, "b3") == 2
    bronze = snapshots.read_snapshot(spark, loading.bronze_path(root, spec))
    assert bronze.count() == 5
    assert {r["batch_id"] for r in bronze.collect()} == {"b1", "b3"}
    assert bronze.filter(F.col("source_file").contains(spec.raw_file)).count() == 5
    rows = audit(spark, root)
    assert [(r["process_name"], r["source_file"], r["target_table"], r["records_processed"], r["status"], r["error_message"]) for r in rows] == [
        (spec.process, spec.raw_file, "bronze.bronze_energy_usage", n, "SUCCESS", None) for n in (3, 0, 2)
    ]
    assert all(r["log_timestamp"] is not None for r in rows)


def test_one_file_and_partitioned_folders_are_loaded_once(spark, root):
    spec = SPECS["weather_stream"]
    rows = raw(spark, spec.name, {}, {}).withColumn("day", F.lit(7))
    rows.coalesce(1).write.partitionBy("day").parquet(f"{root}/raw/folder")
    assert loading.ingest(spark, spec, f"{root}/raw/folder", root) == 2
    (file,) = rows.sparkSession.read.parquet(f"{root}/raw/folder").inputFiles()
    assert loading.ingest(spark, spec, file, root) == 0
    assert {r["day"] for r in snapshots.read_snapshot(spark, loading.bronze_path(root, spec)).collect()} == {7}
    other = work_dir(spark, "load")
    assert loading.ingest(spark, spec, file, other) == 2


@pytest.mark.parametrize("breaks", ["before the write", "after the write"])
def test_a_load_that_broke_off_neither_skips_nor_doubles(spark, root, monkeypatch, breaks):
    spec = SPECS["energy_usage"]
    path = f"{root}/raw/{spec.raw_file}"
    raw(spark, spec.name, {}, {}, {}).write.parquet(path)
    note, publish = ledger.note, snapshots.publish

    def broken_note(spark, at, state, files, batch):
        if state == "done":
            raise RuntimeError("lost")
        note(spark, at, state, files, batch)

    def broken_publish(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if breaks == "after the write":
            patch.setattr(ledger, "note", broken_note)
        else:
            patch.setattr(snapshots, "publish", broken_publish)
        with pytest.raises(RuntimeError, match="lost"):
            loading.ingest(spark, spec, path, root, "b1")
    assert publish is snapshots.publish
    assert loading.ingest(spark, spec, path, root, "b2") == (0 if breaks == "after the write" else 3)
    assert snapshots.read_snapshot(spark, loading.bronze_path(root, spec)).count() == 3
    assert loading.loaded_batches(spark, spec, root).count() == 1


def test_failed_load_is_audited_with_zero_rows_and_raised(spark, root):
    spec = SPECS["grid_load"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        loading.ingest(spark, spec, f"{root}/raw/nothing.parquet", root)
    (row,) = audit(spark, root)
    assert (row["records_processed"], row["status"]) == (0, "FAILED")
    assert "PATH_NOT_FOUND" in row["error_message"]


def test_failure_during_the_write_is_audited(spark, root):
    def broken():
        return spark.range(3).withColumn("v", F.raise_error(F.lit("disk full")).cast("long"))

    with pytest.raises(Exception, match="disk full"):
        loading.audited_load(spark, broken, f"{root}/t", loading.audit_path(root), "P", "f", "t")
    assert audit(spark, root)[0]["status"] == "FAILED"
    assert snapshots.versions(spark, f"{root}/t") == []


def test_audit_table_is_created_once_and_reads_all_processes(spark, root):
    bronze, silver, gold = loading.create_layers(spark, root, "t_audit_")
    assert {bronze, silver, gold} <= {d.name for d in spark.catalog.listDatabases()}
    loading.create_layers(spark, root, "t_audit_")
    location = loading.audit_path(root)
    for _ in range(2):
        loading.create_audit_table(spark, f"{bronze}.audit_log", location)
    loading.append_audit(spark, location, "A", "f", "t", 1)
    loading.append_audit(spark, location, "B", "f", "t", 0, "boom")
    spark.catalog.refreshTable(f"{bronze}.audit_log")
    rows = spark.table(f"{bronze}.audit_log").select("process_name", "status").collect()
    assert sorted(map(tuple, rows)) == [("A", "SUCCESS"), ("B", "FAILED")]


def csv(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").option("header", True).csv(path)


def test_csv_columns_are_found_by_name_and_cast(spark, root):
    csv(spark, f"{root}/csv", [("x", "1"), (None, "2")], "b STRING, a STRING")
    readers.csv_to_parquet(spark, f"{root}/csv", f"{root}/pq", T.StructType().add("a", T.IntegerType()))
    df = readers.read_parquet(spark, f"{root}/pq")
    assert df.dtypes == [("b", "string"), ("a", "int")]
    assert set(map(tuple, df.collect())) == {(None, 2), ("x", 1)}


def test_csv_conversion_stops_at_what_it_cannot_hold(spark, root):
    csv(spark, f"{root}/bad", [("one",)], "a STRING")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.csv_to_parquet(spark, f"{root}/bad", f"{root}/pq", T.StructType().add("a", T.IntegerType()))
    with pytest.raises(ValueError, match="no column z"):
        readers.csv_to_parquet(spark, f"{root}/bad", f"{root}/pq", T.StructType().add("z", T.IntegerType()))
    csv(spark, f"{root}/two", [("1", "2")], "a STRING, b STRING")
    csv(spark, f"{root}/two", [("3", "4")], "b STRING, a STRING")
    with pytest.raises(Exception, match="(?i)header"):
        readers.csv_to_parquet(spark, f"{root}/two", f"{root}/pq2")


def test_whole_run_from_csv_files_to_gates(spark, root):
    for name in SPECS:
        raw(spark, name, {}, {}, {}).write.option("header", True).csv(f"{root}/csv/{name}.csv")
    medallion.convert_csv(spark, f"{root}/csv", f"{root}/raw")
    counts = medallion.run(spark, f"{root}/raw", root)
    assert set(counts) == (
        {f"bronze.bronze_{n}" for n in SPECS} | {f"silver.{n}" for n in SPECS}
        | {f"gold.{n}" for n in GOLD_TABLES}
    )
    assert counts["gold.fact_energy"] == 3 and counts["gold.dim_date"] == 1
    fact = snapshots.read_snapshot(spark, loading.gold_path(root, "fact_energy"))
    row = fact.filter("household_id = 'H1'").first()
    assert row["n_devices"] == row["n_feeders"] == row["n_billing_cycles"] == 1
    assert row["condition_type"] == "CONDITION_TYPE X" and row["month_key"] == 202402
    features, history = (
        snapshots.read_snapshot(spark, loading.gold_path(root, n)) for n in ("forecast_features", "household_history")
    )
    assert features.count() > 0 and history.filter("is_current").count() == 3
    for spec in SPECS.values():
        if spec.ranges:
            left_out = snapshots.read_snapshot(spark, medallion.rejects_path(root, spec))
            assert "failed_rules" in left_out.columns
    assert medallion.column_tests(spark, root).filter("n_failed > 0").isEmpty()
    # A second run finds no new file; every table stays the same.
    assert medallion.run(spark, f"{root}/raw", root) == counts


def test_a_key_that_is_not_unique_fails_the_run(spark, root):
    for name in SPECS:
        raw(spark, name, {}, {}, {}).write.option("header", True).csv(f"{root}/csv/{name}.csv")
    medallion.convert_csv(spark, f"{root}/csv", f"{root}/raw")
    medallion.run(spark, f"{root}/raw", root)
    path = loading.silver_path(root, SPECS["grid_load"])
    snapshots.publish(spark, snapshots.read_snapshot(spark, path).limit(1), path)
    with pytest.raises(Exception, match=r"unique\(.*1 rows"):
        medallion.run_gates(spark, root)


def test_csv_rows_that_cannot_be_converted_are_set_aside(spark, root):
    schema = T.StructType().add("a", T.IntegerType()).add("d", T.DateType())
    lines = ["a,b,d", "1,x,2024-01-02", "two,y,2024-01-02", "3,z", "4,w,2024-01-02,more", "5,,", ",v,yesterday"]
    spark.createDataFrame([("\n".join(lines),)], "value STRING").coalesce(1).write.text(f"{root}/csv")
    out, bad = f"{root}/pq", f"{root}/bad"
    assert readers.csv_to_parquet(spark, f"{root}/csv", out, schema, bad) == 4
    kept = {(r["a"], r["b"], str(r["d"])) for r in spark.read.parquet(out).collect()}
    assert kept == {(1, "x", "2024-01-02"), (5, None, "None")}
    rejected = {r["record"]: r["reason"] for r in spark.read.parquet(bad).collect()}
    assert rejected == {
        '{"a":"two","b":"y","d":"2024-01-02"}': "a is no int", "3,z": "wrong number of columns",
        "4,w,2024-01-02,more": "wrong number of columns", '{"b":"v","d":"yesterday"}': "d is no date",
    }
    with pytest.raises(readers.TooManyRejects, match="4 rows"):
        readers.csv_to_parquet(spark, f"{root}/csv", out, schema, bad, max_rejects=3)
    assert readers.csv_to_parquet(spark, f"{root}/csv", out, schema, bad, max_rejects=4) == 4
    with pytest.raises(Exception):
        readers.csv_to_parquet(spark, f"{root}/csv", out, schema)
