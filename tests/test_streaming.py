import datetime as dt

from fixtures import raw
from pyspark.sql import functions as F

from voltlake.session import work_dir
from voltlake.specs import SPECS
from voltlake.streaming import jobs

SCHEMA = "household_id STRING, reading_timestamp TIMESTAMP, kwh DOUBLE"
DAY = dt.datetime(2024, 3, 1)


def write(spark, root, number, rows):
    data = [(h, DAY + dt.timedelta(hours=t), v) for h, t, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{root}/raw/f{number}")


def stream(spark, root):
    # Files are taken one per micro-batch, oldest first, so later files can be late.
    return jobs.with_event_time(
        jobs.stream_files(spark, f"{root}/raw/*", SCHEMA, glob="*.parquet", files_per_batch=1)
    )


def test_windows_leave_out_late_rows_and_the_open_day(spark):
    root = work_dir(spark, "s")
    write(spark, root, 1, [("H1", 1, 1.0), ("H1", 23, 2.0)])
    write(spark, root, 2, [("H1", 30, 4.0)])
    run = lambda: jobs.run_to_files(
        jobs.daily_usage(stream(spark, root), ["household_id"], "kwh"), f"{root}/out", f"{root}/cp"
    )
    run()
    write(spark, root, 3, [("H1", 2, 100.0)])  # more than two hours behind hour 30
    write(spark, root, 4, [("H1", 31, 8.0), ("H1", 75, 0.5)])
    run()
    run()
    rows = [tuple(r) for r in spark.read.parquet(f"{root}/out").orderBy("day").collect()]
    assert rows == [
        (dt.date(2024, 3, 1), "H1", 2, 3.0, 2.0),
        (dt.date(2024, 3, 2), "H1", 2, 12.0, 8.0),
    ]


def test_copies_within_the_delay_are_dropped_over_restarts(spark):
    root = work_dir(spark, "s")
    run = lambda: jobs.run_to_files(
        jobs.first_per_key(stream(spark, root), ["household_id", "reading_timestamp"]),
        f"{root}/out", f"{root}/cp",
    )
    write(spark, root, 1, [("H1", 1, 1.0), ("H1", 1, 1.0), ("H2", 1, 1.0)])
    run()
    write(spark, root, 2, [("H1", 1, 1.0), ("H1", 2, 1.0)])
    run()
    assert spark.read.parquet(f"{root}/out").count() == 3


def test_ingest_takes_every_file_once(spark):
    root = work_dir(spark, "s")
    run = lambda: jobs.run_to_files(
        jobs.lineage(stream(spark, root), "b1"), f"{root}/out", f"{root}/cp"
    )
    write(spark, root, 1, [("H1", 1, 1.0)])
    run()
    run()
    write(spark, root, 2, [("H1", 99, 1.0), ("H1", 1, 1.0)])
    run()
    landed = spark.read.parquet(f"{root}/out")
    assert landed.count() == 3
    assert landed.filter(F.col("source_file").contains("/raw/f")).count() == 3


def test_refined_stream_keeps_the_newest_valid_reading_per_key(spark):
    spec, root = SPECS["energy_usage"], work_dir(spark, "s")
    same = {"household_id": "H9"}
    rows = raw(
        spark, spec.name, same, same | {"grid_zone": "zzz"}, {"load_factor": "2"}, {"voltage_reading": "abc"}
    ).coalesce(1)
    rows.write.parquet(f"{root}/raw/f1")
    # A day later everything before is closed.
    later = rows.withColumn("reading_timestamp", F.expr("reading_timestamp + INTERVAL 1 DAY"))
    later.withColumn("household_id", F.lit("H99")).limit(1).write.parquet(f"{root}/raw/f2")
    files = jobs.stream_files(spark, f"{root}/raw/*", rows.schema, files_per_batch=1)
    assert jobs.run_to_files(jobs.refine_stream(files, spec), f"{root}/out", f"{root}/cp") == 0
    rows = {r["household_id"]: r for r in spark.read.parquet(f"{root}/out").collect()}
    assert set(rows) == {"H9", "H3"}
    assert rows["H3"]["voltage_reading"] == 0.0 and rows["H3"]["city_name"] == "City_name X"
    assert rows["H9"]["energy_key"] is not None and rows["H9"]["grid_zone"].upper() == "ZZZ"


def test_a_stream_does_not_depend_on_how_it_is_cut(spark):
    readings = [("H%d" % (k % 5), k / 4, float(k)) for k in range(120)]
    readings += [(h, t + 1, v + 0.5) for h, t, v in readings if int(v) % 3 == 0]  # sent again
    readings.sort(key=lambda r: r[1])
    results = []
    for cuts in (1, 3, 5):
        root = work_dir(spark, "s")
        size = -(-len(readings) // cuts)
        for k in range(cuts):
            write(spark, root, k, readings[k * size : (k + 1) * size])
        keyed = stream(spark, root).withColumn("reading", F.floor("kwh"))
        newest = jobs.newest_per_key(keyed, ["household_id", "reading"])
        assert jobs.run_to_files(newest, f"{root}/out", f"{root}/cp") == 0
        results.append(sorted(tuple(r) for r in spark.read.parquet(f"{root}/out").collect()))
    assert results[0] == results[1] == results[2] and len(results[0]) > 90
    assert all(kwh % 1 == (0.5 if int(kwh) % 3 == 0 else 0) for _, _, kwh, _ in results[0])


def test_rows_that_come_too_late_are_counted(spark):
    root = work_dir(spark, "s")
    write(spark, root, 1, [("H1", 50, 1.0)])
    write(spark, root, 2, [("H1", 51, 1.0)])
    write(spark, root, 3, [("H1", 1, 1.0), ("H2", 2, 1.0)])
    newest = jobs.newest_per_key(stream(spark, root), ["household_id", "kwh"])
    assert jobs.run_to_files(newest, f"{root}/out", f"{root}/cp") == 2
