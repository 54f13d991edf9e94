
import pytest
from fixtures import raw
from pyspark.sql import functions as F
from test_streaming import SCHEMA, stream, write

from voltlake.operators import refine as R
from voltlake.operators.merge import read_table
from voltlake.plans import incremental
from voltlake.session import work_dir
from voltlake.sources import loading
from voltlake.specs import SPECS
from voltlake.streaming import jobs


def daily(spark, root):
    usage = jobs.daily_usage(stream(spark, root), ["household_id"], "kwh")
    return usage.withColumn("month_key", F.date_format("day", "yyyyMM").cast("int"))


def upsert(spark, root, audit=None):
    return jobs.run_upsert(daily(spark, root), f"{root}/out", f"{root}/cp", ["day", "household_id"], ["month_key"], audit)


def totals(spark, root):
    rows = read_table(spark, f"{root}/out").collect()
    return sorted((str(r.day), r.household_id, r.n_readings, r.total_value) for r in rows)


def test_corrections_replace_a_day(spark):
    root = work_dir(spark, "s")
    write(spark, root, 1, [("H1", 1, 1.0), ("H2", 2, 5.0)])
    assert upsert(spark, root) == 0
    assert totals(spark, root) == [("2024-03-01", "H1", 1, 1.0), ("2024-03-01", "H2", 1, 5.0)]
    write(spark, root, 2, [("H1", 23, 2.0)])  # within the delay of the newest
    write(spark, root, 3, [("H1", 24, 4.0)])
    assert upsert(spark, root) == 0
    assert totals(spark, root) == [
        ("2024-03-01", "H1", 2, 3.0), ("2024-03-01", "H2", 1, 5.0), ("2024-03-02", "H1", 1, 4.0),
    ]


@pytest.mark.parametrize("lost", ["before the write", "after the write"])
def test_a_batch_that_comes_again_is_not_doubled(spark, monkeypatch, lost):
    root = work_dir(spark, "s")
    audit = jobs.Audit(loading.audit_path(root), "Stream", "files", "usage")
    write(spark, root, 1, [("H1", 1, 1.0), ("H1", 2, 1.5)])
    upsert(spark, root, audit)
    write(spark, root, 2, [("H1", 3, 8.0), ("H2", 3, 2.0)])
    merge, seen = jobs.merge_into, []

    def killed(spark, path, batch, *rest):
        seen.append(batch)
        if len(seen) == 1:
            if lost == "after the write":
                merge(spark, path, batch, *rest)
            raise RuntimeError("executor of the driver lost")
        return merge(spark, path, batch, *rest)

    monkeypatch.setattr(jobs, "merge_into", killed)
    with pytest.raises(Exception, match="lost"):
        upsert(spark, root, audit)
    upsert(spark, root, audit)
    assert len(seen) >= 2
    # The batch came again under its number: the one after the first run's.
    numbers = {r[0] for r in seen[0].select(jobs.BATCH).union(seen[1].select(jobs.BATCH)).collect()}
    assert len(numbers) == 1
    assert totals(spark, root) == [("2024-03-01", "H1", 3, 10.5), ("2024-03-01", "H2", 1, 2.0)]
    rows = loading.read_audit(spark, audit.location).orderBy("log_timestamp").collect()
    assert [(r.status, r.records_processed) for r in rows] == [("SUCCESS", 1), ("FAILED", 0), ("SUCCESS", 2)]
    assert "lost" in rows[1].error_message


def test_one_audit_row_per_batch(spark):
    root = work_dir(spark, "s")
    audit = jobs.Audit(loading.audit_path(root), "Stream", "files", "readings")
    write(spark, root, 1, [("H1", 50, 1.0), ("H2", 50, 1.0)])
    write(spark, root, 2, [("H1", 51, 1.0)])
    write(spark, root, 3, [("H1", 1, 1.0), ("H2", 2, 1.0), ("H3", 52, 1.0)])
    unique = jobs.first_per_key(stream(spark, root), ["household_id", "kwh", "reading_timestamp"])
    assert jobs.run_to_files(unique, f"{root}/out", f"{root}/cp", audit) == 2
    rows = loading.read_audit(spark, audit.location).collect()
    assert sorted((r.status, r.records_processed) for r in rows) == [
        ("LATE", 2), ("SUCCESS", 1), ("SUCCESS", 1), ("SUCCESS", 2),
    ]
    assert {(r.process_name, r.source_file, r.target_table) for r in rows} == {("Stream", "files", "readings")}
    # Nothing new, nothing to note.
    assert jobs.run_to_files(unique, f"{root}/out", f"{root}/cp", audit) == 0
    assert loading.read_audit(spark, audit.location).count() == 4


def test_a_stream_that_cannot_start_is_audited(spark):
    root = work_dir(spark, "s")
    write(spark, root, 1, [("H1", 1, 1.0)])
    audit = jobs.Audit(loading.audit_path(root), "Stream", "files", "readings")
    with pytest.raises(Exception):
        # Adding up without a watermark has no end that could be appended.
        usage = jobs.stream_files(spark, f"{root}/raw/*", SCHEMA).groupBy("household_id").count()
        jobs.run_to_files(usage, f"{root}/out", f"{root}/cp", audit)
    (row,) = loading.read_audit(spark, audit.location).collect()
    assert (row.status, row.records_processed) == ("FAILED", 0)


def test_copies_far_apart_are_one_row_of_silver(spark):
    spec, root = SPECS["weather_stream"], work_dir(spark, "s")
    first = raw(spark, spec.name, {"household_id": "H1"}, {"household_id": "H2"})
    again = first.withColumn("reading_timestamp", F.expr("reading_timestamp + INTERVAL 5 HOURS"))
    old = first.withColumn("reading_timestamp", F.expr("reading_timestamp - INTERVAL 9 DAYS")).withColumn("dew_point", F.lit(1.0))
    for k, rows in enumerate((first, again.limit(1), old)):
        rows.coalesce(1).write.parquet(f"{root}/raw/f{k}")
        files = jobs.stream_files(spark, f"{root}/raw/*", first.schema)
        assert jobs.run_silver(files, spec, root, f"{root}/cp") == 0
    found = incremental.silver(incremental.state(spark, spec, root), spec)
    expected = R.refine(first.union(again.limit(1)).union(old), spec)
    names = [c for c in expected.columns if c != "silver_ingestion_time"]
    assert sorted(map(str, found.select(names).collect())) == sorted(map(str, expected.select(names).collect()))
