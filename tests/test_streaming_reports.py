"""Late rows of a run with more micro-batches than Spark keeps reports of."""

from test_streaming import stream, write
from voltlake.session import work_dir
from voltlake.streaming import jobs

RETENTION = "spark.sql.streaming.numRecentProgressUpdates"


def test_late_rows_are_counted_over_all_batches(spark):
    root = work_dir(spark, "s")
    for k, rows in enumerate([[("H1", 50, 1.0)], [("H1", 51, 1.0)], [("H1", 1, 1.0), ("H2", 2, 1.0)]]):
        write(spark, root, k, rows)
    for k in range(3, 8):
        write(spark, root, k, [("H1", 49.0 + k, 1.0)])
    newest = jobs.newest_per_key(stream(spark, root), ["household_id", "kwh"])
    before = spark.conf.get(RETENTION)
    spark.conf.set(RETENTION, "2")
    try:
        assert jobs.run_to_files(newest, f"{root}/out", f"{root}/cp") == 2
        assert spark.conf.get(RETENTION) == "2"
    finally:
        spark.conf.set(RETENTION, before)
