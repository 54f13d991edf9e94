import datetime as dt

from pyspark.sql import functions as F

from catalogue import queries
from voltlake.session import work_dir


def arrived(spark, rows, times=3):
    """What each run of a stream may read."""
    root, seen = work_dir(spark, "arrivals"), []

    def sink(stream, path, checkpoint):
        query = (
            stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        seen.append(sorted(r[0] for r in spark.read.schema("id LONG").parquet(path).collect()))
        return 1

    assert queries._arrivals(spark, rows, "ts", root, lambda s: s.select("id"), times, sink) == times
    return seen


def test_rows_are_worked_out_once_and_arrive_in_stretches_of_time(spark):
    asked = spark.sparkContext.accumulator(0)
    start = dt.datetime(2024, 1, 1)

    @F.udf("timestamp")
    def at(k):
        asked.add(1)
        return None if k == 7 else start + dt.timedelta(minutes=k)

    # None in the middle stretch; a row without a time never arrives.
    ids = [*range(10), *range(80, 91)]
    rows = spark.createDataFrame([(k,) for k in ids], "id LONG").withColumn("ts", at.asNondeterministic()("id"))
    seen = arrived(spark, rows)
    early = [k for k in range(10) if k != 7]
    assert seen == [early, early, early + list(range(80, 91))]
    assert asked.value == 2 * len(ids)  # for the range of times, and to be written


def test_rows_of_one_time_arrive_in_every_run(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id LONG").withColumn("ts", F.lit(dt.datetime(2024, 1, 1)))
    assert arrived(spark, rows, 2) == [[1, 2], [1, 1, 2, 2]]
