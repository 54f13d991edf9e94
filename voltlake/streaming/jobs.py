"""Structured Streaming jobs: ingest, deduplication, daily usage and upserts of a file stream.

Every job runs with ``availableNow``: it takes what has arrived since its checkpoint,
finishes, and can be started again by any scheduler.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from voltlake.operators import refine as R
from voltlake.operators.dedup import recency_names
from voltlake.operators.merge import merge_into
from voltlake.plans import incremental
from voltlake.sources import loading
from voltlake.sources.readers import with_lineage
from voltlake.specs import WATERMARK_COLUMN, WATERMARK_DELAY, TableSpec

ROWS = "written"  # name under which a stream's rows are observed
BATCH = "stream_batch"  # the micro-batch that wrote a row of an upserted table


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream; a stream needs its schema given."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_event_time(
    df: DataFrame, column: str = WATERMARK_COLUMN, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Watermark on ``column``. It needs a zoned timestamp, so zone-less values are cast."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def lineage(df: DataFrame, batch_id: str) -> DataFrame:
    return with_lineage(df, batch_id)


def first_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """First row of each key; copies are recognised while within the watermark delay."""
    return df.dropDuplicatesWithinWatermark(list(key))


def newest_per_key(
    df: DataFrame, key: Sequence[str], ts: str = WATERMARK_COLUMN, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Newest row of each key, once no further copy can come.

    Copies that follow each other within ``delay`` are one reading. Its newest row, by the same
    order as in the batch job, appears when the watermark has passed the delay after the last
    copy; so the result does not depend on how the input is cut into micro-batches.
    """
    order = recency_names(df, key, [ts])
    session = F.session_window(ts, delay).alias("_session")
    newest = F.max(F.struct(*order)).alias("_newest")
    return df.groupBy(session, *key).agg(newest).select(*key, "_newest.*").select(df.columns)


def refine_stream(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The refine steps on a stream; of the copies of a key the newest is kept, as in a batch."""
    prepared = R.standardise(R.convert_types(df, spec), spec)
    unique = newest_per_key(with_event_time(prepared), spec.key)
    valid = R.validate(R.fill_measures(unique, spec), spec)
    return R.add_audit_columns(R.add_key(valid, spec))


def daily_usage(df: DataFrame, by: Sequence[str], value: str, ts: str = WATERMARK_COLUMN) -> DataFrame:
    """Rows, total and peak of ``value`` per day; a day appears once the watermark passed it."""
    return (
        df.groupBy(F.window(ts, "1 day").alias("_day"), *by)
        .agg(
            F.count(F.lit(1)).alias("n_readings"),
            F.sum(value).alias("total_value"),
            F.max(value).alias("peak_value"),
        )
        .select(F.col("_day.start").cast("date").alias("day"), *by, "n_readings", "total_value", "peak_value")
    )


@dataclass(frozen=True)
class Audit:
    """Where the micro-batches of a job are recorded, and under which names."""

    location: str
    process: str
    source: str
    target: str


class BatchListener(StreamingQueryListener):
    """Notes rows written and rows too late of every micro-batch of one query, as Spark reports them."""

    def __init__(self, name: str):
        self.name, self.run_id = name, None
        self.batches: dict[int, tuple[int, int]] = {}
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = event.runId

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name == self.name:
            observed = progress.observedMetrics.get(ROWS)
            late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
            self.batches[progress.batchId] = (observed["n"] if observed else 0, late)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run_id:
            self.ended.set()


def _run(writer, spark: SparkSession, audit: Audit | None, rows_of: dict[int, int] | None = None) -> int:
    """Runs a stream over what has arrived and returns its late rows.

    Every micro-batch that wrote or left out rows gets an audit row: SUCCESS with the rows written, and
    LATE with those left out. A failure gets a FAILED row with its message and is raised again.
    ``rows_of`` has the rows of batches that a function wrote, which Spark does not observe.
    """
    name = f"voltlake-{uuid.uuid4().hex}"
    listener = BatchListener(name)
    spark.streams.addListener(listener)
    error, query = None, None
    try:
        query = writer.queryName(name).trigger(availableNow=True).start()
        query.awaitTermination()
    except Exception as failure:
        error = str(failure) or type(failure).__name__
        raise
    finally:
        # Reports come in order; the end comes last.
        if query is not None and not listener.ended.wait(timeout=60):
            error = error or "the stream's reports did not arrive"
        spark.streams.removeListener(listener)
        if audit:
            outcomes = []
            for batch, (n_rows, late) in sorted(listener.batches.items()):
                n_rows = rows_of.get(batch, 0) if rows_of is not None else n_rows
                outcomes += [(n_rows, "SUCCESS", None)] if n_rows else []
                outcomes += [(late, "LATE", "behind the watermark")] if late else []
            outcomes += [(0, "FAILED", error)] if error else []
            loading.append_outcomes(spark, audit.location, audit.process, audit.source, audit.target, outcomes)
    return sum(late for _, late in listener.batches.values())


def run_to_files(df: DataFrame, path: str, checkpoint: str, audit: Audit | None = None) -> int:
    """Appends the stream's new rows to Parquet files, each exactly once over all restarts.

    Returns how many rows came too late for their state and were left out.
    """
    writer = df.observe(ROWS, F.count(F.lit(1)).alias("n")).writeStream.format("parquet").outputMode("append")
    return _run(writer.option("checkpointLocation", checkpoint).option("path", path), df.sparkSession, audit)


def run_batches(
    df: DataFrame,
    take: Callable[[DataFrame, int], None],
    checkpoint: str,
    audit: Audit | None = None,
    output_mode: str = "append",
) -> int:
    """Hands every micro-batch to ``take``, which must do the same when a batch comes again.

    That happens when the job is lost after ``take`` and before the batch is noted as done.
    Returns the rows that came too late.
    """
    spark, rows_of = df.sparkSession, {}

    def one(batch: DataFrame, batch_id: int) -> None:
        counted = Observation()
        take(batch.observe(counted, F.count(F.lit(1)).alias("n")), batch_id)
        rows_of[batch_id] = counted.get.get("n", 0)

    writer = df.writeStream.foreachBatch(one).outputMode(output_mode)
    return _run(writer.option("checkpointLocation", checkpoint), spark, audit, rows_of)


def run_upsert(
    df: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str],
    partition_by: Sequence[str],
    audit: Audit | None = None,
) -> int:
    """Keeps the newest row of each key in a partitioned table: a row replaces the key's rows of earlier
    micro-batches. Of the rows of one micro-batch the largest counts.

    A batch that comes again, under its old number, changes nothing. Only the
    partitions a batch touches are read and written; see :func:`voltlake.operators.merge.merge_into`.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        merge_into(df.sparkSession, path, numbered, key, [BATCH], partition_by)

    return run_batches(df, take, checkpoint, audit, "update")


def run_silver(df: DataFrame, spec: TableSpec, root: str, checkpoint: str, audit: Audit | None = None) -> int:
    """Merges a stream of raw readings into Silver's state, batch by batch.

    The state holds one row per key, however far apart its copies arrive, and equals what
    a batch job makes of the same readings. No reading is too late and none is held back.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        incremental.merge_batch(df.sparkSession, batch, spec, root)

    return run_batches(df, take, checkpoint, audit)
