"""Versioned tables over plain Parquet folders, for clusters without a table format.

Every write goes to a new folder below ``<table>/data``; afterwards one row below
``<table>/commits`` names the folders that make up the new version. A failed write
leaves no row and is therefore invisible. One writer per table at a time; a second
writer that reaches the same version number fails instead of overwriting.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.functions.columns import interleave, with_range_buckets
from voltlake.sources.readers import WIDENED, append_evolving, conformed, merged_schema
from voltlake.specs import RETENTION_HOURS

COMMIT_SCHEMA = (
    "version LONG, committed_at TIMESTAMP, operation STRING, n_rows LONG, n_files LONG, "
    "n_bytes LONG, folders ARRAY<STRUCT<dir: STRING, n_files: LONG, n_bytes: LONG>>, "
    "schema_json STRING"
)
TARGET_FILE_BYTES = 512 * 1024 * 1024


class VersionNotFound(LookupError):
    """The version never existed or has expired."""


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _commits(spark: SparkSession, path: str, pattern: str) -> list[str]:
    target, fs = _path(spark, f"{path}/commits/{pattern}")
    return sorted(s.getPath().toString() for s in fs.globStatus(target) or [])


def versions(spark: SparkSession, path: str) -> list[int]:
    """Retained version numbers in order. A commit counts once its marker is written."""
    return [int(p.split("/")[-2][1:]) for p in _commits(spark, path, "v*/_SUCCESS")]


def _commit_folder(path: str, version: int) -> str:
    return f"{path}/commits/v{version:010d}"


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per retained version."""
    folders = [_commit_folder(path, v) for v in versions(spark, path)]
    if not folders:
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).parquet(*folders)


def _commit_row(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    known = versions(spark, path)
    wanted = known[-1] if known and version is None else version
    if wanted not in known:
        return None
    return spark.read.schema(COMMIT_SCHEMA).parquet(_commit_folder(path, wanted)).first()


def _require(spark: SparkSession, path: str, version: int | None) -> Row:
    row = _commit_row(spark, path, version)
    if row is None:
        raise VersionNotFound(
            f"{path}: no version {version}; retained versions: {versions(spark, path)}"
        )
    return row


def latest_version(spark: SparkSession, path: str) -> int:
    return _require(spark, path, None)["version"]


def table_bytes(spark: SparkSession, path: str) -> int:
    return _require(spark, path, None)["n_bytes"]


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of ``version``, the newest by default.

    Folders written before a column existed give null for it.
    """
    row = _require(spark, path, version)
    return _read_dirs(spark, path, list(_sizes(row)), row["schema_json"])


def _read_dirs(spark: SparkSession, path: str, dirs: Sequence[str], schema_json: str) -> DataFrame:
    schema = _schema(schema_json)
    if not dirs:
        return spark.createDataFrame([], schema)
    # Each write is a partition of the table's data folder, and may have partitions of its own.
    reader = spark.read.option("basePath", f"{path}/data")
    if any((f.metadata or {}).get(WIDENED) for f in schema.fields):
        # Some folders hold a type that Spark does not widen while it reads.
        each = [conformed(reader.parquet(f"{path}/{d}").drop("load"), schema) for d in dirs]
        known = [df.select([c for c in df.columns if c in schema.names]) for df in each]
        empty = spark.createDataFrame([], schema)
        return append_evolving([empty, *known]).select(schema.names)
    return reader.schema(schema).parquet(*[f"{path}/{d}" for d in dirs]).select(schema.names)


def _partition_columns(df: DataFrame) -> list[str]:
    """The columns a table's files are partitioned by, from where a file of it lies."""
    folders = next(iter(df.inputFiles()), "").split("/data/", 1)[-1].split("/")[1:-1]
    return [f.split("=", 1)[0] for f in folders]


def _schema(schema_json: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(schema_json))


def _size(spark: SparkSession, path: str, folder: str) -> tuple[int, int]:
    """(files, bytes) of one data folder, from the file system's own summary."""
    target, fs = _path(spark, f"{path}/{folder}")
    summary = fs.getContentSummary(target)
    return summary.getFileCount(), summary.getLength()


def files_bytes(spark: SparkSession, files: Sequence[str]) -> int:
    """Bytes of some files, as the file system has them."""
    return sum(fs.getFileStatus(target).getLen() for target, fs in (_path(spark, f) for f in files))


def _commit(
    spark: SparkSession,
    path: str,
    operation: str,
    sizes: dict[str, tuple[int, int]],
    schema: T.StructType,
    n_rows: int,
) -> int:
    """Makes the folders in ``sizes`` the next version."""
    # Counts folders without a marker too: a commit that broke off keeps its number.
    taken = _commits(spark, path, "v*")
    version = int(taken[-1].rsplit("/v", 1)[1]) + 1 if taken else 0
    row = (
        version, datetime.now(timezone.utc), operation, n_rows,
        sum(n for n, _ in sizes.values()), sum(b for _, b in sizes.values()),
        [{"dir": d, "n_files": n, "n_bytes": b} for d, (n, b) in sizes.items()], schema.json(),
    )
    spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(
        _commit_folder(path, version)
    )
    return version


def _sizes(row: Row | None) -> dict[str, tuple[int, int]]:
    return {d["dir"]: (d["n_files"], d["n_bytes"]) for d in row["folders"]} if row else {}


def _write(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None,
) -> tuple[dict[str, tuple[int, int]], dict[str, int]]:
    """Writes a new data folder; returns it with its size, and what the write counted: all rows as
    "n", and those for which each of ``counts`` holds."""
    folder = f"data/load={uuid.uuid4().hex}"
    counted = Observation()
    more = [F.count_if(condition).alias(name) for name, condition in (counts or {}).items()]
    # Observed directly below the write, where every row is counted exactly once.
    writer = df.observe(counted, F.count(F.lit(1)).alias("n"), *more).write
    # The commit row marks the write as complete, and the size should count data only.
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{folder}")
    return {folder: _size(spark, path, folder)}, {"n": 0} | counted.get


def publish(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None,
    judge: Callable[[dict[str, int], DataFrame], None] | None = None,
) -> tuple[int, int]:
    """Writes ``df`` as the next version; returns (version, rows written).

    ``counts`` are conditions whose rows are counted by the write. ``judge`` gets the counts, all rows
    as "n", and the rows as written, before they become a version; if it raises, they never do.

    ``append`` keeps the folders of the version before, ``overwrite`` drops them.
    Both evolve the schema: new columns are added, missing ones become null, types are widened.
    With ``partition_by`` the rows are rebalanced on those columns first, so that a
    large partition is split over several files and small ones are not scattered.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode}")
    last = _commit_row(spark, path)
    schema = merged_schema(_schema(last["schema_json"]), df.schema) if last else df.schema
    df = conformed(df, schema)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    written, found = _write(spark, df, path, partition_by, counts)
    n_rows = found["n"]
    if judge:
        judge(found, _read_dirs(spark, path, list(written), df.schema.json()))
    kept = _sizes(last) if mode == "append" else {}
    total = n_rows + (last["n_rows"] if kept else 0)
    version = _commit(spark, path, f"WRITE {mode}".upper(), {**kept, **written}, schema, total)
    return version, n_rows


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrites folders that hold more files than their bytes need; others stay as they are.

    Whole scan partitions are merged, so nothing is shuffled, unless the table is partitioned:
    then each partition is gathered and stays one. Returns the version, which is the old one
    when there was nothing to do.
    """
    last = _require(spark, path, None)
    sizes = _sizes(last)
    full = {
        d for d, (n, b) in sizes.items() if n <= max(1, math.ceil(b / target_bytes)) and b > target_bytes // 2
    }
    loose = {d: size for d, size in sizes.items() if d not in full}
    files = max(1, math.ceil(sum(b for _, b in loose.values()) / target_bytes))
    if sum(n for n, _ in loose.values()) <= files:
        return last["version"]
    small = _read_dirs(spark, path, list(loose), last["schema_json"])
    partition_by = _partition_columns(small)
    merged = small.hint("rebalance", *partition_by) if partition_by else small.coalesce(files)
    written, _ = _write(spark, merged, path, partition_by)
    kept = {d: size for d, size in sizes.items() if d in full}
    return _commit(
        spark, path, "OPTIMIZE", {**kept, **written}, _schema(last["schema_json"]), last["n_rows"]
    )


def _rankable(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values; of texts, of their first seven bytes."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("long")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    return F.col(column).cast("double")


def with_cluster_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> DataFrame:
    """Adds ``_z``, the Z-order value over quantile buckets of ``columns``.

    The bucket bounds are approximate quantiles of all rows, found in one aggregate and off by a
    tenth of a cell at most; they steer the layout only, never the result.
    """
    cells = 2**bits
    wanted = [k / cells for k in range(1, cells)]
    ranks = {f"_cell_{k}": _rankable(df, c) for k, c in enumerate(columns)}
    quantiles = [F.percentile_approx(rank, wanted, max(10_000, 10 * cells)) for rank in ranks.values()]
    found = df.agg(*quantiles).first()
    # A value that fills several cells takes the last of them, so that columns of few values keep their weight.
    bounds = {name: sorted(each or []) for name, each in zip(ranks, found)}
    marked = with_range_buckets(df, ranks, bounds)
    return marked.withColumn("_z", interleave([F.col(name) for name in ranks], bits)).drop(*ranks)


def cluster(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    target_bytes: int = TARGET_FILE_BYTES,
    bits: int = 6,
) -> int:
    """Rewrites the table along a Z-order curve, so that files cover narrow value ranges.

    Ranges are cut on (z, columns, row hash): rows that share one z value, or even
    all clustering columns, still spread over several files.
    """
    last = _require(spark, path, None)
    df = _read_dirs(spark, path, list(_sizes(last)), last["schema_json"])
    files = max(1, math.ceil(last["n_bytes"] / target_bytes))
    partition_by = _partition_columns(df)
    ordered = [F.col(c) for c in (*partition_by, "_z", *columns)]
    # Twice as many cells in each column as there are files, so that files can be told apart.
    bits = max(bits, math.ceil(math.log2(2 * files)))
    whole_row = F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])
    laid_out = (
        with_cluster_value(df, columns, bits)
        .repartitionByRange(files, *ordered, whole_row)
        .sortWithinPartitions(*ordered)
        .drop("_z")
    )
    written, found = _write(spark, laid_out, path, partition_by)
    return _commit(
        spark, path, f"ZORDER ({', '.join(columns)})", written,
        _schema(last["schema_json"]), found["n"],
    )


def expire(
    spark: SparkSession, path: str, retain_hours: float = RETENTION_HOURS, now: datetime | None = None
) -> list[int]:
    """Drops versions that were replaced longer ago than the retention, and their folders.

    The newest version always stays. A folder goes only when no retained version
    lists it and it is older than the retention itself, which also clears what failed
    writes left behind. Returns the versions dropped.
    """
    now = now or datetime.now(timezone.utc)
    cutoff = now - timedelta(hours=retain_hours)
    log = (
        history(spark, path)
        .select("version", F.unix_millis("committed_at").alias("at"), F.col("folders.dir").alias("dirs"))
        .orderBy("version")
        .collect()
    )
    oldest = cutoff.timestamp() * 1000
    # A version is replaced when its successor is committed.
    expired = [row["version"] for row, successor in zip(log, log[1:]) if successor["at"] < oldest]
    live = {d for row in log if row["version"] not in expired for d in row["dirs"]}
    data, fs = _path(spark, f"{path}/data")
    for status in fs.listStatus(data) if fs.exists(data) else []:
        name = status.getPath().getName()
        if f"data/{name}" not in live and status.getModificationTime() < oldest:
            fs.delete(status.getPath(), True)
    for version in expired:
        fs.delete(_path(spark, _commit_folder(path, version))[0], True)
    return expired
