"""Merging a batch into a partitioned table: the newest row of every key, whatever the order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.operators.dedup import latest_per_key
from voltlake.session import stored
from voltlake.sources.readers import WIDENED, conformed, merged_schema, path_exists


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replaces the partitions that ``df`` has rows of; all others keep their files."""
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _in_partitions(rows: DataFrame, wanted: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the wanted partitions, which Spark finds out as it runs and reads no others."""
    # A comparison that always holds tells the optimizer that ``wanted`` is worth pruning by.
    some = wanted.filter(F.col(partition_by[0]) >= F.lit(-(1 << 31)))
    return rows.join(some, list(partition_by), "left_semi").select(rows.columns)


def merge_into(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: Sequence[str],
    newest_first: Sequence[str],
    partition_by: Sequence[str],
) -> DataFrame:
    """Brings ``batch`` into the table at ``path`` and returns the partitions it touched.

    Of all rows of a key the newest stays, by ``newest_first`` and then every other column: so the
    table is the same in whatever order and pieces batches come, and a batch that comes again
    changes nothing. ``partition_by`` must follow from the key and be whole numbers, none null. Columns that are
    new, or of a wider type, are added to the table's. Rows are merged into a table of
    their own before anything is replaced. One merge into a table at a time.
    """
    # The batch is used for what it touches and for its rows; copies go first.
    batch = stored(latest_per_key(batch, key, newest_first), "merge-batch")
    touched = batch.select(*partition_by).distinct()
    rows = batch
    if path_exists(spark, path):
        held = read_table(spark, path, batch.schema)
        same = _in_partitions(held, touched, partition_by)
        together = same.unionByName(conformed(batch, held.schema), allowMissingColumns=True)
        rows = stored(latest_per_key(together, key, newest_first), "merge-result")
    _keep_schema(spark, path, rows.schema)
    overwrite_partitions(rows, path, partition_by)
    return touched


def _schema_path(path: str) -> str:
    return f"{path.rstrip('/')}_schema"


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Files of partitions that no batch has touched since lack the columns that came later; so the
    table's columns are kept in an empty table beside it, which is written before any of them."""
    at = _schema_path(path)
    if not path_exists(spark, at) or spark.read.parquet(at).schema != schema:
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(at)


def read_table(spark: SparkSession, path: str, also: T.StructType | None = None) -> DataFrame:
    """A table that batches are merged into, with the columns of ``also`` that it has not yet as nulls."""
    own = spark.read.parquet(_schema_path(path)).schema
    schema = merged_schema(own, also) if also else own
    by_cast = [f.name for f in schema.fields if (f.metadata or {}).get(WIDENED)]
    if by_cast:
        raise ValueError(f"{path}: columns {', '.join(by_cast)} changed their type; rebuild the table")
    return spark.read.schema(schema).parquet(path)
