"""Tables of the session catalog, bucketed on what they are joined by."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame

TARGET_BUCKET_BYTES = 256 * 1024 * 1024
LEAST_BUCKETS = 8


def buckets_for(n_bytes: int, target_bytes: int = TARGET_BUCKET_BYTES) -> int:
    """A power of two, so that tables of different sizes can still be read bucket by bucket."""
    wanted = max(LEAST_BUCKETS, math.ceil(n_bytes / target_bytes))
    return 1 << (wanted - 1).bit_length()


def publish_bucketed(df: DataFrame, name: str, path: str, by: Sequence[str], buckets: int) -> DataFrame:
    """Replaces the catalog table ``name`` by the rows of ``df`` and returns it.

    Rows are dealt out by ``by`` once, one task and file per bucket, sorted by it; joins and
    groupings on these columns then need neither a shuffle nor, with one file, a sort.
    """
    (
        df.repartition(buckets, *by)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *by)
        .sortBy(*by)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)

