"""Running totals of keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import written


def running(rows: DataFrame, key: Sequence[str], order: Sequence[str], sums: Sequence[str], label: str) -> DataFrame:
    """Adds ``sum_<c>`` of each column in ``sums``: its total over the key's rows so far, in ``order``.

    Rows are cut into ranges of (key, order), so that a key with a third of all rows lies in many of them.
    Totals run within a range; what the ranges before hold of its first key is added. Only that
    one key of a range can have begun before, so these sums are one row per range at most, which
    is what is broadcast. ``order`` must tell a key's rows apart, but for rows that are equal.
    """
    keys = list(key)
    cut = written(rows.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), label)
    so_far = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = cut.groupBy(*keys, "__part").agg(*[F.sum(c).alias(f"__{c}") for c in sums])
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select(
        *keys, "__part", *[F.sum(f"__{c}").over(before).alias(f"__{c}") for c in sums]
    ).filter(F.col(f"__{sums[0]}").isNotNull())
    return (
        cut.withColumns({f"sum_{c}": F.sum(c).over(so_far) for c in sums})
        .join(F.broadcast(earlier), [*keys, "__part"], "left")
        .withColumns({f"sum_{c}": F.col(f"sum_{c}") + F.coalesce(f"__{c}", F.lit(0)) for c in sums})
        .drop("__part", *[f"__{c}" for c in sums])
    )
