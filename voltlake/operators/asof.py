"""What held at a time: as-of lookups without a range join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlake.functions.columns import all_of
from voltlake.operators.skew import HOT_ROWS, find_hot, with_cells


def as_of(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    counted: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``left`` with ``values`` of the newest ``right`` row of the same key that is not later.

    Both sides are put into one order of time per key, and the last right row is carried forward:
    one shuffle and one pass, however many right rows a key has. Every left row stays; a key or
    time that is null, and a time before the first right row, get nulls. Of several right rows of a key and
    time the one with the largest values counts. Right rows without key or time play no part.

    ``counted`` is a published table with the keys of ``left``, counted now: a key with more than
    ``hot_rows`` rows is cut by time into stretches that go to different tasks, and the last right row
    of a stretch is handed on to those after it: one row for each stretch of such a key.
    """
    keys = list(on)
    known = all_of([F.col(c).isNotNull() for c in (*keys, left_ts)])
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in values]
    row, value = F.struct(*left.columns).alias("_row"), F.struct(*values).alias("_value")
    kinds = left.select(row).schema["_row"].dataType, right.select(value).schema["_value"].dataType
    asked = left.filter(known).select(
        *keys, F.col(left_ts).cast("timestamp").alias("_at"), F.lit(1).alias("_side"),
        row, F.lit(None).cast(kinds[1]).alias("_value"),
    )
    told = right.filter(all_of([F.col(c).isNotNull() for c in (*keys, right_ts)])).select(
        *keys, F.col(right_ts).cast("timestamp").alias("_at"), F.lit(0).alias("_side"),
        F.lit(None).cast(kinds[0]).alias("_row"), value,
    )
    events = asked.unionByName(told)
    order = ["_at", "_side", "_value"]
    so_far = F.last("_value", ignorenulls=True)
    upto = (Window.unboundedPreceding, Window.currentRow)
    hot = None if counted is None else find_hot(counted, keys, rows=hot_rows)
    if hot is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        carried = events.withColumn("_found", so_far.over(window))
    else:
        cut = with_cells(events, keys, "_at", hot)
        window = Window.partitionBy(*keys, "_cell").orderBy(*order).rowsBetween(*upto)
        within = cut.withColumn("_found", so_far.over(window))
        ends = cut.filter("_cell IS NOT NULL").groupBy(*keys, "_cell").agg(
            F.max(F.when(F.col("_side") == 0, F.struct("_at", "_value"))).alias("_end")
        )
        earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        handed = ends.select(*keys, "_cell", F.last("_end._value", ignorenulls=True).over(earlier).alias("_handed"))
        carried = within.join(handed, [*keys, "_cell"], "left").withColumn("_found", F.coalesce("_found", "_handed"))
    found = carried.filter("_side = 1").select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in values])
    return found.unionByName(left.filter(~known).select("*", *nothing))
