"""Joins and time neighbours that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.functions.columns import all_of

# A task should get at most this share of the rows of one key, unless that is fewer
# rows than a task handles with ease. The share bounds the hot keys of any table at
# 100,000, and the slices of all of them together at twice that.
HOT_SHARE = 0.00001
HOT_ROWS = 100_000
CUTS = 256


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, rows: int = HOT_ROWS
) -> DataFrame:
    """Keys with too many rows for one task, and into how many ``_slices`` to cut each."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    limit = F.greatest(F.lit(rows), total * F.lit(share))
    return counts.filter(F.col("_n") > limit).select(
        *keys, F.ceil(F.col("_n") / limit).cast("int").alias("_slices")
    )


def find_hot(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, rows: int = HOT_ROWS
) -> DataFrame | None:
    """Counts the keys now; gives ``hot_keys`` as a small frame, or None if there are none.

    Runs a job over the key columns, so that the usual case without hot keys keeps
    its simple plan. The number of rows that reach the driver is bounded by 1 / share.
    """
    hot = hot_keys(df.select(*keys), keys, share, rows)
    found = hot.collect()
    return df.sparkSession.createDataFrame(found, hot.schema) if found else None


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    counted: DataFrame | None = None,
    share: float = HOT_SHARE,
    rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join in which the rows of a hot left key go to as many tasks as they need.

    Without ``counted`` this is an ordinary join, whose large partitions Spark splits as it
    runs. ``counted`` has the key frequencies of ``left``, and is counted now: give a
    published table, not a computed frame, where a hot key is known to be too much for
    that. Then only hot keys are cut into slices and only their right rows, of which there
    should be few per key, are repeated.
    The slice is a hash of ``spread_by``: a re-run task gives a row the same slice.
    A hot null key is spread without being repeated, as it matches nothing.

    A wrong guess of the hot keys costs time, not rows.
    ``how`` is inner, left, left_semi or left_anti (the right side is repeated).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join cannot run a {how} join")
    keys = list(on)
    hot = None if counted is None else find_hot(counted, keys, share, rows)
    if hot is None:
        return left.join(right, keys, how)
    flagged = F.broadcast(hot)
    many = left.join(_null_safe(flagged, keys), _same(keys), "left").withColumn(
        "_slice",
        F.when(F.col("_slices").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*spread_by), F.col("_slices")).cast("int")
        ),
    )
    copies = F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)
    few = right.join(flagged, keys, "left").withColumn("_slice", F.explode(copies))
    joined = many.select(*left.columns, "_slice").join(few.drop("_slices"), [*keys, "_slice"], how)
    return joined.drop("_slice")


def _null_safe(hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_slices")


def _same(keys: Sequence[str]) -> Column:
    return all_of([F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])


def with_cells(df: DataFrame, keys: Sequence[str], ts: str, hot: DataFrame) -> DataFrame:
    """Adds ``_cell``: null for ordinary keys, else a stretch of time of the hot key that holds
    about as many rows as every other, whatever its rows' distances in time."""
    flagged = F.broadcast(hot)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    cuts = [k / CUTS for k in range(1, CUTS)]
    stretches = (
        df.select(*keys, at.alias("_at"))
        .join(flagged, keys, "left_semi")
        .groupBy(*keys)
        .agg(F.percentile_approx("_at", cuts, 100 * CUTS).alias("_cuts"))
        .join(flagged, keys)
    )
    before = F.size(F.filter("_cuts", lambda cut: cut <= at))
    per_slice = F.greatest(F.lit(1.0), F.lit(CUTS) / F.col("_slices"))
    # CUTS values for each of the few hot keys.
    return (
        df.join(F.broadcast(stretches), keys, "left")
        .withColumn("_cell", F.when(F.col("_cuts").isNotNull(), F.floor(before / per_slice)))
        .drop("_cuts", "_slices")
    )


def with_neighbours(
    df: DataFrame, key: Sequence[str], ts: str, value: Column, hot: DataFrame | None = None
) -> DataFrame:
    """Adds ``value`` of the key's row before and after in time, as ``_before`` and ``_after``.

    A plain window would put a key of ``hot`` (see ``find_hot``) into one task. The rows of
    such a key are cut by time into as many stretches of about equal size as it has slices,
    ``CUTS`` at most, and the windows cover one stretch each. The first and last rows of all
    windows then meet in a second window per key, which knows what lies across the borders:
    two rows for each stretch. Without hot keys there is one window per key and nothing else.

    (key, ts) must be unique; key, ts and ``value`` must not be null.
    """
    keys = list(key)
    valued = df.withColumn("_value", value)
    per_key = Window.partitionBy(*keys).orderBy(ts)
    before, after = F.lag("_value"), F.lead("_value")
    if hot is None:
        return valued.withColumns(
            {"_before": before.over(per_key), "_after": after.over(per_key)}
        ).drop("_value")
    per_cell = Window.partitionBy(*keys, "_cell").orderBy(ts)
    near = with_cells(valued, keys, ts, hot).withColumns(
        {"_before": before.over(per_cell), "_after": after.over(per_cell)}
    ).drop("_cell")
    at_border = F.col("_before").isNull() | F.col("_after").isNull()
    border = near.filter(at_border).withColumns(
        {
            "_before": F.coalesce("_before", before.over(per_key)),
            "_after": F.coalesce("_after", after.over(per_key)),
        }
    )
    return near.filter(~at_border).unionByName(border).drop("_value")
