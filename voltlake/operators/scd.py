"""Slowly changing history (type 2): one row per period in which a key's attributes held."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.functions.columns import all_of
from voltlake.operators.dedup import latest_per_key
from voltlake.operators.skew import HOT_ROWS, find_hot, spread_join, with_neighbours


def scd2_history(
    observations: DataFrame,
    key: Sequence[str],
    ts: str,
    tracked: Sequence[str],
    tie_break: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Versions of every key: ``effective_from`` up to, not including, ``effective_to``.

    A version starts where a tracked attribute differs from the observation before
    (nulls compare equal). ``tie_break`` picks the state when a key has several
    observations at one time, the largest values winning; leave it out when
    (key, ts) is already unique. Observations without a key or a time are left out.
    ``last_seen`` is the key's newest observation and is set on its current version.
    ``counted`` is a published table with the keys of the observations: where given, they are
    counted now, and a key with more than ``hot_rows`` rows is cut by time.
    """
    extra = list(tie_break or ())
    columns = dict.fromkeys([*key, ts, *tracked, *extra])
    rows = _timed(observations, key, ts).select(*columns)
    if tie_break is not None:
        rows = latest_per_key(rows, [*key, ts], extra)
    states = rows.select(*key, F.col(ts).alias("effective_from"), F.struct(*tracked).alias("_state"))
    hot = None if counted is None else find_hot(counted, key, rows=hot_rows)

    # A version starts where the state differs from the one before. The key's last
    # observation stays as well, to tell how long the current version was seen.
    observed = F.struct("effective_from", "_state")
    seen = with_neighbours(states, key, "effective_from", observed, hot)
    starts = F.col("_before").isNull() | ~F.col("_state").eqNullSafe(F.col("_before._state"))
    marked = seen.select(
        *key, "effective_from", "_state", starts.alias("_starts"), F.col("_after").isNull().alias("_last")
    ).filter("_starts OR _last")

    following = F.struct("effective_from", "_starts")
    versions = with_neighbours(marked, key, "effective_from", following, hot)
    effective_to = F.when(F.col("_after._starts"), F.col("_after.effective_from"))
    last_seen = F.coalesce("_after.effective_from", "effective_from")
    return versions.filter("_starts").select(
        *key,
        *[F.col(f"_state.{c}").alias(c) for c in tracked],
        "effective_from",
        effective_to.alias("effective_to"),
        effective_to.isNull().alias("is_current"),
        F.when(effective_to.isNull(), last_seen).alias("last_seen"),
    )


def scd2_refresh(
    dimension: DataFrame,
    batch: DataFrame,
    history: DataFrame,
    key: Sequence[str],
    ts: str,
    tracked: Sequence[str],
    tie_break: Sequence[str] | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``dimension`` after ``batch``, equal to a rebuild from ``history``.

    ``history`` holds all observations, the batch included. Keys whose new
    observations are all later than their ``last_seen`` continue from their current
    version, without touching the history. Keys with a late observation are rebuilt
    from their own rows of the history. All other versions pass through unchanged.
    Nothing runs while this is planned, but for the count of the keys of ``counted`` (see
    :func:`scd2_history`), the history as a published table, if it is given.
    """
    keys = list(key)
    columns = list(dict.fromkeys([*keys, ts, *tracked, *(tie_break or ())]))
    incoming = _timed(batch, keys, ts).select(*columns)
    current = dimension.filter("is_current")

    # One row per touched key; a key that is new to the dimension is never late.
    touched = (
        incoming.groupBy(*keys)
        .agg(F.min(ts).alias("_first_new"))
        .join(current.select(*keys, "last_seen"), keys, "left")
        .select(*keys, F.coalesce(F.col("_first_new") <= F.col("last_seen"), F.lit(False)).alias("_late"))
    )
    late = touched.filter("_late").select(*keys)
    on_time = touched.filter(~F.col("_late")).select(*keys)

    kept = (
        spread_join(dimension, touched, keys, ["effective_from"])
        .filter(F.col("_late").isNull() | (~F.col("_late") & ~F.col("is_current")))
        .select(*dimension.columns)
    )
    # The current version re-enters as an observation at the start of its period.
    opening = current.join(on_time, keys, "left_semi").select(
        *keys, F.col("effective_from").alias(ts), *tracked
    )
    forward = spread_join(incoming, late, keys, [ts], "left_anti").unionByName(
        opening, allowMissingColumns=True
    )
    again = spread_join(history.select(*columns), late, keys, [ts], "left_semi")
    continued = scd2_history(forward, keys, ts, tracked, tie_break)
    rebuilt = scd2_history(again, keys, ts, tracked, tie_break, counted=counted)
    return kept.unionByName(continued).unionByName(rebuilt)


def scd2_snapshot(
    dimension: DataFrame, snapshot: DataFrame, key: Sequence[str], tracked: Sequence[str], at: datetime | Column
) -> DataFrame:
    """``dimension`` after a full ``snapshot`` of all keys that exist at time ``at``.

    A key whose tracked attributes differ (nulls compare equal) closes its current version at ``at``
    and opens a new one; a key that is missing closes it and opens none; one that is new, or comes back, opens one.
    ``last_seen`` of current versions becomes ``at``. Rows without a complete key are left out; of
    several rows of a key the largest counts. Snapshots come in the order of time; one that comes again
    changes nothing, one that replaces another of the same time leaves no version of no length.
    The join is between two tables with one row per key, so that no key is hot.
    """
    keys, moment = list(key), F.lit(at).cast(dimension.schema["effective_from"].dataType)
    complete = all_of([F.col(c).isNotNull() for c in keys])
    seen = latest_per_key(snapshot.filter(complete).select(*keys, *tracked), keys)
    was = F.struct(*tracked, "effective_from", "last_seen").alias("_was")
    current = dimension.filter("is_current").select(*keys, was)
    met = current.join(seen.select(*keys, F.struct(*tracked).alias("_is")), keys, "full_outer")

    here, there = F.col("_is").isNotNull(), F.col("_was").isNotNull()
    before, after = ([F.col(f"{side}.{c}").alias(c) for c in tracked] for side in ("_was", "_is"))
    same = here & there & F.struct(*before).eqNullSafe(F.struct(*after))
    nothing = F.lit(None).cast(dimension.schema["effective_from"].dataType)

    def version(state: list[Column], start, end, is_current: bool, last_seen) -> Column:
        fields = [*state, start.alias("effective_from"), end.alias("effective_to")]
        return F.struct(*fields, F.lit(is_current).alias("is_current"), last_seen.alias("last_seen"))

    began = F.col("_was.effective_from")
    lasted = there & (began < moment)
    versions = F.array_compact(
        F.array(
            F.when(same, version(before, began, nothing, True, moment)),
            F.when(~same & lasted, version(before, began, moment, False, nothing)),
            F.when(~same & here, version(after, moment, nothing, True, moment)),
        )
    )
    changed = met.select(*keys, F.inline(versions)).select(dimension.columns)
    return dimension.filter("NOT is_current").unionByName(changed)


def _timed(rows: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    return rows.filter(all_of([F.col(c).isNotNull() for c in (*key, ts)]))
