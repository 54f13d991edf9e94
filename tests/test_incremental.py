import itertools
import os
import random

import pytest
from fixtures import raw
from pyspark.sql import functions as F

from voltlake.operators import refine as R
from voltlake.operators.merge import merge_into, read_table
from voltlake.plans import incremental, medallion
from voltlake.session import work_dir
from voltlake.sources import loading, snapshots
from voltlake.specs import SPECS


def bag(df):
    kept = [c for c in df.columns if c not in ("silver_ingestion_time", "bronze_ingestion_time", "source_file", "batch_id")]
    return sorted((str(r.asDict()) for r in df.select(sorted(kept)).collect()))


def readings(spark, name, seed, n=30):
    """Copies, late copies and broken copies of few keys."""
    rng = random.Random(seed)
    spec, rows = SPECS[name], []
    for k in range(n):
        change = {
            "household_id": rng.choice(["H1", "H2", "H3", None]),
            "reading_timestamp": f"2024-0{rng.randint(1, 3)}-0{rng.randint(1, 9)} 00:00:00",
            spec.measures[0]: rng.choice(["1", "-1", None, "n/a"]) if spec.cast_measures else rng.choice(["1", None]),
            spec.text[0]: rng.choice([" a", "A ", "b"]),
        }
        if spec.timestamps:
            change["timestamp"] = rng.choice(["01-01-2024 00:00", "09-02-2024 00:00", "unreadable"])
        elif "timestamp" in spec.key:
            change["timestamp"] = rng.choice(["2024-01-01 00:00:00", "2024-02-09 00:00:00"])
        rows.append(change)
    return raw(spark, name, *rows)


@pytest.mark.parametrize("name", list(SPECS))
def test_batches_in_any_order_give_the_rebuild(spark, name):
    spec = SPECS[name]
    batches = [readings(spark, name, seed) for seed in range(3)]
    whole = batches[0].union(batches[1]).union(batches[2])
    for order in list(itertools.permutations(range(3)))[:: 2 if name == "energy_usage" else 6]:
        root = work_dir(spark, "inc")
        for i in (*order, order[0]):  # one batch comes again
            incremental.merge_batch(spark, batches[i], spec, root, buckets=4)
        state = incremental.state(spark, spec, root)
        assert bag(incremental.silver(state, spec)) == bag(R.refine(whole, spec))
        if spec.ranges:
            assert bag(incremental.rejected(state, spec)) == bag(R.rejects(whole, spec))


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_touched_partitions_are_read_and_written(spark):
    path = f"{work_dir(spark, 'merge')}/t"
    rows = spark.range(1000).select("id", (F.col("id") % 10).cast("int").alias("part"), F.lit(1).alias("v"))
    merge_into(spark, path, rows, ["id"], ["v"], ["part"])
    before = files_of(path)
    batch = spark.createDataFrame([(3, 3, 2), (13, 3, 0), (1003, 3, 5)], "id LONG, part INT, v INT")
    touched = merge_into(spark, path, batch, ["id"], ["v"], ["part"])
    assert [r.part for r in touched.collect()] == [3]
    assert {f.split("part=")[1].split("/")[0] for f in before ^ files_of(path)} == {"3"}
    found = {r.id: r.v for r in read_table(spark, path).collect()}
    assert found == dict.fromkeys(range(1000), 1) | {3: 2, 1003: 5}
    held = read_table(spark, path)
    plan = held.join(touched.filter("part >= 0"), ["part"], "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_columns_that_come_later_and_wider_types(spark):
    path = f"{work_dir(spark, 'merge')}/t"
    first = spark.createDataFrame([(1, 0, 5), (2, 1, 6)], "id LONG, part INT, v INT")
    later = spark.createDataFrame([(1, 0, 5_000_000_000, "x")], "id LONG, part INT, v LONG, w STRING")
    merge_into(spark, path, first, ["id"], ["v"], ["part"])
    merge_into(spark, path, later, ["id"], ["v"], ["part"])
    merge_into(spark, path, first.filter("id = 2"), ["id"], ["v"], ["part"])
    assert {tuple(r) for r in read_table(spark, path).select("id", "v", "w").collect()} == {(1, 5_000_000_000, "x"), (2, 6, None)}


def raw_file(spark, raw_dir, name, *changes):
    raw(spark, name, *changes).coalesce(1).write.mode("append").parquet(f"{raw_dir}/{SPECS[name].raw_file}")


def usage(spark, root):
    return {
        name: bag(snapshots.read_snapshot(spark, loading.gold_path(root, name)))
        for name in ("daily_summary", "monthly_summary", "yearly_summary")
    }


def test_refreshes_equal_a_run_over_everything(spark, monkeypatch):
    root, raw_dir = work_dir(spark, "inc"), work_dir(spark, "raw")
    for name in SPECS:
        raw_file(spark, raw_dir, name, {}, {"household_id": "H7"})
    assert set(medallion.refresh(spark, raw_dir, root).values()) == {2}
    assert set(medallion.refresh(spark, raw_dir, root).values()) == {0}
    # A correction of an old day, a copy that breaks a rule and hides a good one, a new month.
    raw_file(
        spark, raw_dir, "energy_usage", {"energy_usage_kwh": "77", "reading_timestamp": "2024-02-01 12:00:00"},
        {"household_id": "H7", "load_factor": "5", "reading_timestamp": "2024-02-02 00:00:00"},
        {"timestamp": "03-03-2024 01:00"}, {"timestamp": "?"},
    )
    # The refresh breaks off after the load; the next one takes the batch up.
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "merge_batch", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            medallion.refresh(spark, raw_dir, root)
    assert set(medallion.refresh(spark, raw_dir, root).values()) == {0}
    spec, whole = SPECS["energy_usage"], work_dir(spark, "whole")
    medallion.run(spark, raw_dir, whole)
    assert usage(spark, root) == usage(spark, whole)
    refreshed = incremental.silver(incremental.state(spark, spec, root), spec)
    assert bag(refreshed) == bag(snapshots.read_snapshot(spark, loading.silver_path(whole, spec)))
