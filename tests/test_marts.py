import os

import pytest
from pyspark.sql import functions as F

from voltlake.operators.numbering import number_new, numbers
from voltlake.plans import gold, marts
from voltlake.session import work_dir

SCHEMA = (
    "household_id STRING, region_name STRING, energy_usage_kwh DOUBLE, peak_demand_kw DOUBLE, "
    "month_key INT, date_key INT"
)


def readings(spark, rows):
    data = [
        (h, r, float(v), float(v) * 2, d and d // 100, d) for h, r, v, d in rows
    ]
    return spark.createDataFrame(data, SCHEMA)


ROWS = [(f"H{k % 40}", "NSEW"[k % 4], k % 9, 20240128 + k % 3) for k in range(300)]
ROWS += [(f"H{k % 70}", "N", k, 20240201 + k % 5) for k in range(200)] + [(f"H{k}", "S", 1, 20250101) for k in range(9)]
ROWS += [(None, "N", 4, 20240201), ("H1", None, 5, 20240201), ("H2", "N", 6, None), (None, None, 7, None)]


def bag(df):
    return sorted(map(tuple, df.collect()), key=str)


def same_summaries(spark, root, rows):
    states = marts.read_states(spark, root)
    for ours, plain in (
        (marts.daily_summary, gold.daily_summary), (marts.monthly_summary, gold.monthly_summary),
        (marts.yearly_summary, gold.yearly_summary),
    ):
        expected = plain(rows)
        assert bag(ours(states).select(expected.columns)) == bag(expected)


def published(spark, rows):
    path = f"{work_dir(spark, 'readings')}/fact"
    rows.write.partitionBy("month_key").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def files_of(root):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(f"{root}/{marts.USAGE_STATES}") for f in names if f.endswith(".parquet")
    }


def test_months_and_years_add_up_from_days(spark):
    root = work_dir(spark, "marts")
    rows = published(spark, readings(spark, ROWS))
    marts.refresh_states(rows, marts.touched_days(rows), root)
    same_summaries(spark, root, rows)
    assert marts.read_states(spark, work_dir(spark, "none")).count() == 0


def test_a_refresh_replaces_only_touched_days(spark):
    root = work_dir(spark, "marts")
    before = readings(spark, ROWS)
    marts.refresh_states(published(spark, before), None, root)
    files = files_of(root)
    batch = readings(spark, [("H999", "N", 50, 20240203), ("H1", "W", 1, 20260101), (None, "W", 1, None)])
    after = published(spark, before.union(batch))
    marts.refresh_states(after, marts.touched_days(batch), root)
    same_summaries(spark, root, after)
    kept = {f: t for f, t in files_of(root).items() if files.get(f) == t}
    days = {f.split("date_key=")[1].split("/")[0] for f in set(files) - set(kept)}
    assert days == {"20240203", "0"} and len(kept) > 5


def test_only_touched_months_are_read(spark):
    rows = published(spark, readings(spark, ROWS))
    days = marts.touched_days(rows.filter("date_key = 20240203")).filter("date_key >= 0")
    keyed = rows.withColumn("_month_key", F.coalesce("month_key", F.lit(0)))
    plan = keyed.join(days.select(F.col("month_key").alias("_month_key")), "_month_key", "left_semi")
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()


def test_a_day_without_readings_is_emptied(spark):
    root = work_dir(spark, "marts")
    rows = readings(spark, ROWS)
    marts.refresh_states(rows, marts.touched_days(rows), root)
    left = rows.filter("date_key IS NULL OR date_key <> 20250101")
    marts.refresh_states(left, marts.touched_days(rows.filter("date_key = 20250101")), root)
    same_summaries(spark, root, left)


@pytest.mark.parametrize("seed", range(3))
def test_numbers_are_dense_and_stay(spark, seed):
    path = f"{work_dir(spark, 'numbers')}/n"
    first = spark.createDataFrame([(f"K{(k * 7 + seed) % 90}",) for k in range(200)] + [(None,)], "key STRING").repartition(5)
    one = {r.key: r.number for r in number_new(spark, path, first, "key").collect()}
    assert sorted(one.values()) == list(range(1, 91))
    more = spark.createDataFrame([(f"K{k}",) for k in range(60, 130)], "key STRING")
    two = {r.key: r.number for r in number_new(spark, path, more, "key").collect()}
    assert sorted(two.values()) == list(range(1, 131)) and one.items() <= two.items()
    assert number_new(spark, path, more, "key").count() == 130
    assert numbers(spark, f"{path}-none", "key").count() == 0


def test_many_buckets(spark, monkeypatch):
    """Households beyond the first 32,768 fall into further ranges."""
    root = work_dir(spark, "marts")
    rows = spark.range(70_000).select(
        F.concat(F.lit("H"), F.col("id") % 69_000).alias("household_id"), F.lit("N").alias("region_name"),
        F.lit(1.0).alias("energy_usage_kwh"), F.lit(2.0).alias("peak_demand_kw"),
        F.lit(202401).alias("month_key"), (F.lit(20240101) + F.col("id").cast("int") % 2).alias("date_key"),
    )
    marts.refresh_states(rows, marts.touched_days(rows), root)
    assert marts.read_states(spark, root).select("bucket").distinct().count() == 3
    same_summaries(spark, root, rows)
