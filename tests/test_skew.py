from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from voltlake.operators.skew import with_cells, find_hot, hot_keys, spread_join, with_neighbours


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows under one key, another third without a key."""
    left = spark.range(3000).select(
        F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN concat('k', id % 500) END").alias("k"),
        F.col("id").alias("n"),
    )
    right = spark.range(400).select(
        F.expr("if(id = 0, 'hot', concat('k', id))").alias("k"), (F.col("id") * 10).alias("v")
    ).unionByName(spark.createDataFrame([("hot", -1), (None, -2)], "k STRING, v LONG"))
    return left, right


@contextmanager
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_the_plain_join(spark, sides, how):
    left, right = sides
    want = left.join(right, ["k"], how)
    rows = sorted(want.collect(), key=str)
    assert sorted(spread_join(left, right, ["k"], ["n"], how).collect(), key=str) == rows
    with no_broadcast(spark):
        got = spread_join(left, right, ["k"], ["n"], how, counted=left, share=0.1, rows=10)
        assert got.columns == want.columns
        assert sorted(got.collect(), key=str) == rows
        # The hot list only steers the work: a poor one leaves the rows as they are.
        other = spread_join(left, right, ["k"], ["n"], how, counted=right, share=0.001, rows=0)
        assert sorted(other.collect(), key=str) == rows


def test_other_joins_are_refused(sides):
    with pytest.raises(ValueError, match="full"):
        spread_join(*sides, ["k"], ["n"], "full")


def test_hot_list_is_bounded_by_the_share(sides):
    left, _ = sides
    assert {tuple(r) for r in hot_keys(left, ["k"], 0.1, 10).collect()} == {("hot", 4), (None, 4)}
    slices = hot_keys(left, ["k"], 0.0005, 0).agg(F.sum("_slices")).first()[0]
    assert slices <= 2 / 0.0005
    assert hot_keys(left, ["k"], 0.0005, 0).count() < 1 / 0.0005
    assert hot_keys(left, ["k"], 0.1, 5000).count() == 0


def test_null_keys_are_divided_too(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with no_broadcast(spark):
            joined = spread_join(left, right, ["k"], ["n"], "left", counted=left, share=0.02, rows=10)
            per_task = joined.filter("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) >= 4


def test_spread_join_divides_a_hot_key(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with no_broadcast(spark):
            joined = spread_join(
                left.filter("k = 'hot'"), right, ["k"], ["n"], "inner",
                counted=left.filter("k = 'hot'"), share=0.125, rows=10,
            )
            per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) >= 4


@pytest.mark.parametrize("share", [0.1, 0.0, 1.0])
def test_neighbours_equal_a_window_over_the_whole_key(spark, share):
    df = spark.range(400).select(
        F.expr("if(id % 3 = 0, 'hot', concat('k', id % 7))").alias("k"),
        F.expr("timestamp_seconds(1700000000 + id * 1700)").alias("ts"),
        (F.col("id") % 4).alias("s"),
    )
    want = df.selectExpr(
        "*", "lag(struct(s)) OVER (PARTITION BY k ORDER BY ts) AS _before",
        "lead(struct(s)) OVER (PARTITION BY k ORDER BY ts) AS _after",
    )
    hot = find_hot(df, ["k"], share, 1)
    assert (hot is None) == (share == 1.0)
    got = with_neighbours(df, ["k"], "ts", F.struct("s"), hot)
    assert sorted(got.select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("minutes", [1, 15, 30, 60, 1440])
def test_a_hot_key_is_cut_by_rows_whatever_its_cadence(spark, minutes):
    df = spark.range(20_000).select(
        F.lit("hot").alias("k"), F.expr(f"timestamp_seconds(1700000000 + id * {60 * minutes})").alias("ts")
    )
    hot = hot_keys(df, ["k"], 0.1, 10)
    sizes = [r["count"] for r in with_cells(df, ["k"], "ts", hot).groupBy("_cell").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 2 * 20_000 / 10
