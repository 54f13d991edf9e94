import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from voltlake.operators.asof import as_of

START = dt.datetime(2024, 1, 1)
LEFT = "k STRING, ts TIMESTAMP, n INT, value STRING"
RIGHT = "k STRING, since TIMESTAMP, plan STRING, rate DOUBLE"


def at(hours):
    return None if hours is None else START + dt.timedelta(hours=hours)


def plain(left, right):
    found = []
    for k, h, n, v in left:
        known = [(s, (p is not None, p or "", r), p, r) for kk, s, p, r in right if k is not None and kk == k and None not in (h, s) and s <= h]
        best = max(known, key=lambda x: x[:2], default=(None, None, None, None))
        found.append((k, at(h), n, v, best[2], best[3]))
    return sorted(found, key=str)


def tables(spark, left, right):
    return (
        spark.createDataFrame([(k, at(h), n, v) for k, h, n, v in left], LEFT).repartition(4),
        spark.createDataFrame([(k, at(s), p, r) for k, s, p, r in right], RIGHT).repartition(3),
    )


@pytest.mark.parametrize("hot_rows", [None, 40])
def test_the_newest_row_not_later(spark, hot_rows):
    rng = random.Random(8)
    left = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([None, *range(200)]), n, f"v{n}") for n in range(600)]
    right = [("hot", h, f"p{h}", float(h)) for h in (3, 50, 51, 180)] + [("a", 20, None, None), ("a", 100, "q", 1.0)]
    right += [("c", 1, "unused", 0.0), (None, 1, "no key", 0.0), ("a", None, "no time", 0.0), ("hot", 51, "a tie", 9.0)]
    counted, late = tables(spark, left, right)
    found = as_of(counted, late, ["k"], "ts", "since", ["plan", "rate"], counted=counted if hot_rows else None, hot_rows=hot_rows or 1)
    assert sorted(map(tuple, found.collect()), key=str) == plain(left, right)


def test_empty_sides_and_equal_times(spark):
    left, right = tables(spark, [("a", 5, 1, "x"), ("a", 4, 2, "y")], [("a", 5, "p", 1.0)])
    found = as_of(left, right, ["k"], "ts", "since", ["plan"])
    assert sorted((r.n, r.plan) for r in found.collect()) == [(1, "p"), (2, None)]
    assert as_of(left, right.limit(0), ["k"], "ts", "since", ["plan"]).filter("plan IS NULL").count() == 2
    assert as_of(left.limit(0), right, ["k"], "ts", "since", ["plan"]).count() == 0


def test_there_is_no_range_join(spark):
    left, right = tables(spark, [("a", 5, 1, "x")], [("a", 5, "p", 1.0)])
    plan = as_of(left, right, ["k"], "ts", "since", ["plan"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Window ") == 1


def test_clashing_names(spark):
    left, right = tables(spark, [("a", 5, 1, "x")], [("a", 5, "p", 1.0)])
    right = right.withColumn("n", F.lit(7)).withColumn("value", F.lit("other"))
    (row,) = as_of(left, right, ["k"], "ts", "since", ["plan"]).collect()
    assert (row.n, row.value, row.plan) == (1, "x", "p")
