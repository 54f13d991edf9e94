import bisect
import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalogue import queries
from voltlake.functions.columns import with_range_buckets
from voltlake.session import work_dir
from voltlake.sources import snapshots as S


@pytest.fixture
def path(spark):
    return f"{work_dir(spark, 'table')}/t"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def numbers(spark, start, end):
    return spark.range(start, end).withColumn("v", F.col("id") * 2)


def test_append_overwrite_and_time_travel(spark, path):
    assert S.publish(spark, numbers(spark, 0, 5), path) == (0, 5)
    assert S.publish(spark, numbers(spark, 5, 8), path) == (1, 3)
    assert S.publish(spark, numbers(spark, 20, 22), path, "overwrite") == (2, 2)
    assert [S.read_snapshot(spark, path, v).count() for v in (0, 1, 2)] == [5, 8, 2]
    assert S.read_snapshot(spark, path).count() == 2
    log = S.history(spark, path).orderBy("version").collect()
    assert [(r["operation"], r["n_rows"]) for r in log] == [
        ("WRITE APPEND", 5), ("WRITE APPEND", 8), ("WRITE OVERWRITE", 2),
    ]
    assert log[1]["n_files"] == sum(f["n_files"] for f in log[1]["folders"])


def test_overwrite_may_read_its_own_table(spark, path):
    S.publish(spark, numbers(spark, 0, 5), path)
    S.publish(spark, S.read_snapshot(spark, path).filter("id > 2"), path, "overwrite")
    assert rows(S.read_snapshot(spark, path)) == [(3, 6), (4, 8)]


def test_schema_evolution_adds_and_keeps_columns(spark, path):
    S.publish(spark, spark.createDataFrame([(1, "a")], "id INT, late_fee STRING"), path)
    S.publish(spark, spark.createDataFrame([(2, "n")], "id INT, tariff_note STRING"), path)
    df = S.read_snapshot(spark, path)
    assert df.columns == ["id", "late_fee", "tariff_note"]
    assert sorted(df.collect()) == [(1, "a", None), (2, None, "n")]
    assert S.read_snapshot(spark, path, 0).columns == ["id", "late_fee"]


def test_changed_type_is_refused_before_anything_is_written(spark, path):
    S.publish(spark, spark.createDataFrame([(1,)], "id INT"), path)
    with pytest.raises(ValueError, match="id"):
        S.publish(spark, spark.createDataFrame([("x",)], "id STRING"), path)
    assert S.versions(spark, path) == [0]


def test_missing_version_names_the_retained_ones(spark, path):
    S.publish(spark, numbers(spark, 0, 5), path)
    with pytest.raises(S.VersionNotFound, match=r"\[0\]"):
        S.read_snapshot(spark, path, 7)


def test_failed_write_stays_invisible(spark, path):
    S.publish(spark, numbers(spark, 0, 5), path)
    broken = spark.range(3).withColumn("v", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        S.publish(spark, broken, path)
    assert S.versions(spark, path) == [0]
    assert S.read_snapshot(spark, path).count() == 5


def test_unfinished_commit_is_skipped_and_its_number_not_reused(spark, path):
    S.publish(spark, numbers(spark, 0, 5), path)
    folder, fs = S._path(spark, S._commit_folder(path, 1) + "/_temporary")
    fs.mkdirs(folder)
    assert S.read_snapshot(spark, path).count() == 5
    assert S.publish(spark, numbers(spark, 5, 6), path)[0] == 2
    assert S.read_snapshot(spark, path).count() == 6


def test_compaction_merges_small_files_and_leaves_full_folders(spark, path):
    S.publish(spark, numbers(spark, 0, 1000).repartition(7), path)
    S.publish(spark, numbers(spark, 1000, 1100).repartition(3), path)
    before = rows(S.read_snapshot(spark, path))
    version = S.compact(spark, path)
    log = {r["version"]: r for r in S.history(spark, path).collect()}
    assert (log[1]["n_files"], log[version]["n_files"]) == (10, 1)
    assert rows(S.read_snapshot(spark, path)) == before
    assert S.compact(spark, path) == version
    # A folder whose files already have the target size is not rewritten.
    target = log[version]["n_bytes"]
    S.publish(spark, numbers(spark, 2000, 2010).repartition(2), path)
    again = S.compact(spark, path, target_bytes=target)
    kept = {f["dir"] for f in log[version]["folders"]}
    latest = S.history(spark, path).filter(F.col("version") == again).first()
    assert kept < {f["dir"] for f in latest["folders"]}
    assert S.read_snapshot(spark, path).count() == 1110


def files_touched(spark, path, condition):
    return (
        S.read_snapshot(spark, path)
        .select("a", "b", F.col("_metadata.file_path").alias("file"))
        .groupBy("file")
        .agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1"))
        .filter(condition)
        .count()
    )


def test_clustering_narrows_the_files_a_range_touches(spark, path):
    df = spark.range(20_000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("string").alias("b"),
    )
    S.publish(spark, df.repartition(16), path)
    before = rows(S.read_snapshot(spark, path))
    size = S.history(spark, path).first()["n_bytes"]
    hits = "a0 <= 105 AND a1 >= 100"
    assert files_touched(spark, path, hits) == 16
    S.cluster(spark, path, ["a", "b"], target_bytes=size // 16)
    assert rows(S.read_snapshot(spark, path)) == before
    assert files_touched(spark, path, hits) <= 8
    assert files_touched(spark, path, "b0 <= '300' AND b1 >= '300'") <= 8


def test_clustering_splits_one_hot_value(spark, path):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"),
        F.lit(1).alias("b"), "id",
    )
    S.publish(spark, df, path)
    size = S.history(spark, path).first()["n_bytes"]
    S.cluster(spark, path, ["a", "b"], target_bytes=size // 12)
    per_file = S.read_snapshot(spark, path).groupBy(F.col("_metadata.file_path")).count()
    assert per_file.agg(F.max("count")).first()[0] < 30_000 / 3 / 2


def test_clustering_an_empty_and_an_all_null_column(spark, path):
    S.publish(spark, spark.range(0).withColumn("v", F.lit(None).cast("string")), path)
    S.cluster(spark, path, ["id", "v"])
    S.publish(spark, spark.range(5).withColumn("v", F.lit(None).cast("string")), path)
    S.cluster(spark, path, ["id", "v"])
    assert S.read_snapshot(spark, path).count() == 5


def test_expiry_drops_replaced_versions_and_only_unlisted_folders(spark, path):
    S.publish(spark, numbers(spark, 0, 5), path)
    S.publish(spark, numbers(spark, 5, 8), path)
    S.publish(spark, numbers(spark, 8, 9), path, "overwrite")
    assert S.expire(spark, path) == []
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=169)
    assert S.expire(spark, path, now=later) == [0, 1]
    assert S.versions(spark, path) == [2]
    assert rows(S.read_snapshot(spark, path)) == [(8, 16)]
    with pytest.raises(S.VersionNotFound):
        S.read_snapshot(spark, path, 0)
    data, fs = S._path(spark, f"{path}/data")
    assert len(fs.listStatus(data)) == 1


def test_partitioned_table_prunes(spark, path):
    df = spark.range(1000).withColumn("month_key", (F.col("id") % 4).cast("int"))
    S.publish(spark, df, path, partition_by=("month_key",))
    one = S.read_snapshot(spark, path).filter("month_key = 2")
    assert one.count() == 250
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan


def test_a_partitioned_table_survives_appends_compaction_and_clustering(spark, path):
    def month(k):
        return spark.range(k * 100, k * 100 + 100).selectExpr("id", f"id % 7 AS v", f"{202401 + k} AS month_key")

    def pruned():
        plan = S.read_snapshot(spark, path).filter("month_key = 202402")._jdf.queryExecution().executedPlan().toString()
        return "month_key" in plan.split("PartitionFilters: [")[1].split("]")[0]

    for k in range(3):
        S.publish(spark, month(k).repartition(4), path, partition_by=["month_key"])
    S.publish(spark, month(1).repartition(4), path, partition_by=["month_key"])
    want = rows(S.read_snapshot(spark, path))
    assert len(want) == 400 and pruned()
    S.compact(spark, path)
    assert rows(S.read_snapshot(spark, path)) == want and pruned()
    S.cluster(spark, path, ["v"])
    assert rows(S.read_snapshot(spark, path)) == want and pruned()


def test_buckets_of_many_bounds_are_exact_and_leave_the_plan_small(spark):
    bounds = sorted([k * 0.5 for k in range(1, 4000)] + [7.0] * 90 + [float("inf")])
    values = [None, -1.0, 0.5, 6.9, 7.0, 7.1, 1999.5, 1e9, float("inf"), float("nan")]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id INT, v DOUBLE")
    found = with_range_buckets(
        df, {"x": F.col("v"), "y": F.col("id").cast("long"), "z": F.col("v")}, {"x": bounds, "y": [2, 2, 5], "z": []}
    )
    got = {r["id"]: (r["x"], r["y"], r["z"]) for r in found.collect()}
    below = [0 if v is None else len(bounds) if v != v else bisect.bisect_right(bounds, v) for v in values]
    assert got == {k: (below[k], bisect.bisect_right([2, 2, 5], k), 0) for k in range(len(values))}
    assert found._jdf.queryExecution().analyzed().toString().count("CASE WHEN") <= 2 * len(bounds).bit_length()


def test_the_pieces_of_lineitem_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    lines = spark.range(4000).select(
        F.lit(1).cast("long").alias("l_orderkey"), F.col("id").cast("int").alias("l_linenumber"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    few = S.history(spark, queries._lines_in_pieces(spark, str(tmp_path), "few")).agg(F.max("n_files")).first()[0]
    monkeypatch.setattr(queries, "PIECE_BYTES", 1 << 10)
    path = queries._lines_in_pieces(spark, str(tmp_path), "many")
    # Even of one order; a task that compacts has a target's bytes.
    pieces = S.read_snapshot(spark, path).groupBy(F.col("_metadata.file_path")).count()
    assert few <= 24 < pieces.count() and pieces.agg(F.max("count")).first()[0] < 4000 / 24
    size = S.table_bytes(spark, path)
    S.compact(spark, path, target_bytes=size // 4)
    merged = S.read_snapshot(spark, path).groupBy(F.col("_metadata.file_path")).count()
    assert rows(S.read_snapshot(spark, path)) == rows(lines)
    assert merged.agg(F.max("count")).first()[0] < 4000 / 4 * 1.3
