import pytest
from fixtures import raw
from pyspark.sql import types as T

from voltlake.operators import quality
from voltlake.operators import refine as R
from voltlake.plans import gold
from voltlake.session import work_dir
from voltlake.sources import catalog, loading, readers, snapshots
from voltlake.specs import SPECS


def rules_at(root, rules):
    return quality.WriteTests("t", rules, f"{root}/results", f"{root}/failures")


def results(spark, root):
    return {r.check: (r.severity, r.n_checked, r.n_failed) for r in spark.read.parquet(f"{root}/results").collect()}


def test_warnings_are_noted_and_errors_leave_no_version(spark):
    root = work_dir(spark, "q")
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, "z")], "id INT, v STRING")
    warn = [*quality.must_have("id", severity=quality.WARN), quality.must_be_one_of("v", ["a"], quality.WARN)]
    tests = rules_at(root, warn)
    snapshots.publish(spark, rows, f"{root}/t", counts=tests.counts, judge=tests.judge)
    assert results(spark, root) == {"not_null(id)": ("warn", 3, 1), "accepted_values(v)": ("warn", 3, 1)}
    kept = {r.check: r.record for r in spark.read.parquet(f"{root}/failures").collect()}
    assert kept == {"not_null(id)": '{"v":"z"}', "accepted_values(v)": '{"v":"z"}'}
    broken = rules_at(f"{root}/2", quality.must_have("v"))
    with pytest.raises(quality.QualityError, match=r"t: not_null\(v\): 1 rows"):
        snapshots.publish(spark, rows, f"{root}/t", counts=broken.counts, judge=broken.judge)
    assert snapshots.versions(spark, f"{root}/t") == [0]
    assert spark.read.parquet(f"{root}/2/failures").count() == 1


def test_an_empty_table_and_no_failures(spark):
    root = work_dir(spark, "q")
    tests = rules_at(root, quality.must_have("id"))
    empty = spark.createDataFrame([], "id INT")
    snapshots.publish(spark, empty, f"{root}/t", counts=tests.counts, judge=tests.judge)
    assert results(spark, root) == {"not_null(id)": ("error", 0, 0)}
    assert not readers.path_exists(spark, f"{root}/failures")


def test_unreadable_times_are_all_kept(spark):
    spec = SPECS["energy_usage"]
    rows = raw(spark, spec.name, {}, {"timestamp": "soon"}, {"timestamp": "soon", "household_id": "H1"}, {"timestamp": None})
    found = R.unreadable(rows, spec).collect()
    assert [(r.household_id, r.timestamp, r.failed_rules) for r in found] == [("H1", "soon", ["timestamp"])] * 2
    assert R.unreadable(raw(spark, "grid_load", {}), SPECS["grid_load"]).count() == 0


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    root = work_dir(spark, "b")
    layer = loading.create_layers(spark, root, f"t_{root[-8:]}_")[1]
    tables = {}
    for name in ("energy_usage", "weather_stream"):
        rows = R.refine(raw(spark, name, *[{"household_id": f"H{k}"} for k in range(20)]), SPECS[name])
        for _ in range(2):  # a second run replaces the first
            tables[name] = catalog.publish_bucketed(rows, f"{layer}.{name}", f"{root}/{name}", SPECS[name].key, 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = gold.with_weather(gold.energy_readings(tables["energy_usage"]), tables["weather_stream"])
        assert joined.filter("weather_key IS NOT NULL").count() == 20
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [catalog.buckets_for(n) for n in (0, 3 << 30, 5 << 30)] == [8, 16, 32]




@pytest.mark.parametrize(
    ("old", "new", "both"),
    [
        ("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("tinyint", "int", "int"),
        ("int", "double", "double"), ("bigint", "double", "double"), ("float", "double", "double"),
        ("int", "decimal(12,2)", "decimal(12,2)"), ("bigint", "decimal(22,2)", "decimal(22,2)"),
        ("decimal(5,2)", "decimal(4,3)", "decimal(6,3)"), ("date", "timestamp", "timestamp"),
        ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>"),
        ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("string", "int", None), ("timestamp", "bigint", None), ("decimal(38,0)", "decimal(38,10)", None),
        ("struct<a:int>", "struct<a:string>", None), ("boolean", "int", None), ("map<int,int>", "map<bigint,int>", None),
    ],
)
def test_wider_types(old, new, both):
    kinds = [T._parse_datatype_string(k) for k in (old, new)]
    found = readers.wider_type(*kinds)
    assert (found and found.simpleString()) == both


def test_loads_of_different_types_are_read_as_one(spark):
    path = f"{work_dir(spark, 'types')}/t"
    loads = [
        ("1", "DATE '2024-01-02'", "5L"), ("5000000000L", "TIMESTAMP '2024-01-02 03:00:00'", "1.5D"), ("7", "DATE '2024-01-03'", "2"),
    ]
    for k, (n, day, x) in enumerate(loads):
        snapshots.publish(spark, spark.sql(f"SELECT {k} AS k, {n} AS n, {day} AS day, {x} AS x"), path, partition_by=("k",))
    found = snapshots.read_snapshot(spark, path)
    assert [t for _, t in found.select("n", "day", "x").dtypes] == ["bigint", "timestamp", "double"]
    assert [(r.n, str(r.day), r.x) for r in found.orderBy("k").collect()] == [
        (1, "2024-01-02 00:00:00", 5.0), (5000000000, "2024-01-02 03:00:00", 1.5), (7, "2024-01-03 00:00:00", 2.0),
    ]
    with pytest.raises(ValueError, match="n: bigint and string"):
        snapshots.publish(spark, spark.sql("SELECT 9 AS k, 'x' AS n, DATE '2024-01-02' AS day, 1 AS x"), path)
    snapshots.publish(spark, spark.sql("SELECT 9 AS k, named_struct('d', DATE '2024-01-02') AS s"), path)
    with pytest.raises(ValueError, match="s: "):
        snapshots.publish(spark, spark.sql("SELECT 9 AS k, named_struct('d', current_timestamp()) AS s"), path)
