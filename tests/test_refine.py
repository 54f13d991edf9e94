import pytest
from fixtures import raw
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltlake.functions.columns import hash_key
from voltlake.operators import refine as R
from voltlake.operators.dedup import latest_per_key
from voltlake.specs import SPECS

ENERGY, WEATHER, DEVICE, GRID, TARIFF = SPECS.values()


def kept(spark, spec, *changes, **options):
    rows = R.refine(raw(spark, spec.name, *changes), spec, **options).collect()
    return {r["household_id"]: r for r in rows}


def failed(spark, spec, *changes):
    rows = R.rejects(raw(spark, spec.name, *changes), spec).collect()
    return {r["household_id"]: r["failed_rules"] for r in rows}


@pytest.mark.parametrize("spec", SPECS.values(), ids=lambda s: s.name)
def test_clean_row_is_kept_with_key_status_and_text(spark, spec):
    row = kept(spark, spec, {})["H0"]
    assert row["record_status"] == "ACTIVE"
    assert row["silver_ingestion_time"] is not None
    assert isinstance(row[spec.surrogate], int)
    for c in spec.upper:
        assert row[c] == f"{c} x".upper()
    for c in spec.title:
        assert row[c] == f"{c.capitalize()} X"
    for m in spec.measures:
        assert isinstance(row[m], float)


BOUNDED = [
    (ENERGY, "frequency_hz", "45", "65", "44.9", "65.1"),
    (ENERGY, "load_factor", "0", "1", "-0.01", "1.01"),
    (DEVICE, "efficiency_ratio", "0", "1", "-0.01", "1.01"),
    (GRID, "line_loss_percent", "0", "100", "-0.1", "100.1"),
]


@pytest.mark.parametrize("spec,column,low,high,below,above", BOUNDED)
def test_bounds_are_inclusive(spark, spec, column, low, high, below, above):
    changes = [{column: v} for v in (low, high, below, above)]
    assert set(kept(spark, spec, *changes)) == {"H0", "H1"}
    assert failed(spark, spec, *changes) == {"H2": [column], "H3": [column]}


@pytest.mark.parametrize("spec", SPECS.values(), ids=lambda s: s.name)
def test_every_measure_against_its_rule_and_against_null(spark, spec):
    negative = kept(spark, spec, *[{m: "-1"} for m in spec.measures])
    empty = kept(spark, spec, *[{m: None} for m in spec.measures])
    for i, m in enumerate(spec.measures):
        assert (f"H{i}" in negative) == (m not in spec.ranges), m
        # A null becomes 0.0, which only the frequency range refuses.
        assert (f"H{i}" in empty) == (m != "frequency_hz"), m
        if m != "frequency_hz":
            assert empty[f"H{i}"][m] == 0.0


def test_unvalidated_measures_keep_any_value(spark):
    free = {"load_variation": "-5", "frequency_variation": "-5", "reserve_margin": "-5"}
    assert kept(spark, GRID, free)["H0"]["reserve_margin"] == -5.0
    assert kept(spark, WEATHER, {"pressure_hpa": "-1"})["H0"]["pressure_hpa"] == -1.0
    assert kept(spark, DEVICE, {"device_temperature": "-3"}) == {}


def test_unreadable_and_nan_measures_become_zero(spark):
    rows = kept(spark, ENERGY, {"voltage_reading": "abc"}, {"voltage_reading": "NaN"})
    assert [rows[h]["voltage_reading"] for h in ("H0", "H1")] == [0.0, 0.0]
    assert kept(spark, WEATHER, {"dew_point": "NaN"})["H0"]["dew_point"] == 0.0


def test_two_broken_rules_are_both_named(spark):
    broken = {"voltage_reading": "-1", "load_factor": "2"}
    assert failed(spark, ENERGY, broken) == {"H0": ["voltage_reading", "load_factor"]}
    counts = R.reject_counts(raw(spark, "energy_usage", broken, {"load_factor": "3"}), ENERGY)
    assert dict(counts.collect()) == {"voltage_reading": 1, "load_factor": 2}
    assert R.rejects(raw(spark, "weather_stream", {}), WEATHER).count() == 0


def test_unreadable_timestamp_is_a_null_key_part(spark):
    rows = kept(spark, ENERGY, {"timestamp": "2024-12-31"}, {})
    assert rows["H0"]["timestamp"] is None
    assert rows["H1"]["timestamp"].isoformat() == "2024-02-01T10:30:00"


def test_later_duplicate_wins(spark):
    same = {"household_id": "H9"}
    old = same | {"reading_timestamp": "2024-02-01 08:00:00", "voltage_reading": "1"}
    new = same | {"reading_timestamp": "2024-02-01 09:00:00", "voltage_reading": "2"}
    none = same | {"reading_timestamp": None, "voltage_reading": "3"}
    for order in ([old, new, none], [none, new, old], [new, none, old]):
        assert kept(spark, ENERGY, *order)["H9"]["voltage_reading"] == 2.0


def test_key_text_is_standardised_before_deduplication(spark):
    a, b = ({"household_id": "H9", "device_model": m} for m in (" ac-1", "AC-1 "))
    df = raw(spark, "device_metrics", a, b)
    assert R.refine(df, DEVICE).count() == 1
    as_arrived = R.refine(df, DEVICE, raw_key_text=True)
    assert as_arrived.count() == 2
    assert as_arrived.select("device_key").distinct().count() == 1


def test_trim_removes_spaces_and_keeps_tabs(spark):
    row = kept(spark, ENERGY, {"city_name": "  new york ", "region_name": "\tx "})["H0"]
    assert (row["city_name"], row["region_name"]) == ("New York", "\tX")


def test_null_key_parts_get_their_own_surrogate_keys(spark):
    df = spark.createDataFrame(
        [("a", None), (None, "a"), ("a", "a"), (None, None), ("a", "")], "x STRING, y STRING"
    )
    keyed = df.select("x", "y", hash_key("x", "y").alias("k"), F.xxhash64("x", "y").alias("plain"))
    rows = keyed.collect()
    assert len({r["k"] for r in rows}) == 5
    assert all(r["k"] == r["plain"] for r in rows if r["x"] is not None and r["y"] is not None)


def test_null_keys_compare_equal_in_deduplication(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k STRING, v INT")
    assert sorted(latest_per_key(df, ["k"]).collect(), key=str) == [("a", 1), (None, 2)]


def test_sequence_key_and_null_flags(spark):
    df = raw(spark, "weather_stream", {}, {"dew_point": None}, {"dew_point": "NaN"})
    keys = R.refine(df, WEATHER, sequence_key=True).select("weather_key").collect()
    assert len({r[0] for r in keys}) == 3
    flagged = R.fill_measures(df, WEATHER, keep_flags=True)
    flags = {r["household_id"]: r["dew_point_was_null"] for r in flagged.collect()}
    assert flags == {"H0": False, "H1": True, "H2": True}


def test_refining_twice_changes_nothing(spark):
    once = R.refine(raw(spark, "tariff_metrics", {}, {"late_fee": "-1"}, {"unit_rate": None}), TARIFF)
    again = R.refine(once.drop("silver_ingestion_time"), TARIFF)
    columns = [c for c in once.columns if c != "silver_ingestion_time"]
    assert sorted(again.select(columns).collect()) == sorted(once.select(columns).collect())


def test_deduplication_cuts_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).select(F.expr("if(id % 3 = 0, -1, id)").alias("k"), "id")
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


VALUE = st.one_of(st.none(), st.sampled_from(["-1", "0", "0.5", "1", "2", "50", "abc", "NaN"]))
ROW = st.fixed_dictionaries(
    {
        "household_id": st.sampled_from(["H1", "H2", None]),
        "timestamp": st.sampled_from(["01-02-2024 10:30", "01-02-2024 10:31", "bad"]),
        "reading_timestamp": st.sampled_from(["2024-02-01 08:00:00", "2024-02-01 09:00:00", None]),
        "voltage_reading": VALUE,
        "load_factor": VALUE,
        "frequency_hz": VALUE,
    }
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=12))
def test_kept_and_rejected_rows_are_the_distinct_keys(spark, rows):
    df = raw(spark, "energy_usage", *rows)
    good = [(r["household_id"], r["timestamp"]) for r in R.refine(df, ENERGY).collect()]
    bad = [(r["household_id"], r["timestamp"]) for r in R.rejects(df, ENERGY).collect()]
    keys = {(r["household_id"], None if r["timestamp"] == "bad" else r["timestamp"]) for r in rows}
    assert len(set(good + bad)) == len(good + bad) == len(keys)
