import datetime as dt

import pytest
from fixtures import raw

from voltlake.operators.refine import refine
from voltlake.plans import analytics, gold
from voltlake.specs import SPECS


def silver(spark, name, *changes):
    return refine(raw(spark, name, *changes), SPECS[name])


@pytest.fixture(scope="module")
def fact(spark):
    """Three readings on two days, one without weather, one household without devices."""
    energy = silver(
        spark, "energy_usage",
        {"household_id": "H1", "energy_usage_kwh": "4"},
        {"household_id": "H1", "energy_usage_kwh": "8", "timestamp": "02-02-2024 10:30"},
        {"household_id": "H2", "energy_usage_kwh": "6"},
        {"household_id": None, "energy_usage_kwh": "1", "timestamp": "bad"},
    )
    weather = silver(spark, "weather_stream", {"household_id": "H1"}, {"household_id": "H2"})
    device = silver(
        spark, "device_metrics",
        {"household_id": "H1", "device_model": "a"}, {"household_id": "H1", "device_model": "b"},
    )
    grid = silver(spark, "grid_load", {"household_id": "H1"})
    tariff = silver(spark, "tariff_metrics", {"household_id": "H2"}, {"household_id": None})
    return gold.fact_energy(energy, weather, device, grid, tariff)


def test_fact_keeps_its_grain_and_unmatched_readings(fact):
    rows = {(r["household_id"], r["date_key"]): r for r in fact.collect()}
    assert set(rows) == {("H1", 20240201), ("H1", 20240202), ("H2", 20240201), (None, None)}
    first = rows["H1", 20240201]
    assert (first["n_devices"], first["n_feeders"], first["n_billing_cycles"]) == (2, 1, 0)
    assert first["devices_power_kw"] == 20.0 and first["billed_amount"] is None
    assert rows["H1", 20240202]["weather_key"] is None
    assert first["weather_key"] is not None
    unknown = rows[None, None]
    assert unknown["n_devices"] is None and unknown["month_key"] is None


def test_summaries(fact):
    daily = {r["date_key"]: r for r in gold.daily_summary(fact).collect()}
    assert (daily[20240201]["total_kwh"], daily[20240201]["n_households"]) == (10.0, 2)
    assert daily[None]["n_readings"] == 1
    yearly = {r["year"]: r["n_readings"] for r in gold.yearly_summary(fact).collect()}
    assert yearly == {2024: 3, None: 1}
    total = gold.executive_dashboard(fact).filter("level = 3").first()
    assert (total["n_readings"], total["total_kwh"], total["n_households"]) == (4, 19.0, 2)


def test_dim_date_has_no_gaps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 27, 5),), (dt.datetime(2024, 3, 2),), (None,)], "timestamp TIMESTAMP")
    days = gold.dim_date(df).orderBy("date_key").collect()
    assert [d["date_key"] for d in days] == [20240227, 20240228, 20240229, 20240301, 20240302]
    assert [d["is_weekend"] for d in days] == [False, False, False, False, True]
    assert gold.dim_date(df.filter("timestamp IS NULL")).count() == 0


def test_household_takes_the_newest_attributes(spark):
    energy = silver(
        spark, "energy_usage",
        {"household_id": "H1", "meter_type": "old"},
        {"household_id": "H1", "meter_type": "new", "timestamp": "05-02-2024 00:00"},
        {"household_id": "H1", "meter_type": "undated", "timestamp": "bad"},
    )
    (row,) = gold.dim_household(energy).collect()
    assert row["meter_type"] == "NEW"


def test_features_and_billing(spark, fact):
    rows = analytics.forecast_features(fact).orderBy("household_id", "date").collect()
    assert [(r["household_id"], r["kwh"], r["kwh_lag_1"], r["kwh_mean_7"]) for r in rows] == [
        ("H1", 4.0, None, 4.0), ("H1", 8.0, 4.0, 6.0), ("H2", 6.0, None, 6.0),
    ]
    tariff = silver(
        spark, "tariff_metrics",
        {"household_id": "H1", "monthly_bill": "30", "subsidy_amount": "0", "tax_amount": "0", "late_fee": "0"},
        {"household_id": "H9", "monthly_bill": "10", "subsidy_amount": "0", "tax_amount": "0", "late_fee": "0"},
    )
    households = spark.createDataFrame([("H1", "HOME")], "household_id STRING, customer_category STRING")
    bills = analytics.billing_analytics(tariff, households).collect()
    assert {(r["customer_category"], r["revenue"], r["revenue_share"]) for r in bills} == {
        ("HOME", 30.0, 0.75), (None, 10.0, 0.25),
    }
