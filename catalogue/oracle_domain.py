"""Silver and Gold over the raw readings, in DuckDB's SQL."""

from __future__ import annotations

from catalogue.oracle_raw import RAW


def _upper(c: str) -> str:
    return f"upper(trim({c}))"


def _title(c: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({c})), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


# Per table the key, the measures, the text columns in table order with
# their rule, the pass-through columns and the validation rules by rule name.
TABLES = {
    "energy_usage": {
        "key": ["household_id", '"timestamp"'],
        "extra": ["reading_id", "reading_timestamp"],
        "measures": [
            "voltage_reading", "current_reading", "active_power_kw", "reactive_power_kvar",
            "energy_usage_kwh", "frequency_hz", "load_factor", "peak_demand_kw",
            "offpeak_demand_kw", "daily_consumption_kwh",
        ],
        "text": {
            "region_name": _upper, "city_name": _title, "meter_type": _upper,
            "customer_category": _upper, "grid_zone": _upper,
        },
        "rules": {
            "voltage_reading": "voltage_reading >= 0",
            "current_reading": "current_reading >= 0",
            "active_power_kw": "active_power_kw >= 0",
            "reactive_power_kvar": "reactive_power_kvar >= 0",
            "energy_usage_kwh": "energy_usage_kwh >= 0",
            "frequency_hz": "frequency_hz BETWEEN 45 AND 65",
            "load_factor": "load_factor BETWEEN 0 AND 1",
            "peak_demand_kw": "peak_demand_kw >= 0",
            "offpeak_demand_kw": "offpeak_demand_kw >= 0",
            "daily_consumption_kwh": "daily_consumption_kwh >= 0",
        },
    },
    "weather_stream": {
        "key": ["household_id", '"timestamp"'],
        "extra": ["reading_id", "reading_timestamp"],
        "measures": [
            "temperature_celsius", "humidity_percent", "wind_speed_kmh", "rainfall_mm",
            "pressure_hpa", "solar_radiation", "dew_point", "uv_index", "visibility_km",
            "cloud_cover_percent",
        ],
        "text": {
            "weather_region": _title, "weather_city": _title, "weather_station": _upper,
            "climate_zone": _upper, "condition_type": _upper,
        },
        "rules": {},
    },
    "device_metrics": {
        "key": ["household_id", "device_model"],
        "extra": ["reading_timestamp"],
        "measures": [
            "runtime_hours", "device_power_kw", "motor_speed_rpm", "efficiency_ratio",
            "energy_draw_kwh", "heat_output", "cooling_load", "device_voltage",
            "device_current", "device_temperature",
        ],
        "text": {
            "device_category": _upper, "device_brand": _title, "device_model": _upper,
            "maintenance_status": _upper, "installation_region": _title,
        },
        "rules": {
            "runtime_hours": "runtime_hours >= 0",
            "device_power_kw": "device_power_kw >= 0",
            "motor_speed_rpm": "motor_speed_rpm >= 0",
            "efficiency_ratio": "efficiency_ratio BETWEEN 0 AND 1",
            "energy_draw_kwh": "energy_draw_kwh >= 0",
            "heat_output": "heat_output >= 0",
            "cooling_load": "cooling_load >= 0",
            "device_voltage": "device_voltage >= 0",
            "device_current": "device_current >= 0",
            "device_temperature": "device_temperature >= 0",
        },
    },
    "grid_load": {
        "key": ["household_id", "substation_name", "feeder_line"],
        "extra": ["reading_timestamp"],
        "measures": [
            "grid_voltage", "grid_current", "grid_load_kw", "transformer_load",
            "line_loss_percent", "load_variation", "frequency_variation", "grid_capacity_kw",
            "demand_forecast_kw", "reserve_margin",
        ],
        "text": {
            "grid_region": _upper, "substation_name": _upper, "feeder_line": _upper,
            "distribution_zone": _title, "grid_operator": _title,
        },
        "rules": {
            "grid_voltage": "grid_voltage >= 0",
            "grid_current": "grid_current >= 0",
            "grid_load_kw": "grid_load_kw >= 0",
            "transformer_load": "transformer_load >= 0",
            "line_loss_percent": "line_loss_percent BETWEEN 0 AND 100",
            "grid_capacity_kw": "grid_capacity_kw >= 0",
            "demand_forecast_kw": "demand_forecast_kw >= 0",
        },
    },
    "tariff_metrics": {
        "key": ["household_id", "billing_cycle"],
        "extra": ["reading_id", "reading_timestamp"],
        "measures": [
            "unit_rate", "peak_rate", "offpeak_rate", "fixed_charge", "tax_amount",
            "subsidy_amount", "monthly_bill", "billing_units", "late_fee", "adjustment_amount",
        ],
        "text": {
            "tariff_region": _title, "tariff_city": _title, "tariff_plan_type": _upper,
            "billing_cycle": _upper, "utility_provider": _title,
        },
        "rules": {
            c: f"{c} >= 0"
            for c in (
                "unit_rate", "peak_rate", "offpeak_rate", "fixed_charge", "tax_amount",
                "subsidy_amount", "monthly_bill", "billing_units", "late_fee", "adjustment_amount",
            )
        },
    },
}


def candidates(name: str, raw_key_text: bool = False) -> str:
    """CTEs up to ``cand_<name>``: converted, deduplicated, filled, standardised."""
    t = TABLES[name]
    standard = {c: f"{rule(c)} AS {c}" for c, rule in t["text"].items()}
    first = {} if raw_key_text else standard
    columns = list(dict.fromkeys([*t["extra"], *t["key"], *t["measures"], *t["text"]]))

    def converted(c: str) -> str:
        if c in t["measures"] and name != "weather_stream":
            return f"TRY_CAST({c} AS DOUBLE) AS {c}"
        if c == '"timestamp"' and name == "energy_usage":
            return "CAST(try_strptime(\"timestamp\", '%d-%m-%Y %H:%M') AS TIMESTAMP) AS \"timestamp\""
        return first.get(c, c)

    order = ["reading_timestamp", *[c for c in t["extra"] if c != "reading_timestamp"]]
    order += [c for c in (*t["measures"], *t["text"]) if c not in t["key"]]
    ranked = ", ".join(f"{c} DESC NULLS LAST" for c in order)

    def final(c: str) -> str:
        if c in t["measures"]:
            return f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0::DOUBLE ELSE {c} END AS {c}"
        return standard.get(c, c) if raw_key_text else c

    return f"""{RAW[name]},
conv_{name} AS (SELECT {", ".join(map(converted, columns))} FROM raw_{name}),
dedup_{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {", ".join(t["key"])} ORDER BY {ranked}) AS rn
    FROM conv_{name}) WHERE rn = 1),
cand_{name} AS (SELECT {", ".join(map(final, columns))} FROM dedup_{name})"""


def silver(name: str, raw_key_text: bool = False) -> str:
    """CTEs up to ``<name>``: the Silver table without its hash key and clock column."""
    keep = " AND ".join(TABLES[name]["rules"].values()) or "true"
    return f"""{candidates(name, raw_key_text)},
{name} AS (SELECT *, 'ACTIVE' AS record_status FROM cand_{name} WHERE {keep})"""


def failed_rules(name: str) -> str:
    rules = TABLES[name]["rules"]
    parts = ", ".join(f"CASE WHEN NOT ({sql}) THEN '{rule}' END" for rule, sql in rules.items())
    return f"list_filter([{parts}], lambda r: r IS NOT NULL)"


PROFILE = """
profile AS (
  SELECT household_id,
    COALESCE(n_devices, 0) AS n_devices, devices_power_kw, avg_device_efficiency,
    COALESCE(n_feeders, 0) AS n_feeders, feeders_load_kw, feeders_capacity_kw,
    COALESCE(n_billing_cycles, 0) AS n_billing_cycles, billed_amount, avg_unit_rate
  FROM (SELECT household_id, count(*) AS n_devices, sum(device_power_kw) AS devices_power_kw,
          avg(efficiency_ratio) AS avg_device_efficiency FROM device_metrics GROUP BY ALL)
  FULL JOIN (SELECT household_id, count(*) AS n_feeders, sum(grid_load_kw) AS feeders_load_kw,
          sum(grid_capacity_kw) AS feeders_capacity_kw FROM grid_load GROUP BY ALL) USING (household_id)
  FULL JOIN (SELECT household_id, count(*) AS n_billing_cycles, sum(monthly_bill) AS billed_amount,
          avg(unit_rate) AS avg_unit_rate FROM tariff_metrics GROUP BY ALL) USING (household_id))"""

READINGS = """
readings AS (
  SELECT e.household_id, e."timestamp",
    CAST(strftime(e."timestamp", '%Y%m%d') AS INTEGER) AS date_key,
    CAST(strftime(e."timestamp", '%Y%m') AS INTEGER) AS month_key,
    region_name, city_name, meter_type, customer_category, grid_zone,
    energy_usage_kwh, active_power_kw, peak_demand_kw, offpeak_demand_kw,
    daily_consumption_kwh, load_factor,
    w.weather_station IS NOT NULL AS has_weather,
    w.condition_type, w.temperature_celsius, w.humidity_percent, w.solar_radiation
  FROM energy_usage e LEFT JOIN weather_stream w
    ON w.household_id = e.household_id AND w."timestamp" = e."timestamp")"""

# The marts need the readings only; the household totals are checked by fact_energy.
FACT_READINGS = f"{silver('energy_usage')}, {silver('weather_stream')}, {READINGS}"
FACT = (
    f"{FACT_READINGS}, {silver('device_metrics')}, {silver('grid_load')}, "
    f"{silver('tariff_metrics')}, {PROFILE}"
)

USAGE = """count(*) AS n_readings, sum(energy_usage_kwh) AS total_kwh,
  avg(energy_usage_kwh) AS avg_kwh, max(energy_usage_kwh) AS max_kwh,
  max(peak_demand_kw) AS peak_kw, count(DISTINCT household_id) AS n_households"""
