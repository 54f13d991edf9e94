"""One declarative description per domain table; every generic step reads from it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Columns that tell which of two copies of a reading is the later one.
RECENCY = ("reading_timestamp", "bronze_ingestion_time")

TIMESTAMP_PATTERN = "dd-MM-yyyy HH:mm"
WATERMARK_COLUMN = "reading_timestamp"
WATERMARK_DELAY = "2 hours"
RETENTION_HOURS = 168


@dataclass(frozen=True)
class TableSpec:
    """What the refine step needs to know about a table.

    ``ranges`` maps a measure to inclusive bounds; ``None`` leaves that end open.
    A column without an entry is not validated.
    """

    name: str
    process: str
    raw_file: str
    surrogate: str
    key: tuple[str, ...]
    measures: tuple[str, ...]
    upper: tuple[str, ...]
    title: tuple[str, ...]
    cluster_by: tuple[str, ...]
    ranges: dict[str, tuple[float, float | None]] = field(default_factory=dict)
    cast_measures: bool = True
    timestamps: dict[str, str] = field(default_factory=dict)
    recency: tuple[str, ...] = RECENCY

    @property
    def bronze_name(self) -> str:
        return f"bronze_{self.name}"

    @property
    def raw_types(self) -> T.StructType:
        """Columns that the refine step does not convert itself and so need a type on arrival."""
        fields = []
        if not self.cast_measures:
            fields += [T.StructField(c, T.DoubleType()) for c in self.measures]
        if "timestamp" in self.key and "timestamp" not in self.timestamps:
            fields.append(T.StructField("timestamp", T.TimestampType()))
        return T.StructType(fields)

    @property
    def text(self) -> tuple[str, ...]:
        return self.upper + self.title


def _not_negative(*columns: str) -> dict[str, tuple[float, float | None]]:
    return {c: (0.0, None) for c in columns}


# Column names, keys, bounds and text rules of the five tables.

ENERGY_USAGE = TableSpec(
    name="energy_usage",
    process="Ingest_Energy_Usage",
    raw_file="energy_usage_stream_v2.parquet",
    surrogate="energy_key",
    key=("household_id", "timestamp"),
    measures=(
        "voltage_reading", "current_reading", "active_power_kw", "reactive_power_kvar",
        "energy_usage_kwh", "frequency_hz", "load_factor", "peak_demand_kw",
        "offpeak_demand_kw", "daily_consumption_kwh",
    ),
    upper=("region_name", "meter_type", "customer_category", "grid_zone"),
    title=("city_name",),
    cluster_by=("household_id", "timestamp"),
    ranges={
        **_not_negative(
            "voltage_reading", "current_reading", "active_power_kw", "reactive_power_kvar",
            "energy_usage_kwh", "peak_demand_kw", "offpeak_demand_kw", "daily_consumption_kwh",
        ),
        "frequency_hz": (45.0, 65.0),
        "load_factor": (0.0, 1.0),
    },
    timestamps={"timestamp": TIMESTAMP_PATTERN},
)

WEATHER_STREAM = TableSpec(
    name="weather_stream",
    process="Ingest_weather_stream",
    raw_file="weather_stream_v2.parquet",
    surrogate="weather_key",
    key=("household_id", "timestamp"),
    measures=(
        "temperature_celsius", "humidity_percent", "wind_speed_kmh", "rainfall_mm",
        "pressure_hpa", "solar_radiation", "dew_point", "uv_index", "visibility_km",
        "cloud_cover_percent",
    ),
    upper=("weather_station", "climate_zone", "condition_type"),
    title=("weather_region", "weather_city"),
    cluster_by=("household_id", "timestamp"),
    cast_measures=False,
)

DEVICE_METRICS = TableSpec(
    name="device_metrics",
    process="Ingest_device_metrics",
    raw_file="device_metrics_stream_v2.parquet",
    surrogate="device_key",
    key=("household_id", "device_model"),
    measures=(
        "runtime_hours", "device_power_kw", "motor_speed_rpm", "efficiency_ratio",
        "energy_draw_kwh", "heat_output", "cooling_load", "device_voltage",
        "device_current", "device_temperature",
    ),
    upper=("device_category", "device_model", "maintenance_status"),
    title=("device_brand", "installation_region"),
    cluster_by=("household_id", "device_model"),
    ranges={
        **_not_negative(
            "runtime_hours", "device_power_kw", "motor_speed_rpm", "energy_draw_kwh",
            "heat_output", "cooling_load", "device_voltage", "device_current",
            "device_temperature",
        ),
        "efficiency_ratio": (0.0, 1.0),
    },
)

GRID_LOAD = TableSpec(
    name="grid_load",
    process="Ingest_grid_load",
    raw_file="grid_load_stream_v2.parquet",
    surrogate="grid_key",
    key=("household_id", "substation_name", "feeder_line"),
    measures=(
        "grid_voltage", "grid_current", "grid_load_kw", "transformer_load",
        "line_loss_percent", "load_variation", "frequency_variation", "grid_capacity_kw",
        "demand_forecast_kw", "reserve_margin",
    ),
    upper=("grid_region", "substation_name", "feeder_line"),
    title=("distribution_zone", "grid_operator"),
    cluster_by=("household_id", "substation_name"),
    ranges={
        **_not_negative(
            "grid_voltage", "grid_current", "grid_load_kw", "transformer_load",
            "grid_capacity_kw", "demand_forecast_kw",
        ),
        "line_loss_percent": (0.0, 100.0),
    },
)

TARIFF_METRICS = TableSpec(
    name="tariff_metrics",
    process="Ingest_tarrif_metrics",
    raw_file="tariff_metrics_stream_v2.parquet",
    surrogate="tariff_key",
    key=("household_id", "billing_cycle"),
    measures=(
        "unit_rate", "peak_rate", "offpeak_rate", "fixed_charge", "tax_amount",
        "subsidy_amount", "monthly_bill", "billing_units", "late_fee", "adjustment_amount",
    ),
    upper=("tariff_plan_type", "billing_cycle"),
    title=("tariff_region", "tariff_city", "utility_provider"),
    cluster_by=("household_id", "billing_cycle"),
    ranges=_not_negative(
        "unit_rate", "peak_rate", "offpeak_rate", "fixed_charge", "tax_amount",
        "subsidy_amount", "monthly_bill", "billing_units", "late_fee", "adjustment_amount",
    ),
)

SPECS = {
    s.name: s for s in (ENERGY_USAGE, WEATHER_STREAM, DEVICE_METRICS, GRID_LOAD, TARIFF_METRICS)
}

GOLD_TABLES = (
    "fact_energy", "dim_date", "dim_device", "dim_grid", "dim_household", "dim_tariff",
    "dim_weather", "daily_summary", "monthly_summary", "yearly_summary", "executive_dashboard",
)
