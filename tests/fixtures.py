"""Clean raw readings of the five tables, to be changed one column at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltlake.specs import SPECS

# A valid value for every measure that has an upper bound; all others are 10.
GOOD = {"frequency_hz": "50", "load_factor": "0.5", "efficiency_ratio": "0.5", "line_loss_percent": "5"}


def clean_row(name: str) -> dict:
    spec = SPECS[name]
    row = {"household_id": "H1"}
    if "timestamp" in spec.key:
        row["timestamp"] = "01-02-2024 10:30" if spec.timestamps else "2024-02-01 10:30:00"
    row |= {m: GOOD.get(m, "10") for m in spec.measures}
    row |= {c: f" {c} x" for c in spec.text}
    row["reading_timestamp"] = "2024-02-01 10:30:00"
    return row


def raw(spark: SparkSession, name: str, *changes: dict) -> DataFrame:
    """One row per dict of changes to the clean row; each gets its own household."""
    spec = SPECS[name]
    rows = [clean_row(name) | {"household_id": f"H{i}"} | change for i, change in enumerate(changes)]
    columns = list(dict.fromkeys(c for r in rows for c in r))
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    df = spark.createDataFrame([[r.get(c) for c in columns] for r in rows], schema)
    casts = {"reading_timestamp": df["reading_timestamp"].cast("timestamp")}
    if not spec.cast_measures:
        casts |= {m: df[m].cast("double") for m in spec.measures}
        casts["timestamp"] = df["timestamp"].cast("timestamp")
    return df.withColumns(casts)
