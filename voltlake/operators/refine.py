"""Bronze to Silver: convert, deduplicate, fill, validate, standardise, key, stamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.functions import columns as C
from voltlake.operators.dedup import latest_per_key
from voltlake.specs import TableSpec


def convert_types(df: DataFrame, spec: TableSpec) -> DataFrame:
    changes = {c: C.to_timestamp(c, p) for c, p in spec.timestamps.items()}
    if spec.cast_measures:
        changes |= {c: C.to_double(c) for c in spec.measures}
    return df.withColumns(changes) if changes else df


def standardise(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumns(
        {c: C.upper_text(c) for c in spec.upper} | {c: C.title_text(c) for c in spec.title}
    )


def deduplicate(df: DataFrame, spec: TableSpec) -> DataFrame:
    return latest_per_key(df, spec.key, spec.recency)


def fill_measures(df: DataFrame, spec: TableSpec, keep_flags: bool = False) -> DataFrame:
    """Null and NaN measures become 0.0.

    With ``keep_flags`` a ``<measure>_was_null`` column remembers which zeros were
    filled in.
    """
    if keep_flags:
        kinds = dict(df.dtypes)
        df = df.withColumns(
            {
                f"{c}_was_null": F.col(c).isNull() | F.isnan(c)
                if kinds[c] in ("double", "float")
                else F.col(c).isNull()
                for c in spec.measures
            }
        )
    return df.fillna({c: 0.0 for c in spec.measures})


def validate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows inside every range. One predicate, so one pass."""
    return df.filter(C.all_of([C.within(c, *bounds) for c, bounds in spec.ranges.items()]))


def tag_failures(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds ``failed_rules``: the measures of the row that are outside their range."""
    failures = [
        F.when(~C.within(c, *spec.ranges[c]), F.lit(c)) for c in spec.measures if c in spec.ranges
    ]
    tags = F.array_compact(F.array(*failures)) if failures else F.array().cast("array<string>")
    return df.withColumn("failed_rules", tags)


def add_key(df: DataFrame, spec: TableSpec, sequence: bool = False) -> DataFrame:
    """Surrogate key: a hash of the natural key, or a per-run sequence on request."""
    value = F.monotonically_increasing_id() if sequence else C.hash_key(*spec.key)
    return df.withColumn(spec.surrogate, value)


def add_audit_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"silver_ingestion_time": F.current_timestamp(), "record_status": F.lit("ACTIVE")}
    )


def _candidates(df: DataFrame, spec: TableSpec, raw_key_text: bool) -> DataFrame:
    """Converted, deduplicated, filled and standardised rows, before validation.

    Standardising comes before deduplication so that ' ac-1' and 'AC-1' are one
    key. ``raw_key_text`` compares the text as it arrived instead, which can leave
    two rows with one surrogate key.
    """
    df = convert_types(df, spec)
    if raw_key_text:
        return standardise(fill_measures(deduplicate(df, spec), spec), spec)
    return fill_measures(deduplicate(standardise(df, spec), spec), spec)


def refine(
    df: DataFrame, spec: TableSpec, raw_key_text: bool = False, sequence_key: bool = False
) -> DataFrame:
    """The Silver rows of a Bronze frame. The deduplication is the only shuffle."""
    valid = validate(_candidates(df, spec, raw_key_text), spec)
    return add_audit_columns(add_key(valid, spec, sequence_key))


def rejects(df: DataFrame, spec: TableSpec, raw_key_text: bool = False) -> DataFrame:
    """The rows ``refine`` leaves out, each with the names of the rules it broke."""
    tagged = tag_failures(_candidates(df, spec, raw_key_text), spec)
    return tagged.filter(F.size("failed_rules") > 0)


def unreadable(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw rows with a time that is there but cannot be read, named in ``failed_rules``.

    ``refine`` goes on with a null time, so that of all such rows of a household one is left; here
    all of them are, as they arrived.
    """
    failures = [
        F.when(F.col(c).isNotNull() & C.to_timestamp(c, pattern).isNull(), F.lit(c))
        for c, pattern in spec.timestamps.items()
        if isinstance(df.schema[c].dataType, T.StringType)
    ]
    tags = F.array_compact(F.array(*failures)) if failures else F.array().cast("array<string>")
    return df.withColumn("failed_rules", tags).filter(F.size("failed_rules") > 0)


def reject_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rejected rows per rule; a row that breaks two rules counts under both."""
    return (
        rejects(df, spec)
        .select(F.explode("failed_rules").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
