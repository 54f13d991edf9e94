"""Row-count gates and column tests. Every test is one row: (check, n_checked, n_failed)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.functions.columns import all_of


class QualityError(Exception):
    """A gate or test did not pass; the message names all that failed."""


def _together(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of every table, in one job."""
    return _together(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name, df in tables.items()
        ]
    )


def require_rows(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Counts all tables, then fails once, naming each empty one."""
    counts = {r["table_name"]: r["n_rows"] for r in row_counts(tables).collect()}
    empty = sorted(name for name, n in counts.items() if n == 0)
    if empty:
        raise QualityError(f"empty tables: {', '.join(empty)}")
    return counts


def require_not_empty(df: DataFrame, name: str) -> None:
    if df.isEmpty():
        raise QualityError(f"empty table: {name}")


def _result(check: str, df: DataFrame, checked, failed) -> DataFrame:
    return df.agg(checked.alias("n_checked"), F.coalesce(failed, F.lit(0)).alias("n_failed")).select(
        F.lit(check).alias("check"), F.coalesce("n_checked", F.lit(0)).alias("n_checked"), "n_failed"
    )


def column_checks(
    df: DataFrame, not_null: Sequence[str] = (), accepted: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """Not-null and accepted-values tests of one table, all in one scan of it."""
    accepted = dict(accepted or {})
    rows = F.count(F.lit(1))
    tests = {f"not_null({c})": (rows, rows - F.count(c)) for c in not_null}
    # Nulls are the business of ``not_null`` and pass here.
    tests |= {
        f"accepted_values({c})": (F.count(c), F.count_if(~F.col(c).isin(*values)))
        for c, values in accepted.items()
    }
    results = [
        F.struct(F.lit(name).alias("check"), checked.alias("n_checked"), failed.alias("n_failed"))
        for name, (checked, failed) in tests.items()
    ]
    used = list(dict.fromkeys([*not_null, *accepted]))
    return df.select(*used).agg(F.array(*results).alias("_results")).select(F.inline("_results"))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return column_checks(df, not_null=columns)


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fails once per surplus row. Rows with a null in the key are not compared."""
    complete = df.select(*columns).filter(all_of([F.col(c).isNotNull() for c in columns]))
    per_key = complete.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return _result(
        f"unique({', '.join(columns)})", per_key, F.sum("_n"), F.sum(F.col("_n") - 1)
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return column_checks(df, accepted={column: values})


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None
) -> DataFrame:
    """Child rows whose non-null ``column`` has no parent.

    The child is counted per value before the join, so the join sees each value
    once however often it occurs.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = (
        parent.select(F.col(parent_column or column).alias(column))
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    orphans = F.sum(F.when(F.col("_known").isNull(), F.col("_n")).otherwise(0))
    return _result(
        f"relationships({column})", values.join(known, column, "left"), F.sum("_n"), orphans
    )


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return _together(checks)


def require_passed(results: DataFrame) -> None:
    failed = results.filter("n_failed > 0").collect()
    if failed:
        raise QualityError("; ".join(f"{r['check']}: {r['n_failed']} rows" for r in failed))


ERROR, WARN = "error", "warn"
RESULTS = "table_name STRING, check STRING, severity STRING, n_checked LONG, n_failed LONG"
FAILURES = "table_name STRING, check STRING, record STRING"


@dataclass(frozen=True)
class Rule:
    """A test of single rows, by the condition under which a row fails it (null: it passes)."""

    check: str
    fails: Column
    severity: str = ERROR


def must_have(*columns: str, severity: str = ERROR) -> list[Rule]:
    return [Rule(f"not_null({c})", F.col(c).isNull(), severity) for c in columns]


def must_be_one_of(column: str, values: Sequence, severity: str = ERROR) -> Rule:
    return Rule(f"accepted_values({column})", ~F.col(column).isin(*values), severity)


@dataclass(frozen=True)
class WriteTests:
    """Tests that a table's write runs as it goes: their counts are observed in the write's own job.

    Results go to ``results_path``, one row per test, and the failing rows, if there are any, as
    JSON to ``failures_path``, read from what was written. If a rule of severity "error" fails, QualityError
    is raised, and with :func:`voltlake.sources.snapshots.publish` the rows do not become a version.
    """

    table: str
    rules: Sequence[Rule]
    results_path: str
    failures_path: str

    @property
    def counts(self) -> dict[str, Column]:
        return {rule.check: rule.fails for rule in self.rules}

    def judge(self, counts: Mapping[str, int], rows: DataFrame) -> None:
        spark = rows.sparkSession
        results = [
            (self.table, rule.check, rule.severity, counts["n"], counts.get(rule.check, 0)) for rule in self.rules
        ]
        spark.createDataFrame(results, RESULTS).coalesce(1).write.mode("append").parquet(self.results_path)
        failed = [rule for rule in self.rules if counts.get(rule.check, 0)]
        if failed:
            broken = F.array_compact(F.array(*[F.when(rule.fails, F.lit(rule.check)) for rule in failed]))
            record = F.to_json(F.struct(*rows.columns))
            (
                rows.select(F.lit(self.table).alias("table_name"), F.explode(broken).alias("check"), record.alias("record"))
                .write.mode("append")
                .parquet(self.failures_path)
            )
        errors = [f"{rule.check}: {counts[rule.check]} rows" for rule in failed if rule.severity == ERROR]
        if errors:
            raise QualityError(f"{self.table}: {'; '.join(errors)}")
