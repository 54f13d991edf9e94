"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.session import work_dir


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator works on, so that no other column's name can clash.

    A null text counts as empty. Rows are neither dropped nor merged; a null id stays one.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *(F.col(c) for c in more),
    )


def fold(parts: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def is_fold(parts: int, which: int, id_col: str = "doc_id") -> Column:
    """Whether a row falls into one fold; a row without an id is in none."""
    return F.coalesce(fold(parts, id_col) == which, F.lit(False))


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows as a table in the folder all executors share: computed once, and read again
    from there if an executor is lost."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
