"""Files in, columns aligned: Parquet, CSV conversion, lineage, schema evolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """Some of the Parquet files of a folder, with the folder's own partition columns, or the one
    file that ``path`` is."""
    reader = spark.read
    if any(not f.endswith(path.rstrip("/").rsplit("/", 1)[-1]) for f in files):
        reader = reader.option("basePath", path)
    return reader.parquet(*files)


class TooManyRejects(ValueError):
    """More rows than allowed could not be converted."""


MALFORMED = "_malformed"


def csv_to_parquet(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: T.StructType | None = None,
    rejects_path: str | None = None,
    max_rejects: int | None = None,
) -> int:
    """Converts CSV files with a header row; columns are found by name, in any order.

    Columns of ``schema`` are cast and must hold what they promise; all others stay
    text, and nothing is read twice to guess types. Files whose headers differ stop the job.

    Without ``rejects_path`` so do rows of the wrong length and values that cannot be cast. With
    it such rows go there, as (reason, record, source_file): ``record`` is the line of a row of
    the wrong length, else the row as JSON. Their number is returned, counted as the good rows are written,
    and the files are read again only if there are any. Beyond ``max_rejects`` TooManyRejects is raised
    once both tables are written.
    """
    options = {"header": True, "enforceSchema": False}
    names = spark.read.options(**options).csv(csv_path).columns
    types = {f.name: f.dataType for f in schema.fields} if schema else {}
    missing = [c for c in types if c not in names]
    if missing:
        raise ValueError(f"{csv_path}: no column {', '.join(missing)}")
    if rejects_path is None:
        text = spark.read.options(**options, mode="FAILFAST").csv(csv_path)
        columns = [F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in names]
        text.select(*columns).write.mode("overwrite").parquet(parquet_path)
        return 0
    texts = T.StructType([T.StructField(c, T.StringType()) for c in (*names, MALFORMED)])
    reader = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)
    read = reader.schema(texts).csv(csv_path)
    reasons = [F.when(F.col(MALFORMED).isNotNull(), F.lit("wrong number of columns"))]
    reasons += [
        F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(kind).isNull(), F.lit(f"{c} is no {kind.simpleString()}"))
        for c, kind in types.items()
    ]
    reason = F.coalesce(*reasons)
    judged = read.withColumn("_reason", reason)
    counted = Observation()
    good = judged.observe(counted, F.count("_reason").alias("rejects")).filter("_reason IS NULL")
    good.select(
        *[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in names]
    ).write.mode("overwrite").parquet(parquet_path)
    n = counted.get["rejects"]
    rejected = judged.filter("_reason IS NOT NULL").select(
        F.col("_reason").alias("reason"),
        F.coalesce(MALFORMED, F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]))).alias("record"),
        F.col("_metadata.file_path").alias("source_file"),
    )
    (rejected if n else rejected.limit(0)).write.mode("overwrite").parquet(rejects_path)
    if max_rejects is not None and n > max_rejects:
        raise TooManyRejects(f"{csv_path}: {n} rows could not be converted, more than {max_rejects}; see {rejects_path}")
    return n


def with_lineage(df: DataFrame, batch_id: str) -> DataFrame:
    """Ingestion time, file of origin and one batch id for the whole load.

    Has to come straight after the read: an aggregate drops the file metadata.
    """
    return df.withColumns(
        {
            "bronze_ingestion_time": F.current_timestamp(),
            "source_file": F.col("_metadata.file_path"),
            "batch_id": F.lit(batch_id),
        }
    )


def with_row_ids(df: DataFrame, column: str = "row_id") -> DataFrame:
    """A random id per row. Not repeatable; for marking rows, never for joining."""
    return df.withColumn(column, F.expr("uuid()"))


def append_evolving(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column that one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Numbers in the order in which one holds all values of those before; long to double keeps 53 bits.
WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def wider_type(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The narrowest type that holds the values of both, None if there is none.

    Whole numbers widen to longer ones, to decimals and to double; float to double; decimals
    to more digits before and after the point; date to timestamp; structs, arrays and maps by
    their parts, a struct keeping the fields that either has.
    """
    if old == new:
        return old
    pair = (old, new)
    if all(t in WHOLE for t in pair):
        return max(pair, key=WHOLE.index)
    for a, b in (pair, pair[::-1]):
        if isinstance(b, T.DoubleType) and (a in WHOLE or isinstance(a, T.FloatType)):
            return b
        if isinstance(b, T.TimestampType | T.TimestampNTZType) and isinstance(a, T.DateType):
            return b
    as_decimals = [T.DecimalType(DIGITS[t], 0) if t in WHOLE else t for t in pair]
    if all(isinstance(t, T.DecimalType) for t in as_decimals):
        scale = max(t.scale for t in as_decimals)
        precision = max(t.precision - t.scale for t in as_decimals) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    if all(isinstance(t, T.StructType) for t in pair):
        try:
            return merged_schema(old, new)
        except ValueError:
            return None
    if all(isinstance(t, T.ArrayType) for t in pair):
        element = wider_type(old.elementType, new.elementType)
        return element and T.ArrayType(element)
    if all(isinstance(t, T.MapType) for t in pair):
        key, value = wider_type(old.keyType, new.keyType), wider_type(old.valueType, new.valueType)
        return T.MapType(key, value) if key == old.keyType and value else None
    return None


def _read_as_is(old: T.DataType, new: T.DataType) -> bool:
    """Whether Spark's Parquet reader gives files of type ``old`` as ``new`` by itself."""
    if isinstance(old, T.StructType):
        kinds = {f.name.lower(): f.dataType for f in new.fields}
        return all(_read_as_is(f.dataType, kinds[f.name.lower()]) for f in old.fields)
    if isinstance(old, T.ArrayType):
        return _read_as_is(old.elementType, new.elementType)
    if isinstance(old, T.MapType):
        return _read_as_is(old.valueType, new.valueType)
    by_cast = {(T.DateType(), T.TimestampType()), (T.LongType(), T.DoubleType())}
    return (old, new) not in by_cast


WIDENED = "widened"  # metadata of a column whose older files have to be cast when they are read


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` followed by the columns only ``new`` has. A column of two types gets the one that
    holds both (see :func:`wider_type`); where there is none, the change is refused."""
    arriving = {f.name.lower(): f for f in new.fields}
    known = {f.name.lower() for f in old.fields}
    fields = []
    for f in old.fields:
        other = arriving.get(f.name.lower(), f)
        kind = wider_type(f.dataType, other.dataType)
        nested = isinstance(kind, T.StructType | T.ArrayType | T.MapType)
        if kind is None or (nested and not _read_as_is(f.dataType, kind)):
            raise ValueError(
                f"column {f.name}: {f.dataType.simpleString()} and {other.dataType.simpleString()} "
                "have no common type"
            )
        metadata = dict(f.metadata or {})
        if not _read_as_is(f.dataType, kind):
            metadata[WIDENED] = True
        fields.append(T.StructField(f.name, kind, True, metadata))
    fields += [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name.lower() not in known]
    return T.StructType(fields)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with its plain columns in the types they have in ``schema``, if they are in it."""
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    casts = {
        f.name: F.col(f"`{f.name}`").cast(kinds[f.name.lower()])
        for f in df.schema.fields
        if not isinstance(f.dataType, T.StructType) and f.dataType != kinds.get(f.name.lower(), f.dataType)
    }
    return df.withColumns(casts) if casts else df
