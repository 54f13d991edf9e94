"""Scalar expressions shared by the refine step and the Gold models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_double(name: str) -> Column:
    """Numeric conversion that turns unreadable text into null instead of failing the job."""
    return F.col(name).try_cast("double")


def to_timestamp(name: str, pattern: str) -> Column:
    return F.try_to_timestamp(F.col(name), F.lit(pattern))


def upper_text(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def title_text(name: str) -> Column:
    return F.initcap(F.trim(F.col(name)))


def within(name: str, low: float, high: float | None) -> Column:
    value = F.col(name)
    return value >= F.lit(low) if high is None else value.between(low, high)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def hash_key(*names: str) -> Column:
    """64-bit key of the named columns.

    ``xxhash64`` skips nulls, so (a, null) and (null, a) would share a key. Rows
    with a null part also hash the positions of their nulls; complete keys keep
    the plain hash.
    """
    plain = F.xxhash64(*names)
    gaps = F.concat(*[F.when(F.col(n).isNull(), "1").otherwise("0") for n in names])
    complete = all_of([F.col(n).isNotNull() for n in names])
    return F.when(complete, plain).otherwise(F.xxhash64(*names, gaps))


def date_key(value: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)).cast("int")


def with_range_buckets(df: DataFrame, ranks: Mapping[str, Column], bounds: Mapping[str, Sequence]) -> DataFrame:
    """Adds a long column for each of ``ranks``: how many of its sorted ``bounds`` are <= the rank.

    Found by halving, one step of all searches in each projection, with the bounds in one constant:
    plan and compiled code grow with log2(len(bounds)) only. Nulls fall into bucket 0.
    """
    rank = {name: f"__rank_{name}" for name in ranks}
    df = df.withColumns({rank[name]: value for name, value in ranks.items()})
    # As one text, since a constant of many elements would be as many expressions.
    listed = {
        name: F.split(F.lit(",".join(map(str, bounds[name]))), ",").cast(T.ArrayType(df.schema[rank[name]].dataType))
        for name in ranks
        if bounds[name]
    }
    df = df.withColumns({name: F.lit(0) for name in ranks})
    for k in reversed(range(max([len(bounds[name]).bit_length() for name in listed], default=0))):
        step = 1 << k
        taken = {name: F.col(rank[name]) >= F.get(known, F.col(name) + (step - 1)) for name, known in listed.items()}
        # Beyond the last bound there is null, and the step is not taken.
        df = df.withColumns(
            {name: F.when(beyond, F.col(name) + step).otherwise(F.col(name)) for name, beyond in taken.items()}
        )
    return df.withColumns({name: F.col(name).cast("long") for name in ranks}).drop(*rank.values())


def interleave(buckets: list[Column], bits: int) -> Column:
    """Z-order value: bit i of every bucket number sits next to bit i of the others."""
    width = len(buckets)
    parts = [
        F.shiftleft(F.shiftright(b, bit).bitwiseAND(F.lit(1).cast("long")), bit * width + position)
        for position, b in enumerate(buckets)
        for bit in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)
