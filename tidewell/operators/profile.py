"""Column profiles.  Each is one pass over the table, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType, StringType


def null_profile(df: DataFrame, column_name: str = "column_name",
                 count_name: str = "null_count") -> DataFrame:
    """(column, number of nulls) for the columns that have any.  NaN is not null."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return (counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], column_name, count_name)
            .where(F.col(count_name) > 0))


def text_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, min and max of text columns, one row per column."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    stats = [F.struct(F.lit(name).alias("column_name"),
                      F.count(F.col(f"`{name}`")).alias("count"),
                      F.min(F.col(f"`{name}`")).alias("min"),
                      F.max(F.col(f"`{name}`")).alias("max")) for name in columns]
    return df.agg(F.array(*stats).alias("_stats")).select(F.inline("_stats"))


def column_summary(df: DataFrame, columns: Sequence[str] | None = None,
                   digits: int | None = None) -> DataFrame:
    """count, mean, sample standard deviation, min and max of numeric columns, one
    row per column."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    rounded = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    stats = []
    for name in columns:
        value = F.col(f"`{name}`")
        stats.append(F.struct(
            F.lit(name).alias("column_name"),
            F.count(value).alias("count"),
            rounded(F.avg(value)).alias("mean"),
            rounded(F.stddev(value)).alias("stddev"),
            F.min(value).cast("double").alias("min"),
            F.max(value).cast("double").alias("max")))
    return df.agg(F.array(*stats).alias("_stats")).select(F.inline("_stats"))


def exact_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, min and max of numbers, decimals, dates, times and text, one row per column, in one pass.

    The extremes are those of the column's own type, written as text: a double would round large
    integers and long decimals.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, (NumericType, StringType, DatetimeType, BooleanType))]
    stats = [F.struct(F.lit(name).alias("column_name"),
                      F.lit(df.schema[name].dataType.simpleString()).alias("data_type"),
                      F.count(F.col(f"`{name}`")).alias("count"),
                      F.min(F.col(f"`{name}`")).cast("string").alias("min"),
                      F.max(F.col(f"`{name}`")).cast("string").alias("max")) for name in columns]
    return df.agg(F.array(*stats).alias("_stats")).select(F.inline("_stats"))
