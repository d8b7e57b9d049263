"""Grouped and global aggregates.

All of them are algebraic, so Spark aggregates within every map task first and a hot
group costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, keys: Sequence[str | Column], name: str = "count") -> DataFrame:
    """Rows per group; null is a group of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def non_null_count(df: DataFrame, keys: Sequence[str | Column], column: str,
                   name: str) -> DataFrame:
    """Non-null values of ``column`` per group."""
    return df.groupBy(*keys).agg(F.count(column).alias(name))


def global_mean(df: DataFrame, column: str) -> float | None:
    """Mean of a column, as a number on the driver."""
    return df.agg(F.avg(column)).first()[0]


def group_mean(df: DataFrame, keys: Sequence[str | Column], column: str,
               name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(column).alias(name))


def mean_between(df: DataFrame, key: str, column: str, above: float, below: float,
                 name: str) -> DataFrame:
    """Mean per group for the groups strictly between two bounds, in SQL.

    The bounds stand after the aggregate, as in HAVING; Spark moves them to the scan
    because they are on the grouping key.
    """
    means = df.sparkSession.sql(
        f"SELECT avg(`{column}`) AS `{name}`, `{key}` FROM {{rows}} GROUP BY `{key}`", rows=df)
    return means.filter(F.col(key) > above).filter(F.col(key) < below)
