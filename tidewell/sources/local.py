"""Rows given by the caller."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def rows_from_list(spark: SparkSession, rows: Iterable[tuple],
                   schema: StructType | str) -> DataFrame:
    """A small list as a DataFrame.  With a schema given, an empty list works too.

    The rows go to the JVM as Arrow columns, which needs no Python worker.
    """
    if not isinstance(schema, StructType):
        schema = StructType.fromDDL(schema)
    rows = list(rows)
    columns = [pa.array([row[i] for row in rows], to_arrow_type(field.dataType))
               for i, field in enumerate(schema.fields)]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)
