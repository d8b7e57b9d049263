"""Delimited text whose column names and types stand in a separate header file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tidewell.functions import MISSING_INT, parse_token

Header = Sequence[tuple[str, str]]


def read_header(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """``name:type`` lines of all files, by file name and line.  One line per column, so a few
    KB at most.  A line without a colon, or a header without lines, is an error."""
    files = (spark.read.text(path, wholetext=True)
             .select("value", F.col("_metadata.file_path").alias("file")).orderBy("file").collect())
    lines = [line.strip() for file in files for line in file["value"].splitlines() if line.strip()]
    pairs = [tuple(line.split(":")[:2]) for line in lines]
    wrong = [line for line, pair in zip(lines, pairs) if len(pair) < 2]
    if wrong or not pairs:
        raise ValueError(f"no name:type line in the header {path}: {wrong[:1]}")
    return pairs


def typed_schema(header: Header) -> StructType:
    types = {"int": IntegerType(), "double": DoubleType()}
    return StructType([StructField(name, types.get(tag, StringType()), True)
                       for name, tag in header])


def parse_typed_lines(lines: DataFrame, header: Header, delimiter: str = "\t",
                      dash_as: int | None = MISSING_INT,
                      reject_column: str | None = None) -> DataFrame:
    """Typed columns from a one-column DataFrame of text lines.

    Tokens beyond the header are dropped, missing ones become null.  With
    ``reject_column`` a flag marks the lines with a missing or unreadable token.
    """
    line = lines.columns[0]
    escaped = "".join("\\" + c if c in r"\.|*+?()[]{}^$" else c for c in delimiter)
    tokens = lines.select(F.split(F.col(line), escaped).alias("_tokens"))
    typed, bad = [], []
    for i, (name, tag) in enumerate(header):
        token = F.get("_tokens", F.lit(i))
        value = parse_token(token, tag, dash_as)
        typed.append(value.alias(name))
        bad.append(value.isNull())
    if reject_column is not None:
        typed.append(reduce(or_, bad).alias(reject_column))
    return tokens.select(*typed)


def read_typed_text(spark: SparkSession, path: str, header: Header, **options) -> DataFrame:
    """Typed table from text files; ``path`` may hold a glob."""
    return parse_typed_lines(spark.read.text(path), header, **options)
