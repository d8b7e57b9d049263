"""File sources: CSV, JSON lines, columnar tables, directory listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.session import scratch_dir, stored_listing, with_conf


# What lets text come back as it was: quotes are doubled, and outer blanks belong to the text.
CSV_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}


def _inferring(reader, schema: StructType | str | None, sampling_ratio: float | None):
    if schema is not None:
        return reader.schema(schema)
    reader = reader.option("inferSchema", True)
    return reader if sampling_ratio is None else reader.option("samplingRatio", sampling_ratio)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sampling_ratio: float | None = None, null_value: str | None = None,
             multi_line: bool = False, corrupt_column: str | None = None, **dialect) -> DataFrame:
    """CSV with a header row.

    ``multi_line`` reads quoted line breaks, at the price of one task for each file.
    ``dialect`` takes Spark's CSV options, such as ``sep``, ``quote`` and ``escape``.

    Without ``schema`` the types are inferred, which costs a full extra pass; give
    the schema on large inputs.  ``sampling_ratio`` makes that pass cheaper but may
    type a column too narrowly.

    With a schema and ``corrupt_column``, a line that does not fit the schema is kept as text in that
    column, which is null for the others; see ``split_rejects``.
    """
    reader = spark.read.options(**{**CSV_DIALECT, "header": True, "multiLine": multi_line, **dialect})
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return _keeping(_inferring(reader, schema, sampling_ratio), schema, corrupt_column).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              sampling_ratio: float | None = None, corrupt_column: str | None = None) -> DataFrame:
    """JSON lines, one file or a directory.  Keys absent from a record become null.

    ``corrupt_column`` is as in ``read_csv``.
    """
    return _keeping(_inferring(spark.read, schema, sampling_ratio), schema, corrupt_column).json(path)


def _keeping(reader, schema: StructType | str | None, corrupt_column: str | None):
    if corrupt_column is None:
        return reader
    if schema is None:
        raise ValueError("a corrupt column needs a schema")
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    return (reader.schema(fields.add(corrupt_column, "string")).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_column))


def split_rejects(df: DataFrame, corrupt_column: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The rows that fit their schema, the text of the others, and how many there are of each.

    The input is parsed once: rows are written to the shared folder, the good ones apart from the rejects, and
    counted on the way.
    """
    counted = Observation()
    flagged = df.withColumn("_rejected", F.col(corrupt_column).isNotNull().cast("int")).observe(
        counted, F.count_if(F.col("_rejected") == 0).alias("good"), F.count_if(F.col("_rejected") == 1).alias("rejected"))
    path = scratch_dir(df.sparkSession, "parsed")
    flagged.write.partitionBy("_rejected").parquet(path)
    stored = df.sparkSession.read.schema(flagged.schema).parquet(path)
    good = stored.where("_rejected = 0").drop("_rejected", corrupt_column)
    return good, stored.where("_rejected = 1").select(F.col(f"`{corrupt_column}`")), counted.get


def read_lake(spark: SparkSession, path: str,
              schema: StructType | str | None = None) -> DataFrame:
    """Columnar table by path.

    Folder names such as ``date=2024-01-01`` are read back as dates unless the
    schema says that the column is text.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_projected(spark: SparkSession, path: str, columns: Sequence[str],
                   predicate: Column | str, fmt: str = "parquet",
                   schema: StructType | str | None = None, **options) -> DataFrame:
    """Scan that hands the column list and the predicate to the source."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).where(predicate).select(*columns)


def rows_read(df: DataFrame) -> int:
    """Rows that the scans of ``df`` hand on when it is counted: what skipping files and row groups leaves.

    Runs the count, and takes the number from the metrics of its scans.
    """
    with with_conf(df.sparkSession, spark__sql__adaptive__enabled="false"):
        counted = df.agg(F.count(F.lit(1)))
        counted.collect()
        leaves = counted._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaf for leaf in (leaves.apply(i) for i in range(leaves.size())) if leaf.nodeName().startswith("Scan")]
    return sum(scan.metrics().apply("numOutputRows").value() for scan in scans)


def list_files(spark: SparkSession, path: str, pattern: str = "*",
               recursive: bool = False) -> DataFrame:
    """Files below ``path`` as rows (path, length, modificationTime), listed once.

    The content column is pruned, so no file is opened.  As in any Spark scan, empty
    files and names that start with ``_`` or ``.`` do not count as data.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return stored_listing(reader.load(path).select("path", "length", "modificationTime"), "listing")


def file_rows(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length, n_rows) of all columnar files below ``path``, whatever their columns.

    One scan that reads no column: the numbers of rows stand in the files' footers.
    """
    files = (spark.read.schema("_none int").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", True).parquet(path))
    return stored_listing(
        files.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))
        .agg(F.count(F.lit(1)).alias("n_rows")), "file-rows")
