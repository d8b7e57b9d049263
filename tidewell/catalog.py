"""Tables, views and caches of the session catalog."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _quoted(name: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_external_table(spark: SparkSession, name: str, path: str, schema: StructType,
                          partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace table ``name`` by one over the files at ``path``.

    The schema is declared, so that no file is read for it and partition columns
    keep their type.  Partitions exist for the catalog only after the repair.
    """
    drop_table(spark, name)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(f"CREATE TABLE {_quoted(name)} ({columns}) USING parquet "
              + (f"PARTITIONED BY ({parts}) " if parts else "")
              + f"LOCATION {_literal(path)}")
    return refresh_table(spark, name, partitioned=bool(partition_by))


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def refresh_table(spark: SparkSession, name: str, partitioned: bool = False) -> DataFrame:
    """Forget cached metadata, pick up new partitions and return the table anew."""
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {_quoted(name)}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def move_table(spark: SparkSession, name: str, path: str,
               partitioned: bool = False) -> DataFrame:
    """Let a table point at another folder, for instance after a rewrite.

    A partitioned table is made anew under another name, with all its partitions, and then
    takes the place of the old one by two renames.  A failure before that leaves the old
    table as it was, one between the renames gives it its name back.
    """
    if not partitioned:
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION {_literal(path)}")
        return refresh_table(spark, name)
    mark = uuid.uuid4().hex[:8]
    following, former = f"{name}_next_{mark}", f"{name}_former_{mark}"
    try:
        create_external_table(spark, following, path, spark.table(name).schema,
                              partition_columns(spark, name))
        _rename(spark, name, former)
        try:
            _rename(spark, following, name)
        except Exception:
            _rename(spark, former, name)
            raise
    except Exception:
        drop_table(spark, following)
        raise
    drop_table(spark, former)
    return refresh_table(spark, name)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(old)} RENAME TO {_quoted(new)}")


def _partition_spec(values: Mapping[str, object]) -> str:
    return "PARTITION (" + ", ".join(
        f"`{c}`={'NULL' if v is None else _literal(str(v))}" for c, v in values.items()) + ")"


def delete_partitions(spark: SparkSession, name: str, partitions: DataFrame) -> None:
    """Take the listed partitions out of a table, in one statement, and delete their files.

    ``partitions`` holds the partition columns, one row each, and comes to the driver.
    """
    specs = [r.asDict() for r in partitions.collect()]
    if not specs:
        return
    folders = [_partition_folder(spark, name, s) for s in specs]
    spark.sql(f"ALTER TABLE {_quoted(name)} DROP IF EXISTS "
              + ", ".join(_partition_spec(s) for s in specs))
    for folder in folders:  # an external table keeps its files, and a repair would find them
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _partition_folder(spark: SparkSession, name: str, values: Mapping[str, object]) -> str:
    same = reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in values.items()])
    file = spark.table(name).where(same).select("_metadata.file_path").first()[0]
    return unquote(file.rsplit("/", 1)[0])


def move_partitions(spark: SparkSession, name: str, column: str,
                    locations: Mapping[str, str]) -> DataFrame:
    """Let single partitions point at other folders; the rest stays where it is.

    None stands for the partition of null.
    """
    for value, path in locations.items():
        spark.sql(f"ALTER TABLE {_quoted(name)} {_partition_spec({column: value})} "
                  f"SET LOCATION {_literal(path)}")
    return refresh_table(spark, name)


def describe_table(spark: SparkSession, name: str, formatted: bool = True) -> DataFrame:
    kind = "FORMATTED " if formatted else ""
    return spark.sql(f"DESCRIBE TABLE {kind}{_quoted(name)}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    return spark.sql("SHOW TABLES" + (f" IN {_quoted(database)}" if database else ""))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL and return the view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def cache_table(spark: SparkSession, name: str, lazy: bool = False) -> None:
    spark.sql(f"CACHE {'LAZY ' if lazy else ''}TABLE {_quoted(name)} "
              "OPTIONS ('storageLevel' 'MEMORY_AND_DISK')")


def uncache_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"UNCACHE TABLE IF EXISTS {_quoted(name)}")


def clear_cache(spark: SparkSession) -> None:
    spark.catalog.clearCache()


@contextmanager
def cached_table(spark: SparkSession, name: str, lazy: bool = False) -> Iterator[DataFrame]:
    """Keep a table cached for the length of a ``with`` block."""
    cache_table(spark, name, lazy)
    try:
        yield spark.table(name)
    finally:
        uncache_table(spark, name)
