"""History of the writes to a table, kept as an append-only table of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = ("version bigint, written_at timestamp, written_by string, operation string, "
                 "mode string, partition_by string, num_rows bigint")


class WriteLedger:
    """One row per write, appended after the write has succeeded.

    One writer per table is assumed, as for any plain file table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def record(self, operation: str, mode: str, partition_by: Sequence[str],
               num_rows: int) -> None:
        version = self._next_version()
        row = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"),
            F.current_timestamp().alias("written_at"),
            F.current_user().alias("written_by"),
            F.lit(operation).alias("operation"),
            F.lit(mode).alias("mode"),
            F.lit(",".join(partition_by)).alias("partition_by"),
            F.lit(num_rows).cast("bigint").alias("num_rows"))
        row.write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        """Who wrote what and when, in no particular order."""
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def _next_version(self) -> int:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return 0
        last = self.read().agg(F.max("version")).first()[0]
        return 0 if last is None else last + 1
