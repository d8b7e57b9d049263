"""File sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewell.sinks.ledger import WriteLedger
from tidewell.sources.files import CSV_DIALECT, read_lake


def write_lake(df: DataFrame, path: str, partition_by: Sequence[str] = (),
               mode: str = "overwrite", rebalance: bool = True,
               ledger: WriteLedger | None = None, operation: str = "WRITE") -> DataFrame:
    """Write a columnar table and return it freshly read.

    A DataFrame made over a path before a write does not see the new files, hence
    the fresh read.

    ``rebalance`` shuffles the rows by the partition columns, so that a partition
    gets a few files of the advisory size and not one file per task; at run time
    Spark splits the partitions that are too large and joins those that are too
    small, so one huge date becomes several tasks.  Input that is already clustered
    by the partition columns should be written with ``rebalance=False``, without a
    shuffle.
    """
    rows = df
    if partition_by and rebalance:
        rows = rows.hint("rebalance", *partition_by)
    counted = Observation()
    if ledger is not None:
        # Counted in the writing stage itself: each task counts once, even if a
        # lost executor makes an earlier stage run again.
        rows = rows.observe(counted, F.count(F.lit(1)).alias("num_rows"))
    writer = rows.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if ledger is not None:
        ledger.record(operation, mode, partition_by, counted.get["num_rows"])
    return read_lake(df.sparkSession, path, df.schema)


def write_batch(df: DataFrame, path: str, batch: str, partition_by: Sequence[str] = (),
                batch_column: str = "batch", rebalance: bool = True,
                ledger: WriteLedger | None = None) -> DataFrame:
    """Add the rows of one named batch to the table at ``path``; return the whole table without ``batch_column``.

    The outermost partition of the table is its batch.  Writing a batch again replaces all
    that an earlier run of it left, be that whole, broken off, or on other dates, and touches
    no other batch: a job that is started twice adds its rows once.  While it runs, the batch
    is incomplete for readers.
    """
    if not re.fullmatch("[A-Za-z0-9._-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, dots, dashes and underscores, not {batch!r}")
    if batch_column.lower() in [c.lower() for c in df.columns]:
        raise ValueError(f"the rows have a column {batch_column!r} already")
    write_lake(df, f"{path.rstrip('/')}/{batch_column}={batch}", partition_by, "overwrite", rebalance,
               ledger, f"BATCH {batch}")
    schema = StructType([*df.schema.fields, StructField(batch_column, StringType())])
    return read_lake(df.sparkSession, path, schema).drop(batch_column)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = "",
               **dialect) -> str:
    """Flat export with a header line in every file and no row index.

    Outer blanks stay, quotes are doubled, and text with a line break is one quoted field, to be read
    with ``read_csv(multi_line=True)``.  To tell null from the empty text, give a
    ``null_value`` that no text has, here and in ``read_csv``.  ``dialect`` takes
    Spark's CSV options.
    """
    options = {**CSV_DIALECT, "header": True, "nullValue": null_value, **dialect}
    df.write.mode(mode).options(**options).csv(path)
    return path
