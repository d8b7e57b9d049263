"""Tables laid out so that a selective read skips most of their files and row groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, DataType, StructType

from tidewell.sources.files import read_lake


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str],
                    lookup: Mapping[str, int] | None = None, files: int | None = None,
                    row_group_bytes: int = 32 << 20, mode: str = "overwrite") -> DataFrame:
    """Write a table ordered by ``cluster_by`` across and within its files; return it freshly read.

    The footers keep the least and the greatest value of every row group, so a range of the
    leading column is read from the few row groups that hold it.  ``lookup`` names columns
    for which equality is asked while their values lie anywhere, with the number of distinct
    values to expect in a row group: they get a Bloom filter.

    The table is cut at quantiles of ``cluster_by`` and, among rows that are equal there, of
    a hash of the row and the task it comes from.  A value with a third of all rows becomes
    several files, and a task that runs again sends its rows to the same places.

    Without ``files`` there is a file for each shuffle partition, small ones joined at run time.
    """
    part = "_part"
    while part in df.columns:
        part += "_"
    keys = [F.col(f"`{c}`") for c in cluster_by]
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    ties = [F.xxhash64(*hashed), F.col(part)] if hashed else [F.col(part)]
    placed = df.select("*", F.spark_partition_id().alias(part))
    cut = (placed.repartitionByRange(*keys, *ties) if files is None
           else placed.repartitionByRange(files, *keys, *ties))
    writer = cut.drop(part).sortWithinPartitions(*keys).write.mode(mode).option("parquet.block.size", row_group_bytes)
    for name, values in (lookup or {}).items():
        # A dictionary of unique keys costs more than it saves, and would take the filter's place.
        writer = (writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{name}", values)
                  .option(f"parquet.enable.dictionary#{name}", "false"))
    writer.parquet(path)
    return read_lake(df.sparkSession, path, df.schema)


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return isinstance(kind, AtomicType)
