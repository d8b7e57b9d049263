"""Housekeeping of partitioned tables: size report and compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.catalog import partition_columns, refresh_table
from tidewell.operators.features import rank_by_count
from tidewell.operators.joins import sized_for_broadcast
from tidewell.session import materialize, stored_listing, with_conf
from tidewell.sinks.files import write_lake
from tidewell.sinks.ledger import WriteLedger
from tidewell.sinks.upsert import in_partitions

# Files of a partition that are packed together; more are dealt into several such lots.
LOT_FILES = 1000


def _data_files(spark: SparkSession, path: str) -> DataFrame:
    # One row per file, from the directory listing; no data file is opened.
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .load(path).drop("content"))


def partition_detail(spark: SparkSession, path: str,
                     partition_by: Sequence[str]) -> DataFrame:
    """Files and bytes of every partition, listed once."""
    files = (_data_files(spark, path)
             .groupBy(*[F.col(c).cast("string").alias(c) for c in partition_by])
             .agg(F.count(F.lit(1)).alias("num_files"),
                  F.sum("length").alias("size_in_bytes")))
    return stored_listing(files, "partition-detail")


def table_detail(spark: SparkSession, path: str,
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """One row: format, partition columns, number of partitions and files, bytes."""
    parts = partition_detail(spark, path, partition_by)
    return parts.agg(
        F.lit("parquet").alias("format"),
        F.lit(",".join(partition_by)).alias("partition_columns"),
        F.count(F.lit(1)).alias("num_partitions"),
        F.coalesce(F.sum("num_files"), F.lit(0)).cast("bigint").alias("num_files"),
        F.coalesce(F.sum("size_in_bytes"), F.lit(0)).cast("bigint").alias("size_in_bytes"))


def file_detail(table: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bytes and rows of every file that a table reads at present, found once.

    Unlike a listing this follows a catalog table whose partitions have been moved.  No
    data column is read, only the row counts of the files.
    """
    files = (table.groupBy(*partition_by, F.col("_metadata.file_path").alias("path"),
                           F.col("_metadata.file_size").alias("size_in_bytes"))
             .agg(F.count(F.lit(1)).alias("num_rows")))
    return stored_listing(files, "file-detail")


def compact(table: DataFrame, target: str, partition_by: Sequence[str],
            ledger: WriteLedger | None = None) -> DataFrame:
    """Rewrite a table of many small files into files of the advisory size.

    The result goes to a new folder, so that readers of the old one are not
    disturbed; point the catalog table at it with ``catalog.move_table``.  To rewrite
    no more than needed, use ``compact_table``.
    """
    return write_lake(table, target, partition_by, mode="errorifexists", rebalance=True,
                      ledger=ledger, operation="COMPACT")


def pack_files(files: DataFrame, partition_by: Sequence[str], file_bytes: int) -> DataFrame:
    """(partition columns, path, size_in_bytes, lot, bin): which files of a partition go together.

    First fit: the files of a lot, largest first, each into the first bin with room for it
    in ``file_bytes``.  A larger file has a bin to itself.  A lot is a partition's files, or one of the parts
    into which a hash of the path deals those of a partition with over ``LOT_FILES``.
    """
    parts = list(partition_by)
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"n.{c}")) for c in parts]
    lots = files.groupBy(*parts).agg(F.ceil(F.count(F.lit(1)) / F.lit(LOT_FILES)).alias("_lots"))
    dealt = (files.alias("f").join(sized_for_broadcast(lots).alias("n"), same or F.lit(True))
             .select(*[F.col(f"f.{c}").alias(c) for c in parts], "path", "size_in_bytes",
                     F.pmod(F.xxhash64("path"), F.col("_lots")).cast("int").alias("lot")))
    # The state of a lot: free bytes of each bin, and the bin of each file so far.
    first_fit = F.expr(f"""
        aggregate(_files,
          CAST(struct(array(), array()) AS struct<free: array<bigint>, bin: array<int>>),
          (s, f) -> transform(
            array(CAST(array_position(transform(s.free, x -> x >= f.size), true) AS int)),
            i -> IF(i = 0,
              named_struct('free', concat(s.free, array({file_bytes}L - f.size)),
                           'bin', concat(s.bin, array(size(s.free)))),
              named_struct('free', transform(s.free, (x, j) -> IF(j = i - 1, x - f.size, x)),
                           'bin', concat(s.bin, array(i - 1)))))[0],
          s -> s.bin)""")
    ordered = F.sort_array(F.collect_list(F.struct(
        (-F.col("size_in_bytes")).alias("_order"), F.col("path").alias("path"), F.col("size_in_bytes").alias("size"))))
    return (dealt.groupBy(*parts, "lot").agg(ordered.alias("_files"))
            .withColumn("_file", F.explode(F.arrays_zip(F.col("_files").alias("file"), first_fit.alias("bin"))))
            .select(*parts, F.col("_file.file.path").alias("path"), F.col("_file.file.size").alias("size_in_bytes"),
                    "lot", F.col("_file.bin").alias("bin")))


def compact_table(spark: SparkSession, name: str, file_bytes: int = 256 * 1024 * 1024,
                  ledger: WriteLedger | None = None) -> DataFrame:
    """Pack the files of a partitioned catalog table into fewer ones of up to ``file_bytes``.

    The partitions whose files ``pack_files`` fits into fewer bins are rewritten, a task and a file
    for each bin; the others are neither read nor written.  A second call finds something to do only
    where files have become smaller by being packed.
    They are overwritten in place, as in ``upsert_partitions``: nothing changes before the
    whole job has succeeded, and any number of partition columns, nulls and column types will do.
    A file with a bin to itself in such a partition is written again too.  The plan, one row a file,
    stays a table; the driver gets the number of bins.
    """
    parts = partition_columns(spark, name)
    table = refresh_table(spark, name)
    detail = file_detail(table, parts)
    packed = materialize(pack_files(detail, parts, file_bytes), "packed")
    fragmented = (packed.groupBy(*parts).agg(F.count(F.lit(1)).alias("_files"),
                                             F.countDistinct("lot", "bin").alias("_bins"))
                  .filter("_files > _bins"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"g.{c}")) for c in parts]
    plan = packed.alias("p").join(fragmented.alias("g"), same, "left_semi").withColumn(
        "_key", F.to_json(F.struct(*parts, "lot", "bin")))
    plan = materialize(plan.select(*parts, "path", "_key"), "plan")
    numbers = rank_by_count(plan.groupBy("_key").agg(F.count(F.lit(1)).alias("_files")), "_key", "_files", "_bin")
    bins = materialize(plan.join(numbers, "_key").select(
        F.col("path").alias("_path"), F.col("_bin").cast("int").alias("_bin")), "bins")
    last = bins.agg(F.max("_bin")).first()[0]
    if last is None:
        return table
    chosen = sized_for_broadcast(plan.groupBy(*parts).agg(F.count(F.lit(1)).alias("_files"))).filter("_files > 1")
    rows = (in_partitions(table.withColumn("_path", F.col("_metadata.file_path")), chosen, parts)
            .join(sized_for_broadcast(bins), "_path").repartitionById(last + 1, F.col("_bin")))
    with with_conf(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        rows.select(*table.columns).write.mode("overwrite").insertInto(name)
    if ledger is not None:
        ledger.record("COMPACT", "overwrite", parts, detail.join(plan.select("path"), "path").agg(
            F.sum("num_rows")).first()[0])
    return refresh_table(spark, name)
