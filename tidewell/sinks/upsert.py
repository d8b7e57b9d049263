"""Insert or replace rows by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.catalog import delete_partitions, move_table, partition_columns, refresh_table
from tidewell.operators.joins import sized_for_broadcast
from tidewell.session import materialize, with_conf
from tidewell.sinks.files import write_lake
from tidewell.sinks.ledger import WriteLedger


def _require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    checked = {
        key: F.coalesce(F.col(key), F.raise_error(F.lit(f"null in key column {key}")))
        for key in keys
    }
    return df.withColumns(checked)


def latest_per_key(df: DataFrame, keys: Sequence[str],
                   order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` values of every key.

    An aggregate, not a window: every map task reduces a key to one row before the
    shuffle, so a key with very many rows does not end up in one task.  Rows that
    tie on ``order_by`` are told apart by their other columns, which keeps the
    result the same from run to run.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = F.max(F.struct(*order_by, *rest)).alias("_latest")
    return (df.groupBy(*keys).agg(ranked)
            .select(*[F.col(c) if c in keys else F.col(f"_latest.{c}").alias(c)
                      for c in df.columns]))


def keyed_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` inserted, or put in place of the row
    with the same key.

    ``source`` may hold several rows of a key, the latest counts; its ``order_by``
    columns need not exist in ``target``.  ``source`` is read once: its latest rows
    are stored, and the anti join sees only their keys; whether these are broadcast is
    decided from their real size at run time.
    """
    latest = materialize(latest_per_key(_require_keys(source, keys), keys, order_by), "latest")
    untouched = target.join(latest.select(*keys), list(keys), "left_anti")
    return untouched.select(*target.columns).unionByName(latest.select(*target.columns))


def upsert_table(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str], path: str, partition_by: Sequence[str] = (),
                 ledger: WriteLedger | None = None) -> DataFrame:
    """Upsert into a catalog table by rewriting it.

    The result is written to the new folder ``path`` and the table then points there:
    a plain file table cannot be read and overwritten at once, and a job that fails
    half-way leaves the table as it was.  ``upsert_partitions`` rewrites only what changes.
    """
    merged = keyed_upsert(spark.table(name), source, keys, order_by)
    write_lake(merged, path, partition_by, mode="errorifexists", ledger=ledger,
               operation="UPSERT")
    return move_table(spark, name, path, partitioned=bool(partition_by))


def touched_partitions(target: DataFrame, latest: DataFrame, keys: Sequence[str],
                       partition_by: Sequence[str]) -> DataFrame:
    """The partitions that an upsert of ``latest`` (one row per key) changes, with
    ``_changed``, the rows of the target that it replaces and the rows that it brings, and
    ``_left``, the rows that the partition then holds.

    Of the target only keys and partition columns are read.  A key that contains the
    partition columns cannot lie elsewhere; then only the partitions of ``latest`` are.
    """
    parts = list(partition_by)
    fresh = latest.groupBy(*parts).agg(F.count(F.lit(1)).alias("_new"))
    rows = target.select(*dict.fromkeys([*keys, *parts]))
    if set(parts) <= set(keys):
        rows = in_partitions(rows, sized_for_broadcast(fresh).filter("_new > 0"), parts)
    known = latest.select(*keys).withColumn("_hit", F.lit(1))
    old = (rows.join(known, list(keys), "left").groupBy(*parts)
           .agg(F.count(F.lit(1)).alias("_rows"), F.count("_hit").alias("_hits")))
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in parts]
    count = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("_rows", "_hits", "_new")}
    return (old.alias("o").join(fresh.alias("n"), same, "full_outer")
            .select(*[F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c) for c in parts],
                    (count["_hits"] + count["_new"]).alias("_changed"),
                    (count["_rows"] - count["_hits"] + count["_new"]).alias("_left"))
            .filter("_changed > 0"))


def in_partitions(rows: DataFrame, chosen: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The rows in the partitions listed in ``chosen``.

    An equality join, so that Spark prunes the partitions at run time; partitions of null are read
    by a filter and a join of their own.
    """
    parts = list(partition_by)
    has_null = " OR ".join(f"`{c}` IS NULL" for c in parts)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in parts]
    nulls = rows.where(has_null).alias("r").join(
        chosen.where(has_null).select(*parts).alias("c"), same, "left_semi")
    return rows.join(chosen.select(*parts), parts, "left_semi").unionByName(nulls)


def upsert_partitions(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str],
                      order_by: Sequence[str], ledger: WriteLedger | None = None) -> DataFrame:
    """Upsert into a partitioned catalog table, rewriting only the partitions it changes.

    These are the ones that hold a key of ``source`` and the ones that its rows go to, since a row
    may move to another partition.  They are overwritten in place: Spark writes them aside and
    puts them there when the whole job has succeeded, so a job that fails leaves the table
    as it was, and the files of all other partitions stay.  Partitions that lose their last
    row are taken from the table and deleted.  What comes to the driver are these
    emptied partitions alone.  As with any plain file table, a reader during the last moves may
    see old and new partitions side by side.
    """
    parts = partition_columns(spark, name)
    if not parts:
        raise ValueError(f"table {name} has no partitions; use upsert_table")
    target = refresh_table(spark, name)
    latest = materialize(latest_per_key(_require_keys(source, keys), keys, order_by), "latest")
    touched = materialize(touched_partitions(target, latest, keys, parts), "touched")
    if touched.isEmpty():
        return target
    chosen = sized_for_broadcast(touched).filter("_changed > 0")
    untouched = (in_partitions(target, chosen, parts)
                 .join(latest.select(*keys), list(keys), "left_anti"))
    merged = untouched.select(*target.columns).unionByName(latest.select(*target.columns))
    with with_conf(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        (merged.hint("rebalance", *parts).write.mode("overwrite").insertInto(name))
    delete_partitions(spark, name, touched.where("_left = 0").select(*parts))
    if ledger is not None:
        ledger.record("UPSERT", "overwrite", parts, touched.agg(F.sum("_left")).first()[0])
    return refresh_table(spark, name)
