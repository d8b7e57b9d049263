"""Dated event tables and their backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import HISTORY_SHIFT_SECONDS, day_of_epoch, epoch_date
from tidewell.sinks import WriteLedger, write_batch, write_lake


def dated(events: DataFrame, time: str = "time", date: str = "date",
          shift: str = "0") -> DataFrame:
    """Replace epoch seconds by a date, moved by ``shift`` seconds (a SQL expression)."""
    seconds = F.expr(f"`{time}` + ({shift})")
    return events.withColumn(date, epoch_date(seconds)).drop(time)


def write_with_history(events: DataFrame, path: str, time: str = "time",
                       ledger: WriteLedger | None = None) -> DataFrame:
    """Write events partitioned by date, then append them again moved into the past."""
    write_lake(dated(events, time), path, ["date"], "overwrite", ledger=ledger)
    past = dated(events, time, shift=f"-{HISTORY_SHIFT_SECONDS}")
    return write_lake(past, path, ["date"], "append", ledger=ledger)


def backfill_batch(events: DataFrame, path: str, batch: str, time: str = "time", shift: str = "0",
                   ledger: WriteLedger | None = None) -> DataFrame:
    """Events by date, moved by ``shift`` seconds, as one batch of the table; running it again changes nothing."""
    return write_batch(dated(events, time, shift=shift), path, batch, ["date"], ledger=ledger)


def daily_counts(events: DataFrame, action: str, date: str = "date",
                 name: str = "action_count") -> DataFrame:
    """Events per action and date of a dated table, in that order."""
    return (events.groupBy(action, date).agg(F.count(action).alias(name))
            .orderBy(date, action))


def daily_counts_of_raw(events: DataFrame, action: str, seconds, date: str = "date",
                        name: str = "action_count") -> DataFrame:
    """The same from epoch seconds: grouped by the day as a number of days, written
    as text once per group and not once per event."""
    return (events.groupBy(action, day_of_epoch(seconds).alias("_day"))
            .agg(F.count(action).alias(name))
            .select(action, F.col("_day").cast("string").alias(date), name)
            .orderBy(date, action))
