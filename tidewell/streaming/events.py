"""Stream sources, decoding of raw events, append sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewell.functions import EVENT_COLUMNS


def open_stream(spark: SparkSession, fmt: str, **options) -> DataFrame:
    """Stream from any installed connector, for instance a message log read from its
    end with ``startingOffsets="latest"``.  Options come from the caller."""
    return spark.readStream.format(fmt).options(**options).load()


def open_files(spark: SparkSession, path: str, schema: StructType | str,
               fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """Stream of the files that are in, or arrive in, a folder.

    ``files_per_batch`` bounds a batch, and with it what has to be done again after a
    failure.
    """
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", files_per_batch).load(path))


def decode_events(events: DataFrame, offset: str = "offset", enqueued: str = "enqueuedTime",
                  body: str = "body", reason: str | None = None) -> DataFrame:
    """Offset as a number, arrival as a timestamp and as epoch seconds, body as text.

    What cannot be read is null, so one bad event does not end a stream.  With ``reason`` a
    column of that name says what was wrong with it, and is null for events that could be read; a value
    that was null before is not an error.
    """
    arrived = F.col(enqueued).try_cast("timestamp")
    number = F.col(offset).try_cast("long")
    values = [number, arrived, arrived.cast("long"), F.col(body).cast("string")]
    decoded = [value.alias(name) for value, name in zip(values, EVENT_COLUMNS)]
    if reason is None:
        return events.select(*decoded)
    wrong = [F.when(F.col(name).isNotNull() & value.isNull(),
                    F.concat(F.lit(f"unreadable {name}: "), F.col(name).cast("string")))
             for name, value in ((offset, number), (enqueued, arrived))]
    found = F.concat_ws("; ", *wrong)
    return events.select(*decoded, F.when(found != "", found).alias(reason))


_DECODED = "Offset bigint, `Time (readable)` timestamp, Timestamp bigint, Body string, reason string"


def start_decoding(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                   **columns) -> StreamingQuery:
    """Decode a stream into good rows and rejects, each event exactly once, in one write a batch.

    Read them with ``read_decoded`` and ``read_rejects``.  A batch overwrites its own folder, so one that
    runs again after a failure does no harm.  ``columns`` names the columns, as in ``decode_events``.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_events(batch, **columns, reason="reason")
        (decoded.withColumn("rejected", F.col("reason").isNotNull().cast("int"))
         .write.mode("overwrite").partitionBy("rejected").parquet(f"{path}/batch_id={batch_id}"))

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _stored_events(spark: SparkSession, path: str, rejected: int) -> DataFrame:
    return (spark.read.schema(f"{_DECODED}, batch_id bigint, rejected int").parquet(path)
            .where(F.col("rejected") == rejected))


def read_decoded(spark: SparkSession, path: str) -> DataFrame:
    """The events that could be read; the folder of the others is not looked at."""
    return _stored_events(spark, path, 0).select(*[F.col(f"`{c}`") for c in EVENT_COLUMNS])


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The other events, with what could be read of them and the reason."""
    return _stored_events(spark, path, 1).select(*[F.col(f"`{c}`") for c in EVENT_COLUMNS], "reason")


def print_stream(stream: DataFrame) -> StreamingQuery:
    """Print a stream as it comes in, in full; for a look at small streams."""
    return (stream.writeStream.outputMode("append").format("console")
            .option("truncate", False).start())


def append_stream(stream: DataFrame, path: str, checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """Append a stream to a columnar table, each row exactly once.

    With ``available_now`` the query ends by itself once it has taken in what is
    there; call ``awaitTermination`` on the result to wait for that.
    """
    writer = (stream.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
