"""Streams over the test files, run to their end, and their batch twins."""

from pyspark.sql import functions as F

from tidewell.plans.registry import query, table
from tidewell.session import scratch_dir
from tidewell.sources import read_lake
from tidewell.streaming import (
    append_stream, count_words, decode_events, open_files, read_decoded, read_rejects,
    read_word_counts, start_decoding, start_word_count,
)

_WORD_COUNT_SQL = r"""
    SELECT word, count(*) AS count
    FROM (SELECT unnest(string_split_regex(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents)
    GROUP BY word"""


@query(_WORD_COUNT_SQL)
def word_count(spark, sf_dir):
    return count_words(table(spark, sf_dir, "documents"), "text")


def _stream(spark, sf_dir, name):
    # A glob, because a stream takes a plain path for a folder; the table may be either.
    return open_files(spark, f"{sf_dir}/{name}[.]parquet", table(spark, sf_dir, name).schema)


def _word_count_stream(spark, sf_dir, output_mode):
    path, state = scratch_dir(spark, "words"), scratch_dir(spark, "words-state")
    start_word_count(_stream(spark, sf_dir, "documents"), "text", path, state,
                     output_mode, state_partitions=int(spark.conf.get("spark.sql.shuffle.partitions"))
                     ).awaitTermination()
    return read_word_counts(spark, path, output_mode)


@query(_WORD_COUNT_SQL)
def stream_word_count(spark, sf_dir):
    return _word_count_stream(spark, sf_dir, "complete")


@query(_WORD_COUNT_SQL)
def stream_word_count_update(spark, sf_dir):
    """Only changed counts are written; the result is the same."""
    return _word_count_stream(spark, sf_dir, "update")


@query("""
    SELECT event_id AS "offset", strftime(ts, '%Y-%m-%d %H:%M:%S') AS readable_time,
           CAST(floor(epoch(ts)) AS BIGINT) AS epoch_time, props AS body
    FROM events""")
def stream_decode(spark, sf_dir):
    """Events as a message log delivers them, decoded and appended to a table."""
    raw = _stream(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("offset"),
        F.col("ts").alias("enqueuedTime"),
        F.col("props").cast("binary").alias("body"))
    decoded = decode_events(raw)
    path, state = scratch_dir(spark, "decoded"), scratch_dir(spark, "decoded-state")
    append_stream(decoded, path, state).awaitTermination()
    return read_lake(spark, path, decoded.schema).select(
        F.col("Offset").alias("offset"),
        F.date_format("Time (readable)", "yyyy-MM-dd HH:mm:ss").alias("readable_time"),
        F.col("Timestamp").alias("epoch_time"), F.col("Body").alias("body"))


@query("""
    WITH raw AS (
      SELECT CASE WHEN event_id % 7 = 3 THEN 'abc' || event_id WHEN event_id % 11 = 5 THEN NULL
               ELSE CAST(event_id AS VARCHAR) END AS "offset",
             CASE WHEN event_id % 13 = 4 THEN '2024-13-45 x' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
               AS enqueued, event_type, props FROM events),
    tried AS (
      SELECT *, try_cast("offset" AS BIGINT) AS number, try_cast(enqueued AS TIMESTAMP) AS arrived FROM raw),
    marked AS (
      SELECT *, concat_ws('; ',
        CASE WHEN "offset" IS NOT NULL AND number IS NULL THEN 'unreadable offset' END,
        CASE WHEN enqueued IS NOT NULL AND arrived IS NULL THEN 'unreadable enqueuedTime' END) AS reason
      FROM tried)
    SELECT reason, props AS body, count(*) AS n_events, count(number) AS n_offsets,
           CAST(sum(number) AS BIGINT) AS sum_offsets, CAST(max(floor(epoch(arrived))) AS BIGINT) AS last_time
    FROM marked GROUP BY reason, props""")
def stream_rejects(spark, sf_dir):
    """A message log with unreadable offsets and times: the stream goes on, and both outputs together
    hold every event once."""
    event = F.col("event_id")
    raw = _stream(spark, sf_dir, "events").select(
        F.when(event % 7 == 3, F.concat(F.lit("abc"), event.cast("string")))
        .when(event % 11 == 5, F.lit(None)).otherwise(event.cast("string")).alias("offset"),
        F.when(event % 13 == 4, "2024-13-45 x")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("enqueuedTime"),
        F.col("props").cast("binary").alias("body"))
    path, state = scratch_dir(spark, "messages"), scratch_dir(spark, "messages-state")
    start_decoding(raw, path, state).awaitTermination()
    both = read_decoded(spark, path).withColumn("reason", F.lit("")).unionByName(
        read_rejects(spark, path).withColumn("reason", F.regexp_replace("reason", ": [^;]*", "")))
    return both.groupBy("reason", F.col("Body").alias("body")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count("Offset").alias("n_offsets"),
        F.sum("Offset").alias("sum_offsets"), F.max("Timestamp").alias("last_time"))
