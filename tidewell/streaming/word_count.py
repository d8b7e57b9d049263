"""Word count, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.functions import words
from tidewell.session import with_conf

RESULT_SCHEMA = "word string, count bigint, batch_id bigint"


def count_words(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of every word.  Null text has no words.

    On a stream this keeps one state row per distinct word for ever, because there
    is no point after which a word is finished.
    """
    return (df.select(F.explode(words(F.col(text))).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def _batches(spark: SparkSession, path: str) -> dict[int, bool]:
    """The batch folders, and whether each is finished: the writer adds the marker after
    the last file."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = {}
    for found in fs.globStatus(folder) or ():
        marker = spark._jvm.org.apache.hadoop.fs.Path(found.getPath(), "_SUCCESS")
        done[int(found.getPath().getName().split("=")[1])] = fs.exists(marker)
    return done


def _drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch_id}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def start_word_count(stream: DataFrame, text: str, path: str, checkpoint: str,
                     output_mode: str = "complete", available_now: bool = True, *,
                     state_partitions: int, merge_every: int = 10) -> StreamingQuery:
    """Keep a table of word counts up to date; read it with ``read_word_counts``.

    ``complete`` writes the whole table in every batch and keeps the last two versions.
    ``update`` writes only the words whose count changed, which is what to use once the
    vocabulary is large; every ``merge_every`` batches one folder takes up all earlier counts, and
    folders before the previous merge go, so at most twice that many stay.  A batch
    overwrites its own folder, so a batch that is run again after a failure does no harm.

    The state is spread over ``state_partitions``.  Their number is fixed by the first start
    on a checkpoint folder, so choose it for the size that the vocabulary will reach.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        if not _batches(own, path).get(batch_id):  # a merge run again may miss folders
            earlier = read_word_counts(own, path, "update", before=batch_id)
            (earlier.unionByName(batch.select("word", "count")).groupBy("word")
             .agg(F.max("count").alias("count"))
             .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
        for old in _batches(own, path):
            if old < batch_id - merge_every:
                _drop_batch(own, path, old)

    def store(batch: DataFrame, batch_id: int) -> None:
        if output_mode == "update" and batch_id % merge_every == merge_every - 1:
            merge(batch, batch_id)
            return
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if output_mode == "complete":
            _drop_batch(spark, path, batch_id - 2)

    writer = (count_words(stream, text).writeStream.outputMode(output_mode)
              .option("checkpointLocation", checkpoint).foreachBatch(store))
    if available_now:
        writer = writer.trigger(availableNow=True)
    with with_conf(spark, spark__sql__shuffle__partitions=state_partitions):
        return writer.start()


def read_word_counts(spark: SparkSession, path: str,
                     output_mode: str = "complete", before: int | None = None) -> DataFrame:
    """Current word counts, as of the last finished batch (``before`` the given one)."""
    done = {batch: whole and (before is None or batch < before)
            for batch, whole in _batches(spark, path).items()}
    batches = spark.read.schema(RESULT_SCHEMA).parquet(path)
    if output_mode == "update":
        # Counts only grow, so the largest one is the latest.
        broken = [batch for batch, whole in done.items() if not whole]
        return (batches.where(~F.col("batch_id").isin(broken)).groupBy("word")
                .agg(F.max("count").alias("count")))
    latest = max([batch for batch, whole in done.items() if whole], default=-1)
    return batches.where(F.col("batch_id") == latest).select("word", "count")
