import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell.sources import read_lake
from tidewell.streaming import (
    append_stream, count_words, decode_events, open_files, open_stream, print_stream, read_decoded,
    read_rejects, read_word_counts, start_decoding, start_word_count,
)

TEXTS = ["a b", "b  c", " a", "b", None, "c c c"]


@pytest.fixture
def folder(spark, tmp_path):
    path = tmp_path / "in"
    for i, text in enumerate(TEXTS):
        spark.createDataFrame([(text,)], "body string").coalesce(1).write.mode(
            "append").parquet(str(path))
    return str(path)


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_word_count_over_several_batches(spark, folder, tmp_path, mode):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream = open_files(spark, folder, "body string", files_per_batch=2)
    query = start_word_count(stream, "body", out, state, mode, state_partitions=4)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    batch = count_words(spark.read.parquet(folder), "body")
    assert rows(read_word_counts(spark, out, mode)) == rows(batch)
    if mode == "complete":
        assert len(os.listdir(out)) == 2

    # New files are taken up where the last run stopped.
    spark.createDataFrame([("z a",)], "body string").write.mode("append").parquet(folder)
    stream = open_files(spark, folder, "body string", files_per_batch=2)
    start_word_count(stream, "body", out, state, mode, state_partitions=4).awaitTermination()
    batch = count_words(spark.read.parquet(folder), "body")
    assert rows(read_word_counts(spark, out, mode)) == rows(batch)


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_a_batch_that_runs_again_does_no_harm(spark, folder, tmp_path, mode):
    """As after a driver that died between writing a batch and recording it."""
    out, state = str(tmp_path / "out"), tmp_path / "state"
    for _ in range(2):
        stream = open_files(spark, folder, "body string", files_per_batch=3)
        query = start_word_count(stream, "body", out, str(state), mode, state_partitions=4)
        query.awaitTermination()
        counted = rows(read_word_counts(spark, out, mode))
        assert counted == rows(count_words(spark.read.parquet(folder), "body"))
        last = max((f for f in (state / "commits").iterdir() if f.name.isdigit()),
                   key=lambda f: int(f.name))
        last.unlink()
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert any(p["numInputRows"] > 0 for p in query.recentProgress)


def test_update_folders_stay_bounded(spark, tmp_path):
    """Twenty batches, each with a word of its own and one that all share."""
    source, out = tmp_path / "source", tmp_path / "out"
    for i in range(20):
        spark.createDataFrame([(f"shared own{i}",)], "body string").coalesce(1).write.mode(
            "append").parquet(str(source))
    stream = open_files(spark, str(source), "body string", files_per_batch=1)
    start_word_count(stream, "body", str(out), str(tmp_path / "state"), "update",
                     state_partitions=2, merge_every=4).awaitTermination()
    assert rows(read_word_counts(spark, str(out), "update")) == rows(
        count_words(spark.read.parquet(str(source)), "body"))
    kept = [int(f.name.split("=")[1]) for f in out.iterdir() if f.name.startswith("batch_id=")]
    assert max(kept) == 19 and len(kept) <= 8


def test_decode(spark):
    raw = spark.createDataFrame([("12", 1469501107, b"hello")],
                                "offset string, enqueuedTime bigint, body binary")
    raw = raw.withColumn("enqueuedTime", F.timestamp_seconds("enqueuedTime"))
    decoded = decode_events(raw)
    assert decoded.dtypes == [("Offset", "bigint"), ("Time (readable)", "timestamp"),
                              ("Timestamp", "bigint"), ("Body", "string")]
    row = decoded.select(
        "Offset", F.col("Time (readable)").cast("string").alias("t"), "Timestamp",
        "Body").first()
    assert tuple(row) == (12, "2016-07-26 02:45:07", 1469501107, "hello")


def test_append_sink_takes_each_row_once(spark, folder, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        stream = open_files(spark, folder, "body string", files_per_batch=1)
        append_stream(stream, out, state).awaitTermination()
    assert rows(read_lake(spark, out, "body string")) == rows(spark.read.parquet(folder))


def test_any_connector(spark):
    stream = open_stream(spark, "rate", rowsPerSecond=1)
    assert stream.isStreaming and stream.columns == ["timestamp", "value"]


def test_printed_stream(spark, folder):
    query = print_stream(open_files(spark, folder, "body string", files_per_batch=100))
    query.processAllAvailable()
    query.stop()
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(TEXTS)
    assert "Console" in query.lastProgress["sink"]["description"]


RAW = "offset string, enqueuedTime string, body binary"


def test_a_stream_goes_on_after_unreadable_events(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [[("1", "2024-01-01 00:00:00", b"a"), ("abc", "2024-01-01 00:00:01", b"b")],
               [(None, None, None), ("99999999999999999999", "not a time", b"\xff")],
               [("4", "2024-01-01 00:00:04", b"")]]
    for batch in batches:
        spark.createDataFrame(batch, RAW).coalesce(1).write.mode("append").parquet(folder)
    for _ in range(2):  # the second run takes the last batch again
        query = start_decoding(open_files(spark, folder, RAW, files_per_batch=1), out, state)
        query.awaitTermination()
        assert query.exception() is None
        good = sorted((r["Offset"], r["Timestamp"], r["Body"]) for r in read_decoded(spark, out).collect()
                      if r["Offset"] is not None)
        assert good == [(1, 1704067200, "a"), (4, 1704067204, "")]
        assert read_decoded(spark, out).count() == 3
        found = {r["reason"]: (r["Offset"], r["Timestamp"]) for r in read_rejects(spark, out).collect()}
        assert found == {"unreadable offset: abc": (None, 1704067201),
                         "unreadable offset: 99999999999999999999; unreadable enqueuedTime: not a time": (None, None)}
        last = max((f for f in (tmp_path / "state" / "commits").iterdir() if f.name.isdigit()),
                   key=lambda f: int(f.name))
        last.unlink()
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)


def test_decode_without_a_reason_gives_nulls(spark):
    raw = spark.createDataFrame([("x", "y", b"z")], RAW)
    assert rows(decode_events(raw)) == [(None, None, None, "z")]
