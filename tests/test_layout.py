"""Tables laid out for skipping, and batches that can be written again."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell.plans.history import backfill_batch
from tidewell.sinks import WriteLedger, write_batch, write_clustered
from tidewell.sources import file_rows, read_lake, rows_read

MANY = 200_000


@pytest.fixture
def shuffled(spark):
    """Keys in no order, and values spread over them."""
    return spark.range(0, MANY, numPartitions=4).select(
        F.col("id").alias("key"), (F.xxhash64("id") % 1_000_000).alias("value"))


def test_range_reads_few_row_groups_of_one_file(spark, shuffled, tmp_path):
    table = write_clustered(shuffled, str(tmp_path / "t"), ["value"], files=1, row_group_bytes=64 << 10)
    assert file_rows(spark, str(tmp_path / "t")).count() == 1
    part = table.where("value BETWEEN 1000 AND 2000")
    assert 0 < rows_read(part) < MANY / 4
    assert rows(part) == rows(shuffled.where("value BETWEEN 1000 AND 2000"))
    assert rows_read(table) == MANY


def test_bloom_filter_finds_a_key_that_lies_anywhere(spark, shuffled, tmp_path):
    plain = write_clustered(shuffled, str(tmp_path / "plain"), ["value"], files=16)
    table = write_clustered(shuffled, str(tmp_path / "t"), ["value"], {"key": MANY // 16}, files=16)
    unknown = shuffled.where("key % 7 != 3")
    holes = write_clustered(unknown, str(tmp_path / "holes"), ["value"], {"key": MANY // 16}, files=16)
    assert plain.count() == table.count() == MANY
    assert rows_read(table.where("key = 77777")) <= MANY / 4
    assert table.where("key = 77777").count() == 1
    assert rows_read(holes.where("key = 70003")) <= MANY / 4
    assert holes.where("key = 70003").count() == 0


@pytest.mark.parametrize("same_rows", [False, True])
def test_hot_value_is_several_files(spark, tmp_path, same_rows):
    table = spark.range(0, 40_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("value"),
        F.when((F.col("id") % 3 == 0) & F.lit(same_rows), 0).otherwise(F.col("id")).alias("id"))
    write_clustered(table, str(tmp_path / "t"), ["value"], files=12)
    biggest = file_rows(spark, str(tmp_path / "t")).agg(F.max("n_rows")).first()[0]
    assert biggest < 40_000 / 6
    assert rows(read_lake(spark, str(tmp_path / "t"))) == rows(table)


def test_nulls_maps_clashing_names_and_empty_tables(spark, tmp_path):
    table = spark.sql("""
        SELECT * FROM VALUES (1, map('a', 1), array(1.5D)), (NULL, map(), NULL), (1, NULL, array()) AS t(`k.1`, _part, xs)""")
    again = write_clustered(table, str(tmp_path / "t"), ["k.1"])
    assert again.columns == ["k.1", "_part", "xs"]
    assert rows(again, "`k.1`", "xs") == rows(table, "`k.1`", "xs")
    assert write_clustered(table.limit(0), str(tmp_path / "none"), ["k.1"]).count() == 0
    with pytest.raises(AnalysisException):  # maps have no order
        write_clustered(table, str(tmp_path / "maps"), ["_part"])


@pytest.fixture
def events(spark):
    return spark.createDataFrame([("open", 1469501107), ("close", 1469501108), ("open", 1469587507)],
                                 "action string, time bigint")


def test_batch_written_twice_counts_once(spark, events, tmp_path):
    path, ledger = str(tmp_path / "events"), WriteLedger(spark, str(tmp_path / "ledger"))
    backfill_batch(events, path, "2016-07", ledger=ledger)
    once = rows(backfill_batch(events, path, "history", shift="-172800", ledger=ledger))
    twice = backfill_batch(events, path, "history", shift="-172800", ledger=ledger)
    assert rows(twice) == once and len(once) == 6
    assert dict(twice.dtypes) == {"action": "string", "date": "string"}
    assert rows(ledger.read(), "version", "operation", "num_rows") == [
        (0, "BATCH 2016-07", 3), (1, "BATCH history", 3), (2, "BATCH history", 3)]


def test_batch_run_again_leaves_nothing_of_a_wrong_or_broken_run(spark, events, tmp_path):
    path = str(tmp_path / "events")
    backfill_batch(events, path, "7")
    right = rows(backfill_batch(events, path, "history", shift="-172800"))
    backfill_batch(events, path, "history", shift="-400000")
    broken = events.withColumn("action", F.when(F.col("time") > 1469501107, F.raise_error(F.lit("lost"))).otherwise("x"))
    with pytest.raises(Exception, match="lost"):
        backfill_batch(broken, path, "history", shift="-900000").count()
    assert rows(backfill_batch(events, path, "history", shift="-172800")) == right


def test_batches_prune_by_date(spark, events, tmp_path, plan_of):
    lake = backfill_batch(events, str(tmp_path / "events"), "a")
    filters = plan_of(lake.where("date = '2016-07-26'")).split("PartitionFilters: [")[1].split("]")[0]
    assert "2016-07-26" in filters


def test_batch_names(spark, events, tmp_path):
    for name in ("", "a/b", "a=b", "a b"):
        with pytest.raises(ValueError):
            write_batch(events, str(tmp_path / "t"), name)
    with pytest.raises(ValueError):
        write_batch(events.withColumn("Batch", F.lit(1)), str(tmp_path / "t"), "a")
