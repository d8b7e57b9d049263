import os
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell import catalog
from tidewell.plans.history import daily_counts, dated, write_with_history
from tidewell.session import with_conf
from tidewell.sinks import (
    WriteLedger, compact, compact_table, export_csv, keyed_upsert, latest_per_key, maintenance, pack_files, partition_detail,
    table_detail, upsert_partitions, upsert_table, write_lake,
)
from tidewell.sources import list_files, read_lake


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [("open", 1469501107), ("close", 1469501108), ("open", 1469587507),
         (None, 1469587508)], "action string, time bigint")




def test_dated(spark, events):
    result = dated(events)
    assert result.columns == ["action", "date"]
    assert rows(result) == [(None, "2016-07-27"), ("close", "2016-07-26"),
                            ("open", "2016-07-26"), ("open", "2016-07-27")]


def test_backfill_doubles_the_table(spark, events, tmp_path):
    path = str(tmp_path / "events")
    before = write_lake(dated(events), path, ["date"])
    assert before.count() == 4
    lake = write_with_history(events, path)
    assert lake.count() == 8
    assert dict(lake.dtypes)["date"] == "string"
    # Null actions are not counted, but their group is there.
    counts = [(r["date"], r["action"], r["action_count"])
              for r in daily_counts(lake, "action").collect()]
    assert counts == [
        ("2016-07-24", "close", 1), ("2016-07-24", "open", 1),
        ("2016-07-25", None, 0), ("2016-07-25", "open", 1),
        ("2016-07-26", "close", 1), ("2016-07-26", "open", 1),
        ("2016-07-27", None, 0), ("2016-07-27", "open", 1)]


def test_partition_pruning(spark, events, tmp_path, plan_of):
    lake = write_with_history(events, str(tmp_path / "events"))
    plan = plan_of(lake.where("date = '2016-07-26'"))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2016-07-26" in filters


def test_ledger(spark, events, tmp_path):
    ledger = WriteLedger(spark, str(tmp_path / "ledger"))
    path = str(tmp_path / "events")
    lake = write_with_history(events, path, ledger=ledger)
    compact(lake, str(tmp_path / "compacted"), ["date"], ledger)
    history = ledger.read()
    assert rows(history, "version", "operation", "mode", "partition_by", "num_rows") == [
        (0, "WRITE", "overwrite", "date", 4), (1, "WRITE", "append", "date", 4),
        (2, "COMPACT", "errorifexists", "date", 8)]
    assert history.where("written_at IS NULL OR written_by IS NULL").count() == 0


def test_compaction_keeps_the_rows(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    many = spark.range(0, 4000, numPartitions=20).select(
        "id", F.concat(F.lit("d"), (F.col("id") % 4).cast("string")).alias("date"))
    lake = write_lake(many, source, ["date"], rebalance=False)
    assert rows(partition_detail(spark, source, ["date"]), "date", "num_files") == [
        (f"d{i}", 20) for i in range(4)]
    compacted = compact(lake, target, ["date"])
    assert rows(partition_detail(spark, target, ["date"]), "date", "num_files") == [
        (f"d{i}", 1) for i in range(4)]
    assert rows(compacted.groupBy("date").agg(F.count("*"), F.sum("id"))) == rows(
        many.groupBy("date").agg(F.count("*"), F.sum("id")))


def test_a_hot_date_is_written_by_several_tasks(spark, tmp_path):
    """Half of all rows have one date; it must not end up in one task."""
    hot = spark.range(0, 400_000, numPartitions=16).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 2 == 0, "hot")
        .otherwise(F.concat(F.lit("d"), (F.col("id") % 16).cast("string"))).alias("date"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, "64MB")
    spark.conf.set(key, "2MB")
    try:
        path = str(tmp_path / "hot")
        lake = write_lake(hot, path, ["date"])
    finally:
        spark.conf.set(key, before)
    files = dict(rows(partition_detail(spark, path, ["date"]), "date", "num_files"))
    assert files["hot"] > 3
    assert lake.count() == 400_000


def test_table_detail(spark, events, tmp_path):
    path = str(tmp_path / "events")
    write_with_history(events, path)
    files = [f for f in Path(path).rglob("*.parquet")]
    detail = table_detail(spark, path, ["date"]).first()
    assert detail["format"] == "parquet" and detail["partition_columns"] == "date"
    assert detail["num_partitions"] == 4
    assert detail["num_files"] == len(files)
    assert detail["size_in_bytes"] == sum(os.path.getsize(f) for f in files)


def test_csv_export_has_a_header_and_no_index(spark, tmp_path):
    path = export_csv(spark.createDataFrame([(1, "a")], "id int, name string").coalesce(1),
                      str(tmp_path / "out"))
    text = [f.read_text() for f in Path(path).glob("*.csv")]
    assert text == ["id,name\n1,a\n"]


@pytest.fixture
def book(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")


def test_upsert(spark, book):
    source = spark.createDataFrame(
        [(2, "B1", 1), (2, "B2", 2), (4, "D", 1), (4, "d", 1)], "id int, name string, seq int")
    merged = keyed_upsert(book, source, ["id"], ["seq"])
    assert rows(merged) == [(1, "a"), (2, "B2"), (3, "c"), (4, "d")]
    assert merged.columns == ["id", "name"]


def test_upsert_again_changes_nothing(spark, book):
    source = spark.createDataFrame([(2, "B", 1), (4, "d", 1)], "id int, name string, seq int")
    once = keyed_upsert(book, source, ["id"], ["seq"])
    assert rows(keyed_upsert(once, source, ["id"], ["seq"])) == rows(once)


def test_upsert_by_two_keys_and_two_orders(spark):
    target = spark.createDataFrame([(1, "x", 0.5), (1, "y", 0.5)], "a int, b string, v double")
    source = spark.createDataFrame(
        [(1, "x", 1.0, 2, 1), (1, "x", 2.0, 1, 9), (2, "x", 3.0, 1, 1), (1, "x", 4.0, 2, 2)],
        "a int, b string, v double, day int, seq int")
    merged = keyed_upsert(target, source, ["a", "b"], ["day", "seq"])
    assert rows(merged) == [(1, "x", 4.0), (1, "y", 0.5), (2, "x", 3.0)]


def test_upsert_table(spark, book, tmp_path):
    ledger = WriteLedger(spark, str(tmp_path / "ledger"))
    rows_by_kind = book.withColumn("kind", F.lit("k"))
    stored = write_lake(rows_by_kind, str(tmp_path / "a"), ["kind"])
    catalog.create_external_table(spark, "unit_book", str(tmp_path / "a"), stored.schema,
                                  ["kind"])
    source = spark.createDataFrame([(3, "C", "m", 1), (9, "i", "k", 1)],
                                   "id int, name string, kind string, seq int")
    after = upsert_table(spark, "unit_book", source, ["id"], ["seq"], str(tmp_path / "b"),
                         ["kind"], ledger)
    assert rows(after) == [(1, "a", "k"), (2, "b", "k"), (3, "C", "m"), (9, "i", "k")]
    assert rows(ledger.read(), "operation", "num_rows") == [("UPSERT", 4)]
    with pytest.raises(PySparkException, match="null in key"):
        upsert_table(spark, "unit_book", source.withColumn("id", F.lit(None).cast("int")),
                     ["id"], ["seq"], str(tmp_path / "c"), ["kind"])
    assert rows(spark.table("unit_book")) == rows(after)


def _partitioned_book(spark, tmp_path, name):
    rows_by_kind = spark.createDataFrame(
        [(1, "a", "k", 1), (2, "b", "k", 1), (3, "c", "m", 1), (4, "d", "n", 1), (5, "e", None, 1),
         (6, "f", "p'q", 2), (7, "g", "o", 1)], "id int, name string, kind string, zone int")
    write_lake(rows_by_kind, str(tmp_path / name), ["kind", "zone"])
    return catalog.create_external_table(spark, name, str(tmp_path / name),
                                         rows_by_kind.schema, ["kind", "zone"])


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path, plan_of):
    _partitioned_book(spark, tmp_path, "unit_touched")
    before = _files(tmp_path / "unit_touched")
    ledger = WriteLedger(spark, str(tmp_path / "ledger"))
    # 3 moves from m to k, 5 is changed where it is, 9 is new in a new partition
    source = spark.createDataFrame(
        [(3, "C", "k", 1, 1), (5, "E", None, 1, 1), (9, "i", "new", 1, 1), (9, "I", "new", 1, 2)],
        "id int, name string, kind string, zone int, seq int")
    after = upsert_partitions(spark, "unit_touched", source, ["id"], ["seq"], ledger)
    expected = [(1, "a", "k", 1), (2, "b", "k", 1), (3, "C", "k", 1), (4, "d", "n", 1), (5, "E", None, 1),
                (6, "f", "p'q", 2), (7, "g", "o", 1), (9, "I", "new", 1)]
    assert rows(after, "id", "name", "kind", "zone") == expected
    now = _files(tmp_path / "unit_touched")
    kept = {f for f in before if now.get(f) == before[f]}
    assert {f.split("/")[0] for f in kept} == {"kind=n", "kind=p%27q", "kind=o"}
    assert not any(f.startswith("kind=m/") for f in now)
    # a repair finds nothing that had been taken out
    assert rows(catalog.refresh_table(spark, "unit_touched", partitioned=True),
                "id", "name", "kind", "zone") == expected
    assert rows(ledger.read(), "operation", "num_rows") == [("UPSERT", 5)]
    again = upsert_partitions(spark, "unit_touched", source, ["id"], ["seq"])
    assert rows(again, "id", "name", "kind", "zone") == expected
    nothing = upsert_partitions(spark, "unit_touched", source.limit(0), ["id"], ["seq"])
    assert rows(nothing, "id", "name", "kind", "zone") == expected


def test_a_key_with_the_partition_reads_only_its_partitions(spark, tmp_path, plan_of):
    from tidewell.sinks import touched_partitions
    table = _partitioned_book(spark, tmp_path, "unit_pruned")
    latest = spark.createDataFrame([(1, "A", "k", 1), (8, "h", "k", 1)],
                                   "id int, name string, kind string, zone int")
    touched = touched_partitions(table, latest, ["id", "kind", "zone"], ["kind", "zone"])
    assert rows(touched) == [("k", 1, 3, 3)]
    assert "dynamicpruning" in plan_of(touched)


def test_a_failed_upsert_leaves_the_table(spark, tmp_path):
    _partitioned_book(spark, tmp_path, "unit_failed")
    before, files = rows(spark.table("unit_failed")), _files(tmp_path / "unit_failed")
    bad = spark.createDataFrame([(1, "x", "k", 1, 1), (None, "y", "k", 1, 1)],
                                "id int, name string, kind string, zone int, seq int")
    with pytest.raises(PySparkException, match="null in key"):
        upsert_partitions(spark, "unit_failed", bad, ["id"], ["seq"])
    late = bad.where("id IS NOT NULL").withColumn(
        "name", F.when(F.col("seq") == 1, F.raise_error(F.lit("late failure"))).otherwise(F.col("name")))
    with pytest.raises(PySparkException, match="late failure"):
        upsert_partitions(spark, "unit_failed", late, ["id"], ["seq"])
    assert rows(spark.table("unit_failed")) == before and _files(tmp_path / "unit_failed") == files


@pytest.mark.parametrize("step", ["refresh_table", "_rename"])
def test_a_failed_move_leaves_the_table(spark, tmp_path, monkeypatch, step):
    name = f"unit_move_{step.strip('_')}"
    before = rows(_partitioned_book(spark, tmp_path, name))
    write_lake(spark.table(name).limit(1), str(tmp_path / "moved"), ["kind", "zone"])
    real, calls = getattr(catalog, step), []

    def failing(spark, old, new=None, **options):
        calls.append(old)
        if step == "refresh_table" or len(calls) == 2:
            raise RuntimeError("move")
        return real(spark, old, new)

    monkeypatch.setattr(catalog, step, failing)
    with pytest.raises(RuntimeError, match="move"):
        catalog.move_table(spark, name, str(tmp_path / "moved"), partitioned=True)
    monkeypatch.undo()
    assert rows(spark.table(name)) == before
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]


def test_upsert_with_nothing_changes_nothing(spark, book):
    source = spark.createDataFrame([], "id int, name string, seq int")
    assert rows(keyed_upsert(book, source, ["id"], ["seq"])) == rows(book)


def test_upsert_rejects_null_keys(spark, book):
    source = spark.createDataFrame([(None, "x", 1)], "id int, name string, seq int")
    with pytest.raises(PySparkException, match="null in key column id"):
        keyed_upsert(book, source, ["id"], ["seq"]).collect()


def test_latest_per_key_reduces_a_hot_key_before_the_shuffle(spark, plan_of):
    hot = spark.range(100_000).select(
        F.when(F.col("id") < 60_000, 0).otherwise(F.col("id")).alias("key"),
        F.col("id").alias("seq"), F.hash("id").alias("value"))
    latest = latest_per_key(hot, ["key"], ["seq"])
    assert "partial_max" in plan_of(latest) and "Window" not in plan_of(latest)
    assert latest.count() == 40_001
    assert latest.where("key = 0").first()["seq"] == 59_999


def test_external_table(spark, events, tmp_path):
    path = str(tmp_path / "events")
    lake = write_lake(dated(events), path, ["date"])
    table = catalog.create_external_table(spark, "unit_events", path, lake.schema, ["date"])
    assert table.count() == 4
    write_lake(dated(events, shift="-172800"), path, ["date"], "append")
    assert catalog.refresh_table(spark, "unit_events", partitioned=True).count() == 8
    described = catalog.describe_table(spark, "unit_events")
    assert any(r["col_name"] == "# Partition Information" for r in described.collect())
    catalog.drop_table(spark, "unit_events")
    catalog.drop_table(spark, "unit_events")
    assert read_lake(spark, path).count() == 8


def test_move_table_after_a_rewrite(spark, events, tmp_path):
    lake = write_with_history(events, str(tmp_path / "a"))
    catalog.create_external_table(spark, "unit_moved", str(tmp_path / "a"), lake.schema,
                                  ["date"])
    compact(spark.table("unit_moved"), str(tmp_path / "b"), ["date"])
    moved = catalog.move_table(spark, "unit_moved", str(tmp_path / "b"), partitioned=True)
    assert rows(moved) == rows(lake)
    assert all("/b/" in f for f in moved.inputFiles())
    assert moved.columns[-1] == "date"


def test_move_single_partitions(spark, events, tmp_path):
    lake = write_with_history(events, str(tmp_path / "a"))
    catalog.create_external_table(spark, "unit_part", str(tmp_path / "a"), lake.schema,
                                  ["date"])
    one = spark.table("unit_part").where("date = '2016-07-26'")
    compact(one, str(tmp_path / "b"), ["date"])
    moved = catalog.move_partitions(spark, "unit_part", "date",
                                    {"2016-07-26": str(tmp_path / "b" / "date=2016-07-26")})
    assert rows(moved) == rows(lake)
    assert sum("/b/" in f for f in moved.inputFiles()) == 1


def test_only_fragmented_partitions_are_rewritten(spark, tmp_path, plan_of):
    path = tmp_path / "t"
    schema = "id bigint, tags map<string, bigint>, date string, kind int"
    for n, values in ((5, "'many' AS date, 1 AS kind"), (1, "'one' AS date, 1 AS kind"),
                      (3, "CAST(null AS string) AS date, 2 AS kind"), (4, "'it''s' AS date, CAST(null AS int) AS kind")):
        spark.range(0, 100, numPartitions=n).selectExpr("id", "map('a', id) AS tags", values.split(", ")[0],
                                                        values.split(", ")[1]).write.mode(
            "append").partitionBy("date", "kind").parquet(str(path))
    lake = read_lake(spark, str(path), schema)
    name = "unit_fragmented"
    before = catalog.create_external_table(spark, name, str(path), lake.schema, ["date", "kind"])
    expected = rows(before.selectExpr("id", "tags['a'] AS a", "date", "kind"))
    files = _files(path)
    ledger = WriteLedger(spark, str(tmp_path / "ledger"))
    after = compact_table(spark, name, ledger=ledger)
    assert rows(after.selectExpr("id", "tags['a'] AS a", "date", "kind")) == expected
    now = _files(path)
    assert len(now) == 4 and {f.split("/")[0] for f in now if now[f] == files.get(f)} == {"date=one"}
    assert rows(ledger.read(), "operation", "num_rows") == [("COMPACT", 300)]
    assert compact_table(spark, name).count() == 400
    assert _files(path) == now


def test_files_are_packed_first_fit(spark):
    sizes = [7, 5, 5, 4, 3, 2, 2, 30, 1]
    files = spark.createDataFrame([("p", None, f"f{i}", s) for i, s in enumerate(sizes)] + [("q", 1, "g", 3)],
                                  "a string, b int, path string, size_in_bytes bigint")
    found = pack_files(files, ["a", "b"], 10).collect()
    bins = {}
    for r in found:
        bins.setdefault((r["a"], r["b"], r["bin"]), []).append(r["size_in_bytes"])
    # 30 alone; 7 3; 5 5; 4 2 2 1
    assert sorted(sorted(b, reverse=True) for k, b in bins.items() if k[0] == "p") == [
        [4, 2, 2, 1], [5, 5], [7, 3], [30]]
    assert bins["q", 1, 0] == [3]


def test_lots_of_files_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(maintenance, "LOT_FILES", 10)
    files = spark.range(95).selectExpr("'p' AS a", "concat('f', id) AS path", "1 AS size_in_bytes")
    found = pack_files(files, ["a"], 10)
    assert found.select("lot").distinct().count() == 10 and found.count() == 95
    assert found.groupBy("lot", "bin").count().agg({"count": "max"}).first()[0] <= 10


def test_listing_tasks_follow_files_and_not_bytes(spark, tmp_path):
    found = {}
    with with_conf(spark, spark__sql__files__maxPartitionBytes=20_000):
        for label, n in (("small", 100), ("large", 20_000)):
            path = str(tmp_path / label)
            spark.range(0, n, numPartitions=8).selectExpr("id", "sha2(string(id), 256) AS s").write.parquet(path)
            found[label] = (len(list_files(spark, path).inputFiles()), partition_detail(spark, path, []).first()[0],
                            len(spark.read.parquet(path).select("s").rdd.glom().collect()))
    assert found["small"][:2] == found["large"][:2] == (1, 8)
    assert found["large"][2] > found["small"][2]


def test_cached_table_is_released(spark):
    catalog.register_view(spark.range(10), "unit_cached")
    with catalog.cached_table(spark, "unit_cached") as table:
        assert spark.catalog.isCached("unit_cached")
        assert table.count() == 10
    assert not spark.catalog.isCached("unit_cached")
    catalog.cache_table(spark, "unit_cached", lazy=True)
    catalog.clear_cache(spark)
    assert not spark.catalog.isCached("unit_cached")


def test_databases(spark, tmp_path):
    spark.sql(f"CREATE DATABASE unit_db LOCATION '{tmp_path}'")
    assert "unit_db" in [r[0] for r in catalog.list_databases(spark).collect()]
    catalog.use_database(spark, "unit_db")
    assert spark.catalog.currentDatabase() == "unit_db"
    catalog.use_database(spark, "default")
    assert catalog.list_tables(spark, "unit_db").where("NOT isTemporary").count() == 0
