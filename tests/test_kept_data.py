"""Rows that must come back as they were: escaped partitions, CSV text, headers, batches."""

import pytest

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell import catalog
from tidewell.session import with_conf
from tidewell.sinks.files import export_csv, write_lake
from tidewell.sinks.maintenance import compact_table, file_detail
from tidewell.sources.files import read_csv
from tidewell.sources.typed_text import read_header
from tidewell.streaming.word_count import read_word_counts


def test_compaction_keeps_escaped_and_null_partitions(spark, tmp_path):
    values = ["plain", "a:b", "x/y", "50%", "a b", None]
    df = spark.range(600).withColumn("v", F.array(*[F.lit(v) for v in values])[F.col("id") % 6])
    path = str(tmp_path / "table")
    for part in range(3):
        write_lake(df.where(F.col("id") % 3 == part).repartition(4), path, ["v"], "append", rebalance=False)
    catalog.create_external_table(spark, "escaped", path, df.schema, ["v"])
    try:
        before = rows(spark.table("escaped"), "id", "v")
        with with_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="1k"):
            after = compact_table(spark, "escaped", file_bytes=1 << 20)
            assert rows(after, "id", "v") == before and len(before) == 600
            files = file_detail(spark.table("escaped"), ["v"]).groupBy("v").count().collect()
            assert sorted(r["count"] for r in files) == [1] * len(files)
            again = compact_table(spark, "escaped", file_bytes=1 << 20)
            assert sorted(again.inputFiles()) == sorted(after.inputFiles())
    finally:
        catalog.drop_table(spark, "escaped")


def test_csv_gives_back_every_text(spark, tmp_path):
    texts = ["x\ny", "  a  ", "", None, 'say "hi", ok', "back\\slash", "a\\", '"', "\ttab ", "é,ü", "#no comment"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    path = export_csv(df, str(tmp_path / "csv"), null_value="\\N")
    back = read_csv(spark, path, df.schema, null_value="\\N", multi_line=True)
    assert {r["id"]: r["text"] for r in back.collect()} == dict(enumerate(texts))


def test_header_over_several_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x:int\ny:double\n")
    (tmp_path / "b.txt").write_text("z:string\n")
    assert read_header(spark, str(tmp_path)) == [("x", "int"), ("y", "double"), ("z", "string")]
    (tmp_path / "c.txt").write_text("broken\n")
    with pytest.raises(ValueError):
        read_header(spark, str(tmp_path))


def test_unfinished_batches_are_left_out(spark, tmp_path):
    counts = lambda n: spark.createDataFrame([("a", n), ("b", n)], "word string, count bigint")
    for batch in (0, 1):
        counts(batch + 1).write.parquet(str(tmp_path / f"batch_id={batch}"))
    (tmp_path / "batch_id=1" / "_SUCCESS").unlink()
    for mode in ("complete", "update"):
        assert rows(read_word_counts(spark, str(tmp_path), mode), "word", "count") == [("a", 1), ("b", 1)]
