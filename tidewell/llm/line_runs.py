"""Line dedup by levelled sorted runs of line hashes.

``LineRuns`` keeps, for every line seen, its hash and the number of documents that hold it, in runs: tables
bucketed and sorted by hash, so that runs are merged, and joined with a batch, bucket by bucket without a
shuffle of the runs.  A new batch is reduced to counts of its own, anti-joins the lines that the runs
have settled already (those in at least ``limit`` documents need no further counting), and adds the rest as a
run of level 0.  ``fanout`` runs of a level are merged into one of the next, so a row is rewritten
once for each level, a logarithm of the number of batches.

A document learns which of its lines go from a semi-join of its line hashes with the settled ones; these come back as
one list for each document that has any, and the document's text is cut without being shuffled while that list
is small enough to broadcast.

A line's key is the line without ASCII white space at both ends, A-Z in lower case, named by a 128-bit
hash.  A row is a document, whatever its id: repeated rows, and rows of a null id, each count.  A null or empty
text is one empty line.  Keys shorter than ``min_chars`` code points always stay.  A line that stands several times
in a document counts once, and goes from all its places.  Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import text_pieces
from tidewell.operators.joins import sized_for_broadcast
from tidewell.session import materialize, scratch_dir, with_conf

WHITE = " \t\n\x0b\f\r"
BUCKET_BYTES = 1 << 30  # text behind a bucket of the runs
LEAST_BUCKETS = 8
_LINE = ["h1", "h2"]


def _lines(texts: pa.Array) -> pa.ListArray:
    whole = pc.fill_null(texts.cast(pa.large_string()), "")
    return pc.split_pattern(whole, "\n")


def _keys(lines: pa.ListArray) -> pa.Array:
    return pc.ascii_trim(pc.ascii_lower(pc.list_flatten(lines)), characters=WHITE)


def _hashes(keys: pa.Array) -> np.ndarray:
    """Two 64-bit numbers for each key."""
    digests = b"".join([xxhash.xxh3_128_digest(k) for k in keys.cast(pa.large_binary()).to_pylist()])
    return np.frombuffer(digests, "<i8").reshape(-1, 2)


def line_hashes(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(k, h1, h2): the distinct line keys of each row; ``k`` is a hash of id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch, "text"):
                lines = _lines(piece["text"])
                keys = _keys(lines)
                row = np.repeat(np.arange(piece.num_rows), pc.list_value_length(lines).to_numpy())
                long = pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False)
                found, row = _hashes(keys.filter(pa.array(long))), row[long]
                order = np.lexsort((found[:, 1], found[:, 0], row))
                found, row = found[order], row[order]
                fresh = np.ones(len(row), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1]).any(axis=1)
                found, row = found[fresh], row[fresh]
                yield pa.RecordBatch.from_arrays(
                    [piece["k"].take(pa.array(row)), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())],
                    ["k", *_LINE])

    return keyed(docs).select("k", "text").mapInArrow(run, "k bigint, h1 bigint, h2 bigint")


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with ``k``, a hash of id and text.  Rows that share it by chance share their settled
    lines, of which each drops those that it has, so no result depends on it."""
    return docs.withColumn("k", F.xxhash64("doc_id", "text"))


class LineRuns:
    """Runs of (h1, h2, n), by level.  ``limit`` documents settle a line.

    The tables lie in the shared folder under names of their own; ``close`` drops them.
    """

    def __init__(self, spark: SparkSession, limit: int, buckets: int = LEAST_BUCKETS, fanout: int = 2):
        self.spark, self.limit, self.buckets, self.fanout = spark, limit, buckets, fanout
        self.levels: list[list[str]] = []
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.written = 0

    def _write(self, rows: DataFrame) -> str:
        table = f"{self.name}_{self.written}"
        self.written += 1
        (rows.coalesce(self.buckets).write.bucketBy(self.buckets, *_LINE).sortBy(*_LINE)
         .option("path", scratch_dir(self.spark, "run")).saveAsTable(table))
        return table

    def _drop(self, tables: list[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE {table}")

    @property
    def tables(self) -> list[str]:
        return [t for level in self.levels for t in level]

    def _summed(self, tables: list[str]) -> DataFrame:
        """Lines of all these runs with their counts added: a merge of sorted buckets."""
        merged = self.spark.table(tables[0])
        for table in tables[1:]:
            other = self.spark.table(table).withColumnRenamed("n", "_n")
            merged = (merged.join(other.hint("merge"), _LINE, "full_outer")
                      .select(*_LINE, (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n")))
        return merged

    def add(self, hashes: DataFrame) -> None:
        """Take in a batch: ``hashes`` has a row (h1, h2) for each line of each document."""
        with with_conf(self.spark, spark__sql__shuffle__partitions=self.buckets):
            counts = hashes.groupBy(*_LINE).agg(F.count(F.lit(1)).alias("n"))
            for table in self.tables:
                settled = self.spark.table(table).filter(F.col("n") >= self.limit).select(*_LINE)
                counts = counts.join(settled.hint("merge"), _LINE, "left_anti")
            run = self._write(counts)
            level = 0
            while True:
                if len(self.levels) == level:
                    self.levels.append([])
                self.levels[level].append(run)
                if len(self.levels[level]) < self.fanout:
                    return
                merged, self.levels[level] = self.levels[level], []
                run = self._write(self._summed(merged))
                self._drop(merged)
                level += 1

    def settled(self) -> DataFrame:
        """Distinct (h1, h2) of the lines in at least ``limit`` documents so far."""
        found = self.spark.createDataFrame([], "h1 bigint, h2 bigint, n bigint")
        if self.tables:
            found = self._summed(self.tables)
        return materialize(found.filter(F.col("n") >= self.limit).select(*_LINE), "settled")

    def close(self) -> None:
        self._drop(self.tables)
        self.levels = []


def _without(docs: DataFrame) -> DataFrame:
    """``docs`` has ``gone``, the settled line hashes of the row, or null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch, "text"):
                lines = _lines(piece["text"])
                many = pc.list_value_length(lines).to_numpy().astype(np.int64)
                gone = piece["gone"]
                texts, dropped = pc.fill_null(piece["text"], ""), np.zeros(piece.num_rows, np.int64)
                hit = np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False))
                if len(hit):
                    kept = _cut(lines.take(pa.array(hit)), gone.take(pa.array(hit)))
                    texts = texts.to_pylist()
                    for row, (text, n) in zip(hit.tolist(), kept):
                        texts[row], dropped[row] = text, n
                    texts = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [piece["doc_id"], pa.array(many), pa.array(dropped), texts.cast(pa.string())],
                    ["doc_id", "n_lines", "n_dropped", "text"])

    return docs.select("doc_id", "text", "gone").mapInArrow(
        run, "doc_id bigint, n_lines bigint, n_dropped bigint, text string")


def _cut(lines: pa.ListArray, gone: pa.ListArray) -> Iterator[tuple[str, int]]:
    """The text of each row's other lines, and how many went."""
    own = _hashes(_keys(lines)).tobytes()
    flat = gone.flatten()
    lost = np.stack([np.asarray(flat.field(c)) for c in _LINE], axis=1).astype("<i8").tobytes()
    at = lost_at = 0
    for row, size in zip(lines.to_pylist(), pc.list_value_length(gone).to_pylist()):
        out = {lost[16 * j:16 * j + 16] for j in range(lost_at, lost_at + size)}
        kept = [line for j, line in enumerate(row, at) if own[16 * j:16 * j + 16] not in out]
        yield "\n".join(kept), len(row) - len(kept)
        at, lost_at = at + len(row), lost_at + size


def drop_frequent_lines(docs: DataFrame, *, limit: int = 10, min_chars: int = 1, batches: int = 4,
                        fanout: int = 2, buckets: int | None = None) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and the remaining ``text`` of every row.

    Lines in at least ``limit`` documents go.  The documents are taken in as ``batches`` batches; neither that
    number nor ``fanout`` or ``buckets`` (default: by the bytes of the texts) changes the result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = LEAST_BUCKETS + size // BUCKET_BYTES
    batch = F.pmod(F.col("k"), F.lit(batches))
    folder = scratch_dir(spark, "lines")
    found = line_hashes(docs, min_chars).withColumn("batch", batch.cast("int"))
    found.write.partitionBy("batch").parquet(folder)
    stored = spark.read.schema(found.schema).parquet(folder)
    runs = LineRuns(spark, limit, buckets, fanout)
    try:
        for b in range(batches):
            runs.add(stored.filter(F.col("batch") == b).select(*_LINE))
        settled = runs.settled()
    finally:
        runs.close()
    hits = (stored.join(sized_for_broadcast(settled), _LINE, "left_semi")
            .groupBy("k").agg(F.collect_set(F.struct(*_LINE)).alias("gone")))
    return _without(keyed(docs).join(sized_for_broadcast(hits), "k", "left"))
