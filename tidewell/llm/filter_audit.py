"""How five document filters interact, from a sparse document-term matrix.

One pass over the texts cuts them into shards of about ``SHARD_BYTES``, each with its distinct words and, for
every text, the places of its words among them with their counts: the filled cells of a sparse matrix.  The
distinct words of all shards are numbered once for the whole table, and the numbers come back to the shards, where they
become the columns of its compressed rows (pointers, columns, values).  Row sums are then a text's words, nonzero
counts its distinct words, and these decide filters A and B.  The pass also finds C and D; equal texts
by hash decide E.  What each row fails becomes a set of at most five letters, and rows are only
counted by part and set: the 120 orders are worked out on these few counts.

A word goes through the shuffle once for each shard that holds it, however often it stands there, so the most frequent
word of a language is one row for each shard.  Equal texts are joined with one row for each
text that occurs more than once, broadcast if it is small, else in a join in which Spark splits hot keys.

A null text is empty, a null part the empty string.  Words are told apart by their bytes, texts by a 128-bit
hash.  Repeated rows count each: of equal texts those with the smallest id pass E, all of them.  A null id is never
compared, so it passes E.  An id with several label rows is good, or toxic, if one of them says so.  An
empty table has no parts and no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import text_pieces
from tidewell.operators.joins import sized_for_broadcast
from tidewell.session import materialize

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
MARKS = b"#$%&*|"
SHARD_BYTES = 8 << 20
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SHARD = ("shard bigint, words array<string>, cells binary, counts binary, doc_id array<bigint>, "
          "part array<string>, t1 array<bigint>, t2 array<bigint>, marks array<int>")


def _packed(values: np.ndarray, kind: type) -> bytes:
    return zstandard.compress(values.astype(kind).tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind).astype(np.int64)


def _matrix(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of the texts, the filled cells (text * words + word) in order, and their counts."""
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts.cast(pa.large_string())))
    words = pc.list_flatten(split)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    some = pc.greater(pc.binary_length(words), 0)  # a blank text is split into one empty word
    row = row[some.to_numpy(zero_copy_only=False)]
    coded = words.filter(some).dictionary_encode()
    cells, counts = np.unique(row * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
    return coded.dictionary.cast(pa.string()), cells, counts


def _marks(text: bytes) -> int:
    """Filters C and D as bits of ``FILTERS``."""
    points = len(text.decode("utf-8", "replace"))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    marked = len(text) > len(text.translate(None, MARKS))
    return (4 if 100 * capitals > MAX_CAPITAL_PERCENT * points else 0) | (8 if marked else 0)


def shards(docs: DataFrame) -> DataFrame:
    """One row for each shard of the texts, with columns local to the shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in text_pieces(batch, "text", SHARD_BYTES):
                words, cells, counts = _matrix(pc.fill_null(piece["text"], ""))
                texts = pc.fill_null(piece["text"], "").cast(pa.binary()).to_pylist()
                names = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), "<i8").reshape(-1, 2)
                whole = [piece["doc_id"], piece["part"], pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy()),
                         pa.array([_marks(t) for t in texts], pa.int32())]
                row = [pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, len(words)], words),
                       pa.array([_packed(np.diff(cells, prepend=0), np.int64)], pa.binary()),
                       pa.array([_packed(counts, np.int32)], pa.binary()),
                       *[pa.ListArray.from_arrays([0, len(a)], a) for a in whole]]
                number += 1
                yield pa.RecordBatch.from_arrays(row, ["shard", "words", "cells", "counts", "doc_id",
                                                       "part", "t1", "t2", "marks"])

    return docs.select("doc_id", "text", "part").mapInArrow(run, _SHARD)


def word_numbers(parts: DataFrame) -> DataFrame:
    """(shard, place, number): the number that each word of a shard has in the whole table.

    It is the smallest among the places at which shards hold the word, numbered through the table.
    """
    words = (parts.select(F.col("shard").alias("shard"), F.posexplode("words").alias("place", "word"))
             .withColumn("_place", F.monotonically_increasing_id()))
    number = F.min("_place").over(Window.partitionBy("word"))
    return words.select("shard", "place", number.alias("number"))


def _rows(parts: pa.Table, numbers: pa.Table) -> pa.Table:
    """A row for each text of a shard, from the matrix over the whole table's words."""
    number = np.empty(numbers.num_rows, np.int64)
    number[numbers["place"].to_numpy()] = numbers["number"].to_numpy()
    out = []
    for row in parts.to_batches():
        for i in range(row.num_rows):
            texts = {c: row[c][i].values for c in ("doc_id", "part", "t1", "t2", "marks")}
            cells, counts = np.cumsum(_unpacked(row["cells"][i].as_py(), np.int64)), _unpacked(row["counts"][i].as_py(), np.int32)
            width = max(1, len(number))
            # the rows of the matrix over the whole table's words: pointers, columns, values
            pointers = np.searchsorted(cells, np.arange(len(texts["doc_id"]) + 1) * width)
            columns = number[cells % width]
            sums = np.diff(np.concatenate([[0], np.cumsum(counts)])[pointers])
            filled = np.diff(np.concatenate([[0], np.cumsum(columns >= 0)])[pointers])
            failed = np.where(sums < MIN_WORDS, 1, 0) | np.where(
                100 * filled < MIN_DISTINCT_PERCENT * sums, 2, 0)
            out.append(pa.table({"doc_id": texts["doc_id"], "part": texts["part"], "t1": texts["t1"],
                                 "t2": texts["t2"], "n_words": sums, "n_distinct": filled,
                                 "failed": pa.array(failed.astype(np.int32) | texts["marks"].to_numpy(), pa.int32())}))
    return pa.concat_tables(out) if out else _NO_ROWS


_ROWS = "doc_id bigint, part string, t1 bigint, t2 bigint, n_words bigint, n_distinct bigint, failed int"
_NO_ROWS = pa.table({n: pa.array([], t) for n, t in (
    ("doc_id", pa.int64()), ("part", pa.string()), ("t1", pa.int64()), ("t2", pa.int64()),
    ("n_words", pa.int64()), ("n_distinct", pa.int64()), ("failed", pa.int32()))})


def failed_filters(docs: DataFrame, part: str = "lang") -> DataFrame:
    """``doc_id``, ``part``, ``n_words``, ``n_distinct`` and ``failed``, a bit for each of
    ``FILTERS``, of every row."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    parts = materialize(shards(docs), "shards")
    rows = materialize(parts.drop("words").groupBy("shard").cogroup(word_numbers(parts).groupBy("shard"))
                       .applyInArrow(_rows, _ROWS), "rows")
    copies = (rows.groupBy("t1", "t2").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .filter("_n > 1").drop("_n"))
    copied = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))
    return (rows.join(sized_for_broadcast(copies), ["t1", "t2"], "left")
            .select("doc_id", "part", "n_words", "n_distinct",
                    F.col("failed").bitwiseOR(F.when(copied, 16).otherwise(0)).alias("failed")))


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost`` and ``shapley`` for every part, order of the filters and step.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``.
    """
    marks = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    marked = failed_filters(docs, part).join(marks, "doc_id", "left")
    kinds = marked.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    # at most 32 rows for each part from here on
    orders = F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])
    steps = (materialize(kinds, "kinds").withColumn("filter_order", F.explode(orders))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))))
    bit = F.lit(0)
    earlier = F.lit(0)
    for i, name in enumerate(FILTERS):
        at = F.instr("filter_order", name)
        bit = F.when(at == F.col("step"), 1 << i).otherwise(bit)
        earlier = earlier + F.when(at < F.col("step"), 1 << i).otherwise(0)
    steps = steps.select("*", bit.alias("_bit"), earlier.alias("_earlier"))
    fails = F.col("failed").bitwiseAND(F.col("_bit")) != 0
    gone = F.col("failed").bitwiseAND(F.col("_earlier")) != 0
    # of the filters that a row fails, each comes first in the same number of orders
    first = F.expr(f"n * ({factorial(len(FILTERS))} DIV greatest(bit_count(failed), 1))")

    def total(condition, value=F.col("n")):
        return F.sum(F.when(condition, value).otherwise(0)).cast("bigint")

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("failed") == F.col("_bit")).alias("unique_fails"),
        total(fails & ~gone, F.col("good")).alias("good_lost"),
        total(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
        total(fails, first).alias("shapley"))
