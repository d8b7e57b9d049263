"""Importance resampling of documents towards a target distribution.

Features are the runs of 1 to ``runs`` consecutive words of a text, joined by one space; each falls into
the bucket of its CRC-32 (``position_crc.py``) modulo ``buckets``.  Both corpora are counted by bucket,
a bucket's gain is its log ratio, a text's weight the sum of its features' gains.  Documents with the
highest weight plus Gumbel noise are drawn, which is a draw without replacement in proportion to the
weights' exponentials.

The texts are read twice, once to count and once to weigh.  A task sends at most ``buckets`` sums, and
the driver gets one number for each bucket.  Ranks come from a range sort of (score, id) and the sizes
of its ranges, one row for each shuffle partition.

Words are runs of digits, a-z and any character beyond ASCII, A-Z in lower case.  A null or empty text has no
features and weight 0.  A null id draws its noise from the empty text, and stands first among equal
scores.  Repeated rows count, and are drawn, each by itself; equal scores go to the smaller id.  Other columns
are ignored.  If nothing has ``min_words`` words, nothing is drawn; an empty target makes every gain that of
no target features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import text_pieces
from tidewell.llm.position_crc import PositionCrc
from tidewell.session import materialize

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _words(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with one space between words, where each word begins and ends, and the number of
    words of each text."""
    data = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
    raw = np.frombuffer(b"\n" + b"\n".join(data) + b"\n", np.uint8)
    inside = _WORD[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    text_at = np.cumsum([1] + [len(d) + 1 for d in data])
    sizes = np.diff(np.searchsorted(begin, text_at))
    keep = inside.copy()
    keep[end] = True  # what follows a word becomes its space
    joined = raw[keep]
    stop = np.cumsum(end - begin + 1)
    joined[stop - 1] = 32
    return joined, stop - 1 - (end - begin), stop - 1, sizes


def feature_buckets(texts: list, runs: int, buckets: int, crc: PositionCrc) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of a run: the buckets of all features, text by text, and how many each text has."""
    data, begin, end, sizes = _words(texts)
    first = np.cumsum(sizes) - sizes
    for n in range(1, runs + 1):
        many = np.maximum(sizes - (n - 1), 0)
        at = np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many)
        yield crc.crc(data, begin[at], end[at + n - 1]) % np.uint32(buckets), many


def bucket_counts(texts: DataFrame, runs: int, buckets: int) -> DataFrame:
    """(bucket, n): features of the column ``text`` in each bucket that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, counts = PositionCrc(), np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in text_pieces(batch, "text"):
                for found, _ in feature_buckets(piece["text"].to_pylist(), runs, buckets, crc):
                    counts += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bucket", "n"])

    return (texts.select("text").mapInArrow(run, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored log ratios, in thousandths, of smoothed shares of target and corpus."""
    buckets, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (s + buckets) / ((float(a) + 1) * (t + buckets))))
                     for a, b in zip(corpus, target)], np.int64)


def _counts(texts: DataFrame, runs: int, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for bucket, n in bucket_counts(texts, runs, buckets).collect():  # at most one row for each bucket
        out[bucket] = n
    return out


def weigh(docs: DataFrame, gains: np.ndarray, runs: int) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = PositionCrc()
        for batch in batches:
            for piece in text_pieces(batch, "text"):
                n = piece.num_rows
                words, features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
                found_runs = feature_buckets(piece["text"].to_pylist(), runs, len(gains), crc)
                for length, (found, many) in enumerate(found_runs, 1):
                    words = many if length == 1 else words
                    sums = np.concatenate([[0], np.cumsum(gains[found])])
                    stop = np.cumsum(many)
                    features += many
                    weight += sums[stop] - sums[stop - many]
                yield pa.RecordBatch.from_arrays(
                    [piece["doc_id"], pa.array(words), pa.array(features), pa.array(weight)],
                    ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(doc_id: str, seed: int) -> Column:
    """Noise of a document in thousandths: the first 32 bits of a hash of seed and id, on the Gumbel scale."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def numbered(rows: DataFrame, order: list[Column], place: str) -> DataFrame:
    """``rows`` with their place, from 1, in a total order, for any number of rows.

    A range sort, then an offset for each range; the offsets, one row for each shuffle partition, are the only
    thing that one task sees whole.
    """
    ordered = materialize(rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "ranked")
    ordered = ordered.withColumn("_range", F.shiftright("_id", 33))  # the lower 33 bits count within it
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ordered.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")))
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (ordered.join(F.broadcast(offsets), "_range")
            .withColumn(place, F.col("_offset") + within + 1).drop("_id", "_range", "_offset"))


def resample(docs: DataFrame, target: DataFrame, *, runs: int = 1, buckets: int = 10_000,
             percent: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row.

    ``percent`` of the rows with at least ``min_words`` words are drawn and ranked, from 1; the others' rank is null.
    """
    gains = bucket_gains(_counts(docs, runs, buckets), _counts(target, runs, buckets))
    scored = materialize(weigh(docs, gains, runs).withColumn("score", F.col("weight") + gumbel("doc_id", seed))
                         .withColumn("_able", F.col("n_words") >= min_words), "weighed")
    drawn = scored.filter("_able").count() * percent // 100
    order = [F.desc("_able"), F.desc("score"), F.asc("doc_id")]
    return numbered(scored, order, "_place").select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("_able") & (F.col("_place") <= drawn), F.col("_place")).alias("rank"))


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn ids with their rank; see ``resample``."""
    return resample(docs, target, **options).filter("rank IS NOT NULL").select("doc_id", "rank")
