"""Near duplicates by odd sketches of MinHash samples.

Every text becomes the set of its distinct word shingles.  Texts with the same set are
collapsed first.  Of each distinct set, ``BANDS * ROWS`` MinHash samples are taken; ``ROWS``
at a time form band keys, and all samples are folded into a parity bitmap, the odd sketch.
The population count of the XOR of two sketches estimates a high similarity
precisely, so a pair that shares a band is compared on its full sets only if the estimate
is within ``SIGMAS`` standard errors of the threshold.  A second parity bitmap holds the
whole set: the sets of a pair differ in at least as many shingles as the bitmaps differ
in bits, so a pair above that bound is left out without any error.

A band key with many texts never gives all its pairs.  First each text is compared with
one leader of the key, the text that meets most others; the links found are contracted to
components.  Then only pairs whose texts are still in different components are looked at,
in blocks of a key, and of these only those pass whose sketches are close enough.  What is
left out are pairs already connected, so no link that matters is lost.  A pair at exactly
the threshold misses all bands with a probability of about 1e-7.

Words are what lies between ASCII white space, with A-Z in lower case.  A text with fewer
words than a shingle has is one shingle; a null, empty or blank text has none and is linked
with nothing.  A null id takes no part: it is its own, kept.  Repeated rows each give a row.
If an id has several texts, each row is placed by its own text: sets are linked with sets, and only then
is the smallest id of the linked sets taken.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import Memo, map_documents, mix64, word_hash, words_of
from tidewell.llm.components import connected_components
from tidewell.session import materialize

BANDS, ROWS = 40, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 1024
SKETCH_WORDS = SKETCH_BITS // 64
SIGMAS = 5
BLOCK = 256  # texts of one key that meet in a block

_rng = np.random.default_rng(20)
_SCALE = (_rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_SHIFT = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_ROW = _rng.integers(0, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)
_BAND = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_SAMPLE = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)


def shingle_set(text: str | None, n: int, memo: Memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.array([memo[w] for w in words], np.uint64)
    if len(words) < n:
        n = len(words)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total += ids[i:len(ids) - n + 1 + i] * _PLACE[i]
    return np.unique(mix64(total))


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """``SAMPLES`` minima of the set under as many hash functions."""
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    best = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 4096):
        part = low[start:start + 4096]
        np.minimum(best, (_SCALE[:, None] * part + _SHIFT[:, None]).min(axis=1), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(BANDS, ROWS).astype(np.uint64) * _ROW
    return mix64(rows.sum(axis=1, dtype=np.uint64) + _BAND).view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parities of how many samples fall on each bit."""
    bits = (mix64(_SAMPLE | samples.astype(np.uint64)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = (np.bincount(bits, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def parity_bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parities of how many shingles of the set fall on each bit."""
    bits = (shingles % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=SKETCH_BITS) & 1).astype(np.uint8)).view(np.int64)


def estimate(differing_bits: int) -> float:
    """Similarity that two sketches differing in so many bits stand for."""
    rest = 1 - 2 * differing_bits / SKETCH_BITS
    return 1 + SKETCH_BITS / (4 * SAMPLES) * math.log(rest) if rest > 0 else 0.0


def most_bits(threshold: float) -> int:
    """Differing bits up to which a pair may reach the threshold."""
    least = threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / SAMPLES) - 0.01
    return max([b for b in range(SKETCH_BITS // 2) if estimate(b) >= least])


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``set_key``, ``bands`` and ``sketch`` of every row.

    ``sketch`` holds the odd sketch of the samples, the parity bitmap of the whole set, and
    the size of the set.
    """
    def make():
        memo = Memo(word_hash)

        def work(ids, texts, keys):
            for i, text, key in zip(ids, texts, keys):
                found = shingle_set(text, shingle, memo)
                if len(found) == 0 or i is None:
                    yield i, key, len(found), None, None, None
                    continue
                samples = min_hashes(found)
                yield (i, key, len(found), xxhash.xxh3_128_digest(found.tobytes()),
                       band_keys(samples).tolist(), odd_sketch(samples).tolist()
                       + parity_bitmap(found).tolist() + [len(found)])
        return work

    return map_documents(text_keyed(docs), ["doc_id", "text", "text_key"],
                         "doc_id bigint, text_key bigint, n_shingles bigint, set_key binary, "
                         "bands array<bigint>, sketch array<bigint>", make)


def text_keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text_key``, which tells the texts of one id apart."""
    return docs.withColumn("text_key", F.xxhash64("text"))


def _close(left: str, right: str, percent: int) -> Column:
    """Whether a pair with these sketches may reach the similarity."""
    def differing(first: int) -> Column:
        total = F.lit(0)
        for i in range(first, first + SKETCH_WORDS):
            total = total + F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i]))
        return total

    sizes = F.col(left)[2 * SKETCH_WORDS] + F.col(right)[2 * SKETCH_WORDS]
    return ((differing(SKETCH_WORDS) * (100 + percent) <= sizes * (100 - percent))
            & (differing(0) <= most_bits(percent / 100)))


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets reach the similarity, in whole numbers."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))

    def make():
        memo = Memo(word_hash)
        held: dict[int, np.ndarray] = {}

        def work(ids_a, ids_b, texts_a, texts_b):
            for a, b, ta, tb in zip(ids_a, ids_b, texts_a, texts_b):
                if a not in held:  # rows of one leader follow each other
                    held.clear()
                    held[a] = shingle_set(ta, shingle, memo)
                x, y = held[a], shingle_set(tb, shingle, memo)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    yield a, b
        return work

    rows = pairs.select("a", "b").join(right, "b").join(left, "a")
    return map_documents(rows, ["a", "b", "text_a", "text_b"], "a bigint, b bigint", make)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs``.

    Two texts are linked if 100 * intersection >= percent * union of their shingle sets.
    ``component_id`` is the smallest id reachable over links, ``kept`` says that it is the
    row's own.
    """
    return placed_rows(docs, shingle, percent).drop("text_key", "set_key")


def placed_rows(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``near_duplicates`` with ``text_key`` and ``set_key``, null for rows that take no part."""
    signed = materialize(signatures(docs, shingle), "signatures")
    # The signature is a function of the set, so any row of a set will do; ``rep`` numbers the sets.
    sets = materialize(
        signed.filter("set_key is not null").groupBy("set_key").agg(
            F.min(F.struct("doc_id", "text_key")).alias("_row"), F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"))
        .select("set_key", F.monotonically_increasing_id().alias("rep"), "_row.doc_id", "_row.text_key",
                "bands", "sketch"), "sets")
    sketches = sets.select("rep", "sketch")
    rows = sets.select("rep", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialize(rows.join(shared, "key"), "members")
    wanted = sets.join(members.select("rep").distinct(), "rep", "left_semi").select("doc_id", "text_key", "rep")
    # one text of each set, however often its row repeats
    texts = materialize(text_keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
                        .join(wanted, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
                        .select("rep", "text"), "texts")

    def close(pairs: DataFrame) -> DataFrame:
        a = sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("sketch_a"))
        b = sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("sketch_b"))
        return (pairs.join(a, "a").join(b, "b")
                .filter(_close("sketch_a", "sketch_b", percent)))

    met = members.groupBy("rep").agg(F.sum("n").alias("met"))
    leaders = (members.join(met, "rep").groupBy("key")
               .agg(F.max(F.struct("met", (-F.col("rep")).alias("least"))).alias("top"))
               .select("key", (-F.col("top.least")).alias("a")))
    tried = materialize(
        members.select("key", F.col("rep").alias("b")).join(leaders, "key")
        .filter("a <> b").select("a", "b").distinct(), "tried")
    links = materialize(verified(close(tried), texts, shingle, percent), "verified")
    found = materialize(connected_components(links), "components")

    rest = materialize(_apart(members, found), "apart")
    if not rest.isEmpty():
        more = (_block_pairs(rest, sketches, percent)
                .join(tried, ["a", "b"], "left_anti")
                .join(tried.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"],
                      "left_anti"))
        more = materialize(verified(more, texts, shingle, percent), "verified")
        if not more.isEmpty():
            edges = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            found = connected_components(edges.unionByName(more))

    named = materialize(
        sets.select("set_key", "rep", "doc_id").join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .select("set_key", "doc_id", F.coalesce("component", "rep").alias("component")), "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (signed.select("doc_id", "text_key", "n_shingles", "set_key")
            .join(named.join(least, "component").select("set_key", "component_id"), "set_key", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id", "text_key", "set_key")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the keys that still hold texts of several components, with the component."""
    placed = (members.join(found.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    mixed = (placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
             .filter("x <> y").select("key"))
    return placed.join(mixed, "key")


def _block_pairs(rest: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of one key in different components whose sketches are close.

    A key's texts are dealt into blocks of about ``BLOCK``; each pair of blocks is a join key
    of its own, and the sketches are compared inside the join.
    """
    dealt = (rest.join(sketches, "rep")
             .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int")))
    left = dealt.select("key", F.col("rep").alias("a"), F.col("component").alias("of_a"),
                        F.col("sketch").alias("sketch_a"), F.col("block").alias("i"),
                        F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    right = dealt.select("key", F.col("rep").alias("b"), F.col("component").alias("of_b"),
                         F.col("sketch").alias("sketch_b"), F.col("block").alias("j"),
                         F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"))
    met = left.join(right, ["key", "i", "j"]).filter(
        (F.col("of_a") != F.col("of_b")) & ((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
        & _close("sketch_a", "sketch_b", percent))
    return met.select("a", "b").distinct()


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows, with all columns, of one document of each group; rows without id stay.

    Of rows that repeat both id and text, or have one id and the same shingles, one stays.
    """
    kept = (placed_rows(docs, shingle, percent).filter("kept and doc_id is not null")
            # texts without shingles are told apart by themselves
            .groupBy("doc_id", F.coalesce("set_key", F.col("text_key").cast("string").cast("binary")).alias("_set"))
            .agg(F.min("text_key").alias("_text_key")).select(F.col("doc_id").alias("_id"), "_text_key"))
    rows = docs.withColumns({"_id": F.col("doc_id").cast("bigint"), "_text_key": F.xxhash64("text")})
    return (rows.join(kept, ["_id", "_text_key"], "left_semi").dropDuplicates(["_id", "_text_key"])
            .select(*docs.columns).unionByName(docs.filter("doc_id is null")))
