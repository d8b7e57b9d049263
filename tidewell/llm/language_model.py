"""A bigram language model in Elias-Fano tries, learned and queried in shards.

Documents are dealt into blocks of about ``BLOCK_BYTES`` of text.  A block sends the distinct
words it holds, with their counts in training documents, to shards by word hash; a shard sums the counts,
numbers the words and answers each block with number and count.  Then the block sends its
distinct word pairs to shards by context; a shard sums them, builds a trie of contexts and
successors, memory-maps it and answers with quantised counts and numbers of successors.  So counting and
scoring share one shuffle each way, both carry each word or pair of a block once, and no task sees the whole model.

``P(w | v) = max(c(vw) - D, 0) / c(v) + D * n(v) / c(v) * P(w)``, with n(v) the number of
distinct successors, D by the counts of counts of all pairs, and the add-one unigram ``P(w)``.  D is known when all
shards have counted, so tries hold counts (up to 32 as they are, larger ones as a quantised share of c(v)), and
probabilities are formed from them where a text is scored.  A context with many tokens is dealt
over several shards by successor; a block that has it asks all of them, and n(v) is the sum.  So the model does not
depend on the number of blocks or shards.  An unseen word after a known
context has the second term alone.  The first word, and a word after one unknown to the training
documents, has the unigram's probability.

Words lie between ASCII white space, A-Z in lower case; one end token follows the last.  A null or
empty text is the end token alone.  Words are told apart by a 64-bit hash.  A null id counts as a
training document.  Repeated rows each count and give a row; other columns are ignored.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import fold, hash_words, mix64
from tidewell.llm.elias_fano import EliasFano, Trie, code_counts, discounted
from tidewell.session import materialize

BLOCK_BYTES = 12 * 1024 * 1024
BLOCKS_PER_SHARD = 2
CONTEXT_TOKENS = 1_000_000
END = np.uint64(0x656E64)  # stands for the end token
# ``a`` and ``b`` answer a block; rows without one (-1) hold the shard's sums.
_ANSWER = "block bigint, level int, shard int, a binary, b binary, x bigint, y bigint, z bigint"

_ANSWER_NAMES = ["block", "level", "shard", "a", "b", "x", "y", "z"]


def _tokens(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end token last, and the number of tokens of each."""
    hashes, sizes = hash_words(texts)
    return np.insert(hashes, np.cumsum(sizes), END), sizes + 1


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each among ``keys``, and the number of every key."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return ordered[fresh], order[fresh], place


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and the run of every value."""
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(fresh), np.cumsum(fresh) - 1


def _by_shard(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by shard that keeps the order within each, and where each shard begins."""
    order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


class Block:
    """The tokens of a block, with the vocabulary's answers if they are given."""

    def __init__(self, table: pa.Table, shards: int, answers: dict | None = None):
        self.texts = table["text"].to_pylist()
        tokens, self.sizes = _tokens(self.texts)
        hashes, _, self.at = _distinct(tokens)
        self.train = np.repeat(np.array(table["train"].to_pylist(), bool), self.sizes)
        self.order, self.begin = _by_shard((hashes >> np.uint64(32)).astype(np.int64) % shards, shards)
        self.hashes = hashes[self.order]
        if answers is not None:
            number, count = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
            for s in range(shards):
                part = self.order[self.begin[s]:self.begin[s + 1]]
                if len(part):
                    a, b = answers[1, s]
                    number[part], count[part] = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
            self.number, self.count = number, count  # number 0: unknown

    def pairs(self, words: int, shards: int, context_tokens: int) -> Pairs:
        return Pairs(self, words, shards, context_tokens)


class Pairs:
    """The distinct pairs of known words of a block, in order of shard, context and successor.

    Where a shard holds successors of a context that the block has, but none of the block's pairs, successor
    0 asks it for their number alone.  ``pair_of`` and ``context_of`` are a token's pair (-1: it is unseen) and
    the context before it (-1: none or unknown).
    """

    def __init__(self, block: Block, words: int, shards: int, context_tokens: int):
        number = block.number[block.at]
        before = np.concatenate([[0], number[:-1]])
        before[np.cumsum(block.sizes)[:-1]] = 0
        self.contexts, place = np.unique(before, return_inverse=True)
        known = self.contexts > 0
        self.contexts = self.contexts[known]
        self.context_of = place - (~known).sum()
        total = np.zeros(int(block.number.max()) + 1 if len(block.number) else 1, np.int64)
        total[block.number] = block.count
        self.totals = total[self.contexts]
        both = np.flatnonzero((before > 0) & (number > 0))
        pairs, _, pair = _distinct(before[both].astype(np.uint64) * np.uint64(words) + number[both].astype(np.uint64))
        seen = np.bincount(pair, block.train[both], len(pairs)).astype(np.int64)
        context = np.searchsorted(self.contexts, (pairs // np.uint64(words)).astype(np.int64))
        spread = np.minimum(shards, 1 + self.totals // context_tokens)
        side = (mix64(pairs % np.uint64(words)) >> np.uint64(8)).astype(np.int64) % spread[context]
        # every (context, side), and those that no pair of the block asks
        whose = np.repeat(np.arange(len(spread)), spread)
        sides = np.arange(len(whose)) - np.repeat(np.cumsum(spread) - spread, spread)
        rest = np.setdiff1d(whose * shards + sides, context * shards + side)
        keys = np.concatenate([pairs, self.contexts[rest // shards].astype(np.uint64) * np.uint64(words)])
        context, side = np.concatenate([context, rest // shards]), np.concatenate([side, rest % shards])
        shard = ((mix64(self.contexts[context].astype(np.uint64)) >> np.uint64(8)).astype(np.int64) + side) % shards
        order = np.lexsort((keys, shard))
        self.keys, self.context = keys[order], context[order]
        self.seen = np.concatenate([seen, np.zeros(len(rest), np.int64)])[order]
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.pair_of = np.full(len(number), -1, np.int64)
        self.pair_of[both] = rank[pair]

    def parts(self):
        """(shard, first pair, end, places in ``contexts`` of the part's contexts)."""
        for s, (a, b) in enumerate(zip(self.begin[:-1], self.begin[1:])):
            if b > a:
                own = self.context[a:b]
                yield s, a, b, own[_runs(own)[0]]


def _send_words(shards: int):
    def run(table: pa.Table) -> pa.Table:
        block = Block(table, shards)
        seen = np.bincount(block.at, block.train, len(block.hashes)).astype(np.int64)[block.order]
        rows = [(int(table["block"][0].as_py()), s, block.hashes[a:b].tobytes(), seen[a:b].tobytes())
                for s, (a, b) in enumerate(zip(block.begin[:-1], block.begin[1:])) if b > a]
        return _table(rows, ["block", "shard", "keys", "counts"])
    return run


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    kinds = {"block": pa.int64(), "shard": pa.int32(), "level": pa.int32(), "x": pa.int64(), "y": pa.int64(),
             "z": pa.int64()}
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), kinds.get(n, pa.binary())) for c, n in zip(columns, names)], names=names)


def _number_words(shards: int):
    """Answers of a shard of words: numbers (0: not in training) and counts; and one row of
    block -1 with the shard's tokens, words and largest number."""
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        keys = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
        counts = [np.frombuffer(c, np.int64) for c in table["counts"].to_pylist()]
        distinct, _, place = _distinct(np.concatenate(keys))
        total = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
        number = np.where(total > 0, (np.cumsum(total > 0) - 1) * shards + shard + 1, 0)
        rows, at = [], 0
        for block, k in zip(table["block"].to_pylist(), keys):
            mine = place[at:at + len(k)]
            at += len(k)
            rows.append((block, 1, shard, number[mine].tobytes(), total[mine].tobytes(), 0, 0, 0))
        rows.append((-1, 0, shard, b"", b"", int(total.sum()), int((total > 0).sum()), int(number.max())))
        return _table(rows, _ANSWER_NAMES)
    return run


def _answers(table: pa.Table) -> dict:
    return {(level, shard): (a, b) for level, shard, a, b in zip(
        *[table[c].to_pylist() for c in ("level", "shard", "a", "b")])}


def _send_pairs(shards: int, words: int, context_tokens: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows:
            block = Block(docs, shards, _answers(told))
            pairs = block.pairs(words, shards, context_tokens)
            for shard, a, b, contexts in pairs.parts():
                rows.append((int(docs["block"][0].as_py()), shard, EliasFano.encode(pairs.keys[a:b], words * words),
                             pairs.seen[a:b].astype(np.uint32).tobytes(), pairs.totals[contexts].tobytes()))
        return _table(rows, ["block", "shard", "keys", "counts", "totals"])
    return run


def _answer_pairs(shards: int, words: int):
    def run(table: pa.Table) -> pa.Table:
        blocks, shard = table["block"].to_pylist(), table["shard"][0].as_py()
        keys = [EliasFano(k).decode() for k in table["keys"].to_pylist()]
        sizes = np.array([len(k) for k in keys])
        flat = np.concatenate(keys)
        counts = np.concatenate([np.frombuffer(c, np.uint32) for c in table["counts"].to_pylist()])
        totals = np.concatenate([np.frombuffer(t, np.int64)[_runs(k // np.uint64(words))[1]]
                                 for k, t in zip(keys, table["totals"].to_pylist())])
        distinct, first, place = _distinct(flat)
        seen = np.bincount(place, counts, len(distinct)).astype(np.int64)
        there = seen > 0
        data = Trie.build(distinct[there], words, code_counts(seen[there], totals[first[there]]))
        with tempfile.NamedTemporaryFile(prefix="trie-") as file:  # gone when the task has answered
            file.write(data)
            file.flush()
            trie = Trie(np.memmap(file.name, np.uint8, "r", shape=(os.path.getsize(file.name),)))
            code, many = trie.look_up(distinct // np.uint64(words), distinct % np.uint64(words))
            del trie
        rows, at = [], 0
        for block, n in zip(blocks, sizes):
            mine = place[at:at + n]
            at += n
            contexts = mine[_runs(distinct[mine] // np.uint64(words))[0]]
            rows.append((block, 2, shard, code[mine].tobytes(), many[contexts].astype(np.uint32).tobytes(), 0, 0, 0))
        rows.append((-1, 3, shard, b"", b"", int((seen == 1).sum()), int((seen == 2).sum()), 0))
        return _table(rows, _ANSWER_NAMES)
    return run


def _score(shards: int, words: int, context_tokens: int, tokens: int, types: int, discount: float):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        names = ["doc_id", "train", "n_tokens", "n_known", "base_score", "score"]
        if not docs.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(),
                                                       pa.float64(), pa.float64())], names=names)
        answers = _answers(told)
        block = Block(docs, shards, answers)
        pairs = block.pairs(words, shards, context_tokens)
        code, many = np.zeros(len(pairs.keys), np.uint8), np.zeros(len(pairs.contexts), np.int64)
        for shard, a, b, contexts in pairs.parts():
            code[a:b] = np.frombuffer(answers[2, shard][0], np.uint8)
            many[contexts] += np.frombuffer(answers[2, shard][1], np.uint32)
        count = block.count[block.at]
        unigram = (count + 1.0) / (tokens + types + 1.0)
        model = unigram.copy()
        after = np.flatnonzero(pairs.context_of >= 0)
        context = pairs.context_of[after]
        model[after] = np.minimum(discount * many[context] / pairs.totals[context], 1.0) * unigram[after]
        paired = np.flatnonzero(pairs.pair_of >= 0)
        model[paired] += discounted(code[pairs.pair_of[paired]], pairs.totals[pairs.context_of[paired]], discount)
        first = np.cumsum(block.sizes) - block.sizes
        sums = [np.add.reduceat(np.log10(x), first) for x in (unigram, np.minimum(model, 1.0))]
        known = np.add.reduceat((count > 0).astype(np.int64), first)
        return pa.table([docs["doc_id"].combine_chunks(), docs["train"].combine_chunks(), pa.array(block.sizes),
                         pa.array(known), pa.array(sums[0]), pa.array(sums[1])], names=names)
    return run


def score_texts(docs: DataFrame, *, parts: int = 7, held_out: int = 2, block_bytes: int = BLOCK_BYTES,
                context_tokens: int = CONTEXT_TOKENS) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` of every row.

    The model is learned from the documents outside the held-out fold.  ``base_score`` is the
    add-one unigram's log10 probability, ``score`` the bigram model's.  ``block_bytes`` of text are a block, and
    contexts with ``context_tokens`` tokens are dealt over shards; neither changes the scores.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    shards = max(1, blocks // BLOCKS_PER_SHARD)
    dealt = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                        (fold("doc_id", parts) != held_out).alias("train"),
                        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"))
    vocabulary = materialize(
        dealt.groupBy("block").applyInArrow(_send_words(shards), "block bigint, shard int, keys binary, counts binary")
        .groupBy("shard").applyInArrow(_number_words(shards), _ANSWER), "vocabulary")
    tokens, types, largest = (n or 0 for n in vocabulary.filter("level = 0").agg(
        F.sum("x"), F.sum("y"), F.max("z")).first())
    words = largest + 1
    if words >= 1 << 32:
        raise ValueError(f"{words} numbers of words: pairs of them do not fit into 64 bits")
    told = vocabulary.filter("level = 1")
    answers = materialize(dealt.groupBy("block").cogroup(told.groupBy("block"))
                          .applyInArrow(_send_pairs(shards, words, context_tokens),
                                        "block bigint, shard int, keys binary, counts binary, totals binary")
                          .groupBy("shard").applyInArrow(_answer_pairs(shards, words), _ANSWER), "answers")
    once, twice = (n or 0 for n in answers.filter("level = 3").agg(F.sum("x"), F.sum("y")).first())
    discount = min(max(once / max(1, once + 2 * twice), 0.1), 0.95)
    scored = dealt.groupBy("block").cogroup(
        told.unionByName(answers.filter("level = 2")).groupBy("block")).applyInArrow(
        _score(shards, words, context_tokens, tokens, types, discount),
        "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
