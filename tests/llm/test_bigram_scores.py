"""Scores of the language model against a plain bigram model."""

import math
import zlib
from collections import Counter

import numpy as np

from tidewell.llm.common import words_of
from tidewell.llm.elias_fano import _STEP
from tidewell.llm.language_model import score_texts


def test_scores_are_those_of_a_plain_bigram(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.6, 40) % 30)) for i in range(300)]
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    fresh = next(i for i in range(300, 400) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows.append((fresh, " ".join(f"w1 new{i}" for i in range(50))))
    split = lambda t: words_of(t) + [b"\n"]
    words = Counter(w for t in train for w in split(t))
    pairs = Counter(p for t in train for p in zip(split(t), split(t)[1:]))
    after = Counter(v for v, _ in pairs)
    once, twice = (sum(c == n for c in pairs.values()) for n in (1, 2))
    d = min(max(once / max(1, once + 2 * twice), 0.1), 0.95)
    n, types = sum(words.values()), len(words)

    def probability(v, w):
        unigram = (words[w] + 1) / (n + types + 1)
        if not words[v]:
            return unigram
        return max(pairs[v, w] - d, 0) / words[v] + d * after[v] / words[v] * unigram

    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = dict(rows)
    found = {}
    # one shard; several; and contexts dealt over them
    for options in ({}, {"block_bytes": 3000}, {"block_bytes": 900}, {"block_bytes": 900, "context_tokens": 50}):
        found[str(options)] = scores = {r["doc_id"]: r["score"] for r in score_texts(docs, **options).collect()}
        for i, score in scores.items():
            tokens = split(texts[i])
            plain = sum(math.log10(probability(v, w)) for v, w in zip([None, *tokens], tokens))
            assert abs(score - plain) <= len(tokens) * _STEP / 2 + 1e-9
    one = found.pop("{}")
    assert all(abs(scores[i] - one[i]) < 1e-9 for scores in found.values() for i in one)
