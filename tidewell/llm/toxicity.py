"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence gets a probability from a sparse
logistic model; the document's probability is their noisy-or, ``1 - prod(1 - p)``.  Only
document labels are needed: the gradient of the noisy-or finds the sentences that explain
a label, so the fitted model also says where the offending sentences are.

Null and empty texts have no sentence and score 0.  A text without any word scores 0.
Repeated rows each give a row; columns other than the id and the text are ignored.
Without labels of both classes nothing is learned and every score is 0.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame

from tidewell.llm.common import Memo, fit_in_task, labelled_sample, map_documents

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W_]+")
FEATURE_BITS = 20
# Bounds of the fit: labelled documents of each class, and features kept.
PER_CLASS = 4000
MAX_FEATURES = 4096
OFFENDING = 0.3


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-case word: itself and its beginnings of 3 to 6 letters."""
    parts = [word] + [f"{word[:n]}-" for n in range(3, 7) if n < len(word)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) >> (32 - FEATURE_BITS) for p in parts]


def _select(texts: list[str], y: np.ndarray, at_most: int) -> np.ndarray:
    """Features that occur in positive documents more often than in others, best first by
    the gain in likelihood; ties to the smaller feature."""
    counts, memo = np.zeros((2, 1 << FEATURE_BITS)), Memo(word_features)
    for text, label in zip(texts, y):
        found = set()
        for word in set(WORD.findall(text.lower())):
            found.update(memo[word])
        counts[int(label), list(found)] += 1
    neg, pos = counts
    expected = (pos + neg) * y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(pos / y.sum() > 2 * neg / (1 - y).sum(), pos * np.log(pos / expected), 0)
    gain[pos < 3] = 0
    order = np.lexsort((np.arange(len(gain)), -gain))[:at_most]
    return order[gain[order] > 0]


def _bags(texts: list[str], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct chosen features of every sentence, the sentence of each, the document of each
    sentence that has a word."""
    place = {int(f): i for i, f in enumerate(chosen)}
    memo = Memo(lambda word: [place[f] for f in word_features(word) if f in place])
    features, sentences, owner = [], [], []
    for d, text in enumerate(texts):
        for sentence in SENTENCE.findall(text.lower()):
            words = WORD.findall(sentence)
            if words:
                found = {f for word in words for f in memo[word]}
                features += found
                sentences += [len(owner)] * len(found)
                owner.append(d)
    return np.array(features, np.int64), np.array(sentences, np.int64), np.array(owner, np.int64)


def fit_bags(texts: list[str], labels: list[int], rounds: int = 250, l1: float = 2e-4,
             max_features: int = MAX_FEATURES) -> dict:
    """Weights of hashed features and the bias, by proximal Adam on the noisy-or likelihood.

    Classes count by their rows; the sample may hold the classes in another ratio than the
    corpus, which moves the bias only.
    """
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return {"weights": {}, "bias": -40.0}
    chosen = _select(texts, y, max_features)
    column, sentence, owner = _bags(texts, chosen)
    n, d = len(owner), len(y)
    theta = np.zeros(len(chosen) + 1)
    theta[-1] = -5.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        z = theta[-1] + np.bincount(sentence, theta[column], n)
        survive = np.maximum(np.bincount(owner, np.logaddexp(0, z), d), 1e-9)
        # survive = -log(1 - P); the derivative of the loss by it
        slope = (1 - y) - y / np.expm1(np.minimum(survive, 50))
        dz = slope[owner] / (1 + np.exp(-np.clip(z, -40, 40)))
        grad = np.append(np.bincount(column, dz[sentence], len(chosen)), dz.sum()) / d
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        rate = 0.2 / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
        theta -= np.minimum(rate, 200) * m / (1 - 0.9 ** step)
        weights = theta[:-1]
        theta[:-1] = np.sign(weights) * np.maximum(np.abs(weights) - l1 * 50, 0)
    used = np.flatnonzero(theta[:-1])
    return {"weights": {int(chosen[i]): float(theta[i]) for i in used}, "bias": float(theta[-1])}


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", *, parts: int = 4,
                 held_out: int = 2, per_class: int = PER_CLASS, max_features: int = MAX_FEATURES) -> dict:
    """Learn from at most about ``per_class`` labelled documents of each class, none of
    whose ids has ``crc32(id) mod parts`` equal to ``held_out``.  The model uses the
    ``max_features`` best features."""
    sample = labelled_sample(docs, labels, label, per_class, parts, held_out)
    return fit_in_task(sample, lambda rows: fit_bags(
        [t or "" for t in rows["text"].to_pylist()], rows["label"].to_pylist(), max_features=max_features))


def sentence_scorer(model: dict):
    """A function from a text to (score, [(start, end, probability of a sentence)])."""
    weights, bias = model["weights"], model["bias"]

    # a feature counts once in a sentence, so words keep their features apart
    memo = Memo(lambda word: tuple(f for f in word_features(word) if f in weights))

    def score(text: str | None):
        found, survive = [], 0.0
        lowered = (text or "").lower()
        same = len(lowered) == len(text or "")
        for match in SENTENCE.finditer(lowered):
            words = set(WORD.findall(match[0]))
            if not words:
                continue
            features = {f for hit in map(memo.__getitem__, words) if hit for f in hit}
            z = min(40.0, bias + sum(weights[f] for f in sorted(features)))
            p = 1 / (1 + math.exp(-max(z, -40.0)))
            survive += math.log1p(-p) if p < 1 else -40.0
            if p >= OFFENDING:
                # a few letters change their length in lower case; then the span is the text
                found.append((*(match.span() if same else (0, len(text))), p))
        return min(1.0, max(0.0, -math.expm1(survive))), found

    return score


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``offending``, the sentences with a probability of
    at least 0.3 as ``start``, ``end`` (code points, end exclusive) and ``score``."""
    def make():
        score = sentence_scorer(model)
        return lambda ids, texts: ((i, *score(t)) for i, t in zip(ids, texts))

    return map_documents(docs, ["doc_id", "text"],
                         "doc_id bigint, score double, "
                         "offending array<struct<start:int,end:int,score:double>>", make)


def drop_toxic(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose text scores below ``threshold``."""
    import pyarrow as pa

    def run(batches):
        score = sentence_scorer(model)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([score(t)[0] < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
