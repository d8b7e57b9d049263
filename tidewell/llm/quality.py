"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  The bad state's score of a line is linear in features of the line
and of its neighbours; transitions have weights of their own, the path of only good lines
scores 0.  Only documents have labels, so the field is fitted on them: a good
document has only good lines, a bad one has at least one bad line.  Forward-backward gives each line
the probability of being bad; their mean, weighted by line length, is calibrated to the
probability that the document is good.

A null or empty text is one empty line.  Repeated rows each give a row; other columns are
ignored.  Without labels of both classes every line is good and the score is the share of
good labels, or 0.5 without any.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tidewell.llm.common import fit_in_task, labelled_sample, map_documents

PER_CLASS = 3000
ROUNDS = 150
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGIT = b"0123456789"
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,|")
N_FEATURES = 13


def line_features(line: str) -> list[float]:
    data = line.encode("utf-8", "replace")
    size, words = max(1, len(data)), data.split()
    n = max(1, len(words))
    count = lambda drop: len(data) - len(data.translate(None, drop))
    marks, bars = count(_MARKS), count(b"|")
    return [
        1.0, count(_UPPER) / size, count(_DIGIT) / size, min(1.0, 4 * marks / size),
        min(1.0, 2 * bars / n), min(1.0, marks / n), 1 - len(set(words)) / n,
        float(len(words) >= 2 and words[0] == words[1]), min(len(words), 60) / 60,
        float(len(words) < 3), float(data[-1:] in (b".", b"!", b"?")),
        float(data.strip()[:1].islower()), min(2.0, size / n / 12),
    ]


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with those of its neighbours, and line lengths."""
    lines = (text or "").split("\n")
    own = np.array([line_features(x) for x in lines], np.float32)
    edge = np.zeros((1, own.shape[1]), np.float32)
    return (np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])]),
            np.array([len(x) + 1 for x in lines], float))


def marginals(emission: np.ndarray, sizes: np.ndarray, turn: np.ndarray):
    """Forward-backward over many chains at once.

    ``emission`` holds the bad state's score of all lines, chain after chain; ``turn`` the
    scores of good-bad, bad-good and bad-bad.  Returns the probability of bad of each line,
    each chain's log partition, and the expected counts of the three turns by chain.
    """
    order = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    size, chains, total = sizes[order], len(sizes), len(emission)
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right") if chains else []
    good, bad = np.zeros(total), np.zeros(total)
    for t, n in enumerate(live):
        at = first[:n] + t
        if t == 0:
            bad[at] = emission[at]
            continue
        g, b = good[at - 1], bad[at - 1]
        good[at] = np.logaddexp(g, b + turn[1])
        bad[at] = np.logaddexp(g + turn[0], b + turn[2]) + emission[at]
    last = first + size - 1
    log_z = np.zeros(chains)
    log_z[order] = np.logaddexp(good[last], bad[last])
    back_good, back_bad = np.zeros(total), np.zeros(total)
    turns = np.zeros((chains, 3))
    for t in range(len(live) - 2, -1, -1):
        n = live[t + 1]
        at = first[:n] + t
        g, b = back_good[at + 1], back_bad[at + 1] + emission[at + 1]
        z = log_z[order[:n]]
        turns[order[:n], 0] += np.exp(good[at] + turn[0] + b - z)
        turns[order[:n], 1] += np.exp(bad[at] + turn[1] + g - z)
        turns[order[:n], 2] += np.exp(bad[at] + turn[2] + b - z)
        back_good[at] = np.logaddexp(g, turn[0] + b)
        back_bad[at] = np.logaddexp(turn[1] + g, turn[2] + b)
    return np.exp(bad + back_bad - np.repeat(log_z, sizes)), log_z, turns


def _weighted(p: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.bincount(owner, p * lengths, len(sizes)) / np.bincount(owner, lengths, len(sizes))


def _inputs(share: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(share)), share, np.sqrt(share)])


def fit_texts(texts: list, labels: list[int]) -> dict:
    """Weights of the field and the calibration, from labels (1: good)."""
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        rate = float(y.mean()) if len(y) else 0.5
        z = 0.0 if rate == 0.5 else 20.0 if rate == 1 else -20.0
        return {"w": np.append(-40.0, np.zeros(3 * N_FEATURES - 1)), "turn": np.zeros(3), "out": np.array([z, 0, 0])}
    made = [document_features(t) for t in texts]
    x, lengths = np.vstack([m[0] for m in made]), np.concatenate([m[1] for m in made])
    sizes = np.array([len(m[1]) for m in made])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    w, turn = np.zeros(x.shape[1]), np.array([-1.0, -1.0, 1.0])
    w[0] = -3.0
    theta = np.concatenate([w, turn])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        p, log_z, turns = marginals(x @ theta[:-3], sizes, theta[-3:])
        # all lines good has probability 1 / Z
        pull = np.where(y > 0, -1.0, 1 / np.maximum(np.expm1(np.minimum(log_z, 50)), 1e-3))
        grad = np.concatenate([x.T @ (p * pull[owner]), pull @ turns]) / len(y) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    p, _, _ = marginals(x @ theta[:-3], sizes, theta[-3:])
    inputs, out = _inputs(_weighted(p, lengths, sizes)), np.zeros(3)
    for _ in range(30):  # Newton steps of a logistic fit
        q = 1 / (1 + np.exp(-np.clip(inputs @ out, -30, 30)))
        hessian = inputs.T @ (inputs * np.maximum(q * (1 - q), 1e-4)[:, None]) + 1e-2 * np.eye(3)
        out += np.linalg.solve(hessian, inputs.T @ (y - q) - 1e-2 * out)
    return {"w": theta[:-3], "turn": theta[-3:], "out": out}


def fit_quality(docs: DataFrame, labels: DataFrame, *, parts: int = 5, held_out: int = 0,
                per_class: int = PER_CLASS) -> dict:
    """Learn from at most about ``per_class`` labelled documents of each class outside the
    held-out fold."""
    sample = labelled_sample(docs, labels, "quality", per_class, parts, held_out)
    return fit_in_task(sample, lambda rows: fit_texts(rows["text"].to_pylist(),
                                                      rows["label"].to_pylist()))


def scorer(model: dict):
    """A function from a list of texts to [(score, lines, probability of bad of each line)]."""
    def score(texts: list):
        if not texts:
            return []
        made = [document_features(t) for t in texts]
        sizes = np.array([len(m[1]) for m in made])
        p, _, _ = marginals(np.vstack([m[0] for m in made]) @ model["w"], sizes, model["turn"])
        share = _weighted(p, np.concatenate([m[1] for m in made]), sizes)
        good = 1 / (1 + np.exp(-np.clip(_inputs(share) @ model["out"], -40, 40)))
        return list(zip(good.tolist(), np.split(p, np.cumsum(sizes)[:-1])))

    return score


def score_quality(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``score`` (probability of good) and ``bad``, that of each line being bad."""
    def make():
        score = scorer(model)
        return lambda ids, texts: ((i, s, p.tolist()) for i, (s, p) in zip(ids, score(texts)))

    return map_documents(docs, ["doc_id", "text"], "doc_id bigint, score double, bad array<float>", make)
