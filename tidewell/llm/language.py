"""Language identification with error-correcting output codes.

Each language has a codeword.  For each bit a logistic classifier over hashed byte 2- and 3-grams
predicts +1 or -1.  Decoding takes the language with the smallest weighted loss over its
bits, ``sum(w[k, b] * log(1 + exp(-code[k, b] * margin[b])))``; the weights follow how
well bit ``b`` holds on the language's own training texts.  Up to seven languages get the exhaustive
code, more get the best of several dense random codes.  ``ambiguous`` marks texts whose
runner-up is close.

Texts that are null or have no letter are ``und`` with score 0.  With one language, every
text with a letter is that language.  With none, every text is ``und``.  Of equally near
codewords the first language by name is taken.  Repeated rows each give a
row; other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import bounded_sample, fit_in_task, fold, map_documents, most_rows

LETTER = re.compile(r"[^\W\d_]")
BITS = 12  # of each of the two feature tables
# Bound of the fit: about so many texts over all languages.
SAMPLE_DOCS = 4000
MARGIN = 0.25
_BLANK = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language."""
    if languages <= 7:
        columns = range(1, 1 << max(0, languages - 1))
        rows = [[1] * len(columns)] if languages else []
        rows += [[-1 if c >> (k - 1) & 1 else 1 for c in columns] for k in range(1, languages)]
        return np.array(rows, float).reshape(languages, len(columns))
    width, best = int(np.ceil(10 * np.log2(languages))), (-1, None)
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (languages, width))
        split = (np.abs(code.sum(axis=0)) < languages).all()
        near = min((width - a @ b) / 2 for a, b in combinations(code, 2)) if split else -1
        if near > best[0]:
            best = (near, code)
    return best[1]


def profile(text: str) -> np.ndarray:
    """Square roots of hashed n-gram counts, at length 1."""
    data = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace").translate(_BLANK), np.uint8)
    a = data.astype(np.uint32)
    two = a[:-1] << 8 | a[1:]
    three = (two[:-1] << 8 | a[2:]) * np.uint32(0x9E3779B1)
    two = two * np.uint32(0x85EBCA6B)
    shift = np.uint32(32 - BITS)
    x = np.concatenate([np.bincount(two >> shift, minlength=1 << BITS),
                        np.bincount(three >> shift, minlength=1 << BITS)])
    x = np.sqrt(x, dtype=np.float32)
    return x / np.sqrt(x @ x)


def fit_profiles(x: np.ndarray, y: np.ndarray, languages: list[str], rounds: int = 120) -> dict:
    """One logistic classifier for each bit, all fitted side by side."""
    code = codewords(len(languages)).astype(np.float32)
    target = code[y]
    w = np.zeros((x.shape[1] + 1, code.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        pull = -target / (1 + np.exp(np.clip(target * (x @ w[:-1] + w[-1]), -30, 30)))
        grad = np.vstack([x.T @ pull, pull.sum(axis=0, keepdims=True)]) / len(x) + 1e-6 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.3 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
    right = (target * (x @ w[:-1] + w[-1]) > 0).astype(float)
    trust = np.array([right[y == k].mean(axis=0) for k in range(len(languages))])
    trust = np.maximum(trust - 0.5, 0.01)
    return {"languages": languages, "code": code, "w": w,
            "trust": trust / trust.mean(axis=1, keepdims=True) if trust.size else trust}


def fit_language(docs: DataFrame, *, parts: int = 5, held_out: int = 0,
                 sample_docs: int = SAMPLE_DOCS) -> dict:
    """Learn from about ``sample_docs`` rows with a language, evenly over the languages, none
    in the held-out fold."""
    known = docs.select("doc_id", "text", F.col("lang").alias("label")).filter(
        F.col("label").isNotNull() & (fold("doc_id", parts) != held_out))
    names = known.agg(F.count_distinct("label")).first()[0]
    each = max(20, sample_docs // max(1, names))
    ids = bounded_sample(known.select("doc_id", "label"), "doc_id", "label", each)
    # an id with many rows must not make the sample larger
    sample = (known.join(F.broadcast(ids), ["doc_id", "label"])
              .limit(max(1, names) * most_rows(each)))

    def fit(rows):
        pairs = [(t, k) for t, k in zip(rows["text"].to_pylist(), rows["label"].to_pylist())
                 if t and LETTER.search(t)]
        found = sorted({k for _, k in pairs})
        if not found:
            return {"languages": []}
        x = np.array([profile(t) for t, _ in pairs], np.float32)
        return fit_profiles(x, np.array([found.index(k) for _, k in pairs]), found)

    return fit_in_task(sample.select("doc_id", "text", "label"), fit)


def predictor(model: dict):
    """A function from a list of texts to [(language, score, ambiguous)]."""
    languages = model["languages"]

    def predict(texts: list):
        out = [("und", 0.0, False)] * len(texts)
        some = [n for n, t in enumerate(texts) if languages and t and LETTER.search(t)]
        for start in range(0, len(some), 200):
            rows = some[start:start + 200]
            if len(languages) == 1:
                probability = np.ones((len(rows), 1))
            else:
                x = np.array([profile(texts[n]) for n in rows], np.float32)
                margin = (x @ model["w"][:-1] + model["w"][-1]).astype(float)
                loss = np.logaddexp(0, -model["code"][None] * margin[:, None, :])
                loss = (model["trust"][None] * loss).sum(axis=2)
                probability = np.exp(loss.min(axis=1, keepdims=True) - loss)
                probability /= probability.sum(axis=1, keepdims=True)
            order = np.argsort(-probability, axis=1, kind="stable")
            for n, p, o in zip(rows, probability, order):
                close = len(o) > 1 and p[o[0]] - p[o[1]] < MARGIN
                out[n] = (languages[o[0]], float(p[o[0]]), bool(close))
        return out

    return predict


def identify_language(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``ambiguous`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bits x 8192 weights

    def make():
        predict = predictor(shared.value)
        return lambda ids, texts: ((i, *p) for i, p in zip(ids, predict(texts)))

    return map_documents(docs, ["doc_id", "text"],
                         "doc_id bigint, lang_pred string, score double, ambiguous boolean", make)
