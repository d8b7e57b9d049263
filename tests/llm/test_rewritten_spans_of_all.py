"""The model of personal data learns from all documents, however their rows are dealt."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_rewritten_spans import _card, _texts
from tidewell.llm import pii


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def _turns(docs):
    return docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("turn"))


def test_documents_that_a_sample_by_id_leaves_out_are_learned_from(spark):
    rng = np.random.default_rng(12)
    # Of 14000 documents, a sample of 6000 by this hash of the id has none of the ids in ``late``.
    ids = spark.range(14000).withColumnRenamed("id", "doc_id")
    late = [r["doc_id"] for r in ids.filter(
        F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) >= int(0.45 * (1 << 30))).orderBy("doc_id").collect()]
    held = dict(zip(late, _texts(rng, 600)))
    model = pii.fit_pii(_docs(spark, [(i, held.get(i, "nothing here")) for i in range(14000)]))
    card = _card(rng).replace(" ", ".")
    hidden = f"mail me: ann [at] host [dot] com or call 49 301 2345 678 now. Pay by card {card} today."
    clean = "Built on 2019-04-17, part 1234.5678.90 of 123 456 789 012."
    (_, spans), (_, none) = pii.finder(model)([hidden, clean])
    assert none == [] and {(k, hidden[s:e]) for k, s, e in spans} == {
        ("email", "ann [at] host [dot] com"), ("phone", "49 301 2345 678"), ("card", card)}


def test_counts_are_those_of_all_rows_however_dealt(spark):
    rng = np.random.default_rng(13)
    rows = [(i % 190 or None, t) for i, t in enumerate(_texts(rng, 100))] + [(7, None), (None, "")]
    rows += rows[:40]  # repeated rows count again
    docs = _docs(spark, rows)
    turns = [(r["text"] or "", r["turn"]) for r in _turns(docs).collect()]
    plain = pii.fit_texts(*map(list, zip(*turns)))
    assert plain["trees"]
    n = sum(1 for text, turn in turns for _ in pii.examples(text, turn))
    for parts in (1, 5):
        dealt = docs.repartition(parts)
        assert pii.example_rows(dealt).agg(F.sum("n")).first()[0] == n
        assert pii.fit_pii(dealt) == plain


def test_trees_are_grown_as_on_single_rows():
    """The first tree and the thresholds, recomputed row by row."""
    rng = np.random.default_rng(14)
    texts = list(_texts(rng, 200))
    model = pii.fit_texts(texts)
    side, x, y = zip(*((n % 3 == 0, x, y) for n, t in enumerate(texts) for x, y in pii.examples(t, n)))
    side, x, y = np.array(side), np.array(x), np.array(y)

    def grow(x, g, depth):
        value = -g.sum() / (0.25 * len(g) + 1)
        if depth == 0 or len(g) < pii.LEAST_ROWS:
            return value
        strength = lambda part: part.sum() ** 2 / (0.25 * len(part) + 1)
        gains = [(strength(g[x[:, f] <= c]) + strength(g[x[:, f] > c]) - strength(g), -f, -c)
                 for f, marks in enumerate(cuts) for c in marks]
        gain, f, c = max(((round(v, 9), f, c) for v, f, c in gains), default=(0, 0, 0))
        if gain <= 1e-3:
            return value
        left = x[:, -f] <= -c
        return (-f, -c, grow(x[left], g[left], depth - 1), grow(x[~left], g[~left], depth - 1))

    tx = x[~side]
    step = np.where(tx >= 1000, 10.0 ** np.floor(np.log10(np.maximum(tx, 1)) - 2), 1)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 33)[1:-1])) for c in (np.floor(tx / step) * step).T]

    def same(a, b):
        if not isinstance(a, tuple):
            return not isinstance(b, tuple) and a == pytest.approx(b, abs=1e-6)
        return a[0] == b[0] and a[1] == pytest.approx(b[1]) and same(a[2], b[2]) and same(a[3], b[3])

    assert same(model["trees"][0], grow(tx, 0.5 - y[~side], pii.DEPTH))
    z = pii.raw_scores(model["trees"], x)
    for place, kind in enumerate(pii.KINDS):
        mine = side & (x[:, 0] == place)
        good = [c for c in np.unique(np.quantile(z[mine], np.linspace(0, 1, pii.BINS + 1)) if mine.any() else [])
                if y[mine & (z >= c - 1e-9)].mean() >= pii.PRECISION]
        assert model["least"][kind] == pytest.approx(good[0]) if good else model["least"][kind] == float("inf")
