"""Models against plain recomputation: decoding, noisy-or, overlaps; samples in one pass."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import common, language, pii, toxicity
from tidewell.llm.common import read_table
from tests.conftest import SF_DIR


def test_decoding_takes_the_codeword_of_least_weighted_loss(spark):
    docs = read_table(spark, SF_DIR, "documents").filter("doc_id < 200")
    model = language.fit_language(docs)
    found = {r["doc_id"]: r for r in language.identify_language(docs, model).collect()}
    assert len(model["languages"]) > 1
    for r in docs.select("doc_id", "text").collect():
        if not r["text"] or not language.LETTER.search(r["text"]):
            assert (found[r["doc_id"]]["lang_pred"], found[r["doc_id"]]["score"]) == ("und", 0.0)
            continue
        x = language.profile(r["text"]).astype(float)
        loss = []
        for k in range(len(model["languages"])):
            bits = range(model["code"].shape[1])
            margins = [float(x @ model["w"][:-1, b]) + float(model["w"][-1, b]) for b in bits]
            loss.append(sum(model["trust"][k, b] * math.log1p(math.exp(-model["code"][k, b] * margins[b]))
                            for b in bits))
        p = sorted((math.exp(-v) / sum(math.exp(-u) for u in loss) for v in loss), reverse=True)
        got = found[r["doc_id"]]
        assert got["lang_pred"] == model["languages"][int(np.argmin(loss))]
        assert got["score"] == pytest.approx(p[0], abs=1e-4)
        assert got["ambiguous"] == (p[0] - p[1] < language.MARGIN) or abs(p[0] - p[1] - 0.25) < 1e-3


def test_scores_are_the_noisy_or_of_sentences(spark):
    docs, labels = (read_table(spark, SF_DIR, t) for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    for r in docs.select("doc_id", "text").collect():
        clean, shown = 1.0, []
        for m in toxicity.SENTENCE.finditer((r["text"] or "").lower()):
            words = set(toxicity.WORD.findall(m[0]))
            held = {f for w in words for f in toxicity.word_features(w)} & set(model["weights"])
            if words:
                p = 1 / (1 + math.exp(-(model["bias"] + sum(model["weights"][f] for f in held))))
                clean *= 1 - p
                shown += [m.span()] if p >= toxicity.OFFENDING else []
        got = rows[r["doc_id"]]
        assert got["score"] == pytest.approx(1 - clean, abs=1e-9)
        assert len(got["offending"]) == len(shown)


def test_fitted_weights_leave_no_slope():
    """The likelihood of noisy-or documents does not rise when the bias moves either way."""
    texts = ["good day. you fool. fine"] * 20 + ["good day. fine"] * 30 + ["a fool said. so"] * 5
    y = [1] * 20 + [0] * 30 + [0, 1, 0, 0, 1]
    model = toxicity.fit_bags(texts, y)

    def loss(shift):
        score = toxicity.sentence_scorer({**model, "bias": model["bias"] + shift})
        p = [min(max(score(t)[0], 1e-12), 1 - 1e-12) for t in texts]
        return -sum(math.log(q if k else 1 - q) for q, k in zip(p, y))

    assert loss(0) < loss(1.0) and loss(0) < loss(-1.0)


def test_overlaps_are_those_of_all_pairs():
    rng = np.random.default_rng(3)
    span = lambda: (lambda s: ("ip", s, s + int(rng.integers(1, 9))))(int(rng.integers(0, 120)))
    for _ in range(300):
        spans, asked = [span() for _ in range(rng.integers(0, 15))], [span() for _ in range(20)]
        test = pii.overlap_test(spans)
        for _, s, e in asked:
            assert test(s, e) == any(a < e and s < b for _, a, b in spans)
        taken = []
        for k, s, e in asked:
            if not any(a < e and s < b for _, a, b in taken):
                taken.append((k, s, e))
        assert pii.disjoint(asked) == taken


def test_time_follows_the_length_of_a_text_with_many_spans():
    model = {"trees": [1.0], "least": {k: 0.0 for k in pii.KINDS}}
    find, took = pii.finder(model), []
    for n in (4_000, 32_000):  # up to 2 MB and 96,000 spans
        text = "mail a.b@c.de or 10.0.0.1 or a [at] b [dot] com 1.2.3.999 on " * n
        start = time.perf_counter()
        (base, spans), = find([text])
        took.append(time.perf_counter() - start)
        assert len(base) == 2 * n and len(spans) >= 3 * n
    assert took[1] < 24 * took[0]


def test_samples_of_all_values_in_one_pass(spark, plan_of):
    rows = spark.range(9000).select("id", F.when(F.col("id") < 8000, "big").when(F.col("id") < 8990, "mid")
                                    .when(F.col("id") < 8999, "few").alias("kind"))
    rows = rows.unionAll(rows)
    sample = common.bounded_sample(rows, "id", "kind", 400)
    found = {r["kind"]: r["count"] for r in sample.groupBy("kind").count().collect()}
    assert set(found) == {"big", "mid", "few"} and found["few"] == 9
    assert all(found[k] <= common.most_rows(400) for k in found) and found["big"] > 100
    assert sample.count() == sample.distinct().count() and sample.columns == ["id", "kind"]
    assert common.bounded_sample(rows.limit(0), "id", "kind", 5).count() == 0
