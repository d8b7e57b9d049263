"""Queries whose nearest lists are short."""

import numpy as np

from tidewell.llm import nearest


def test_a_query_in_a_short_list_goes_on(spark, monkeypatch):
    model = {"centres": np.eye(3), "rotation": np.eye(3), "probes": 1, "dim": 3,
             "sample": np.zeros((0, 3), np.float32), "owner": np.zeros(0, np.int64)}
    monkeypatch.setattr(nearest, "fit_in_task", lambda sample, fit: model)
    rows = [(i, [1.0, 0.2, i / 1000]) for i in range(3)] + [(i, [0.0, 1.0, i / 1000]) for i in range(3, 63)] \
        + [(i, [i / 1000, 0.0, 1.0]) for i in range(63, 70)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = {}
    for r in nearest.nearest_neighbours(vectors, every=20, k=20).collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert {q: len(set(ids)) for q, ids in found.items()} == {q: 20 for q in (0, 20, 40, 60)}
    assert set(found[0]) >= {1, 2}
