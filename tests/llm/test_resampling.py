"""Importance resampling: the CRC by position, features, draws and edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.conftest import SF_DIR
from tidewell.llm.position_crc import PositionCrc
from tidewell.llm.queries import QUERIES, SQL
from tidewell.llm.resampling import draw, resample

EDGE = [(1, None, 9), (2, "", 9), (3, "One two, TWO three", 9), (3, "One two, TWO three", 9),
        (None, "no id at all", 9), (4, "é語 x\x00y 12", 9), (5, "w" * 100_000, 9), (6, "a b c d " * 9, 9)]


@pytest.mark.parametrize("reach", [1, 3, 64])
def test_crc_of_spans_of_any_length(reach):
    rng = np.random.default_rng(reach)
    data = rng.integers(0, 256, 20_000).astype(np.uint8)
    begin = rng.integers(0, 20_000, 300)
    end = np.minimum(20_000, begin + rng.choice([0, 1, 2, 63, 64, 65, 128, 700, 20_000], 300))
    expected = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(begin, end)]
    assert PositionCrc(reach).crc(data, begin, end).tolist() == expected


def _plain(rows, target, runs, buckets, percent, min_words, seed):
    def features(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets
                            for n in range(1, runs + 1) for i in range(len(words) - n + 1)]

    found = [(i, *features(t)) for i, t, *_ in rows]
    s, t = Counter(b for *_, f in found for b in f), Counter(b for _, x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in s}
    out = []
    for i, n_words, f in found:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    places = {}
    for place, r in enumerate(able[:len(able) * percent // 100], 1):
        places.setdefault(r, []).append(place)
    return sorted(((r[0], *r[2:], places[r].pop() if places.get(r) and r[1] >= min_words else None) for r in out), key=str)


@pytest.mark.parametrize("runs", [1, 3])
def test_same_as_a_plain_version(spark, runs):
    docs = spark.createDataFrame(EDGE, "doc_id bigint, text string, rank int").repartition(3)
    target = [(1, "two three a b c"), (2, None), (2, "a b")]
    options = dict(runs=runs, buckets=97, percent=60, min_words=2, seed=5)
    found = resample(docs, spark.createDataFrame(target, "item_id bigint, text string"), **options)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == _plain(EDGE, target, **options)


def test_empty_tables(spark):
    docs = spark.createDataFrame(EDGE, "doc_id bigint, text string, score int")
    target = spark.createDataFrame([], "item_id bigint, text string")
    assert resample(docs.limit(0), target).count() == 0
    rows = resample(docs, target).collect()
    assert len(rows) == len(EDGE) and all(r["rank"] is None for r in rows if r["n_features"] < 20)
    assert draw(docs, target, percent=100).count() == 1  # one text has 20 words


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    found = [tuple(r) for r in QUERIES["op11_importance_resampling"](spark, SF_DIR).collect()]
    assert sorted(con.execute(SQL["op11_importance_resampling"]).fetchall()) == sorted(found)
