"""Filter audit: matrix, edge rows, shards, and the query against its SQL."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import pyarrow as pa

from tests.conftest import SF_DIR
from tidewell.llm import filter_audit
from tidewell.llm.filter_audit import _matrix, audit_filters, failed_filters
from tidewell.llm.queries import QUERIES, SQL

LONG = " ".join(f"w{i}" for i in range(150))
ROWS = [(1, None, "en"), (2, "", None), (3, LONG, "en"), (3, LONG, "en"), (4, LONG, "fr"), (None, LONG, "en"),
        (5, LONG + " $", ""), (6, "a b " * 200, "fr"), (7, "ABC DEF É", "en"), (8, "x" * 300_000, "en"),
        (9, "a\x00b\x0b\x1ca " * 60, "en"), (10, LONG + " #&|", "fr"), (11, LONG + " #&|", "fr")]
LABELS = [(3, 1, 0), (3, 0, 1), (4, 1, None), (11, None, 1), (99, 1, 1), (None, 1, 1), (6, 1, 0)]


def _failed(rows):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield i, part or "", len(w), len(set(w)), "".join(
            name for name, fails in zip("ABCDE", (
                len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                re.search("[#$%&*|]", t), i is not None and i > first[t])) if fails)


def _plain(rows, labels):
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    out = defaultdict(Counter)
    for i, part, _, _, failed in _failed(rows):
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, name in enumerate(order, 1):
                cell = out[part, order, step]
                fails = name in failed
                cell["kept"] += not gone and not fails
                cell["removed"] += not gone and fails
                cell["redundant"] += gone and fails
                cell["unique_fails"] += failed == name
                cell["good_lost"] += not gone and fails and i in good
                cell["toxic_lost"] += not gone and fails and i in toxic
                gone = gone or fails
    total = Counter()
    for (part, order, step), cell in out.items():
        total[part, order[step - 1]] += cell["removed"]
    return {(*key, *(cell[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")),
             total[key[0], key[1][key[2] - 1]]) for key, cell in out.items()}


def _tables(spark, rows=ROWS, labels=LABELS):
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id bigint, text string, lang string, failed int")
    return docs.repartition(3), spark.createDataFrame(
        [(*r, "x") for r in labels], "doc_id bigint, quality int, toxic int, part string")


def test_same_as_a_plain_version(spark):
    rows = audit_filters(*_tables(spark)).collect()
    assert len(rows) == 3 * 600 and {tuple(r) for r in rows} == _plain(ROWS, LABELS)


def test_shards_and_joins_do_not_change_the_rows(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 700)
    monkeypatch.setattr(filter_audit, "sized_for_broadcast", lambda df: df.hint("merge"))
    docs, _ = _tables(spark)
    found = failed_filters(docs.repartition(2)).collect()
    expected = [(i, part, n, d, sum(1 << "ABCDE".index(x) for x in f)) for i, part, n, d, f in _failed(ROWS)]
    assert sorted((tuple(r) for r in found), key=str) == sorted(expected, key=str)


def test_empty_tables(spark):
    docs, labels = _tables(spark)
    assert audit_filters(docs.limit(0), labels).count() == 0
    assert {tuple(r) for r in audit_filters(docs, labels.limit(0)).collect()} == _plain(ROWS, [])


def test_matrix_cells():
    words, cells, counts = _matrix(pa.array(["b a b", "", " c\x0ba\x1c \n", "\t"]))
    assert words.to_pylist() == ["b", "a", "c", "a\x1c"]
    assert cells.tolist() == [0, 1, 2 * 4 + 2, 2 * 4 + 3] and counts.tolist() == [2, 1, 1, 1]
    assert [len(a) for a in _matrix(pa.array(["", ""]))] == [0, 0, 0]


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    found = [tuple(r) for r in QUERIES["op13_filter_audit"](spark, SF_DIR).collect()]
    assert sorted(con.execute(SQL["op13_filter_audit"]).fetchall()) == sorted(found)
