"""Line dedup: runs, compaction, edge rows, and the query against its SQL."""

from collections import Counter

import duckdb
import pytest

from tests.conftest import SF_DIR
from tidewell.llm import line_runs
from tidewell.llm.line_runs import LineRuns, drop_frequent_lines, line_hashes
from tidewell.llm.queries import QUERIES, SQL

WHITE = " \t\n\x0b\f\r"
ROWS = ([(i, f"Same  line \r\n{i}\nÉcole {i % 3}\n", 9) for i in range(12)]
        + [(20, None, 9), (21, "", 9), (22, " \n\t\n", 9), (None, "x\nsame  LINE", 9), (None, "x", 9), (3, "x\nx\nx", 9),
           (3, "x\nx\nx", 9), (23, "z" * 300_000 + "\nx", 9), (24, "\n".join(f"l{i}" for i in range(20_000)) + "\nécole 1", 9)])
SCHEMA = "doc_id bigint, text string, n_lines int"


def _plain(rows, limit, min_chars):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line).strip(WHITE)

    found = Counter(k for _, t, *_ in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or found[key(x)] < limit]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"batches": 1, "buckets": 3}, {"batches": 5, "fanout": 3, "min_chars": 3}])
def test_same_as_a_plain_version(spark, options):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    found = drop_frequent_lines(docs, limit=4, **options)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == _plain(ROWS, 4, options.get("min_chars", 1))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_runs")]


def test_joins_without_broadcast_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(line_runs, "sized_for_broadcast", lambda df: df.hint("merge"))
    found = drop_frequent_lines(spark.createDataFrame(ROWS, SCHEMA), limit=4)
    assert sorted((tuple(r) for r in found.collect()), key=str) == _plain(ROWS, 4, 1)


def test_empty_table(spark):
    assert drop_frequent_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_are_levelled_and_settled_lines_are_counted_no_more(spark, plan_of):
    runs = LineRuns(spark, limit=2, buckets=4)
    try:
        for at in range(5):
            docs = spark.createDataFrame([(at, f"every\nodd {at % 2}\nown {at}")], "doc_id bigint, text string")
            runs.add(line_hashes(docs).select("h1", "h2"))
        # five runs: four merged into one of level 2, and the last alone
        assert [len(level) for level in runs.levels] == [1, 0, 1]
        counts = sorted(r["n"] for r in spark.table(runs.levels[2][0]).collect())
        assert counts == [1, 1, 1, 1, 2, 2, 2]
        assert spark.table(runs.levels[0][0]).count() == 1  # its other lines were settled before
        assert runs.settled().count() == 3
        # merging runs moves no row between tasks
        assert "Exchange" not in plan_of(runs._summed(runs.tables))
    finally:
        runs.close()


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    found = [tuple(r) for r in QUERIES["op12_line_dedup"](spark, SF_DIR).collect()]
    assert sorted(con.execute(SQL["op12_line_dedup"]).fetchall()) == sorted(found)
