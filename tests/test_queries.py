"""Every registered query against its SQL twin, row by row."""

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SF_DIR
from tidewell.plans.file_queries import TABLES
from tidewell.plans.registry import load_all

OWN = load_all()
QUERIES = {name: fn for name, fn in contract.queries().items() if name in OWN}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in OWN}
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: DUCK_TYPES.get(t, t) for c, t in df.dtypes} == types
    columns = sorted(df.columns)
    places = [list(types).index(c) for c in columns]
    expected = _sorted(tuple(r[i] for i in places) for r in result.fetchall())
    assert _sorted(tuple(r[c] for c in columns) for r in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_without_sql_have_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["event_type", "date", "action_count"]
    assert df.count() > 0


def test_flagship_is_ordered(spark):
    result = [(r["date"], r["event_type"])
              for r in QUERIES["daily_action_counts"](spark, SF_DIR).collect()]
    assert result == sorted(result)
