"""Named queries over the test tables, each with its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewell.session import pin_session

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a function, by default under its own name, with the SQL that gives the
    same rows."""

    def add(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(pin_session(spark), str(sf_dir).rstrip("/"))

        run.__doc__ = fn.__doc__
        key = name or fn.__name__
        REGISTRY[key] = Query(key, run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> dict[str, Query]:
    """Import the modules that register queries."""
    from tidewell.plans import (  # noqa: F401
        feature_queries, file_queries, jdbc_queries, model_queries, row_queries,
        stream_queries,
    )
    return REGISTRY
