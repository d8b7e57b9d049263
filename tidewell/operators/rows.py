"""Row operators beyond plain ``select``, ``where`` and ``drop``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def top_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in the given order.

    A bare limit returns whichever rows come first; with an order, every task keeps
    its own best ``n`` and only these are merged.
    """
    return df.orderBy(*order_by).limit(n)
