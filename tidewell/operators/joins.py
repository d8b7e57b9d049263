"""Size check in front of a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize

# What an executor is asked to hold at most, well below a usual heap.
BROADCAST_BYTES = 64 * 1024 * 1024


def sized_for_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, computed once, and marked for broadcast only if it is small enough.

    The rows are written to the shared folder, measured there, and returned with the
    broadcast hint if they fit.  Otherwise they are returned as they are, and
    the join that follows is a shuffle join in which Spark splits hot keys.
    """
    kept = materialize(df, "small-side")
    size = kept.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(kept) if size <= max_bytes else kept
