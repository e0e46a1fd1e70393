"""Join helpers: broadcast only sides whose size has been checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookups up to this many rows are shipped to every task; larger ones shuffle.
DEFAULT_BROADCAST_ROWS = 1_000_000
# Lookups that Catalyst expects to be at most this large need no counting.
DEFAULT_BROADCAST_BYTES = 10 << 20


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (from file and literal sizes; runs no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` is small enough to ship to every task.

    The plan's byte estimate decides where it is small. It multiplies the sides of joins,
    so beyond ``max_bytes`` the rows are counted (reads at most max_rows + 1). Nothing is
    remembered: a source that grew is judged by its new size.
    """
    return planned_bytes(df) <= max_bytes or df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when ``df`` passes ``is_bounded``; else the optimizer / AQE plans the join."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df
