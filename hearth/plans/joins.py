"""Join helpers: size-checked broadcast of dimension-like inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side that the plan's statistics put above this many bytes is joined with a
# shuffle instead of being shipped to every executor. Rule tables, site maps and
# menus sit far below it.
BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Size of ``df`` by the optimizer's statistics: the bytes of the files it scans,
    scaled by the columns kept. Files are compressed, so rows in memory may take some
    times as much; filters and aggregations do not make it smaller. Runs no job and is asked anew for every plan, so a
    table that has grown is seen."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    return estimated_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES, basis: DataFrame | None = None) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise leave the choice to AQE,
    which still broadcasts a side whose measured size is under the session's
    threshold and otherwise sorts and merges. ``basis`` is a table the side is a
    projection or filter of, checked instead."""
    return F.broadcast(df) if is_small(basis if basis is not None else df, max_bytes) else df
