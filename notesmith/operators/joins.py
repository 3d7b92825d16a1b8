"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Registry-style tables (feeds, whitelists) are broadcast only below this many rows.
BROADCAST_MAX_ROWS = 100_000


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only after checking the row count; otherwise leave the choice
    to the planner (sort-merge, or AQE's own runtime-size broadcast)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
