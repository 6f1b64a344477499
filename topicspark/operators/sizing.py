"""Size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicspark.session import checkpoint_dir

# Row bound for broadcasting a small side (per-topic tables and the like).
MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Materialise a small table once (reliable checkpoint in the shared
    folder), count it, and mark it for broadcast only when the count is
    within ``max_rows`` (default ``MAX_BROADCAST_ROWS``); otherwise return
    it for a shuffle join."""
    checkpoint_dir(df.sparkSession)
    bound = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    fixed = df.checkpoint(eager=True)
    return F.broadcast(fixed) if fixed.count() <= bound else fixed
