"""Size-checked broadcast.

The optimizer's estimate settles tables that are small beyond doubt (scans
of small files).  It multiplies through joins and ignores grouping, so for
anything else the side is materialised in the shared checkpoint folder and
its rows are counted: up to ``max_rows`` it is broadcast, above that the
planner's shuffle join (with skew splitting) takes the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_BROADCAST_ROWS = 200_000


def estimated_bytes(df: DataFrame) -> int:
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - estimate unavailable
        return 1 << 62


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                       max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    if estimated_bytes(df) <= max_bytes:
        return F.broadcast(df)
    from ..session import cut_lineage
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= max_rows else df
