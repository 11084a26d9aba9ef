"""KPI snapshots and de-duplication on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators import kpi as kpi_ops


def kpi_stream(orders: DataFrame, every: str = "1 hour", delay: str = "2 hours", period: str = "hourly") -> DataFrame:
    """Snapshots per window, region and category, emitted once a window is closed.

    Orders up to ``delay`` late still count into their window. Later ones are
    dropped and counted, see :func:`late_rows`.
    """
    timed = orders.withColumn("order_ts", F.col("order_ts").cast("timestamp")).withWatermark("order_ts", delay)
    grouped = kpi_ops.valid_orders(timed).groupBy(F.window("order_ts", every), "region", "category")
    measured = grouped.agg(*kpi_ops.measures())
    return measured.select(
        F.col("window.start").alias("snapshot_ts"), "region", "category",
        "total_orders", "total_revenue", "avg_order_val", "return_rate", F.lit(period).alias("period"),
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their window was closed, over the query's recorded progress."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """First row per key within the watermark delay; state is dropped after it."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def best_stream(df: DataFrame, keys: Sequence[str], ts: str, rank: Sequence[str | Column], every: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """The best row of each key and window, emitted once the watermark has passed the window.

    Best is the largest ``rank``, and of equal ones the earliest. Rows are combined before the shuffle, and state is one row
    per open key and window. Rows later than ``delay`` are dropped and counted, see :func:`late_rows`.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(r).alias(f"r{i}") if isinstance(r, str) else r.alias(f"r{i}") for i, r in enumerate(rank)], (-F.unix_micros(F.col(ts))).alias("t"))
    best = df.withWatermark(ts, delay).groupBy(F.window(ts, every), *keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(F.col("window.start").alias("window_start"), *keys, *[F.col("_row")[c].alias(c) for c in rest])
