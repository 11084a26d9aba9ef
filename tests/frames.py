"""Small frames with fixed values."""

from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def kpi_rows(n: int, region: str = "North", category: str = "Books", spike: float | None = None, start: datetime = START):
    """Hourly snapshots with a small regular wave; the last one optionally a spike."""
    rows = []
    for i in range(n):
        wave = (i * 7) % 11 - 5
        revenue = 10_000.0 + 100.0 * wave
        if spike is not None and i == n - 1:
            revenue = spike
        rows.append(
            (start + timedelta(hours=i), "hourly", region, category, 100 + wave, revenue, 100.0 + wave, 0.05 + wave / 1000, 0.08 + wave / 2000)
        )
    return rows


KPI_SCHEMA = (
    "snapshot_ts timestamp, period string, region string, category string, total_orders int, "
    "total_revenue double, avg_order_val double, return_rate double, conversion_rt double"
)


def kpi_frame(spark, *parts):
    return spark.createDataFrame([r for p in parts for r in p], KPI_SCHEMA)
