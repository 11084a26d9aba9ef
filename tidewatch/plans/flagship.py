"""Orders to anomalies in one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import Settings
from tidewatch.operators import anomaly, windows
from tidewatch.session import prepare
from tidewatch.sources import adapters


def order_anomalies(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> DataFrame:
    """Strongest rolling-z anomaly per region, category and metric of the monthly order KPIs."""
    prepare(spark)
    kpis = adapters.order_kpis(spark, sf_dir, "month")
    events = anomaly.zscore_anomalies(kpis, settings)
    best = windows.dedup_best(events)
    return best.select(
        "region",
        "category",
        "metric_name",
        F.date_format("window_end", "yyyy-MM-dd").alias("month"),
        F.round("metric_value", 4).alias("metric_value"),
        F.round("expected_value", 4).alias("expected_value"),
        F.round("z_score", 4).alias("z_score"),
        "severity",
    )
