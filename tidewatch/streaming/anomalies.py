"""Anomaly detection on a stream of KPI snapshots."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch import fixed_values as fv
from tidewatch.config import Settings
from tidewatch.functions import scalars as S
from tidewatch.operators import anomaly as anomaly_ops
from tidewatch.operators import windows
from tidewatch.session import path_exists


# -- (a) batch detector on each batch -------------------------------------------------


def detect_batches(
    history_path: str, events_path: str, settings: Settings = Settings(), forest: bool = True
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: store the snapshots, detect on the recent hours, store the new events.

    History is partitioned by date, so a batch reads only the days its look-back
    touches. Both writes replace what the same batch id wrote before, so a batch
    that is run again after a failure leaves the same result.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        oldest = batch.agg(F.min("snapshot_ts").alias("t")).first()["t"]
        if oldest is None:
            return
        dated = batch.withColumn("snapshot_date", F.to_date("snapshot_ts")).withColumn("batch", F.lit(batch_id))
        (
            dated.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("snapshot_date", "batch")
            .parquet(history_path)
        )
        # The look-back covers the window of every row of this batch.
        start = oldest - timedelta(hours=settings.lookback_hours)
        stored = spark.read.parquet(history_path).where(
            (F.col("snapshot_date") >= F.lit(start.date())) & (F.col("snapshot_ts") >= F.lit(start)) & (F.col("batch") <= batch_id)
        )
        recent = stored.drop("batch", "snapshot_date")
        if forest:
            events = anomaly_ops.detect(recent, settings)
        else:
            found = anomaly_ops.zscore_anomalies(recent, settings)
            events = windows.assign_ids(found, ["region", "category", "metric_name", "window_end"])
        fresh = events.where(F.col("window_end") >= F.lit(oldest))
        fresh.write.mode("overwrite").parquet(f"{events_path}/batch={batch_id}")

    return run


# -- (b) keyed state ----------------------------------------------------------------------

SCORED = (
    "region string, category string, snapshot_ts timestamp, metric_name string, metric_value double, "
    "expected_value double, z_score double"
)


def _scorer(metrics: tuple[str, ...], window: int, min_periods: int, threshold: float, min_rows: int):
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, kept, last = 0, [], None
        if state.exists:
            seen, flat, last = state.get
            kept = np.array(flat, dtype=float).reshape(-1, len(metrics)).tolist()
        # One batch of one series; rollup rows, so at most one per bucket.
        new = pd.concat(list(batches)).sort_values("snapshot_ts")
        out = []
        for row in new.itertuples(index=False):
            stamp = int(row.snapshot_ts.value)
            if last is not None and stamp <= last:
                continue
            last = stamp
            seen += 1
            kept.append([float(getattr(row, m)) if getattr(row, m) is not None else np.nan for m in metrics])
            kept = kept[-window:]
            if seen < min_rows:
                continue
            block = np.array(kept)
            for i, m in enumerate(metrics):
                values = block[:, i][~np.isnan(block[:, i])]
                x = block[-1, i]
                if len(values) < min_periods or np.isnan(x):
                    continue
                sd = values.std(ddof=1)
                if sd > 0 and abs((x - values.mean()) / sd) >= threshold:
                    out.append((*key, row.snapshot_ts, m, x, values.mean(), (x - values.mean()) / sd))
        state.update((seen, [v for r in kept for v in r], last))
        columns = ["region", "category", "snapshot_ts", "metric_name", "metric_value", "expected_value", "z_score"]
        yield pd.DataFrame(out, columns=columns)

    return update


def stateful_anomalies(
    kpis: DataFrame, settings: Settings = Settings(), metrics: Sequence[str] = fv.Z_METRICS, threshold: float | None = None
) -> DataFrame:
    """Rolling z with the last rows of every series kept as state.

    A snapshot not newer than the series' last one is passed over. A series
    starts to report at its fourth row; the batch form also reports rows before
    that, because it already sees the later ones.
    """
    metrics = tuple(metrics)
    limit = settings.z_threshold if threshold is None else threshold
    fn = _scorer(metrics, settings.rolling_window, settings.min_periods, limit, settings.min_group_rows)
    slim = kpis.where(F.col("region").isNotNull() & F.col("category").isNotNull()).select(
        "region", "category", "snapshot_ts", *[S.finite(m).alias(m) for m in metrics]
    )
    scored = slim.groupBy("region", "category").applyInPandasWithState(
        fn, SCORED, "seen long, recent array<double>, last long", "append", GroupStateTimeout.NoTimeout
    )
    return scored.withColumn("severity", S.severity("z_score", settings.bands))


# -- bounded log ---------------------------------------------------------------------------


def recent_batches(path: str, n: int = 150, ts: str = "ts", ties: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that keeps the newest n rows.

    Versions alternate between two folders: the one before stays readable while
    the next is written, a repeated batch writes the same folder again, and
    storage stays bounded.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        top = windows.keep_recent(batch, n, ts, ties)
        before = f"{path}/slot={(batch_id + 1) % 2}"
        if batch_id > 0 and path_exists(spark, before):
            old = spark.read.parquet(before).drop("version")
            top = windows.keep_recent(top.unionByName(old), n, ts, ties)
        versioned = top.withColumn("version", F.lit(batch_id))
        versioned.coalesce(1).write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    return run


def read_recent(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest version of the bounded log."""
    if not path_exists(spark, path):
        return None
    versions = spark.read.parquet(path)
    newest = versions.agg(F.max("version")).scalar()
    return versions.where(F.col("version") == newest).drop("version", "slot")
