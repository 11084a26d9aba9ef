"""Rolling z-scores on a stream of snapshots that may come late, released in order by event-time timers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch import fixed_values as fv
from tidewatch.config import Settings
from tidewatch.functions import scalars as S

#: Timers and list state need this state store.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OUTPUT = (
    "region string, category string, snapshot_ts timestamp, metric_name string, metric_value double, "
    "expected_value double, z_score double"
)
_COLUMNS = [x.split()[0] for x in OUTPUT.split(", ")]


def rolling_scores(values: np.ndarray, past: int, window: int, min_periods: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and z of each row after the first ``past`` ones over the last ``window`` rows, itself included; columns are series, gaps are NaN.

    All windows of all columns are taken at once as a view of the padded values.
    """
    padded = np.concatenate([np.full((window - 1, values.shape[1]), np.nan), values])
    frames = np.lib.stride_tricks.sliding_window_view(padded, window, axis=0)[past:]
    known = ~np.isnan(frames)
    n = known.sum(axis=2)
    mean = np.where(known, frames, 0.0).sum(axis=2) / np.maximum(n, 1)
    spread = np.sqrt((np.where(known, frames - mean[:, :, None], 0.0) ** 2).sum(axis=2) / np.maximum(n - 1, 1))
    fit = (n >= min_periods) & (spread > 0) & ~np.isnan(values[past:])
    with np.errstate(divide="ignore", invalid="ignore"):
        return mean, np.where(fit, (values[past:] - mean) / spread, np.nan)


class Released(StatefulProcessor):
    """Holds the snapshots of one series until the watermark has passed them, then scores them in the order of their time.

    ``waiting`` are rows ahead of the watermark, with a timer at the earliest; ``recent`` the last rows that were released; ``held`` the
    events of a series that is still too short to report.
    """

    def __init__(self, metrics: tuple[str, ...], window: int, min_periods: int, threshold: float, min_rows: int):
        self.metrics, self.window, self.min_periods, self.threshold, self.min_rows = metrics, window, min_periods, threshold, min_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, row array<double>")
        self.recent = handle.getListState("recent", "at long, row array<double>")
        self.held = handle.getListState("held", "at long, metric string, value double, mean double, z double")
        self.seen = handle.getValueState("seen", "n long")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            if batch.empty:
                continue
            at = batch["snapshot_ts"].astype("datetime64[ms]").astype("int64").tolist()
            cells = batch[list(self.metrics)].astype("float64").to_numpy().tolist()
            self.waiting.appendList([(a, c) for a, c in zip(at, cells, strict=True)])
            first = min(at) if first is None else min(first, *at)
        if first is not None:
            self._wake(first)
        yield pd.DataFrame(columns=_COLUMNS)

    def _wake(self, at: int) -> None:
        """One timer per series, at the earliest waiting row."""
        now = self.timer.get()[0] if self.timer.exists() else None
        if now is None or at < now:
            if now is not None:
                self.handle.deleteTimer(now)
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        self.timer.clear()
        waiting = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        due = {}
        for at, row in sorted(((a, list(r)) for a, r in waiting if a <= limit), key=lambda r: r[0]):
            due.setdefault(at, row)
        past = [(a, list(r)) for a, r in map(tuple, self.recent.get())] if self.recent.exists() else []
        new = [(a, r) for a, r in due.items() if not past or a > past[-1][0]]
        left = [(a, list(r)) for a, r in waiting if a > limit]
        if left:
            self.waiting.put(left)
            self._wake(min(a for a, _ in left))
        else:
            self.waiting.clear()
        if not new:
            yield pd.DataFrame(columns=_COLUMNS)
            return
        values = np.array([r for _, r in [*past, *new]], dtype=float)
        mean, z = rolling_scores(values, len(past), self.window, self.min_periods)
        events = [(new[i][0], self.metrics[j], float(values[len(past) + i, j]), float(mean[i, j]), float(z[i, j])) for i, j in zip(*np.nonzero(np.abs(z) >= self.threshold), strict=True)]
        self.recent.put([*past, *new][-(self.window - 1) :])
        n = (self.seen.get()[0] if self.seen.exists() else 0) + len(new)
        self.seen.update((n,))
        if n < self.min_rows:
            if events:
                self.held.appendList(events)
            yield pd.DataFrame(columns=_COLUMNS)
            return
        if self.held.exists():
            events = [tuple(e) for e in self.held.get()] + events
            self.held.clear()
        out = pd.DataFrame([(*key, pd.Timestamp(at, unit="ms"), *rest) for at, *rest in events], columns=_COLUMNS)
        yield out

    def close(self) -> None:
        pass


def timed_anomalies(
    kpis: DataFrame, delay: str = "2 hours", settings: Settings = Settings(), metrics: Sequence[str] = fv.Z_METRICS, threshold: float | None = None
) -> DataFrame:
    """Rolling z of every snapshot once the watermark, ``delay`` behind the newest snapshot, has passed it.

    A snapshot up to ``delay`` late takes its place in order, so the result equals the batch form, whatever the batches.
    Of rows that repeat a series' time the first counts. Later rows are dropped and counted: ``kpis.late_rows(query)``.
    State of a series is its last ``rolling_window`` rows and what waits for the watermark.
    """
    spark = kpis.sparkSession
    if spark.conf.get(PROVIDER[0], "") != PROVIDER[1]:
        spark.conf.set(*PROVIDER)
    limit = settings.z_threshold if threshold is None else threshold
    slim = kpis.where(F.col("region").isNotNull() & F.col("category").isNotNull()).select(
        "region", "category", F.col("snapshot_ts").cast("timestamp").alias("snapshot_ts"), *[S.finite(m).alias(m) for m in metrics]
    )
    processor = Released(tuple(metrics), settings.rolling_window, settings.min_periods, limit, settings.min_group_rows)
    scored = slim.withWatermark("snapshot_ts", delay).groupBy("region", "category").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"
    )
    return scored.withColumn("severity", S.severity("z_score", settings.bands))

