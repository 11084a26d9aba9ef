"""Thresholds and sizes shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

from tidewatch import fixed_values as fv


@dataclass(frozen=True)
class Settings:
    z_threshold: float = 3.0
    contamination: float = 0.05
    rolling_window: int = 24
    min_periods: int = 3
    min_group_rows: int = 4
    bands: tuple[tuple[str, float, float], ...] = fv.SEVERITY_BANDS
    forest_min_rows: int = 50
    forest_trees: int = 200
    forest_sample: int = 256
    seed: int = 42
    lookback_hours: int = 48
    latest_hours: int = 2
    bootstrap_replicates: int = 200
    debate_rounds: int = 2
    # None: every anomaly gets a cause and a decision.
    decisions_per_cycle: int | None = None
    batch_size: int = 1000
    interval_seconds: int = 60
