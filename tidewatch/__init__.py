"""KPI monitoring on Spark: rollups, anomalies, causes, decisions, data quality."""

from tidewatch.config import Settings
from tidewatch.session import prepare

__all__ = ["Settings", "prepare"]
