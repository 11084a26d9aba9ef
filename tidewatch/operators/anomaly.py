"""Anomaly detection on KPI series and on whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.config import Settings
from tidewatch.functions import scalars as S
from tidewatch.operators import forest, windows
from tidewatch.operators import kpi as kpi_ops
from tidewatch.operators.quantiles import exact_medians

EVENT_COLUMNS = [
    "metric_name", "metric_value", "expected_value", "z_score", "isolation_score",
    "severity", "region", "category", "window_start", "window_end", "raw_context",
]


def zscore_anomalies(
    kpi: DataFrame,
    settings: Settings = Settings(),
    metrics: Sequence[str] = fv.Z_METRICS,
    threshold: float | None = None,
    include_current: bool = True,
    below: str = "CRITICAL",
) -> DataFrame:
    """Snapshots whose rolling z reaches the threshold, one event per metric.

    All metrics are scored in one window pass; the rows are then turned long.
    """
    metrics = [m for m in metrics if m in kpi.columns]
    limit = settings.z_threshold if threshold is None else threshold
    scored = windows.rolling_z(kpi, metrics, settings, include_current=include_current)
    cells = [
        F.struct(
            F.lit(m).alias("metric_name"),
            F.col(m).cast("double").alias("metric_value"),
            F.col(f"{m}_mean").alias("expected_value"),
            F.col(f"{m}_z").alias("z_score"),
        )
        for m in metrics
    ]
    # Keep only metrics over the limit before the rows are multiplied.
    hits = F.filter(F.array(*cells), lambda e: F.abs(e["z_score"]) >= limit)
    events = scored.select("region", "category", "snapshot_ts", F.explode(hits).alias("e")).select(
        "e.*", "region", "category", "snapshot_ts"
    )
    context = F.create_map(
        F.lit("method"), F.lit("zscore"), F.lit("rolling_window_h"), F.lit(str(settings.rolling_window))
    )
    return events.select(
        "metric_name",
        "metric_value",
        F.coalesce("expected_value", F.lit(0.0)).alias("expected_value"),
        "z_score",
        F.lit(0.0).alias("isolation_score"),
        S.severity("z_score", settings.bands, below).alias("severity"),
        "region",
        "category",
        S.window_start("snapshot_ts", settings.rolling_window).alias("window_start"),
        F.col("snapshot_ts").alias("window_end"),
        context.alias("raw_context"),
    )


def union_events(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Events of several detectors, with the detector's rank for stable ties."""
    out = first.select(*EVENT_COLUMNS).withColumn("source_rank", F.lit(0))
    for i, o in enumerate(others, 1):
        out = out.unionByName(o.select(*EVENT_COLUMNS).withColumn("source_rank", F.lit(i)))
    return out


def forest_events(scored: DataFrame, settings: Settings = Settings(), below: str = "CRITICAL") -> DataFrame:
    """Events of rows the forest marked; z is ten times the score's size."""
    z = F.abs("isolation_score") * 10
    context = F.create_map(
        F.lit("method"), F.lit("isolation_forest"), F.lit("score"), F.round("isolation_score", 6).cast("string")
    )
    return scored.where("is_anomaly").select(
        F.lit("multivariate_kpi").alias("metric_name"),
        F.coalesce(F.col("total_revenue").cast("double"), F.lit(0.0)).alias("metric_value"),
        F.lit(0.0).alias("expected_value"),
        z.alias("z_score"),
        "isolation_score",
        S.severity(z, settings.bands, below).alias("severity"),
        F.coalesce("region", F.lit("unknown")).alias("region"),
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.col("snapshot_ts").alias("window_start"),
        F.col("snapshot_ts").alias("window_end"),
        context.alias("raw_context"),
    )


def detect(kpi: DataFrame, settings: Settings = Settings(), include_current: bool = True) -> DataFrame:
    """Both detectors together: one event per region, category and metric, largest |z| first.

    The forest is fitted on all of ``kpi`` and scores its newest hours. Fitting
    runs jobs; pass a persisted or stored rollup. Without trees in the settings only the z-scores count.
    """
    by_z = zscore_anomalies(kpi, settings, include_current=include_current)
    model = forest.fit(kpi, settings=settings) if settings.forest_trees else None
    if model is None:
        events = union_events(by_z)
    else:
        newest = kpi_ops.latest_slice(kpi, settings.latest_hours)
        events = union_events(by_z, forest_events(forest.score(newest, model), settings))
    best = windows.dedup_best(events, "source_rank").drop("source_rank")
    best = windows.assign_ids(best, ["region", "category", "metric_name", "window_end"])
    return best.orderBy(F.abs("z_score").desc(), "region", "category", "metric_name")


# -- whole tables -------------------------------------------------------------------------


def _stats(df: DataFrame, columns: Sequence[str], sd) -> Column:
    """Mean, deviation and count of every column as one scalar subquery."""
    parts = []
    for c in columns:
        x = S.finite(c)
        parts.append(F.struct(F.avg(x).alias("mean"), sd(x).alias("sd"), F.count(x).alias("n")).alias(c))
    return df.agg(F.struct(*parts)).scalar()


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    stats = _stats(df, columns, F.stddev_pop)
    scaled = {}
    for c in columns:
        s = stats.getField(c)
        sd = F.when(s.getField("sd") == 0, F.lit(1.0)).otherwise(s.getField("sd"))
        scaled[c] = (S.finite(c) - s.getField("mean")) / sd
    return df.withColumns(scaled)


def zscore_global(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Largest |z| of a row across the columns, and its severity."""
    stats = _stats(df, columns, F.stddev_samp)
    zs = [
        F.abs(S.safe_z(S.finite(c), stats.getField(c).getField("mean"), stats.getField(c).getField("sd")))
        for c in columns
    ]
    z = F.greatest(*zs) if len(zs) > 1 else zs[0]
    return df.withColumn("z_score", z).withColumn("severity", S.severity_simple("z_score"))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Infinities and gaps become the column median; columns without any value are dropped."""
    medians = exact_medians(df, columns)
    empty = [c for c in columns if medians[c] is None]
    filled = {c: F.coalesce(S.finite(c), F.lit(medians[c])) for c in columns if medians[c] is not None}
    return (df.withColumns(filled) if filled else df).drop(*empty)


def flagged_only(base: DataFrame, flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` that the other detector marked."""
    return base.join(flagged.select(*keys), list(keys), "left_semi")


def ml_anomalies(df: DataFrame, columns: Sequence[str], keys: Sequence[str], settings: Settings = Settings(forest_trees=100)) -> DataFrame:
    """Table-wide forest on imputed columns: adds ``ml_anomaly``, -1 for anomalies, else 1."""
    filled = impute_median(df, columns)
    usable = [c for c in columns if c in filled.columns]
    if not usable:
        return df.withColumn("ml_anomaly", F.lit(1))
    fitted = forest.fit_scored(filled, usable, settings, keys=keys, min_rows=1)
    if fitted is None:
        return df.withColumn("ml_anomaly", F.lit(1))
    scored = fitted[1]
    return scored.withColumn("ml_anomaly", F.when(F.col("is_anomaly"), -1).otherwise(1)).drop("is_anomaly")


def column_outliers(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], dataset_type: str = "general", enough: int | None = None
) -> DataFrame:
    """Cells with |z| > 2.5 in the numeric columns.

    Columns with under 6 values or no spread are passed over. With ``enough`` no
    further column is looked at once the earlier ones gave so many rows.
    """
    cols = list(numeric)
    stats = _stats(df, cols, F.stddev_samp)

    def z_of(c: str) -> Column:
        s = stats.getField(c)
        fit = (s.getField("n") >= 6) & (s.getField("sd") >= 1e-9)
        return F.when(fit, (S.finite(c) - s.getField("mean")) / F.nullif(s.getField("sd"), F.lit(0.0)))

    zs = df.withColumns({f"_z{i}": z_of(c) for i, c in enumerate(cols)})
    over = zs.agg(
        F.struct(*[F.count_if(F.abs(F.col(f"_z{i}")) > 2.5).alias(f"c{i}") for i in range(len(cols))])
    ).scalar()
    region = F.coalesce(F.col(categorical[0]).cast("string"), F.lit("N/A")) if categorical else F.lit("N/A")
    cells = []
    for i, c in enumerate(cols):
        earlier = F.lit(0)
        for j in range(i):
            earlier = earlier + over.getField(f"c{j}")
        z = F.col(f"_z{i}") if enough is None else F.when(earlier < enough, F.col(f"_z{i}"))
        cells.append(
            F.struct(
                F.lit(c).alias("metric_name"),
                S.finite(c).alias("metric_value"),
                stats.getField(c).getField("mean").alias("expected_value"),
                z.alias("z_score"),
            )
        )
    # Rows without any such cell go before the rest is turned long.
    some = zs.where(F.greatest(*[F.abs(F.col(f"_z{i}")) for i in range(len(cols))], F.lit(0.0)) > 2.5)
    long = some.select(region.alias("region"), F.explode(F.array(*cells)).alias("e"))
    return long.where(F.abs(F.col("e.z_score")) > 2.5).select(
        "e.*",
        S.severity_csv("e.z_score").alias("severity"),
        "region",
        F.lit(dataset_type.title()).alias("category"),
    )


def live_event(anomalies: DataFrame) -> DataFrame:
    """Anomalies in the form of the live event log."""
    return anomalies.select(
        windows.event_id("region", "category", "metric_name", "window_end").alias("event_id"),
        F.date_format("window_end", "HH:mm:ss").alias("ts"),
        F.coalesce("metric_name", F.lit("?")).alias("metric"),
        F.coalesce("region", F.lit("?")).alias("region"),
        F.coalesce("severity", F.lit("MEDIUM")).alias("severity"),
        F.coalesce("metric_value", F.lit(0.0)).alias("observed"),
        F.coalesce("expected_value", F.lit(0.0)).alias("expected"),
        F.coalesce("z_score", F.lit(0.0)).alias("z_score"),
        F.lit(False).alias("analyzed"),
    )


