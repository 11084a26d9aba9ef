"""Aggregations behind the dashboard: health, shares, trends, correlations, histograms."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed_values as fv
from tidewatch.functions.scalars import finite
from tidewatch.operators import kpi as kpi_ops
from tidewatch.operators import windows


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# -- health of the pipeline ---------------------------------------------------------


def drift_health(log: DataFrame, now: datetime | Column, hours: int = 24) -> DataFrame:
    """Drifts and healed drifts per type in the last day, with a total row (type NULL)."""
    return (
        kpi_ops.lookback(log, hours, now, "detected_at")
        .rollup("drift_type")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(F.col("auto_healed").cast("int")).alias("healed"),
            F.grouping("drift_type").cast("int").alias("is_total"),
        )
    )


def run_health(runs: DataFrame, now: datetime | Column, hours: int = 1) -> DataFrame:
    """Runs per status among those started recently."""
    recent = kpi_ops.lookback(runs, hours, now, "started_at")
    return recent.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Counts in total, per priority and per severity, and the newest alert's title, in one pass."""
    known = alerts.select(
        F.coalesce("priority", F.lit("?")).alias("priority"),
        F.coalesce("severity", F.lit("?")).alias("severity"),
        "fired_at",
        "title",
    )
    sets = known.groupingSets([["priority"], ["severity"], []], "priority", "severity").agg(
        F.count(F.lit(1)).alias("total"),
        F.max_by("title", F.struct("fired_at", "title")).alias("latest"),
        F.grouping_id("priority", "severity").alias("gid"),
    )
    return sets.select(
        F.when(F.col("gid") == 1, "priority").when(F.col("gid") == 2, "severity").otherwise("all").alias("dimension"),
        F.coalesce("priority", "severity", F.lit("all")).alias("value"),
        "total",
        "latest",
    )


def counters(
    anomalies: DataFrame | None = None,
    drifts: DataFrame | None = None,
    decisions: DataFrame | None = None,
    runs: DataFrame | None = None,
) -> DataFrame:
    """Labelled counters as a long metric table (name, labels, value)."""
    parts = []

    def counted(df: DataFrame, name: str, labels: Sequence[str]) -> None:
        pairs = [x for label in labels for x in (F.lit(label), F.col(label))]
        parts.append(
            df.groupBy(*labels)
            .agg(F.count(F.lit(1)).cast("double").alias("value"))
            .select(F.lit(name).alias("name"), F.create_map(*pairs).alias("labels"), "value")
        )

    if anomalies is not None:
        counted(anomalies, "anomalies_total", ["severity", "region", "category"])
    if drifts is not None:
        counted(drifts, "schema_drifts_total", ["drift_type"])
    if decisions is not None:
        counted(decisions, "agent_decisions_total", ["priority"])
    if runs is not None:
        parts.append(
            runs.agg(F.coalesce(F.sum("rows_ingested"), F.lit(0)).cast("double").alias("value")).select(
                F.lit("pipeline_rows_ingested_total").alias("name"),
                F.from_json(F.lit("{}"), "map<string,string>").alias("labels"),
                "value",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duration_histogram(runs: DataFrame, seconds: str = "seconds", bounds: Sequence[int] = fv.DURATION_BOUNDS) -> DataFrame:
    """Cumulative bucket counts, sum and count of run durations; one pass, one row per bound."""
    total = runs.agg(
        *[F.count_if(F.col(seconds) <= b).alias(str(b)) for b in bounds],
        F.count(seconds).alias("+Inf"),
        F.sum(seconds).alias("sum_seconds"),
        F.count(seconds).alias("n_runs"),
    )
    names = [str(b) for b in bounds] + ["+Inf"]
    return total.unpivot(["sum_seconds", "n_runs"], names, "le", "cumulative")


# -- shares and means ---------------------------------------------------------------------


def share_by(df: DataFrame, cat: str, val: str) -> DataFrame:
    """Sum per category and its share of the whole."""
    sums = df.groupBy(cat).agg(F.sum(val).alias("value"))
    # Summed from the sums: the scan and its shuffle are shared.
    whole = sums.agg(F.sum("value")).scalar()
    return sums.withColumn("share", F.try_divide(F.col("value"), whole))


def severity_distribution(df: DataFrame, column: str = "severity") -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), column)


def mean_by(df: DataFrame, cat: str, metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric per category."""
    return df.where(F.col(cat).isNotNull()).groupBy(cat).agg(*[F.avg(m).alias(m) for m in metrics])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Wide to long: one row per id and value column."""
    same = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return same.unpivot(list(ids), list(values), "metric", "value")


def trend(df: DataFrame, ts: str, cat: str, metrics: Sequence[str]) -> DataFrame:
    kept = df.where(F.col(ts).isNotNull() & F.col(cat).isNotNull())
    return kept.groupBy(ts, cat).agg(*[F.avg(m).alias(m) for m in metrics])


def pivot_revenue(df: DataFrame, regions: Sequence[str], value: str = "total_revenue") -> DataFrame:
    """Revenue per snapshot with one column per region; the list spares a job that would find it."""
    return df.groupBy("snapshot_ts").pivot("region", list(regions)).agg(F.sum(value))


def overview(kpi: DataFrame, anomalies: DataFrame, decisions: DataFrame) -> DataFrame:
    """Headline numbers in one row."""
    change = windows.pct_change(kpi, "total_revenue")
    found = anomalies.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("severity") == "CRITICAL").alias("critical"))
    ).scalar()
    made = decisions.agg(F.count(F.lit(1))).scalar()
    return change.agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.avg("total_revenue_pct_change").alias("mean_pct_change"),
        F.avg("return_rate").alias("mean_return_rate"),
    ).select(
        "*",
        found.getField("n").alias("anomalies"),
        found.getField("critical").alias("critical"),
        made.alias("decisions"),
    )


def kpi_baseline(kpi: DataFrame) -> DataFrame:
    """Means of the four KPIs; a KPI that is missing or all NULL stays NULL."""
    return kpi.agg(
        *[
            (F.avg(finite(m)) if m in kpi.columns else F.lit(None).cast("double")).alias(m)
            for m in fv.BASELINE_METRICS
        ]
    )


# -- correlation ----------------------------------------------------------------------------


def pearson(a: str, b: str) -> Column:
    """Correlation over rows where both are present; NULL if either is constant.

    The columns must be free of NaN, see :func:`finite_columns`."""
    x, y = F.col(a), F.col(b)
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    spread = F.stddev_samp(px) * F.stddev_samp(py)
    return F.covar_samp(px, py) / F.nullif(spread, F.lit(0.0))


def finite_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[finite(c).alias(c) for c in columns])


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise correlations of the columns as rows (x, y, r); each pair is computed once."""
    cols = list(columns)
    if len(cols) < 3:
        raise ValueError("a correlation matrix needs three numeric columns")
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    wide = finite_columns(df, cols).agg(*[pearson(cols[i], cols[j]).alias(f"r_{i}_{j}") for i, j in pairs])
    cells = []
    for i, x in enumerate(cols):
        for j, y in enumerate(cols):
            r = F.col(f"r_{min(i, j)}_{max(i, j)}")
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), r.alias("r")))
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.x", "c.y", "c.r")


def histogram(df: DataFrame, column: str, by: str, width: float, low: float = 0.0) -> DataFrame:
    """Rows per bin of fixed width and per ``by`` value."""
    bin_no = F.floor((F.col(column) - F.lit(low)) / F.lit(width))
    return (
        df.where(F.col(column).isNotNull())
        .groupBy((F.lit(low) + bin_no * F.lit(width)).alias("bin_start"), by)
        .agg(F.count(F.lit(1)).alias("n"))
    )


# -- small summaries ---------------------------------------------------------------------------


def heal_counts(log: DataFrame) -> DataFrame:
    healed = F.coalesce(F.col("auto_healed"), F.lit(False))
    return log.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(healed).alias("healed"), F.count_if(~healed).alias("pending")
    )


def bounded_distinct(df: DataFrame, columns: Sequence[str], most: int) -> DataFrame:
    """(column_name, n): distinct non-null values of each column, counted up to ``most`` + 1.

    One scan of the columns. Each task keeps a set per column that stops growing at ``most`` + 1 values and drops what is
    then full from its scan; the sets of all tasks, at most ``most`` + 1 short rows each, are merged by one aggregation. Long
    texts are kept as hashes. No row is copied per column.
    """
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[set] = [set() for _ in columns]
        for batch in batches:
            for own, values in zip(seen, batch.columns, strict=True):
                if len(own) <= most:
                    own.update(values.drop_null().unique().slice(0, 2 * most + 2).to_pylist())
        rows = [(c, v) for c, own in zip(columns, seen, strict=True) for v in list(own)[: most + 1]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["column_name", "value"])

    hashed = df.select(*[F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(columns)])
    found = hashed.mapInArrow(sets, "column_name string, value long")
    return found.distinct().groupBy("column_name").agg(F.least(F.count(F.lit(1)), F.lit(most + 1)).alias("n"))


def cardinality_gate(df: DataFrame, candidates: Sequence[str], most: int = 20, exact: bool = False) -> DataFrame:
    """First candidate with more than one and at most ``most`` distinct values; NULL if none. Counts stop at ``most`` + 1, unless ``exact``."""
    present = [c for c in candidates if c in df.columns]
    n = lambda c: F.coalesce(F.max(F.when(F.col("column_name") == c, F.col("n"))), F.lit(0)).alias(c)
    if exact:
        counted = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(c) for c in present])
    else:
        counted = bounded_distinct(df, present, most).agg(*[n(c) for c in present])
    fits = [F.when((F.col(c) > 1) & (F.col(c) <= most), F.lit(c)) for c in present]
    return counted.select(F.coalesce(*fits, F.lit(None).cast("string")).alias("chosen"), *present)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()
