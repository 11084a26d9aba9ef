"""Ordered computations: rolling statistics, lag, first/best per key, ids, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import Settings
from tidewatch.functions.scalars import finite
from tidewatch.session import stored

GROUP = ("region", "category")


def series(group: Sequence[str] = GROUP, ts: str = "snapshot_ts"):
    """Window over one KPI series in time order.

    A rollup holds one row per bucket and series, so a series never has more
    rows than there are buckets (87,600 hours in ten years); raw rows are never
    windowed. For frames without that bound see :func:`in_blocks`.
    """
    return Window.partitionBy(*group).orderBy(ts)


def rolling(window: int, group: Sequence[str] = GROUP, ts: str = "snapshot_ts", include_current: bool = True):
    last = 0 if include_current else -1
    first = 1 - window if include_current else -window
    return series(group, ts).rowsBetween(first, last)


def recent_kpis(kpi: DataFrame, window: int = 24, period: str | None = "hourly") -> DataFrame:
    """Previous revenue and rolling mean revenue of every snapshot."""
    if period is not None:
        kpi = kpi.where(F.col("period") == period)
    return kpi.withColumns(
        {
            "prev_revenue": F.lag("total_revenue").over(series()),
            "rolling_24h_avg_revenue": F.avg("total_revenue").over(rolling(window)),
        }
    )


def rolling_z(
    kpi: DataFrame,
    metrics: Sequence[str],
    settings: Settings = Settings(),
    include_current: bool = True,
    hours_range: bool = False,
) -> DataFrame:
    """Adds ``<metric>_mean`` and ``<metric>_z`` for each metric.

    Mean and sample deviation come from the last ``rolling_window`` rows, the
    current one included by default. z is NULL with fewer than ``min_periods``
    values, with zero deviation, and in series shorter than ``min_group_rows``.
    All metrics share one sort. With ``hours_range`` the window spans hours
    instead of rows.
    """
    n = settings.rolling_window
    df = kpi.where(F.col("region").isNotNull() & F.col("category").isNotNull())
    df = df.withColumns({m: finite(m) for m in metrics})
    if hours_range:
        df = df.withColumn("_sec", F.unix_timestamp("snapshot_ts"))
        top = 0 if include_current else -1
        w = Window.partitionBy(*GROUP).orderBy("_sec").rangeBetween(1 - n * 3600, top)
    else:
        w = rolling(n, include_current=include_current)
    # Ordered like the rolling window, so that both use one sort.
    order = "_sec" if hours_range else "snapshot_ts"
    whole = series(GROUP, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stats = {"_rows": F.count(F.lit(1)).over(whole)}
    for m in metrics:
        stats[f"_{m}_n"] = F.count(m).over(w)
        stats[f"_{m}_mu"] = F.avg(m).over(w)
        stats[f"_{m}_sd"] = F.stddev_samp(m).over(w)
    df = df.withColumns(stats)
    enough_rows = F.col("_rows") >= settings.min_group_rows
    out = {}
    for m in metrics:
        usable = enough_rows & (F.col(f"_{m}_n") >= settings.min_periods)
        mean = F.col(f"_{m}_mu")
        out[f"{m}_mean"] = F.when(usable, mean)
        out[f"{m}_z"] = F.when(usable, (F.col(m) - mean) / F.nullif(F.col(f"_{m}_sd"), F.lit(0.0)))
    return df.withColumns(out).drop(*stats, "_sec")


def in_blocks(
    df: DataFrame,
    columns: dict[str, "callable"],
    group: Sequence[str],
    order: Sequence[str],
    preceding: int,
    block: Column,
) -> DataFrame:
    """Row-window columns over series too long for one task.

    ``block`` cuts each series along its order into pieces that a task can sort,
    whatever share of all rows the series holds (for example one per minute). Rows are numbered from per-block counts, each
    run of ``size`` numbers also receives the ``preceding`` rows before it, and
    the window runs per (series, run). Exact for any frame that looks back at
    most ``preceding`` rows. ``columns`` maps a name to a function of the window.
    """
    keys = list(group)
    df = df.withColumn("_block", block)
    sizes = df.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    named = offsets.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*keys, "_block"])], "_offset")
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*keys, "_block"])]
    joined = df.join(named, same).drop(*[f"_k{i}" for i in range(len(keys) + 1)])
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    numbered = joined.withColumn("_pos", F.col("_offset") + F.row_number().over(inside) - 1)
    size = max(10_000, 4 * preceding)
    run = F.floor(F.col("_pos") / size)
    # The last rows of a run are also the lead-in of the next one.
    is_tail = F.col("_pos") % size >= size - preceding
    copies = F.when(is_tail, F.array(run, run + 1)).otherwise(F.array(run))
    spread = numbered.withColumn("_home", run).withColumn("_run", F.explode(copies))
    w = Window.partitionBy(*keys, "_run").orderBy("_pos").rowsBetween(-preceding, 0)
    out = spread.withColumns({name: fn(w) for name, fn in columns.items()})
    return out.where(F.col("_run") == F.col("_home")).drop("_block", "_offset", "_pos", "_home", "_run")


def pct_change(df: DataFrame, column: str, group: Sequence[str] = GROUP, ts: str = "snapshot_ts") -> DataFrame:
    """Relative change to the previous row of the series; NULL after 0 or at the start."""
    previous = F.lag(column).over(series(group, ts))
    return df.withColumn(f"{column}_pct_change", F.try_divide(F.col(column), previous) - 1)


# -- one row per key -------------------------------------------------------------------


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Smallest row per key by ``order``, as an aggregation: it combines before the
    shuffle, so a key that holds most rows costs no more than any other."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    ranked = df.select(*keys, F.struct(*rest).alias("_row"), F.struct(*order).alias("_by"))
    best = ranked.groupBy(*keys).agg(F.min_by("_row", "_by").alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def dedup_best(events: DataFrame, rank: str | None = None) -> DataFrame:
    """One event per region, category and metric: the largest |z|, then source rank, then time."""
    order = [-F.abs(F.col("z_score"))]
    if rank is not None:
        order.append(F.col(rank))
    order.append(F.col("window_end"))
    return first_per_key(events, ["region", "category", "metric_name"], order)


def event_id(*keys: str) -> Column:
    """Id of a record from its keys: the same on every run, no global numbering."""
    return F.xxhash64(*keys)


def assign_ids(df: DataFrame, keys: Sequence[str], name: str = "anomaly_id") -> DataFrame:
    return df.withColumn(name, event_id(*keys))


def number_rows(top: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """1..n on a frame that is already cut to a few rows by a top-k."""
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))


_PART = 1 << 33


def placed(df: DataFrame, order: Sequence[str | Column], at: str = "_at") -> DataFrame:
    """The frame range-sorted by ``order``, with each row's place in the whole table, from 0 on, in ``at``.

    Rows are cut into ranges that follow the data (as many as their size asks for), sorted within, and written once with
    their range and place in it. The ranges' counts, one row each, are added up and give each range its start. No task sees
    more than its range; ties are cut by content only if ``order`` tells them apart.
    """
    row = F.monotonically_increasing_id()
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", row)
    cut = stored(cut.withColumns({"_part": F.floor(F.col("_row") / _PART), "_inside": F.col("_row") % _PART}).drop("_row"), "placed")
    sizes = cut.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return cut.join(starts, "_part").withColumn(at, F.col("_start") + F.col("_inside")).drop("_part", "_inside", "_start")


def number_all(df: DataFrame, order_by: str | Column | Sequence[str | Column], name: str = "position") -> DataFrame:
    """1..n over a whole table in any order, nulls first as in a sort. One range sort; see :func:`placed`."""
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return placed(df, order, "_place").withColumn(name, F.col("_place") + 1).drop("_place")


# -- top-k -----------------------------------------------------------------------------


def latest(df: DataFrame, ts: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """Newest n rows."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c).asc() for c in ties]).limit(n)


def top_abs(df: DataFrame, column: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """k rows with the largest absolute value."""
    return df.orderBy(F.abs(F.col(column)).desc(), *[F.col(c).asc() for c in ties]).limit(k)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def keep_recent(log: DataFrame, n: int, ts: str = "ts", ties: Sequence[str] = ()) -> DataFrame:
    """Bounded log: the newest n entries."""
    return latest(log, ts, n, ties)


def first_per_metric(events: DataFrame, k: int, ties: Sequence[str] = ("metric_name", "region", "category")) -> DataFrame:
    """Top k events by |z|, then only the first one of each metric."""
    top = top_abs(events, "z_score", k, ties)
    return first_per_key(top, ["metric_name"], [-F.abs(F.col("z_score")), *[F.col(c) for c in ties]])
