"""From orders and events to KPI snapshots and features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD_NAMES = {"hour": "hourly", "day": "daily", "month": "monthly"}


# -- rows ---------------------------------------------------------------------------


def exact_revenue() -> Column:
    return F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct") / 100)


def with_revenue(orders: DataFrame) -> DataFrame:
    """Adds ``revenue_exact`` and ``revenue``, the latter as stored: two decimals.

    Binary noise is rounded off first, so that halves round as decimals do.
    """
    return orders.withColumn("revenue_exact", exact_revenue()).withColumn(
        "revenue", F.round("revenue_exact", 6).cast("decimal(14,2)")
    )


def valid_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_ts").isNotNull() & (F.col("unit_price") > 0) & (F.col("quantity") > 0))


def last_complete_hour(df: DataFrame, now: datetime | Column, ts: str = "order_ts", period: str = "hour") -> DataFrame:
    """Rows of the last full bucket before ``now``: half-open, in plain bounds the scan can use."""
    end = F.date_trunc(period, _as_ts(now))
    step = {"hour": "1 hour", "day": "1 day", "month": "1 month"}[period]
    return df.where((F.col(ts) >= end - F.expr(f"interval {step}")) & (F.col(ts) < end))


def lookback(df: DataFrame, hours: int, now: datetime | Column, ts: str = "snapshot_ts") -> DataFrame:
    return df.where(F.col(ts) >= _as_ts(now) - F.make_interval(hours=F.lit(hours)))


def latest_slice(df: DataFrame, hours: int = 2, ts: str = "snapshot_ts") -> DataFrame:
    """Rows within ``hours`` of the newest one."""
    newest = df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.make_interval(hours=F.lit(hours)))


def by_period(kpi: DataFrame, period: str = "hourly") -> DataFrame:
    return kpi.where(F.col("period") == period)


def filter_anomalies(
    events: DataFrame, severities: Sequence[str] = ("CRITICAL", "HIGH"), regions: Sequence[str] = ()
) -> DataFrame:
    """Severity and region lists; an empty list does not filter."""
    if severities:
        events = events.where(F.col("severity").isin(*severities))
    if regions:
        events = events.where(F.col("region").isin(*regions))
    return events


def exclude_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def newer_than_target(source: DataFrame, target: DataFrame, source_ts: str = "order_ts", target_ts: str = "snapshot_ts") -> DataFrame:
    """Source rows later than the newest target row; all of them for an empty target."""
    newest = target.agg(F.max(target_ts)).scalar()
    return source.where(newest.isNull() | (F.col(source_ts) > newest))


def _as_ts(now: datetime | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(now)


# -- rollups -----------------------------------------------------------------------------


def measures(revenue: Column | None = None) -> list[Column]:
    """The four KPI aggregates."""
    revenue = exact_revenue() if revenue is None else revenue
    zero = F.lit(0.0)
    return [
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum(revenue), zero).alias("total_revenue"),
        F.coalesce(F.avg(revenue), zero).alias("avg_order_val"),
        F.coalesce(F.avg(F.col("is_returned").cast("int")), zero).alias("return_rate"),
    ]


def kpi_by_period(orders: DataFrame, period: str = "hour", label: str = "start") -> DataFrame:
    """Snapshots of every bucket x region x category.

    Partial aggregation runs before the only shuffle, so hot regions cost
    nothing extra. The label is the start of the bucket, or its end.
    """
    bucket = F.date_trunc(period, "order_ts")
    if label == "end":
        bucket = bucket + F.expr(f"interval 1 {period}")
    return (
        valid_orders(orders)
        .groupBy(bucket.alias("snapshot_ts"), "region", "category")
        .agg(*measures())
        .withColumn("period", F.lit(PERIOD_NAMES.get(period, period)))
    )


def kpi_snapshot(orders: DataFrame, now: datetime | Column, period: str = "hour") -> DataFrame:
    """Snapshot of the last full bucket before ``now``, labelled with the bucket's end."""
    return (
        last_complete_hour(orders, now, period=period)
        .groupBy("region", "category")
        .agg(*measures())
        .withColumn("snapshot_ts", F.date_trunc(period, _as_ts(now)))
        .withColumn("period", F.lit(PERIOD_NAMES.get(period, period)))
    )


def backfill(orders: DataFrame, start: datetime, end: datetime, period: str = "hour") -> DataFrame:
    """All snapshots of a time range in one batch."""
    in_range = (F.col("order_ts") >= F.lit(start)) & (F.col("order_ts") < F.lit(end))
    return kpi_by_period(orders.where(in_range), period)


def conversion_rate(events: DataFrame, period: str = "hour", by: Sequence[str] = ()) -> DataFrame:
    """Purchases per view in each bucket; NULL without views."""
    kind = F.col("event_type")
    counted = events.groupBy(F.date_trunc(period, "event_ts").alias("snapshot_ts"), *by).agg(
        F.count_if(kind == "purchase").alias("purchases"), F.count_if(kind.isin("view", "page_view")).alias("views")
    )
    return counted.withColumn("conversion_rt", F.try_divide("purchases", "views"))


# -- features for causal analysis -----------------------------------------------------------


def order_features(orders: DataFrame, period: str = "hour", by: Sequence[str] = ("region", "category")) -> DataFrame:
    """Volume, price, discount, return and revenue per bucket for every group at once."""
    return orders.groupBy(F.date_trunc(period, "order_ts").alias("hour_bucket"), *by).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.avg("unit_price").alias("avg_price"),
        F.avg("discount_pct").alias("avg_discount"),
        F.avg(F.col("is_returned").cast("int")).alias("return_rate"),
        F.sum(exact_revenue()).alias("revenue"),
        F.avg("quantity").alias("avg_qty"),
    )


def event_features(events: DataFrame, types: Sequence[str], period: str = "hour") -> DataFrame:
    """Events per bucket and type, one column ``evt_<type>`` each, 0 where none."""
    kind = F.col("event_type")
    return events.groupBy(F.date_trunc(period, "event_ts").alias("hour_bucket")).agg(
        *[F.count_if(kind == t).alias(f"evt_{t}") for t in types]
    )


def join_event_features(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Event columns beside the order features of the same bucket, every gap as 0.

    The event side has one row per bucket; whether it is broadcast is decided
    from its measured size at run time.
    """
    joined = orders.join(events, "hour_bucket", "left")
    numeric = [f.name for f in joined.schema.fields if f.dataType.typeName() in ("long", "double", "integer")]
    return joined.fillna(0, subset=numeric)
