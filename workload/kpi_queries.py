"""Filters, rollups, dashboard aggregations, windows, top-k."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewatch.functions import scalars as S
from tidewatch.operators import analytics, anomaly, kpi, setops, windows
from tidewatch.sources import adapters, readers, sinks
from workload import fragments as q
from workload.registry import query, r4, r6, ts

NOW = datetime(1999, 7, 1, 10, 30)
NOW_SQL = "timestamp '1999-07-01 10:30:00'"
EVENT_NOW = datetime(2024, 1, 20, 10, 30)
EVENT_NOW_SQL = "timestamp '2024-01-20 10:30:00'"
KPI_COLS = ["total_revenue", "avg_order_val", "return_rate"]


def anomalies(spark, sf):
    """Order anomalies at |z| >= 2, as in the SQL piece ANOM."""
    return anomaly.zscore_anomalies(adapters.order_kpis(spark, sf), threshold=2.0)


# -- rows -------------------------------------------------------------------------------


@query("order_revenue", f"""
with {q.RAW}
select order_id, product_id, round({q.REV}, 4) as revenue_exact,
       cast(cast(cast(round({q.REV}, 6) as decimal(24, 6)) as decimal(14, 2)) as double) as revenue
from raw""")
def order_revenue(spark, sf):
    df = kpi.with_revenue(adapters.raw_orders(spark, sf))
    return df.select("order_id", "product_id", *r4("revenue_exact"), F.col("revenue").cast("double").alias("revenue"))


@query("valid_orders", f"""
with {q.DIRTY}
select region, category, count(*) as n, sum(quantity) as quantity from dirty where {q.VALID} group by 1, 2""")
def valid_orders(spark, sf):
    ok = kpi.valid_orders(adapters.dirty_orders(spark, sf))
    return ok.groupBy("region", "category").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


@query("last_complete_hour", f"""
select event_id, {q.ts('ts', 'event_ts')} from events
where ts >= date_trunc('hour', {EVENT_NOW_SQL}) - interval 1 hour and ts < date_trunc('hour', {EVENT_NOW_SQL})""")
def last_complete_hour(spark, sf):
    rows = kpi.last_complete_hour(adapters.raw_events(spark, sf), EVENT_NOW, "event_ts")
    return rows.select("event_id", ts("event_ts"))


@query("lookback", f"""
select event_id, event_type, {q.n4('value')} as value from events where ts >= {EVENT_NOW_SQL} - interval 48 hour""")
def lookback(spark, sf):
    rows = kpi.lookback(adapters.raw_events(spark, sf), 48, EVENT_NOW, "event_ts")
    return rows.select("event_id", "event_type", *r4("value"))


@query("latest_slice", f"""
with {q.EKPI}
select {q.ts('snapshot_ts')}, category, total_orders, {q.r4('total_revenue')} from ekpi
where snapshot_ts >= (select max(snapshot_ts) from ekpi) - interval 2 hour""")
def latest_slice(spark, sf):
    rows = kpi.latest_slice(adapters.event_kpis(spark, sf), 2)
    return rows.select(ts("snapshot_ts"), "category", "total_orders", *r4("total_revenue"))


@query("filter_anomalies", f"""
with {q.ANOM}
select metric_name, region, category, {q.ts('window_end')}, severity, {q.r4('z_score')} from anom
where severity in ('CRITICAL', 'HIGH') and region in ('ASIA', 'EUROPE')""")
def filter_anomalies(spark, sf):
    kept = kpi.filter_anomalies(anomalies(spark, sf), regions=("ASIA", "EUROPE"))
    return kept.select("metric_name", "region", "category", ts("window_end"), "severity", *r4("z_score"))


@query("by_period", f"""
with {q.KPI}, {q.EKPI},
both_kpis as (select snapshot_ts, region, category, period, total_revenue from kpi
              union all select snapshot_ts, region, category, period, total_revenue from ekpi)
select {q.ts('snapshot_ts')}, region, category, {q.r4('total_revenue')} from both_kpis where period = 'hourly'""")
def by_period(spark, sf):
    cols = ["snapshot_ts", "region", "category", "period", "total_revenue"]
    both = adapters.order_kpis(spark, sf).select(*cols).unionByName(adapters.event_kpis(spark, sf).select(*cols))
    return kpi.by_period(both, "hourly").select(ts("snapshot_ts"), "region", "category", *r4("total_revenue"))


@query("exclude_null", f"""
with {q.DIRTY}
select region, count(*) as n, round(sum({q.REV}), 4) as revenue from dirty
where customer_id is not null and unit_price is not null and order_ts is not null group by 1""")
def exclude_null(spark, sf):
    kept = kpi.exclude_null(adapters.dirty_orders(spark, sf), ["customer_id", "unit_price", "order_ts"])
    return kept.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(kpi.exact_revenue()), 4).alias("revenue"))


@query("newer_than_target", f"""
with {q.KPI}, target as (select * from kpi where snapshot_ts < timestamp '2001-01-01')
select order_id, product_id, quantity, {q.ts('order_ts')} from raw
where order_ts > (select max(snapshot_ts) from target)""")
def newer_than_target(spark, sf):
    orders = adapters.raw_orders(spark, sf)
    target = adapters.order_kpis(spark, sf).where(F.col("snapshot_ts") < F.lit(datetime(2001, 1, 1)))
    fresh = kpi.newer_than_target(orders, target)
    return fresh.select("order_id", "product_id", "quantity", ts("order_ts"))


# -- rollups ----------------------------------------------------------------------------


@query("kpi_by_period", f"""
with {q.KPI}
select {q.ts('snapshot_ts')}, region, category, period, total_orders, {q.r4(*KPI_COLS)} from kpi""")
def kpi_by_period(spark, sf):
    k = adapters.order_kpis(spark, sf)
    return k.select(ts("snapshot_ts"), "region", "category", "period", "total_orders", *r4(*KPI_COLS))


@query("kpi_snapshot", f"""
with {q.RAW}, k as (
  select region, category, {q.MEASURES} from raw
  where order_ts >= date_trunc('month', {NOW_SQL}) - interval 1 month and order_ts < date_trunc('month', {NOW_SQL}) group by 1, 2)
select {q.ts(f"date_trunc('month', {NOW_SQL})", 'snapshot_ts')}, region, category, total_orders, {q.r4(*KPI_COLS)} from k""")
def kpi_snapshot(spark, sf):
    k = kpi.kpi_snapshot(adapters.raw_orders(spark, sf), NOW, "month")
    return k.select(ts("snapshot_ts"), "region", "category", "total_orders", *r4(*KPI_COLS))


@query("backfill", f"""
with {q.RAW}
select strftime(date_trunc('month', order_ts), '%Y-%m-%d %H:%M:%S') as snapshot_ts, region, category, count(*) as total_orders,
       {q.n4('sum(' + q.REV + ')')} as total_revenue
from raw where {q.VALID} and order_ts >= timestamp '1997-01-01' and order_ts < timestamp '1999-01-01' group by 1, 2, 3""")
def backfill(spark, sf):
    k = kpi.backfill(adapters.raw_orders(spark, sf), datetime(1997, 1, 1), datetime(1999, 1, 1), "month")
    return k.select(ts("snapshot_ts"), "region", "category", "total_orders", *r4("total_revenue"))


@query("conversion_rate", f"""
select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as snapshot_ts, count_if(event_type = 'purchase') as purchases,
       count_if(event_type in ('view', 'page_view')) as views,
       {q.n6("count_if(event_type = 'purchase')::double / nullif(count_if(event_type in ('view', 'page_view')), 0)")} as conversion_rt
from events group by 1""")
def conversion_rate(spark, sf):
    c = kpi.conversion_rate(adapters.raw_events(spark, sf))
    return c.select(ts("snapshot_ts"), "purchases", "views", *r6("conversion_rt"))


FEATURES = f"""features as (
  select date_trunc('month', order_ts)::timestamp as hour_bucket, region, category, count(*) as order_count, avg(unit_price) as avg_price,
         avg(discount_pct) as avg_discount, avg(case when is_returned then 1.0::double else 0 end) as return_rate,
         sum({q.REV}) as revenue, avg(quantity) as avg_qty from raw group by 1, 2, 3)"""
FEATURE_COLS = ["avg_price", "avg_discount", "return_rate", "revenue", "avg_qty"]


@query("order_features", f"""
with {q.RAW}, {FEATURES}
select {q.ts('hour_bucket')}, region, category, order_count, {q.r4(*FEATURE_COLS)} from features""")
def order_features(spark, sf):
    f = kpi.order_features(adapters.raw_orders(spark, sf), "month")
    return f.select(ts("hour_bucket"), "region", "category", "order_count", *r4(*FEATURE_COLS))


TYPES = ["click", "view", "purchase", "signup", "error"]
EVT_SQL = ", ".join(f"count_if(event_type = '{t}') as evt_{t}" for t in TYPES)


@query("event_features", f"""
select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour_bucket, {EVT_SQL} from events group by 1""")
def event_features(spark, sf):
    f = kpi.event_features(adapters.raw_events(spark, sf), TYPES)
    return f.select(ts("hour_bucket"), *[f"evt_{t}" for t in TYPES])


@query("join_event_features", f"""
with {q.EKPI}, f as (select date_trunc('hour', ts)::timestamp as hour_bucket, {EVT_SQL} from events
                     where event_type in ('purchase', 'view') group by 1)
select {q.ts('snapshot_ts', 'hour_bucket')}, category, {q.n4('total_revenue')} as revenue,
       coalesce(evt_purchase, 0) as evt_purchase, coalesce(evt_view, 0) as evt_view
from ekpi left join f on snapshot_ts = hour_bucket""")
def join_event_features(spark, sf):
    """Event KPIs beside the view and purchase counts of their hour; hours without either get 0."""
    orders = adapters.event_kpis(spark, sf).select(
        F.col("snapshot_ts").alias("hour_bucket"), "category", F.col("total_revenue").alias("revenue")
    )
    events = adapters.raw_events(spark, sf).where(F.col("event_type").isin("purchase", "view"))
    j = kpi.join_event_features(orders, kpi.event_features(events, ["purchase", "view"]))
    return j.select(ts("hour_bucket"), "category", *r4("revenue"), "evt_purchase", "evt_view")


# -- health -----------------------------------------------------------------------------

RUNS = """runs as (
  select o_orderkey as run_id, o_orderpriority as pipeline_name, o_orderdate as started_at, shipped as finished_at,
         case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'RUNNING' else 'FAILED' end as status,
         coalesce(lines, 0) as rows_ingested, o_totalprice / 1000 as seconds
  from orders left join (select l_orderkey, max(l_shipdate) as shipped, count(*) as lines from lineitem group by 1)
       on o_orderkey = l_orderkey)"""


@query("run_health", f"""
with {RUNS}
select status, count(*) as n from runs where started_at >= {NOW_SQL} - interval 8760 hour group by 1""")
def run_health(spark, sf):
    return analytics.run_health(adapters.order_runs(spark, sf), NOW, 8760)


@query("latest_runs", f"""
with {RUNS},
log as (select run_id, started_at as event_ts, 'RUNNING' as status, 0 as rows_ingested from runs
        union all select run_id, finished_at, status, rows_ingested from runs where status <> 'RUNNING' and finished_at is not null),
ranked as (select *, row_number() over (partition by run_id order by event_ts desc, (status <> 'RUNNING')::int desc) as rn from log)
select run_id, status, rows_ingested, {q.ts('event_ts')} from ranked where rn = 1""")
def latest_runs(spark, sf):
    """Present state of every run from its start and finish events."""
    runs = adapters.order_runs(spark, sf)
    started = runs.select("run_id", F.col("started_at").alias("event_ts"), F.lit("RUNNING").alias("status"), F.lit(0).cast("long").alias("rows_ingested"))
    ended = runs.where("status <> 'RUNNING' and finished_at is not null").select(
        "run_id", F.col("finished_at").alias("event_ts"), "status", "rows_ingested"
    )
    return sinks.latest_runs(started.unionByName(ended)).select("run_id", "status", "rows_ingested", ts("event_ts"))


@query("duration_histogram", f"""
with {RUNS}, c as (select {', '.join(f"count_if(seconds <= {b}) as b{b}" for b in (1, 5, 10, 30, 60, 120, 300))}, count(seconds) as n, sum(seconds) as s from runs)
select le, cumulative, n as n_runs, {q.n4('s')} as sum_seconds from (
{' union all '.join(f"select '{b}' as le, b{b} as cumulative, n, s from c" for b in (1, 5, 10, 30, 60, 120, 300))}
union all select '+Inf', n, n, s from c)""")
def duration_histogram(spark, sf):
    h = analytics.duration_histogram(adapters.order_runs(spark, sf))
    return h.select("le", "cumulative", "n_runs", *r4("sum_seconds"))


@query("metric_counters", f"""
with {q.ANOM}, {RUNS}
select 'anomalies_total' as name, severity || '/' || region || '/' || category as label, count(*)::double as value from anom group by 2
union all select 'pipeline_rows_ingested_total', '', sum(rows_ingested)::double from runs""")
def metric_counters(spark, sf):
    c = analytics.counters(anomalies=anomalies(spark, sf), runs=adapters.order_runs(spark, sf))
    label = F.array_join(F.map_values("labels"), "/")
    return c.select("name", label.alias("label"), "value")


# -- dashboard --------------------------------------------------------------------------


@query("share_by", f"""
with {q.KPI}
select region, {q.n4('sum(total_revenue)')} as value, {q.n6('sum(total_revenue) / (select sum(total_revenue) from kpi)')} as share
from kpi group by 1""")
def share_by(spark, sf):
    return analytics.share_by(adapters.order_kpis(spark, sf), "region", "total_revenue").select("region", *r4("value"), *r6("share"))


@query("severity_distribution", f"with {q.ANOM} select severity, count(*) as n from anom group by 1")
def severity_distribution(spark, sf):
    return analytics.severity_distribution(anomalies(spark, sf))


@query("mean_by", f"""
with {q.KPI} select category, {', '.join(q.n4(f"avg({m})") + f" as {m}" for m in ('total_revenue', 'total_orders', 'avg_order_val'))} from kpi group by 1""")
def mean_by(spark, sf):
    m = ["total_revenue", "total_orders", "avg_order_val"]
    return analytics.mean_by(adapters.order_kpis(spark, sf), "category", m).select("category", *r4(*m))


@query("melt_means", f"""
with {q.KPI}, m as (select region, avg(total_orders) as total_orders, avg(avg_order_val) as avg_order_val from kpi group by 1)
select region, 'total_orders' as metric, {q.n4('total_orders')} as value from m
union all select region, 'avg_order_val', {q.n4('avg_order_val')} from m""")
def melt_means(spark, sf):
    m = ["total_orders", "avg_order_val"]
    means = analytics.mean_by(adapters.order_kpis(spark, sf), "region", m)
    return analytics.melt(means, ["region"], m).select("region", "metric", *r4("value"))


@query("trend", f"""
with {q.KPI} select {q.ts('snapshot_ts')}, region, {q.n4('avg(total_revenue)')} as total_revenue, {q.n4('avg(total_orders)')} as total_orders
from kpi group by snapshot_ts, region""")
def trend(spark, sf):
    t = analytics.trend(adapters.order_kpis(spark, sf), "snapshot_ts", "region", ["total_revenue", "total_orders"])
    return t.select(ts("snapshot_ts"), "region", *r4("total_revenue", "total_orders"))


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("pivot_revenue", f"""
with {q.KPI} select {q.ts('snapshot_ts')}, {', '.join(f"round(sum(case when region = '{r}' then total_revenue end), 4) as rev_{r.split()[0].lower()}" for r in REGIONS)}
from kpi group by snapshot_ts""")
def pivot_revenue(spark, sf):
    p = analytics.pivot_revenue(adapters.order_kpis(spark, sf), REGIONS)
    return p.select(ts("snapshot_ts"), *[F.round(F.col(f"`{r}`"), 4).alias(f"rev_{r.split()[0].lower()}") for r in REGIONS])


@query("overview", f"""
with {q.ANOM}, pc as (select *, total_revenue / nullif(lag(total_revenue) over (partition by region, category order by snapshot_ts), 0) - 1 as pc from kpi)
select {q.n4('sum(total_revenue)')} as total_revenue, {q.n6('avg(pc)')} as mean_pct_change, {q.n6('avg(return_rate)')} as mean_return_rate,
       (select count(*) from anom) as anomalies, (select count_if(severity = 'CRITICAL') from anom) as critical,
       (select count(*) from (select distinct region, category, metric_name from anom)) as decisions
from pc""")
def overview(spark, sf):
    k, a = adapters.order_kpis(spark, sf), anomalies(spark, sf)
    o = analytics.overview(k, a, windows.dedup_best(a))
    return o.select(*r4("total_revenue"), *r6("mean_pct_change", "mean_return_rate"), "anomalies", "critical", "decisions")


@query("kpi_baseline", f"""
with {q.KPI} select {', '.join(q.n4(f"avg({m})") + f" as {m}" for m in ('total_revenue', 'total_orders', 'return_rate', 'avg_order_val'))} from kpi""")
def kpi_baseline(spark, sf):
    return analytics.kpi_baseline(adapters.order_kpis(spark, sf)).select(*r4("total_revenue", "total_orders", "return_rate", "avg_order_val"))


CORR = ["total_orders", "total_revenue", "avg_order_val", "return_rate"]
PAIR_SQL = " union all ".join(
    f"select '{a}' as x, '{b}' as y, {q.n6(f'covar_samp({a}::double, {b}::double) / nullif(stddev_samp({a}::double) * stddev_samp({b}::double), 0)')} as r from kpi"
    for a in CORR
    for b in CORR
)


@query("corr_matrix", f"with {q.KPI} {PAIR_SQL}")
def corr_matrix(spark, sf):
    return analytics.corr_matrix(adapters.order_kpis(spark, sf), CORR).select("x", "y", *r6("r"))


@query("z_histogram", f"""
with {q.ANOM} select floor(z_score / 0.25) * 0.25 as bin_start, severity, count(*) as n from anom group by 1, 2""")
def z_histogram(spark, sf):
    return analytics.histogram(anomalies(spark, sf), "z_score", "severity", 0.25)


@query("cardinality_gate", f"""
with {q.RAW}, c as (select count(distinct product_id) as product_id, count(distinct region) as region, count(distinct category) as category from raw)
select case when product_id > 1 and product_id <= 20 then 'product_id' when region > 1 and region <= 20 then 'region'
            when category > 1 and category <= 20 then 'category' end as chosen, product_id, region, category from c""")
def cardinality_gate(spark, sf):
    return analytics.cardinality_gate(adapters.raw_orders(spark, sf), ["product_id", "missing", "region", "category"], exact=True)


@query("distinct_values", "select distinct event_type from events where event_type is not null")
def distinct_values(spark, sf):
    return analytics.distinct_values(adapters.raw_events(spark, sf), "event_type")


# -- windows ----------------------------------------------------------------------------


@query("recent_kpis", f"""
with {q.EKPI}
select {q.ts('snapshot_ts')}, category, {q.n4('total_revenue')} as total_revenue,
       {q.n4('lag(total_revenue) over (partition by region, category order by snapshot_ts)')} as prev_revenue,
       {q.n4('avg(total_revenue) over (partition by region, category order by snapshot_ts rows between 23 preceding and current row)')} as rolling_24h_avg_revenue
from ekpi where period = 'hourly'""")
def recent_kpis(spark, sf):
    r = windows.recent_kpis(adapters.event_kpis(spark, sf))
    return r.select(ts("snapshot_ts"), "category", *r4("total_revenue", "prev_revenue", "rolling_24h_avg_revenue"))


@query("rolling_z", f"""
with {q.KPI}, {q.rolling('kpi')}
select {q.ts('snapshot_ts')}, region, category, {', '.join(q.r4(f"{m}_mean") + ", " + q.r6(f"{m}_z") for m in q.Z_METRICS)} from zs""")
def rolling_z(spark, sf):
    z = windows.rolling_z(adapters.order_kpis(spark, sf), q.Z_METRICS)
    cols = [c for m in q.Z_METRICS for c in (*r4(f"{m}_mean"), *r6(f"{m}_z"))]
    return z.select(ts("snapshot_ts"), "region", "category", *cols)


@query("rolling_z_hourly", f"""
with {q.EKPI}, {q.rolling('ekpi', ('total_revenue', 'total_orders'), 'rows between 24 preceding and 1 preceding')}
select {q.ts('snapshot_ts')}, category, {', '.join(q.r6(f"{m}_z") for m in ('total_revenue', 'total_orders'))} from zs""")
def rolling_z_hourly(spark, sf):
    """Events per hour against the 24 hours before, the current one left out."""
    z = windows.rolling_z(adapters.event_kpis(spark, sf), ["total_revenue", "total_orders"], include_current=False)
    return z.select(ts("snapshot_ts"), "category", *r6("total_revenue_z", "total_orders_z"))


@query("event_moving_average", f"""
select event_id, {q.n6('avg(value) over (partition by event_type order by ts, event_id rows between 23 preceding and current row)')} as moving_avg,
       count(*) over (partition by event_type order by ts, event_id rows between 23 preceding and current row) as in_window
from events""")
def event_moving_average(spark, sf):
    """Rolling mean over raw events. A type may hold a third of all rows, so series are cut into blocks."""
    events = adapters.raw_events(spark, sf)
    out = windows.in_blocks(
        events,
        {"moving_avg": lambda w: F.avg("value").over(w), "in_window": lambda w: F.count(F.lit(1)).over(w)},
        ["event_type"], ["event_ts", "event_id"], 23, F.date_trunc("minute", "event_ts"),
    )
    return out.select("event_id", *r6("moving_avg"), "in_window")


@query("pct_change", f"""
with {q.KPI}
select {q.ts('snapshot_ts')}, region, category,
       {q.n6('total_revenue / nullif(lag(total_revenue) over (partition by region, category order by snapshot_ts), 0) - 1')} as total_revenue_pct_change
from kpi""")
def pct_change(spark, sf):
    c = windows.pct_change(adapters.order_kpis(spark, sf), "total_revenue")
    return c.select(ts("snapshot_ts"), "region", "category", *r6("total_revenue_pct_change"))


@query("dedup_best", f"""
with {q.ANOM}, ranked as (select *, row_number() over (partition by region, category, metric_name order by abs(z_score) desc, window_end) as rn from anom)
select region, category, metric_name, {q.r4('metric_value', 'expected_value', 'z_score')}, severity, {q.ts('window_end')} from ranked where rn = 1""")
def dedup_best(spark, sf):
    b = windows.dedup_best(anomalies(spark, sf))
    return b.select("region", "category", "metric_name", *r4("metric_value", "expected_value", "z_score"), "severity", ts("window_end"))


@query("first_per_metric", f"""
with {q.ANOM}, top as (select * from anom order by abs(z_score) desc, metric_name, region, category limit 8),
ranked as (select *, row_number() over (partition by metric_name order by abs(z_score) desc, metric_name, region, category) as rn from top)
select metric_name, region, category, {q.r4('z_score')} from ranked where rn = 1""")
def first_per_metric(spark, sf):
    return windows.first_per_metric(anomalies(spark, sf), 8).select("metric_name", "region", "category", *r4("z_score"))


@query("number_events", "select event_id, row_number() over (order by event_id) as position from events")
def number_events(spark, sf):
    """Sequential numbers over a whole table without a global sort in one task."""
    return windows.number_all(adapters.raw_events(spark, sf).select("event_id"), "event_id")


# -- top-k ------------------------------------------------------------------------------


@query("latest_kpis", f"""
with {q.EKPI} select {q.ts('snapshot_ts')}, category, {q.r4('total_revenue')} from ekpi
order by snapshot_ts desc, category limit 500""")
def latest_kpis(spark, sf):
    rows = windows.latest(adapters.event_kpis(spark, sf), "snapshot_ts", 500, ["category"])
    return rows.select(ts("snapshot_ts"), "category", *r4("total_revenue"))


@query("top_abs", f"""
with {q.ANOM} select metric_name, region, category, {q.r4('z_score')} from anom
order by abs(anom.z_score) desc, metric_name, region, category limit 5""")
def top_abs(spark, sf):
    rows = windows.top_abs(anomalies(spark, sf), "z_score", 5, ["metric_name", "region", "category"])
    return rows.select("metric_name", "region", "category", *r4("z_score"))


@query("preview", None)
def preview(spark, sf):
    return windows.preview(adapters.order_kpis(spark, sf), 5).select(ts("snapshot_ts"), "region", "category", "total_orders")


@query("keep_recent", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as event_ts from events order by ts desc, event_id limit 150")
def keep_recent(spark, sf):
    return windows.keep_recent(adapters.raw_events(spark, sf), 150, "event_ts", ["event_id"]).select("event_id", ts("event_ts"))


# -- sets and messages --------------------------------------------------------------------


@query("union_events", f"""
with {q.ANOM}, e as (select * from anom union all select * from anom where severity = 'LOW')
select severity, count(*) as n, round(sum(z_score), 4) as z_sum from e group by 1""")
def union_events(spark, sf):
    a = anomalies(spark, sf)
    both = anomaly.union_events(a, a.where(F.col("severity") == "LOW"))
    return both.groupBy("severity").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z_score"), 4).alias("z_sum"))


DIRTY_COLS = ["customer_id", "order_ts", "unit_price", "payment_method"]


@query("observed_columns", f"""
with {q.DIRTY}
{' union all '.join(f"select '{c}' as column_name, count({c}) as filled from dirty having count({c}) > 0" for c in DIRTY_COLS)}""")
def observed_columns(spark, sf):
    df = adapters.dirty_orders(spark, sf).select(*DIRTY_COLS)
    return setops.observed_columns(df, "raw_orders").select("column_name", "filled")


@query("message_round_trip", """
select event_type, count(*) as n, round(sum(value), 4) as value, sum(json_extract(props, '$.k')::bigint) as k_sum from events group by 1""")
def message_round_trip(spark, sf):
    """Events to JSON envelopes and back, with the payload's own JSON read last."""
    events = adapters.raw_events(spark, sf)
    sent = readers.encode_message(events, "events")
    got = readers.decode_message(sent, events.schema, "events")
    k = F.get_json_object("metadata", "$.k").cast("long")
    return got.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"), F.sum(k).alias("k_sum")
    )


@query("audit_rows", """
select o_orderkey::varchar as order_id, 'N/A' as item, o_totalprice as amount,
       case when o_orderpriority like '1%' then 'Reject' when o_orderpriority like '2%' then 'Flag for review' else 'ok' end as ai_decision,
       case when o_orderpriority like '1%' then 'ACCOUNT_BLOCKED' when o_orderpriority like '2%' then 'FUNDS_HELD' else 'APPROVED' end as action_taken,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as "timestamp"
from orders""")
def audit_rows(spark, sf):
    p = F.col("o_orderpriority")
    orders = adapters.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"), "o_orderdate",
        F.when(p.startswith("1"), "Reject").when(p.startswith("2"), "Flag for review").otherwise("ok").alias("ai_decision"),
    )
    orders = orders.withColumn("action_taken", S.action_from_decision("ai_decision"))
    return sinks.audit_rows(orders, F.col("o_orderdate"))


@query("merge_snapshots", f"""
with {q.KPI}, old as (select * from kpi where snapshot_ts < timestamp '2000-01-01'),
fresh as (select snapshot_ts, period, region, category, total_orders + 1 as total_orders from kpi where snapshot_ts >= timestamp '1999-06-01')
select {q.ts('snapshot_ts')}, region, category, total_orders from (
  select snapshot_ts, region, category, total_orders from fresh
  union all select o.snapshot_ts, o.region, o.category, o.total_orders from old o where not exists (
    select 1 from fresh f where f.snapshot_ts = o.snapshot_ts and f.region = o.region and f.category = o.category))""")
def merge_snapshots(spark, sf):
    k = adapters.order_kpis(spark, sf).select("snapshot_ts", "period", "region", "category", "total_orders")
    old = k.where(F.col("snapshot_ts") < F.lit(datetime(2000, 1, 1)))
    fresh = k.where(F.col("snapshot_ts") >= F.lit(datetime(1999, 6, 1))).withColumn("total_orders", F.col("total_orders") + 1)
    return sinks.merge_snapshots(old, fresh).select(ts("snapshot_ts"), "region", "category", "total_orders")
