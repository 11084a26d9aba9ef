"""Scalar rules, detectors, outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.config import Settings
from tidewatch.functions import scalars as S
from tidewatch.operators import anomaly, forest, kpi, windows
from tidewatch.session import checkpoint_dir
from tidewatch.sources import adapters
from workload import fragments as q
from workload.kpi_queries import anomalies
from workload.registry import query, r4, r6, ts

EVENT = ["metric_name", "region", "category", "severity"]


def event_anomalies(spark, sf):
    """Hourly event anomalies at |z| >= 2, as in the SQL piece EANOM."""
    return anomaly.zscore_anomalies(
        adapters.event_kpis(spark, sf), metrics=("total_revenue", "avg_order_val", "total_orders"), threshold=2.0
    )


# -- scalar rules -------------------------------------------------------------------------


@query("severity_rules", f"""
with {q.KPI}, {q.rolling('kpi')}, z as (select snapshot_ts, region, category, total_revenue_z * 2.5 as z from zs)
select {q.ts('snapshot_ts')}, region, category, case when z is null then 'CRITICAL' else {q.severity('z')} end as severity,
       case when z > 3 then 'CRITICAL' when z > 2 then 'HIGH' when z > 1 then 'MEDIUM' else 'LOW' end as severity_simple,
       case when abs(z) > 4 then 'CRITICAL' when abs(z) > 3 then 'HIGH' else 'MEDIUM' end as severity_csv,
       case when abs(z) > 4 then 'EXTREME' when abs(z) > 3 then 'HIGH' else 'MODERATE' end as magnitude,
       case when abs(z) > 4 then '🔴 CRITICAL BREACH' when abs(z) > 3 then '🟠 HIGH ALERT' else '🟡 ELEVATED' end as signal
from z""")
def severity_rules(spark, sf):
    """Every severity rule on the stretched revenue z of each snapshot, so that all bands occur."""
    z = windows.rolling_z(adapters.order_kpis(spark, sf), q.Z_METRICS).withColumn("z", F.col("total_revenue_z") * 2.5)
    return z.select(
        ts("snapshot_ts"), "region", "category", S.severity("z").alias("severity"), S.severity_simple("z").alias("severity_simple"),
        S.severity_csv("z").alias("severity_csv"), S.magnitude("z").alias("magnitude"), S.signal("z").alias("signal"),
    )


@query("normalize_text", """
select page_id, regexp_replace(regexp_replace(lower(trim(url)), '[^a-z0-9_]', '_', 'g'), '^_+|_+$', '', 'g') as name from pages""")
def normalize_text(spark, sf):
    return adapters.table(spark, sf, "pages").select("page_id", S.normalize_text("url").alias("name"))


@query("clean_numeric", """
with t as (select l_orderkey, l_partkey, l_linenumber, case when l_quantity = 50 then 'n/a' else '₹ ' || l_extendedprice::varchar end as price,
                  (l_discount * 100 + 0.0)::varchar || ' %' as discount from lineitem)
select l_orderkey, l_partkey, l_linenumber, try_cast(regexp_replace(price, '[₹$€£,%\\s]', '', 'g') as double) as price,
       try_cast(regexp_replace(discount, '[₹$€£,%\\s]', '', 'g') as double) as discount from t""")
def clean_numeric(spark, sf):
    price = F.when(F.col("l_quantity") == 50, "n/a").otherwise(F.concat(F.lit("₹ "), F.col("l_extendedprice").cast("string")))
    discount = F.concat((F.col("l_discount") * 100 + F.lit(0.0)).cast("string"), F.lit(" %"))
    return adapters.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", S.clean_numeric(price).alias("price"), S.clean_numeric(discount).alias("discount")
    )


@query("hour_buckets", f"""
select event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour_bucket, {q.ts('ts - interval 24 hour', 'window_start')},
       {q.ts('ts', 'window_end')} from events""")
def hour_buckets(spark, sf):
    b = S.window_bounds("event_ts", 24)
    return adapters.raw_events(spark, sf).select(
        "event_id", ts(S.hour_bucket("event_ts"), "hour_bucket"), ts(b["window_start"], "window_start"), ts(b["window_end"], "window_end")
    )


@query("decision_words", r"""
with t as (select doc_id, text, upper(text) as u from documents)
select doc_id,
  case when contains(text, 'P0') then 'P0' when contains(text, 'P1') then 'P1' when contains(text, 'P2') then 'P2'
       when contains(text, 'P3') then 'P3' else 'P2' end as priority,
  case when regexp_matches(text, '(?m)^[ \t]*1[).](.*)$')
       then substring(regexp_replace(regexp_extract(text, '(?m)^[ \t]*1[).](.*)$', 1), '^\s+|\s+$', '', 'g'), 1, 128)
       else regexp_replace(substring(text, 1, 128), '^\s+|\s+$', '', 'g') end as action,
  case when regexp_matches(u, 'REJECT|CRITICAL|IMMEDIATE|P1') then 'P1' when regexp_matches(u, 'FLAG|URGENT|HIGH|P2') then 'P2'
       when regexp_matches(u, 'APPROVE|MONITOR|MEDIUM|P3') then 'P3' else 'P4' end as keyword_priority,
  case when contains(text, 'Reject') or contains(text, 'Fraud') then 'ACCOUNT_BLOCKED'
       when contains(text, 'Flag') or contains(text, 'Review') then 'FUNDS_HELD' else 'APPROVED' end as action_taken
from t""")
def decision_words(spark, sf):
    """Priority and action rules on whole texts."""
    return adapters.table(spark, sf, "documents").select(
        "doc_id", S.extract_priority("text").alias("priority"), S.extract_action("text").alias("action"),
        S.priority_from_keywords("text").alias("keyword_priority"), S.action_from_decision("text").alias("action_taken"),
    )


@query("effect_sizes", f"""
with {q.ANOM}
select metric_name, region, category, {q.ts('window_end')}, {q.n4('metric_value - expected_value')} as ate,
       {q.n4('(metric_value - expected_value) / greatest(abs(expected_value), 1e-9) * 100')} as ate_pct,
       {q.n4('least(0.99, 0.60 + abs(z_score) * 0.04)')} as conf_analyst, {q.n4('least(0.99, 0.50 + abs(z_score) * 0.07)')} as conf_causal,
       {q.n4('least(0.99, 0.65 + abs(z_score) * 0.04)')} as conf_parsed
from anom""")
def effect_sizes(spark, sf):
    a = anomalies(spark, sf)
    vals = {
        "ate": S.ate_delta("metric_value", "expected_value"),
        "ate_pct": S.ate_pct("metric_value", "expected_value"),
        "conf_analyst": S.confidence("z_score", (0.60, 0.04)),
        "conf_causal": S.confidence("z_score"),
        "conf_parsed": S.confidence("z_score", (0.65, 0.04)),
    }
    return a.withColumns(vals).select("metric_name", "region", "category", ts("window_end"), *r4(*vals))


@query("json_maps", """
select event_id, json_extract_string(props, '$.k') as k, event_type as kind,
       case when event_type = 'error' then 'changed' else json_extract_string(props, '$.k') end as merged_k
from events""")
def json_maps(spark, sf):
    """Payload read as a map, patched with the event type, errors overwriting the old key."""
    base = S.parse_map("metadata")
    patch = F.when(
        F.col("event_type") == "error", F.create_map(F.lit("kind"), F.col("event_type"), F.lit("k"), F.lit("changed"))
    ).otherwise(F.create_map(F.lit("kind"), F.col("event_type")))
    merged = S.merge_maps(base, patch)
    return adapters.raw_events(spark, sf).select(
        "event_id", base["k"].alias("k"), merged["kind"].alias("kind"), merged["k"].alias("merged_k")
    )


@query("alert_keys", f"""
with {q.ANOM}
select metric_name, region, category, {q.ts('window_end')}, 'anomaly-' || total.total_orders || '-' || metric_name as dedup_key,
       case severity when 'CRITICAL' then 'critical' when 'HIGH' then 'error' when 'MEDIUM' then 'warning' when 'LOW' then 'info' else 'warning' end as pager_level
from anom join (select snapshot_ts as t, region as r, category as c, total_orders from kpi) total on t = snapshot_ts and r = region and c = category""")
def alert_keys(spark, sf):
    k = adapters.order_kpis(spark, sf)
    n = k.select(F.col("snapshot_ts").alias("window_end"), "region", "category", "total_orders")
    a = anomaly.zscore_anomalies(k, threshold=2.0).join(n, ["window_end", "region", "category"])
    return a.select(
        "metric_name", "region", "category", ts("window_end"), S.dedup_key("total_orders", "metric_name").alias("dedup_key"),
        S.pager_level("severity").alias("pager_level"),
    )


# -- detectors ------------------------------------------------------------------------------


@query("zscore_anomalies", f"""
with {q.KPI}, {q.anomalies('kpi', 3.0)}
select metric_name, region, category, severity, {q.r4('metric_value', 'expected_value', 'z_score')}, {q.ts('window_start')}, {q.ts('window_end')} from anom""")
def zscore_anomalies(spark, sf):
    a = anomaly.zscore_anomalies(adapters.order_kpis(spark, sf))
    return a.select(*EVENT, *r4("metric_value", "expected_value", "z_score"), ts("window_start"), ts("window_end"))


@query("zscore_anomalies_hourly", f"""
with {q.EKPI}, {q.anomalies('ekpi', 3.0, ('total_revenue', 'avg_order_val', 'total_orders'))}
select metric_name, region, category, severity, {q.r4('metric_value', 'expected_value', 'z_score')}, {q.ts('window_end')} from anom""")
def zscore_anomalies_hourly(spark, sf):
    a = anomaly.zscore_anomalies(adapters.event_kpis(spark, sf))
    return a.select(*EVENT, *r4("metric_value", "expected_value", "z_score"), ts("window_end"))


@query("zscore_anomalies_prior_window", f"""
with {q.EKPI}, {q.anomalies('ekpi', 3.0, ('total_revenue', 'avg_order_val', 'total_orders'), 'rows between 24 preceding and 1 preceding')}
select metric_name, region, category, case when abs(z_score) < 3 then 'NONE' else severity end as severity,
       {q.r4('metric_value', 'expected_value')}, round(z_score, 3) as z_score, {q.ts('window_end')} from anom""")
def zscore_anomalies_prior_window(spark, sf):
    """Each hour against the hours before it only, which lets |z| reach every band."""
    a = anomaly.zscore_anomalies(adapters.event_kpis(spark, sf), include_current=False, below="NONE")
    return a.select(*EVENT, *r4("metric_value", "expected_value"), F.round("z_score", 3).alias("z_score"), ts("window_end"))


def _scaled(cols):
    return ", ".join(
        q.n6(f"({c} - avg({c}) over ()) / case when stddev_pop({c}) over () = 0 then 1 else stddev_pop({c}) over () end") + f" as {c}"
        for c in cols
    )


@query("standard_scale", f"""
with {q.CKPI} select {q.ts('snapshot_ts')}, region, category, {_scaled(['total_revenue', 'avg_order_val', 'return_rate', 'conversion_rt'])} from ckpi""")
def standard_scale(spark, sf):
    cols = ["total_revenue", "avg_order_val", "return_rate", "conversion_rt"]
    s = anomaly.standard_scale(adapters.customer_event_kpis(spark, sf), cols)
    return s.select(ts("snapshot_ts"), "region", "category", *r6(*cols))


@query("zscore_global", """
with s as (select avg(l_quantity) as m1, stddev_samp(l_quantity) as s1, avg(l_extendedprice) as m2, stddev_samp(l_extendedprice) as s2,
                  avg(l_tax) as m3, stddev_samp(l_tax) as s3 from lineitem),
z as (select l_returnflag, greatest(abs((l_quantity - m1) / (s1 + 1e-9)), abs((l_extendedprice - m2) / (s2 + 1e-9)), abs((l_tax - m3) / (s3 + 1e-9))) as z
      from lineitem, s)
select l_returnflag, case when z > 3 then 'CRITICAL' when z > 2 then 'HIGH' when z > 1 then 'MEDIUM' else 'LOW' end as severity,
       count(*) as n, round(sum(z), 3) as z_sum from z group by 1, 2""")
def zscore_global(spark, sf):
    z = anomaly.zscore_global(adapters.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
    return z.groupBy("l_returnflag", "severity").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z_score"), 3).alias("z_sum"))


@query("impute_median", f"""
with {q.DIRTY}
select region, category, count(*) as n, {q.n4('avg(coalesce(unit_price, (select median(unit_price) from dirty)))')} as mean_price from dirty group by 1, 2""")
def impute_median(spark, sf):
    filled = anomaly.impute_median(adapters.dirty_orders(spark, sf), ["unit_price"])
    return filled.groupBy("region", "category").agg(F.count(F.lit(1)).alias("n"), F.avg("unit_price").alias("mean_price")).select(
        "region", "category", "n", *r4("mean_price")
    )


OUT_COLS = ("o_totalprice", "lines", "quantity")
OUT_BASE = """h as (select o_orderkey, o_orderpriority, o_totalprice, count(l_orderkey)::double as lines, coalesce(sum(l_quantity), 0) as quantity
  from orders left join lineitem on o_orderkey = l_orderkey group by 1, 2, 3)"""


@query("column_outliers", f"""
with {OUT_BASE},
s as (select {', '.join(f'avg({c}) as m_{c}, stddev_samp({c}) as s_{c}' for c in OUT_COLS)} from h),
e as (select 'o_totalprice' as metric_name, o_totalprice as metric_value, m_o_totalprice as expected_value, (o_totalprice - m_o_totalprice) / s_o_totalprice as z_score, o_orderpriority as region from h, s
      union all select 'lines', lines, m_lines, (lines - m_lines) / s_lines, o_orderpriority from h, s
      union all select 'quantity', quantity, m_quantity, (quantity - m_quantity) / s_quantity, o_orderpriority from h, s)
select metric_name, {q.r4('metric_value', 'expected_value', 'z_score')}, region, 'Sales' as category,
       case when abs(z_score) > 4 then 'CRITICAL' when abs(z_score) > 3 then 'HIGH' else 'MEDIUM' end as severity
from e where abs(e.z_score) > 2.5""")
def column_outliers(spark, sf):
    lines = adapters.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("lines"), F.sum("l_quantity").alias("quantity")
    )
    h = adapters.table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", F.coalesce("lines", F.lit(0.0)).alias("lines"), F.coalesce("quantity", F.lit(0.0)).alias("quantity")
    )
    out = anomaly.column_outliers(h, list(OUT_COLS), ["o_orderpriority"], "sales")
    return out.select("metric_name", *r4("metric_value", "expected_value", "z_score"), "region", "category", "severity")


@query("flagged_only", f"""
with {q.CKPI}, s as (select avg(total_revenue) as m, stddev_samp(total_revenue) as sd, avg(total_orders) as m2, stddev_samp(total_orders) as sd2 from ckpi)
select {q.ts('snapshot_ts')}, region, category, {q.n4('greatest(abs((total_revenue - m) / (sd + 1e-9)), abs((total_orders - m2) / (sd2 + 1e-9)))')} as z_score
from ckpi, s where return_rate > 0.5""")
def flagged_only(spark, sf):
    """Rows scored by one detector and kept where another one (here: an error-share rule) marked them."""
    k = adapters.customer_event_kpis(spark, sf)
    base = anomaly.zscore_global(k, ["total_revenue", "total_orders"])
    kept = anomaly.flagged_only(base, k.where("return_rate > 0.5"), ["snapshot_ts", "region", "category"])
    return kept.select(ts("snapshot_ts"), "region", "category", *r4("z_score"))


@query("live_events", f"""
with {q.EANOM}
select strftime(window_end, '%H:%M:%S') as ts, metric_name as metric, region, severity, {q.n4('metric_value')} as observed,
       {q.n4('expected_value')} as expected, {q.r4('z_score')}, false as analyzed from anom""")
def live_events(spark, sf):
    e = anomaly.live_event(event_anomalies(spark, sf))
    return e.select("ts", "metric", "region", "severity", *r4("observed", "expected", "z_score"), "analyzed")


# -- isolation forest -------------------------------------------------------------------------


def _stored_kpis(spark, sf):
    """The rollup, stored once: fitting reads it several times."""
    checkpoint_dir(spark)
    return adapters.customer_event_kpis(spark, sf).checkpoint()


@query("forest_scores")
def forest_scores(spark, sf):
    """Isolation-forest score of every daily KPI row."""
    k = _stored_kpis(spark, sf)
    s = forest.score(k, forest.fit(k))
    return s.select(ts("snapshot_ts"), "region", "category", *r6("isolation_score"), "is_anomaly")


@query("forest_events")
def forest_events(spark, sf):
    k = _stored_kpis(spark, sf)
    e = anomaly.forest_events(forest.score(k, forest.fit(k)))
    return e.select(*EVENT, *r4("metric_value", "z_score"), *r6("isolation_score"), ts("window_end"))


@query("detect")
def detect(spark, sf):
    """Both detectors together on the daily KPIs."""
    d = anomaly.detect(_stored_kpis(spark, sf), Settings(latest_hours=72))
    return d.select(*EVENT, *r4("metric_value", "expected_value", "z_score"), *r6("isolation_score"), ts("window_end"))


@query("ml_anomalies")
def ml_anomalies(spark, sf):
    """Table-wide forest over order lines after filling gaps with medians."""
    checkpoint_dir(spark)
    o = adapters.dirty_orders(spark, sf).select("order_id", "product_id", "region", "category", "quantity", "unit_price", "discount_pct")
    # Scoring is bound by cores, not bytes: spread the rows before it.
    o = adapters.spread(o).checkpoint()
    m = anomaly.ml_anomalies(o, ["quantity", "unit_price", "discount_pct"], ["order_id", "product_id", "quantity", "unit_price"])
    return m.groupBy("region", "category", "ml_anomaly").agg(F.count(F.lit(1)).alias("n"))
