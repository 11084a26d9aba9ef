"""Streaming forms, run over the tables as streams until their end, and the full cycle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewatch.config import Settings
from tidewatch.plans import cycle
from tidewatch.operators import setops
from tidewatch.session import stored, workspace
from tidewatch.sources import adapters, readers
from tidewatch.streaming import anomalies as stream_anomalies
from tidewatch.streaming import kpis, timed
from tidewatch.streaming.ingest import ingest_stream, with_dead_letters
from tidewatch.streaming.run import drain_batches, drain_to_table
from workload import fragments as q
from workload.registry import query, r4, r6, ts


def event_stream(spark, sf):
    """The events table as a stream."""
    schema = adapters.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf).select(
        "event_id", F.col("user_id").alias("customer_id"), "event_type", F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("props").alias("metadata"), "value",
    )


def event_orders(events):
    """Events in the form of orders."""
    return events.select(
        F.col("event_ts").alias("order_ts"), F.lit("ALL").alias("region"), F.col("event_type").alias("category"),
        F.lit(1.0).alias("quantity"), F.col("value").alias("unit_price"), F.lit(0.0).alias("discount_pct"),
        (F.col("event_type") == "error").alias("is_returned"),
    )


@query("stream_ingest", """
select event_type, count(*) as n, round(sum(value), 4) as value from events group by 1""")
def stream_ingest(spark, sf):
    """Events through JSON envelopes: encoded, read by topic, decoded."""
    events = event_stream(spark, sf)
    rows = ingest_stream(readers.encode_message(events, "events"), "events", events.schema)
    table, _ = drain_to_table(rows, "stream_ingest")
    return table.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("stream_kpis", f"""
with w as (select date_trunc('hour', ts)::timestamp as snapshot_ts, event_type as category, 'ALL' as region, count(*) as total_orders, sum(value) as total_revenue,
  avg(value) as avg_order_val, case when event_type = 'error' then 1.0::double else 0 end as return_rate from events where value > 0 group by 1, 2)
select {q.ts('snapshot_ts')}, region, category, total_orders, {q.r4('total_revenue', 'avg_order_val', 'return_rate')} from w
where snapshot_ts + interval 1 hour <= (select max(ts) from events) - interval 2 hour""")
def stream_kpis(spark, sf):
    """Hourly snapshots of all windows that the watermark has closed."""
    table, _ = drain_to_table(kpis.kpi_stream(event_orders(event_stream(spark, sf))), "stream_kpis")
    return table.select(ts("snapshot_ts"), "region", "category", "total_orders", *r4("total_revenue", "avg_order_val", "return_rate"))


@query("stream_dedup", "select distinct user_id as customer_id, event_type from events")
def stream_dedup(spark, sf):
    """First event per customer and type within a delay longer than the data."""
    events = event_stream(spark, sf).select("customer_id", "event_type", "event_ts")
    table, _ = drain_to_table(kpis.dedup_stream(events, ["customer_id", "event_type"], "event_ts", "60 days"), "stream_dedup")
    return table.select("customer_id", "event_type")


@query("stream_recent", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as event_ts from events order by ts desc, event_id limit 150")
def stream_recent(spark, sf):
    path = workspace(spark, "stream_recent_log")
    events = event_stream(spark, sf)
    drain_batches(events, "stream_recent", stream_anomalies.recent_batches(path, 150, "event_ts", ["event_id"]))
    return stream_anomalies.read_recent(spark, path).select("event_id", ts("event_ts"))


def kpi_rows(spark, sf, name):
    """Event KPIs stored as files, to be read as a stream."""
    path = workspace(spark, name)
    k = adapters.event_kpis(spark, sf).select(
        "snapshot_ts", "region", "category", "period", F.col("total_orders"), "total_revenue", "avg_order_val", F.lit(0.0).alias("return_rate")
    )
    k.write.parquet(path)
    return spark.readStream.schema(k.schema).parquet(path)


ZS = f"""with {q.EKPI}, {q.anomalies('ekpi', 3.0, ('total_revenue', 'avg_order_val', 'total_orders'))}
select {q.ts('window_end')}, category, metric_name, {q.r4('metric_value', 'expected_value')}, {q.r6('z_score')}, severity from anom"""


@query("stream_anomalies_by_batch", ZS)
def stream_anomalies_by_batch(spark, sf):
    """Rolling z in each batch over the stored history."""
    base = workspace(spark, "stream_anomalies")
    run = stream_anomalies.detect_batches(f"{base}/history", f"{base}/events", Settings(lookback_hours=24 * 60), forest=False)
    drain_batches(kpi_rows(spark, sf, "kpi_source"), "stream_anomalies", run)
    e = spark.read.parquet(f"{base}/events")
    return e.select(ts("window_end"), "category", "metric_name", *r4("metric_value", "expected_value"), *r6("z_score"), "severity")


@query("stream_anomalies_stateful", ZS)
def stream_anomalies_stateful(spark, sf):
    """Rolling z with the last rows of each series as state."""
    metrics = ("total_revenue", "avg_order_val", "total_orders")
    scored = stream_anomalies.stateful_anomalies(kpi_rows(spark, sf, "kpi_source"), metrics=metrics)
    table, _ = drain_to_table(scored, "stream_stateful")
    return table.select(
        ts("snapshot_ts", "window_end"), "category", "metric_name", *r4("metric_value", "expected_value"), *r6("z_score"), "severity"
    )


TIMED = f"""with {q.EKPI}, {q.anomalies('ekpi', 3.0, ('total_revenue', 'avg_order_val', 'total_orders'))}
select {q.ts('window_end')}, category, metric_name, {q.r4('metric_value', 'expected_value')}, {q.r6('z_score')}, severity from anom
where window_end <= (select max(snapshot_ts) from ekpi) - interval 2 hour"""


@query("stream_anomalies_timed", TIMED)
def stream_anomalies_timed(spark, sf):
    """Rolling z of all snapshots that the watermark has passed, released by timers."""
    metrics = ("total_revenue", "avg_order_val", "total_orders")
    table, _ = drain_to_table(timed.timed_anomalies(kpi_rows(spark, sf, "kpi_source"), "2 hours", metrics=metrics), "stream_timed")
    return table.select(
        ts("snapshot_ts", "window_end"), "category", "metric_name", *r4("metric_value", "expected_value"), *r6("z_score"), "severity"
    )


@query("stream_dedup_best", f"""
with b as (select date_trunc('day', ts)::timestamp as day, event_type, user_id as customer_id, arg_max({{'i': event_id, 't': ts, 'v': value}}, {{'v': value, 't': -epoch_us(ts), 'i': -event_id}}) as e from events group by 1, 2, 3)
select {q.ts('day', 'window_start')}, event_type, customer_id, {q.ts('e.t', 'event_ts')}, e.v as value from b where day + interval 1 day <= (select max(ts) from events) - interval 1 hour""")
def stream_dedup_best(spark, sf):
    """Largest event per customer, type and day, once the day is closed."""
    events = event_stream(spark, sf).select("event_id", "customer_id", "event_type", "event_ts", "value")
    table, _ = drain_to_table(kpis.best_stream(events, ["event_type", "customer_id"], "event_ts", ["value"]), "stream_best")
    return table.select(ts("window_start"), "event_type", "customer_id", ts("event_ts"), "value")


@query("stream_dead_letters", """
with m as (select *, case when event_type = 'error' then case when value > 50 then 'truncated' else 'text for a number' end when event_type = 'signup' and value > 90 then 'no topic' else 'fine' end as kind from events)
select kind in ('fine') as accepted, case when kind = 'no topic' then 'no topic' when kind = 'fine' then 'accepted' else 'malformed payload' end as reason, count(*) as n, round(sum(value), 4) as value from m group by 1, 2""")
def stream_dead_letters(spark, sf):
    """Events as messages, of which errors come truncated or with text for a number and large signups without a topic: rows and rejected envelopes."""
    events, base = event_stream(spark, sf), workspace(spark, "dead-letters")
    sent = readers.encode_message(events, "events")
    bad, value = F.get_json_object("data", "$.event_type"), F.get_json_object("data", "$.value").cast("double")
    broken = F.when((bad == "error") & (value > 50), F.expr("substr(data, 1, length(data) - 1)")).when(bad == "error", F.replace("data", F.lit('"event_id":'), F.lit('"event_id":"x","was":'))).otherwise(F.col("data"))
    lost = F.when((bad == "signup") & (value > 90), F.lit(None)).otherwise(F.col("topic"))
    sent = sent.select(lost.alias("topic"), broken.alias("data"))
    sink = lambda df, i: df.write.mode("overwrite").parquet(f"{base}/rows/batch={i}")
    drain_batches(sent, "stream_dead_letters", with_dead_letters(events.schema, "events", sink, f"{base}/dead"))
    good = spark.read.parquet(f"{base}/rows").select(F.lit(True).alias("accepted"), F.lit("accepted").alias("reason"), "value")
    dead = spark.read.parquet(f"{base}/dead")
    dead = dead.select(F.lit(False).alias("accepted"), "reason", F.regexp_extract("data", '"value":([0-9.eE+-]+)', 1).cast("double").alias("value"))
    return good.unionByName(dead).groupBy("accepted", "reason").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("run_cycle")
def run_cycle(spark, sf):
    """One full cycle over all orders and events in monthly buckets."""
    report = cycle.run_cycle(
        spark, workspace(spark, "store"), adapters.raw_orders(spark, sf), adapters.raw_events(spark, sf), datetime(2001, 9, 1),
        Settings(latest_hours=24 * 62), period="month", event_types=("purchase", "view"), lookback_hours=24 * 366 * 8, partition="month",
    )
    return report.select(
        F.col("ingestion.rows").alias("rows"), F.col("ingestion.status").alias("status"), "anomalies_found",
        "decisions", F.col("healing.drifts").alias("drifts"), F.col("healing.healed").alias("healed"),
    )


STORE = f"""with {q.DIRTY}, kpi as (select date_trunc('month', order_ts)::timestamp as snapshot_ts, region, category, {q.MEASURES}, 'monthly' as period from dirty where {q.VALID} group by 1, 2, 3),
{q.anomalies('kpi', 3.0)}, best as (select region, category, metric_name, arg_max(severity, abs(z_score)) as severity from anom group by 1, 2, 3)
select 'raw_orders' as stored, 'rows' as item, count(*) as n from dirty
union all select 'raw_orders', 'nulls left', 0
union all select 'raw_orders', 'customer_id 0', count_if(coalesce(customer_id, 0) = 0) from dirty
union all select 'raw_orders', 'unit_price filled', count(*) - count(unit_price) from dirty
union all select 'raw_orders', 'order_ts filled', count(*) - count(order_ts) from dirty
union all select 'raw_events', 'rows', count(*) from events
union all select 'kpi_snapshots', 'rows', count(*) from kpi
union all select 'kpi_snapshots', 'orders', sum(total_orders)::bigint from kpi
union all select 'anomaly_events', 'rows', count(*) from best
union all select 'agent_decisions', case severity when 'CRITICAL' then 'P1' when 'HIGH' then 'P2' when 'MEDIUM' then 'P3' else 'P4' end, count(*) from best group by 2
union all select 'schema_drift_log', 'raw_orders.' || c || ' repaired', 1 from (values ('customer_id NULL_VIOLATION'), ('unit_price NULL_VIOLATION'), ('order_ts NULL_VIOLATION'), ('created_at DROPPED_COLUMN')) t(c)
union all select 'schema_drift_log', 'raw_orders.quantity TYPE_CHANGE open', 1
union all select 'schema_drift_log', 'raw_events.' || c || ' repaired', 1 from (values ('session_id DROPPED_COLUMN'), ('product_id DROPPED_COLUMN'), ('value NEW_COLUMN')) t(c)
union all select 'second cycle', 'repaired again', 0"""


@query("cycle_store", STORE)
def cycle_store(spark, sf):
    """What a cycle over orders with gaps leaves in its tables, and what a second cycle with a batch of the same form repairs again."""
    store, settings, now = workspace(spark, "store"), Settings(forest_trees=0), datetime(2001, 9, 1)
    orders, events = adapters.dirty_orders(spark, sf), adapters.raw_events(spark, sf)
    run = lambda o, e, t: cycle.run_cycle(spark, store, o, e, t, settings, period="month", event_types=("purchase", "view"), lookback_hours=24 * 366 * 8, partition="month")
    run(orders, events, now)
    read = lambda name: readers.read_table(spark, store, name)
    n, rows = F.count(F.lit(1)), lambda df, table, item: df.select(F.lit(table).alias("stored"), item.alias("item"), F.col("n").cast("bigint").alias("n"))
    o, k, log = read("raw_orders"), read("kpi_snapshots"), read("schema_drift_log")
    counts = o.agg(
        n.alias("rows"), F.count_if(F.expr("customer_id is null or unit_price is null or order_ts is null")).alias("nulls left"),
        F.count_if(F.col("customer_id") == 0).alias("customer_id 0"), F.count_if(F.col("unit_price") == 0).alias("unit_price filled"),
        F.count_if(F.col("order_ts") == F.lit(datetime(1970, 1, 1))).alias("order_ts filled"),
    )
    parts = [rows(counts.unpivot([], counts.columns, "item", "n"), "raw_orders", F.col("item"))]
    parts.append(rows(read("raw_events").agg(n.alias("n")), "raw_events", F.lit("rows")))
    both = k.agg(n.alias("rows"), F.sum("total_orders").alias("orders"))
    parts.append(rows(both.unpivot([], both.columns, "item", "n"), "kpi_snapshots", F.col("item")))
    parts.append(rows(read("anomaly_events").agg(n.alias("n")), "anomaly_events", F.lit("rows")))
    parts.append(rows(read("agent_decisions").groupBy("priority").agg(n.alias("n")), "agent_decisions", F.col("priority")))
    state = F.when(F.col("auto_healed") & F.col("validated"), F.lit(" repaired")).otherwise(F.lit(" open"))
    named = log.withColumn("item", F.concat("table_name", F.lit("."), "column_name", F.lit(" "), "drift_type", state)).groupBy("item").agg(n.alias("n"))
    kept = [stored(p, "cycle-store") for p in (*parts, rows(named, "schema_drift_log", F.col("item")))]
    later = datetime(2001, 9, 2)
    run(orders.where("order_ts >= '2001-07-15' and customer_id is not null and unit_price is not null"), events.where("event_ts >= '2024-01-30'"), later)
    again = read("schema_drift_log").where((F.col("detected_at") == F.lit(later)) & F.col("auto_healed")).agg(n.alias("n"))
    kept.append(rows(again, "second cycle", F.lit("repaired again")))
    return setops.concat_tables(*kept)
