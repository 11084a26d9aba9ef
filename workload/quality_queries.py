"""Drift, healing, expectations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.operators import analytics, healing, quality, setops
from tidewatch.sources import adapters, readers
from tidewatch.streaming.ingest import drift_guard
from workload import fragments as q
from workload.kpi_queries import NOW, NOW_SQL, anomalies
from workload.registry import query, r4

AT = datetime(2001, 6, 1)
AT_SQL = "timestamp '2001-06-01 00:00:00'"

LOG = f"""{q.RAW}, log as (
  select order_ts as detected_at, 'NULL_VIOLATION' as drift_type, is_returned as auto_healed from raw where payment_method like '4-%'
  union all select order_ts, 'TYPE_CHANGE', false from raw where quantity = 50)"""


@query("drift_health", f"""
with {LOG}, r as (select * from log where detected_at >= {NOW_SQL} - interval 8760 hour)
select drift_type, count(*) as total, sum(auto_healed::int)::bigint as healed, 0 as is_total from r group by 1
union all select null, count(*), sum(auto_healed::int)::bigint, 1 from r""")
def drift_health(spark, sf):
    return analytics.drift_health(adapters.drift_log(spark, sf), NOW, 8760)


@query("heal_counts", f"""
with {LOG} select count(*) as total, count_if(auto_healed) as healed, count_if(not auto_healed) as pending from log""")
def heal_counts(spark, sf):
    return analytics.heal_counts(adapters.drift_log(spark, sf))


NULLS = f"""{q.DIRTY}, nulls as (
{' union all '.join(f"select 'raw_orders' as table_name, '{c}' as column_name, count_if({c} is null) as n from dirty" for c in ('customer_id', 'order_ts', 'unit_price'))}),
violations as (select table_name, column_name, 'NULL_VIOLATION' as drift_type, 'NOT NULL' as old_definition, n || ' NULL rows found' as new_definition from nulls where n > 0)"""


@query("null_violations", f"with {NULLS} select * from violations")
def null_violations(spark, sf):
    return healing.null_violations({"raw_orders": adapters.dirty_orders(spark, sf)})


# Live columns of the dirty orders differ from the expected ones in two places.
SCAN = f"""{NULLS}, scan as (select * from violations
  union all select 'raw_orders', 'created_at', 'DROPPED_COLUMN', 'TIMESTAMP', null
  union all select 'raw_orders', 'quantity', 'TYPE_CHANGE', 'INTEGER', 'DOUBLE PRECISION')"""


@query("drift_scan", f"with {SCAN} select * from scan")
def drift_scan(spark, sf):
    return healing.scan(spark, {"raw_orders": adapters.dirty_orders(spark, sf)})


@query("heal_plan", f"""
with {SCAN}
select table_name, column_name, drift_type, case drift_type when 'NEW_COLUMN' then 'TAG_COLUMN' when 'DROPPED_COLUMN' then 'ADD_COLUMN' when 'NULL_VIOLATION' then 'FILL_NULLS' else 'MANUAL_REVIEW' end as action,
  drift_type <> 'TYPE_CHANGE' as auto_heal,
  case when drift_type = 'DROPPED_COLUMN' then 'ALTER TABLE raw_orders ADD COLUMN created_at TIMESTAMP'
       when column_name = 'order_ts' then 'UPDATE raw_orders SET order_ts = TIMESTAMP ''1970-01-01 00:00:00'' WHERE order_ts IS NULL'
       when drift_type = 'NULL_VIOLATION' then 'UPDATE raw_orders SET ' || column_name || ' = 0 WHERE ' || column_name || ' IS NULL' end as heal_query
from scan""")
def heal_plan(spark, sf):
    expected = setops.expected_rows(spark, fv.EXPECTED_SCHEMAS)
    plan = healing.heal_plan(healing.scan(spark, {"raw_orders": adapters.dirty_orders(spark, sf)}), expected)
    return plan.select("table_name", "column_name", "drift_type", "action", "auto_heal", "heal_query")


@query("heal_fill_nulls", f"""
with {q.DIRTY} select region, count(*) as n, count(coalesce(customer_id, 0)) as customers, sum(coalesce(customer_id, 0))::bigint as customer_sum,
  {q.n4('sum(coalesce(unit_price, 0))')} as price_sum, count_if(order_ts is null) as at_epoch, count_if(coalesce(payment_method, 'UNKNOWN') = 'UNKNOWN') as unknown_payment from dirty group by 1""")
def heal_fill_nulls(spark, sf):
    rules = {"customer_id": "BIGINT", "unit_price": "NUMERIC", "order_ts": "TIMESTAMP", "payment_method": "VARCHAR"}
    healed = healing.heal_fill_nulls(adapters.dirty_orders(spark, sf), rules)
    return healed.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.count("customer_id").alias("customers"), F.sum("customer_id").alias("customer_sum"),
        F.sum("unit_price").alias("price_sum"), F.count_if(F.unix_timestamp("order_ts") == 0).alias("at_epoch"),
        F.count_if(F.col("payment_method") == "UNKNOWN").alias("unknown_payment"),
    ).select("region", "n", "customers", "customer_sum", *r4("price_sum"), "at_epoch", "unknown_payment")


@query("heal_dirty_orders", f"""
with {SCAN} select column_name, drift_type, drift_type <> 'TYPE_CHANGE' as auto_healed, drift_type <> 'TYPE_CHANGE' as validated from scan""")
def heal_dirty_orders(spark, sf):
    """Repair of the dirty orders, validated by a second scan of the repaired rows."""
    _, log = healing.heal(spark, adapters.dirty_orders(spark, sf), "raw_orders", AT)
    return log.select("column_name", "drift_type", "auto_healed", "validated")


@query("payload_drift", f"""
with {q.DIRTY}, seen as (
{' union all '.join(f"select '{c}' as column_name from dirty having count({c}) > 0" for c in ('order_id', 'customer_id', 'product_id', 'category', 'region', 'order_ts', 'quantity', 'unit_price', 'discount_pct', 'payment_method', 'is_returned'))}),
known as (select unnest({[*fv.EXPECTED_SCHEMAS['raw_orders'], 'coupon']}) as column_name)
select column_name, case when k.column_name is null then 'NEW_COLUMN' else 'DROPPED_COLUMN' end as drift_type
from seen s full join known k using (column_name) where s.column_name is null or k.column_name is null""")
def payload_drift(spark, sf):
    """Columns in the JSON payloads of the orders against a known schema with one more column."""
    known = {"raw_orders": {**fv.EXPECTED_SCHEMAS["raw_orders"], "coupon": "VARCHAR"}}
    messages = readers.encode_message(adapters.dirty_orders(spark, sf), "orders")
    drift = drift_guard(messages, setops.expected_rows(spark, known), "raw_orders")
    return drift.select("column_name", "drift_type")


# -- expectations ----------------------------------------------------------------------------

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
KINDS = ["ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD"]
PAYS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _set_name(values) -> str:
    return "all in {" + ", ".join(sorted(values)) + "}"


def _check(no: int, name: str, bad: str, noun: str, clean: str) -> str:
    return f"select {no} as check_no, '{name}' as name, count_if({bad}) as n, '{noun}' as noun, '{clean}' as clean from t"


def _suite(table: str, source: str, counts: list[str], extra: list[str]) -> str:
    return f"""t as (select * from {source}), c as ({' union all '.join(counts)}),
checks as (select '{table}' as "table", check_no, name, n = 0 as passed, case when n = 0 then clean else n || ' ' || noun end as detail, n as failing_rows from c
{' '.join('union all ' + e for e in extra)})"""


ORDERS_SUITE = _suite("raw_orders", "dirty", [
    _check(1, "no_nulls:customer_id", "customer_id is null", "null rows", "clean"),
    _check(2, "no_nulls:order_ts", "order_ts is null", "null rows", "clean"),
    _check(3, "no_nulls:unit_price", "unit_price is null", "null rows", "clean"),
    _check(4, "between:[0.01,1000000]:unit_price", "not coalesce(unit_price between 0.01 and 1000000, false)", "out-of-range values", "all in [0.01, 1000000]"),
    _check(5, "between:[1,10000]:quantity", "not coalesce(quantity between 1 and 10000, false)", "out-of-range values", "all in [1, 10000]"),
    _check(6, "between:[0,100]:discount_pct", "not coalesce(discount_pct between 0 and 100, false)", "out-of-range values", "all in [0, 100]"),
    _check(7, "values_in_set:category", f"not coalesce(category in ({_list(KINDS)}), false)", "invalid values", _set_name(KINDS)),
    _check(8, "values_in_set:region", f"not coalesce(region in ({_list(REGIONS)}), false)", "invalid values", _set_name(REGIONS)),
    _check(9, "values_in_set:payment_method", f"not coalesce(payment_method in ({_list(PAYS)}), false)", "invalid values", _set_name(PAYS)),
    _check(11, "no_future_ts:order_ts", f"order_ts > {AT_SQL} + interval 5 minute", "future timestamps", "clean"),
], [
    "select 'raw_orders', 0, 'row_count', count(*) between 1 and 10000000, count(*) || ' rows (expected 1–10000000)', 0 from t",
    "select 'raw_orders', 10, 'mean_between:[5,1000]:unit_price', avg(unit_price) between 5 and 1000, 'mean=' || printf('%.4f', round(avg(unit_price), 4)), 0 from t",
])


@query("orders_quality", f"""with {q.DIRTY}, {ORDERS_SUITE} select * from checks""")
def orders_quality(spark, sf):
    suite = quality.raw_orders_suite(AT, KINDS, REGIONS, PAYS, most_rows=fv.MOST_ORDERS)
    return quality.validate(adapters.dirty_orders(spark, sf), "raw_orders", suite)


@query("orders_quality_report", f"""
with {q.DIRTY}, {ORDERS_SUITE}
select "table", count(*) as checks, count_if(passed) as passed_checks, {q.n4('count_if(passed) / count(*)::double')} as pass_rate,
  'Data Quality Report: raw_orders' || chr(10) || '  Pass rate: ' || printf('%.0f%%', round(count_if(passed) / count(*)::double * 100, 0)) || '  (' || count_if(passed) || '/' || count(*) || ')' || chr(10) ||
  string_agg('  ' || case when passed then '✅' else '❌' end || ' ' || name || ': ' || detail, chr(10) order by check_no) as summary
from checks group by 1""")
def orders_quality_report(spark, sf):
    suite = quality.raw_orders_suite(AT, KINDS, REGIONS, PAYS, most_rows=fv.MOST_ORDERS)
    r = quality.report(quality.validate(adapters.dirty_orders(spark, sf), "raw_orders", suite))
    return r.select("table", "checks", "passed_checks", *r4("pass_rate"), "summary")


KPI_SUITE = _suite("kpi_snapshots", "kpi", [
    _check(1, "no_nulls:snapshot_ts", "snapshot_ts is null", "null rows", "clean"),
    _check(2, "no_nulls:total_revenue", "total_revenue is null", "null rows", "clean"),
    _check(3, "between:[0,1]:return_rate", "not coalesce(return_rate between 0 and 1, false)", "out-of-range values", "all in [0, 1]"),
    _check(4, "between:[0,1000000000]:total_revenue", "not coalesce(total_revenue between 0 and 1e9, false)", "out-of-range values", "all in [0, 1000000000]"),
    _check(5, "values_in_set:period", "not coalesce(period in ('hourly', 'daily'), false)", "invalid values", "all in {daily, hourly}"),
    _check(6, "no_future_ts:snapshot_ts", f"snapshot_ts > {AT_SQL} + interval 5 minute", "future timestamps", "clean"),
], ["select 'kpi_snapshots', 0, 'row_count', count(*) between 1 and 5000000, count(*) || ' rows (expected 1–5000000)', 0 from t"])


@query("kpi_quality", f"with {q.KPI}, {KPI_SUITE} select * from checks")
def kpi_quality(spark, sf):
    return quality.validate(adapters.order_kpis(spark, sf), "kpi_snapshots", quality.kpi_snapshots_suite(AT, most_rows=fv.MOST_SNAPSHOTS))


ANOMALY_SUITE = _suite("anomaly_events", "anom", [
    _check(0, "no_nulls:metric_name", "metric_name is null", "null rows", "clean"),
    _check(1, "no_nulls:severity", "severity is null", "null rows", "clean"),
    _check(2, "values_in_set:severity", "not coalesce(severity in ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL'), false)", "invalid values", "all in {CRITICAL, HIGH, LOW, MEDIUM}"),
    _check(3, "between:[-100,100]:z_score", "not coalesce(z_score between -100 and 100, false)", "out-of-range values", "all in [-100, 100]"),
], [])


@query("anomaly_quality", f"with {q.ANOM}, {ANOMALY_SUITE} select * from checks")
def anomaly_quality(spark, sf):
    return quality.validate(anomalies(spark, sf), "anomaly_events", quality.anomaly_events_suite())


@query("uniqueness_checks", """
select 'order_id' as name, count(*) - count(distinct l_orderkey) as failing_rows from lineitem
union all select 'o_orderkey', count(*) - count(distinct o_orderkey) from orders
union all select 'payment', count(*) - count(distinct p) - max((p is null)::int) from (select case when o_orderpriority not like '4-%' then o_orderpriority end as p from orders)""")
def uniqueness_checks(spark, sf):
    """Repeats of line keys, order keys, and a column with gaps."""
    lines = adapters.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    orders = adapters.table(spark, sf, "orders")
    pay = orders.select(F.when(~F.col("o_orderpriority").startswith("4-"), F.col("o_orderpriority")).alias("payment"))
    parts = [
        quality.validate(df, "t", [quality.expect_unique(c)])
        for df, c in ((lines, "order_id"), (orders.select("o_orderkey"), "o_orderkey"), (pay, "payment"))
    ]
    return setops.concat_tables(*parts).select(F.regexp_replace("name", "unique:", "").alias("name"), "failing_rows")
