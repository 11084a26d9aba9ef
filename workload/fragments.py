"""SQL pieces shared by the checking queries (DuckDB dialect)."""

from __future__ import annotations

REV = "quantity * unit_price * (1 - discount_pct / 100)"

RAW = """raw as (
  select l_orderkey as order_id, o_custkey as customer_id, l_partkey as product_id, p_type as category,
         r_name as region, o_orderdate as order_ts, l_quantity as quantity,
         l_extendedprice / nullif(l_quantity, 0) as unit_price, l_discount * 100 + 0.0 as discount_pct,
         o_orderpriority as payment_method, l_returnflag = 'R' as is_returned
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
       join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
       join part on l_partkey = p_partkey)"""

DIRTY = (
    RAW
    + """, dirty as (
  select order_id, case when payment_method not like '4-%' then customer_id end as customer_id, product_id,
         category, region, case when not (discount_pct >= 9.5 and is_returned) then order_ts end as order_ts,
         quantity, case when quantity < 50 then unit_price end as unit_price, discount_pct,
         case when payment_method not like '4-%' then payment_method end as payment_method, is_returned
  from raw)"""
)

MEASURES = f"""count(*) as total_orders, coalesce(sum({REV}), 0) as total_revenue,
  coalesce(avg({REV}), 0) as avg_order_val, coalesce(avg(case when is_returned then 1.0::double else 0 end), 0) as return_rate"""

VALID = "order_ts is not null and unit_price > 0 and quantity > 0"

KPI = (
    RAW
    + f""", kpi as (
  select date_trunc('month', order_ts)::timestamp as snapshot_ts, region, category, {MEASURES}, 'monthly' as period
  from raw where {VALID} group by 1, 2, 3)"""
)

EV = "ev as (select event_id, user_id as customer_id, event_type, ts as event_ts, props as metadata, value from events)"

# Events per hour and type as KPIs.
EKPI = (
    EV
    + """, ekpi as (
  select date_trunc('hour', event_ts)::timestamp as snapshot_ts, event_type as category, 'ALL' as region,
         count(*) as total_orders, sum(value) as total_revenue, avg(value) as avg_order_val, 'hourly' as period
  from ev group by 1, 2)"""
)

# Events per day, customer region and market segment as KPIs.
CKPI = """ckpi as (
  select date_trunc('day', ts)::timestamp as snapshot_ts, r_name as region, c_mktsegment as category,
         count(*) as total_orders, sum(value) as total_revenue, avg(value) as avg_order_val,
         avg(case when event_type = 'error' then 1.0::double else 0 end) as return_rate,
         coalesce(count_if(event_type = 'purchase')::double / nullif(count_if(event_type = 'view'), 0), 0) as conversion_rt,
         'daily' as period
  from events join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey
  group by 1, 2, 3)"""

Z_METRICS = ("total_revenue", "avg_order_val", "return_rate", "total_orders")


def severity(z: str) -> str:
    return (
        f"case when abs({z}) >= 3 and abs({z}) < 4 then 'LOW' when abs({z}) >= 4 and abs({z}) < 6 then 'MEDIUM' "
        f"when abs({z}) >= 6 and abs({z}) < 9 then 'HIGH' else 'CRITICAL' end"
    )


def rolling(kpi: str, metrics=Z_METRICS, frame: str = "rows between 23 preceding and current row") -> str:
    """CTE ``zs``: per metric the windowed mean and z under the count rules."""
    cols = []
    for m in metrics:
        ok = f"n_rows >= 4 and {m}_n >= 3"
        cols.append(
            f"case when {ok} then {m}_mu end as {m}_mean, "
            f"case when {ok} then (v_{m} - {m}_mu) / nullif({m}_sd, 0) end as {m}_z"
        )
    stats = ", ".join(
        f"{m}::double as v_{m}, count({m}) over w as {m}_n, avg({m}::double) over w as {m}_mu, "
        f"stddev_samp({m}::double) over w as {m}_sd"
        for m in metrics
    )
    return f"""ws as (
  select *, count(*) over (partition by region, category) as n_rows, {stats}
  from {kpi} window w as (partition by region, category order by snapshot_ts {frame})),
zs as (select *, {', '.join(cols)} from ws)"""


def anomalies(kpi: str, threshold: float, metrics=Z_METRICS, frame: str = "rows between 23 preceding and current row") -> str:
    """CTEs up to ``anom``: long events over the threshold."""
    parts = " union all ".join(
        f"select '{m}' as metric_name, v_{m} as metric_value, coalesce({m}_mean, 0) as expected_value, {m}_z as z_score, "
        f"region, category, snapshot_ts from zs where abs({m}_z) >= {threshold}"
        for m in metrics
    )
    return (
        rolling(kpi, metrics, frame)
        + f""", anom0 as ({parts}),
anom as (select *, {severity('z_score')} as severity, snapshot_ts as window_end,
                snapshot_ts - interval 24 hour as window_start from anom0)"""
    )


# Anomalies of the order KPIs at |z| >= 2: a fuller set than the default 3 for downstream queries.
ANOM = KPI + ", " + anomalies("kpi", 2.0)
EANOM = EKPI + ", " + anomalies("ekpi", 2.0, ("total_revenue", "avg_order_val", "total_orders"))

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def ts(c: str, alias: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {alias or c}"


# The same small offsets against rounding ties as on the Spark side; + 0.0 turns -0 into 0.


def n4(expr: str) -> str:
    return f"round(({expr})::double + 0.00001371::double, 4) + 0.0::double"


def n6(expr: str) -> str:
    return f"round(({expr})::double + 0.0000001371::double, 6) + 0.0::double"


def r4(*names: str) -> str:
    return ", ".join(f"{n4(n)} as {n}" for n in names)


def r6(*names: str) -> str:
    return ", ".join(f"{n6(n)} as {n}" for n in names)


def exact2(expr: str) -> str:
    """Two digits as text: rounded as a decimal to six digits, where the order of a sum no longer shows, then half up."""
    return f"printf('%.2f', round(round(cast(cast(({expr})::double as varchar) as decimal(38,12)), 6), 2)::double)"
