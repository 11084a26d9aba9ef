"""Untidy text tables: typing, filling, deriving, insight, KPI form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import anomaly, profile
from tidewatch.session import stored, workspace
from tidewatch.sources import adapters, readers
from workload import fragments as q
from workload.registry import query, r4, ts

NOISE = r"[₹$€£,%\s]"
NUMS = ["unit_price", "qty", "cost", "sales_amount"]
CSV = """csv as (
  select case when l_quantity = 50 then 'n/a' else '$' || printf('%,.2f', l_extendedprice) end as unit_price,
         case when l_linenumber <> 7 then l_quantity::int::varchar end as qty, '€ ' || printf('%.2f', l_extendedprice * 0.8) as cost,
         printf('%.2f', l_extendedprice + 10) as sales_amount, strftime(o_orderdate, '%Y-%m-%d') as order_date,
         case when o_orderpriority not like '4-%' then o_orderpriority end as region, case when l_tax < 0.06 then 'std' else 'high' end as tax_band
  from lineitem join orders on l_orderkey = o_orderkey)"""
TYPED = f"""{CSV}, typed as (
  select {', '.join(f"try_cast(regexp_replace({c}, '{NOISE}', '', 'g') as double) as {c}" for c in NUMS)}, order_date::timestamp as order_date, region, tax_band from csv)"""
FILLED = f"""{TYPED}, filled as (
  select {', '.join(f"coalesce({c}, (select median({c}) from typed)) as {c}" for c in NUMS)}, order_date, coalesce(region, 'Unknown') as region, tax_band from typed)"""


def typed(spark, sf):
    return profile.typed(profile.normalize_columns(adapters.order_csv(spark, sf)))


@query("csv_parse_rates", f"""
with {CSV}
{' union all '.join(f"select '{c}' as column_name, {q.n4(f'''count(try_cast(regexp_replace({c}, '{NOISE}', '', 'g') as double)) / count(*)::double''')} as numeric_rate, coalesce(bool_or(regexp_matches({c}, '[0-9]')), false) as has_digit from csv" for c in (*NUMS, 'order_date', 'region', 'tax_band'))}""")
def csv_parse_rates(spark, sf):
    r = profile.parse_rates(profile.normalize_columns(adapters.order_csv(spark, sf)))
    return r.select("column_name", *r4("numeric_rate"), "has_digit")


@query("csv_typed", f"with {TYPED} select {q.r4(*NUMS)}, {q.ts('order_date')}, region, tax_band from typed")
def csv_typed(spark, sf):
    df, _ = typed(spark, sf)
    return df.select(*r4(*NUMS), ts("order_date"), "region", "tax_band")


@query("csv_imputed", f"with {FILLED} select {q.r4(*NUMS)}, {q.ts('order_date')}, region, tax_band from filled")
def csv_imputed(spark, sf):
    df, kinds = typed(spark, sf)
    df = stored(df, "typed")
    return profile.impute(df, kinds).select(*r4(*NUMS), ts("order_date"), "region", "tax_band")


@query("csv_derived", f"""
with {FILLED} select {q.r4(*NUMS)}, {q.n4('unit_price * qty')} as auto_revenue, {q.n4('(sales_amount - cost) / nullif(sales_amount, 0)')} as auto_profit_margin from filled""")
def csv_derived(spark, sf):
    df, kinds = typed(spark, sf)
    df = stored(df, "typed")
    out = profile.derive_metrics(profile.impute(df, kinds))
    return out.select(*r4(*NUMS, "auto_revenue", "auto_profit_margin"))


@query("csv_profile", f"""
with {CSV} select count(*) as row_count, 9 as col_count, 'order_date' as date_cols, 'unit_price,qty,cost,sales_amount' as numeric_cols, 'region,tax_band' as cat_cols, 'sales' as dataset_type from csv""")
def csv_profile(spark, sf):
    df, p = profile.process(adapters.order_csv(spark, sf))
    return profile.profile(df, p.kinds, p.dataset_type)


@query("csv_insight", f"""
with {FILLED}, s as (select avg(unit_price) as m, stddev_samp(unit_price) as sd, count(*) as n from filled),
h as (select count_if(abs((unit_price - m) / (sd + 1e-9)) > 2.5) as hits from filled, s),
c as (select tax_band as v, count(*) as n, count(*) / sum(count(*)) over () as share from filled group by 1 order by 2 desc limit 1),
r as (select region as v, count(*) as n, count(*) / sum(count(*)) over () as share from filled group by 1 order by 2 desc limit 1)
select 0 as position, '**' || hits || ' spike(s)** in `unit_price` (z>2.5σ) — investigate anomalies.' as text from h where hits > 0
union all select 1, '`region` dominated by **' || v || '** (' || printf('%.0f%%', round(share * 100, 0)) || ') — skewed distribution.' from r where share > 0.55
union all select 2, '`tax_band` dominated by **' || v || '** (' || printf('%.0f%%', round(share * 100, 0)) || ') — skewed distribution.' from c where share > 0.55
union all select 3, 'Dataset is **sales/revenue** data. KPI and anomaly views pre-loaded.'""")
def csv_insight(spark, sf):
    df, p = profile.process(adapters.order_csv(spark, sf))
    return profile.insight(df, p.of_kind("numeric"), p.of_kind("categorical"), p.dataset_type)


@query("csv_to_kpi", f"""
with {FILLED} select {q.ts('order_date', 'snapshot_ts')}, region, 'Sales' as category, {q.n4('sales_amount')} as total_revenue, {q.n4('qty')} as total_orders, null::double as return_rate from filled""")
def csv_to_kpi(spark, sf):
    df, p = profile.process(adapters.order_csv(spark, sf))
    k = profile.to_kpi(df, p)
    return k.select(ts("snapshot_ts"), "region", "category", *r4("total_revenue", "total_orders"), "return_rate")


@query("csv_file_anomalies", f"""
with good as (select * from orders where o_orderstatus <> 'P'), s as (select avg(o_totalprice) as m, stddev_samp(o_totalprice) as sd, count(*) as n from good)
select 'outlier' as kind, {q.n4('o_totalprice')} as metric_value, {q.n4('(o_totalprice - m) / sd')} as z_score, count(*) as n from good, s where abs((o_totalprice - m) / sd) > 2.5 group by o_totalprice, m, sd
union all select 'rescued', null, null, count(*) from orders where o_orderstatus = 'P'""")
def csv_file_anomalies(spark, sf):
    """Orders written as an untidy CSV file, pending ones with a cell too many: read back, typed, outliers flagged, broken lines kept apart."""
    o = adapters.table(spark, sf, "orders")
    extra = F.when(F.col("o_orderstatus") == "P", ", late").otherwise("")
    untidy = o.select(F.col("o_orderkey").alias(" Order Key"), F.concat(F.lit("$"), F.col("o_totalprice").cast("decimal(18,2)")).alias("Total Price "), F.concat("o_orderpriority", extra).alias("Priority"))
    path = workspace(spark, "untidy-csv")
    untidy.write.option("header", True).option("quote", "").csv(path)
    rows = stored(readers.read_csv_rescued(spark, path), "csv-rescued")
    good = rows.where(F.col(readers.CORRUPT).isNull()).drop(readers.CORRUPT)
    df, _ = profile.process(good)
    cells = anomaly.column_outliers(df, ["total_price"], ["priority"], "sales").groupBy("metric_value", "z_score").agg(F.count(F.lit(1)).alias("n"))
    found = cells.select(F.lit("outlier").alias("kind"), *r4("metric_value", "z_score"), "n")
    broken = rows.where(F.col(readers.CORRUPT).isNotNull()).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("double")
    return found.unionByName(broken.select(F.lit("rescued").alias("kind"), none.alias("metric_value"), none.alias("z_score"), "n"))
