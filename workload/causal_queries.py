"""Effects, errors, adjustment, choice of causes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.operators import analytics, causal, kpi
from tidewatch.plans import cycle
from tidewatch.sources import adapters
from workload import fragments as q
from workload.kpi_queries import CORR, FEATURES, anomalies
from workload.registry import query, r4, r6, ts

BY = ["region", "category"]
PAIRS = fv.CAUSAL_PAIRS[:4]
FEAT = f"{q.RAW}, {FEATURES}"
LONG = "long as (" + " union all ".join(
    f"select region, category, hour_bucket, {i} as pair_no, '{x}' as cause_variable, '{y}' as effect_variable, '{why}' as hypothesis, "
    f"{x}::double as x, {y}::double as y from features"
    for i, (x, y, why) in enumerate(PAIRS, 1)
) + ")"
SLOPES = """slopes as (
  select region, category, pair_no, cause_variable, effect_variable, hypothesis, count(x) as n_samples,
         case when count(x) < 5 then 0 else coalesce(regr_slope(y, x), 0) end as ate,
         case when count(x) < 5 then 'insufficient_data' else 'ols_bootstrap' end as method
  from long group by all)"""
WEIGHT = " + ".join(f"(u >= {s})::int" for s in causal.POISSON_STEPS)
ERRORS = f"""centred as (
  select l.region, l.category, pair_no, x - avg(x) over g as x, y - avg(y) over g as y,
         l.region || '|' || l.category || '|' || strftime(hour_bucket, '%Y-%m-%d %H:%M:%S') as row_key
  from long l window g as (partition by region, category, pair_no)),
keys as (select distinct row_key from centred),
weights as (
  select row_key, rep, {WEIGHT} as w from (
    select row_key, rep, ('0x' || substr(md5(row_key || '|' || rep::varchar), 1, 8))::bigint as u from keys, range(200) t(rep))),
boots as (
  select region, category, pair_no, rep, sum(w)::double as n, sum(w * x) as sx, sum(w * y) as sy, sum(w * x * x) as sxx, sum(w * x * y) as sxy
  from centred join weights using (row_key) where w > 0 group by 1, 2, 3, 4),
errors as (
  select region, category, pair_no,
         stddev_pop(case when sxx - sx * sx / n > 1e-12 * sxx then (sxy - sx * sy / n) / (sxx - sx * sx / n) else 0 end) as se
  from boots group by 1, 2, 3)"""
FINDINGS = """findings as (
  select *, greatest(0, 1 - p_value) as confidence from (
    select s.*, e.se, case when method = 'insufficient_data' then 1 else
      least(1, greatest(0, 2 * (1 - least(abs(ate / (coalesce(se, 0) + 1e-9)) / 2, 0.999)))) end as p_value
    from slopes s left join errors e using (region, category, pair_no)))"""


def features(spark, sf):
    return kpi.order_features(adapters.raw_orders(spark, sf), "month")



@query("causal_pairs", f"""
with {FEAT}, {LONG} select region, category, {q.ts('hour_bucket')}, pair_no, cause_variable, effect_variable, {q.r4('x', 'y')} from long""")
def causal_pairs(spark, sf):
    c = causal.causal_pairs(features(spark, sf))
    return c.select(*BY, ts("hour_bucket"), "pair_no", "cause_variable", "effect_variable", *r4("x", "y"))


@query("ols_ate", f"""
with {FEAT}, {LONG}, {SLOPES} select region, category, pair_no, cause_variable, effect_variable, n_samples, {q.r4('ate')}, method from slopes""")
def ols_ate(spark, sf):
    a = causal.ols_ate(features(spark, sf))
    return a.select(*BY, "pair_no", "cause_variable", "effect_variable", "n_samples", *r4("ate"), "method")


@query("bootstrap_se", f"with {FEAT}, {LONG}, {ERRORS} select region, category, pair_no, {q.r4('se')} from errors")
def bootstrap_se(spark, sf):
    return causal.bootstrap_se(features(spark, sf)).select(*BY, "pair_no", *r4("se"))


@query("ols_findings", f"""
with {FEAT}, {LONG}, {SLOPES}, {ERRORS}, {FINDINGS}
select region, category, pair_no, {q.r4('ate', 'se')}, {q.r6('p_value', 'confidence')}, method from findings""")
def ols_findings(spark, sf):
    f = causal.ols_findings(features(spark, sf))
    return f.select(*BY, "pair_no", *r4("ate", "se"), *r6("p_value", "confidence"), "method")


BEST = f"""{FEAT}, {LONG}, {SLOPES}, {ERRORS}, {FINDINGS},
best as (select *, row_number() over (partition by region, category order by confidence desc, pair_no) as rn from findings where confidence > 0)"""


@query("best_cause", f"""
with {BEST}
select region, category, cause_variable, effect_variable, {q.r4('ate')}, {q.r6('confidence')}, method, hypothesis,
       cause_variable || ' caused ' || effect_variable || ' anomaly in ' || region || '/' || category || ' with ATE=' || printf('%.4f', round(ate, 4))
       || ' and confidence=' || printf('%.2f%%', round(confidence * 100, 2)) || '. Hypothesis: ' || hypothesis || '.' as explanation
from best where rn = 1""")
def best_cause(spark, sf):
    b = causal.best_cause(causal.ols_findings(features(spark, sf)))
    return b.select(*BY, "cause_variable", "effect_variable", *r4("ate"), *r6("confidence"), "method", "hypothesis", "explanation")


@query("attach_findings", f"""
with {BEST}, k as (select date_trunc('month', order_ts)::timestamp as snapshot_ts, region, category, {q.MEASURES} from raw where {q.VALID} group by 1, 2, 3),
{q.anomalies('k', 2.0)}
select a.metric_name, a.region, a.category, {q.ts('a.window_end', 'window_end')}, coalesce(b.cause_variable, 'unknown') as cause_variable,
       case when b.region is not null then b.effect_variable else a.metric_name end as effect_variable,
       {q.n4('coalesce(b.ate, 0)')} as ate, {q.n6('coalesce(b.confidence, 0)')} as confidence, coalesce(b.method, 'no_causal_pairs_matched') as method
from anom a left join (select * from best where rn = 1) b on a.region = b.region and a.category = b.category""")
def attach_findings(spark, sf):
    """Every anomaly with the cause of its group, in one join."""
    orders = adapters.raw_orders(spark, sf)
    j = causal.attach_findings(anomalies(spark, sf), cycle.findings_for(orders, None, "month", adjusted=False))
    return j.select(
        "metric_name", *BY, ts("window_end"), "cause_variable", "effect_variable", *r4("ate"), *r6("confidence"), "method"
    )


# Two controls: the three-variable normal equations, solved with determinants.
@query("backdoor_two_variables", f"""
with {FEAT}, m as (
  select region, category, count(*) as n_samples, var_pop(avg_discount) as xx, var_pop(avg_price) as zz, covar_pop(avg_discount, avg_price) as xz,
         covar_pop(avg_discount, revenue) as xy, covar_pop(avg_price, revenue) as zy from features group by 1, 2)
select region, category, n_samples, {q.n4('case when n_samples < 5 then 0 else (xy * zz - zy * xz) / (xx * zz - xz * xz) end')} as ate from m""")
def backdoor_two_variables(spark, sf):
    """Effect of discount on revenue with price held fixed; small enough for a closed form in SQL."""
    b = causal.backdoor_ate(features(spark, sf), "avg_discount", "revenue", ["avg_price"])
    return b.select(*BY, "n_samples", *r4("ate"))


def _adjusted(source: str, controls: list[str], x: str, y: str) -> str:
    """CTE ``adj``: effect and error of x on y, each control swept out of the ones after it in turn."""
    names = [*controls, x, y]
    group = "partition by region, category"
    steps = [f"r0 as (select region, category, {', '.join(f'{c} - avg({c}) over ({group}) as {c}' for c in names)} from {source})"]
    for i, c in enumerate(controls):
        rest = ", ".join(f"{v} - {c} * sum({c} * {v}) over ({group}) / sum({c} * {c}) over ({group}) as {v}" for v in names[i + 1 :])
        steps.append(f"r{i + 1} as (select region, category, {rest} from r{i})")
    k = len(names)
    steps.append(f"""adj as (select region, category, count(*) as n_samples, sum({x} * {y}) / sum({x} * {x}) as ate,
      sqrt((sum({y} * {y}) - sum({x} * {y}) * sum({x} * {y}) / sum({x} * {x})) / (count(*) - {k}) / sum({x} * {x})) as se
      from r{len(controls)} group by 1, 2)""")
    return ", ".join(steps)


@query("backdoor_ate", f"""
with {FEAT}, {_adjusted('features', ['order_count', 'avg_price', 'return_rate', 'avg_qty'], 'avg_discount', 'revenue')}
select region, category, n_samples, {q.n4('ate')} as ate, {q.n4('se')} as se,
       {q.n6('greatest(0, 1 - least(1, greatest(0, 2 * (1 - least(abs(ate / (se + 1e-9)) / 2, 0.999)))))')} as confidence,
       'backdoor_linear_regression' as method from adj""")
def backdoor_ate(spark, sf):
    """Effect of discount on revenue with all other features held fixed."""
    b = causal.backdoor_ate(features(spark, sf), "avg_discount", "revenue")
    return b.select(*BY, "n_samples", *r4("ate", "se"), *r6("confidence"), "method")


NAMES = ["order_count", "avg_price", "avg_discount", "return_rate", "revenue", "avg_qty"]
ALL_PAIRS = [(i, x, y) for i, (x, y, _) in enumerate(fv.CAUSAL_PAIRS, 1) if x in NAMES and y in NAMES]
ADJUSTED = " union all ".join(
    f"select * from (with {_adjusted('features', [c for c in NAMES if c not in (x, y)], x, y)} select region, category, {i} as pair_no, '{x}' as cause_variable, '{y}' as effect_variable, n_samples, ate, se from adj)"
    for i, x, y in ALL_PAIRS
)
ADJUSTED_P = "greatest(0, 1 - least(1, greatest(0, 2 * (1 - least(abs(ate / (se + 1e-9)) / 2, 0.999)))))"


@query("adjusted_effects", f"""
with {FEAT}, every as ({ADJUSTED})
select region, category, pair_no, cause_variable, effect_variable, n_samples, {q.n4('ate')} as ate, {q.n4('se')} as se, {q.n4(ADJUSTED_P)} as confidence from every""")
def adjusted_effects(spark, sf):
    """Effect of every pair with all other features held fixed, from one matrix per group."""
    a = causal.adjusted_ate(features(spark, sf))
    return a.select(*BY, "pair_no", "cause_variable", "effect_variable", "n_samples", *r4("ate", "se", "confidence"))


@query("adjusted_cause", f"""
with {FEAT}, every as ({ADJUSTED}), c as (select *, {ADJUSTED_P} as confidence from every),
best as (select * from c where confidence > 0 qualify row_number() over (partition by region, category order by confidence desc, pair_no) = 1)
select region, category, cause_variable, effect_variable, {q.n4('ate')} as ate, {q.n4('confidence')} as confidence, 'backdoor_linear_regression' as method from best""")
def adjusted_cause(spark, sf):
    """Best cause of each group by its adjusted effects."""
    b = causal.best_cause(causal.adjusted_findings(features(spark, sf)))
    return b.select(*BY, "cause_variable", "effect_variable", *r4("ate", "confidence"), "method")


@query("refute_random_cause", f"""
with {FEAT}, noisy as (select *, ('0x' || substr(md5(region || '|' || category || '|' || strftime(hour_bucket, '%Y-%m-%d %H:%M:%S') || '|42'), 1, 8))::bigint / 4294967296.0::double as random_cause from features),
a as (with {_adjusted('noisy', ['order_count', 'avg_price', 'avg_discount', 'return_rate'], 'avg_qty', 'revenue')} select * from adj),
b as (with {_adjusted('noisy', ['order_count', 'avg_price', 'avg_discount', 'return_rate', 'random_cause'], 'avg_qty', 'revenue')} select * from adj)
select region, category, {q.n4('a.ate')} as ate, {q.n4('b.ate')} as new_effect from a join b using (region, category)""")
def refute_random_cause(spark, sf):
    b = causal.refute_random_common_cause(features(spark, sf), "avg_qty", "revenue")
    return b.select(*BY, *r4("ate", "new_effect"))


@query("correlation_impact", f"""
with {q.KPI}, c as ({' union all '.join(f"select '{m}' as cause_variable, covar_samp({m}::double, total_revenue) / nullif(stddev_samp({m}::double) * stddev_samp(total_revenue), 0) as r from kpi" for m in CORR if m != 'total_revenue')})
select cause_variable, {q.n6('r')} as ate, {q.n6('abs(r)')} as confidence, 'total_revenue' as effect_variable, 'Correlation Proxy' as method from c""")
def correlation_impact(spark, sf):
    c = causal.correlation_impact(adapters.order_kpis(spark, sf), "total_revenue")
    return c.select("cause_variable", *r6("ate", "confidence"), "effect_variable", "method")


def _narrative(m: str, ate: str, z: str) -> str:
    cases = " ".join(f"when {m} = '{n}' and {ate} {'>' if w == 'spike' else '<='} 0 then '{t}'" for n, w, t in fv.HYPOTHESES)
    return f"""'[' || case when abs({z}) > 4 then 'EXTREME' when abs({z}) > 3 then 'HIGH' else 'MODERATE' end || ' ' ||
  case when {ate} > 0 then 'SPIKE' else 'DROP' end || '] ' || case {cases} else '{fv.HYPOTHESIS_UNKNOWN}' end ||
  case when {m} = 'total_revenue' then ' Baseline avg $' || printf('%,.0f', round(b_rev, 0)) || ' — deviation is ' || printf('%.0f%%', round(abs({ate}) / greatest(b_rev, 1) * 100, 0)) || ' of mean.'
       when {m} = 'return_rate' then ' Mean return rate ' || printf('%.1f%%', round(b_ret * 100, 1)) || '; breach threshold >15%.' else '' end"""


@query("anomaly_ate", f"""
with {q.ANOM}, b as (select avg(total_revenue) as b_rev, avg(return_rate) as b_ret from kpi),
top as (select * from anom order by abs(z_score) desc, metric_name, region, category limit 8),
one as (select *, row_number() over (partition by metric_name order by abs(z_score) desc, region, category) as rn from top)
select metric_name as cause_variable, 'business_outcome' as effect_variable, round(metric_value - expected_value, 4) as ate,
       round((metric_value - expected_value) / greatest(abs(expected_value), 1e-9) * 100, 1) as ate_pct,
       round(least(0.99, 0.50 + abs(z_score) * 0.07), 3) as confidence, round(abs(z_score), 2) as z_score, severity, region,
       'Z-score + ATE (live)' as method, {_narrative('metric_name', '(metric_value - expected_value)', 'z_score')} as explanation
from one, b where rn = 1""")
def anomaly_ate(spark, sf):
    return causal.anomaly_ate(anomalies(spark, sf), adapters.order_kpis(spark, sf))


@query("causal_narratives", f"""
with {q.ANOM}, b as (select avg(total_revenue) as b_rev, avg(return_rate) as b_ret from kpi)
select metric_name, region, category, {q.ts('window_end')}, {_narrative('metric_name', '(metric_value - expected_value)', 'z_score')} as narrative from anom, b""")
def causal_narratives(spark, sf):
    from tidewatch.functions import scalars as S
    from tidewatch.functions import text as X

    base = analytics.kpi_baseline(adapters.order_kpis(spark, sf)).select(F.struct("*").alias("b")).scalar()
    text = X.causal_narrative(
        "metric_name", S.ate_delta("metric_value", "expected_value"), "z_score", base.getField("total_revenue"), base.getField("return_rate")
    )
    return anomalies(spark, sf).select("metric_name", *BY, ts("window_end"), text.alias("narrative"))
