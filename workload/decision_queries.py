"""Verdicts, reports, decisions, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions import text as X
from tidewatch.operators import alerts, anomaly, causal, decisions, windows
from tidewatch.operators import analytics
from tidewatch.plans import cycle
from tidewatch.sources import adapters
from workload import fragments as q
from workload.causal_queries import _narrative
from workload.kpi_queries import anomalies
from workload.registry import query, r4, ts

BY = ["region", "category"]
KEY = ["metric_name", "region", "category"]


def with_ids(spark, sf):
    """Best event per series with a readable id."""
    best = windows.dedup_best(anomalies(spark, sf))
    return best.withColumn("anomaly_id", F.concat_ws("/", "region", "category", "metric_name"))


IDS = f"""{q.ANOM}, best as (
  select *, region || '/' || category || '/' || metric_name as anomaly_id from (
    select *, row_number() over (partition by region, category, metric_name order by abs(z_score) desc, window_end) as rn from anom) where rn = 1)"""


def decision_rows(spark, sf):
    """A decision for all but the MEDIUM anomalies: priority by metric, so that all routes occur."""
    p = (
        F.when(F.col("metric_name") == "total_revenue", "P0").when(F.col("metric_name") == "return_rate", "P1")
        .when(F.col("metric_name") == "avg_order_val", "P3").otherwise("P2")
    )
    return with_ids(spark, sf).where("severity <> 'MEDIUM' and z_score > -2.5").select(
        "anomaly_id", p.alias("priority"), F.concat(F.lit("Check "), F.col("metric_name")).alias("final_action"),
        F.lit("Looks real.").alias("analyst_output"),
    )


DECIDED = """made as (select anomaly_id, case metric_name when 'total_revenue' then 'P0' when 'return_rate' then 'P1' when 'avg_order_val' then 'P3' else 'P2' end as priority,
  'Check ' || metric_name as final_action, 'Looks real.' as analyst_output from best where severity <> 'MEDIUM' and z_score > -2.5)"""


def _esc(text: str) -> str:
    return text.replace("'", "''").replace("\n", "' || chr(10) || '")


def _verdict_sql(source: str, by: str) -> str:
    pick = lambda s: f"arg_min({{'m': metric_name, 'r': region}}, {{'z': -abs(z_score), 'm': metric_name, 'r': region, 'c': category}}) filter (severity = '{s}')"
    p1 = _esc(fv.VERDICTS["P1"][1]).replace("{metric}", "' || tc.m || '").replace("{region}", "' || tc.r || '")
    p2 = _esc(fv.VERDICTS["P2"][1]).replace("{metric}", "' || th.m || '").replace("{region}", "' || th.r || '")
    group = f"group by {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""v0 as (select {lead} count(*) as n_anomalies, count_if(severity = 'CRITICAL') as n_critical, count_if(severity = 'HIGH') as n_high,
  count_if(severity = 'MEDIUM') as n_medium, max(abs(z_score)) as max_z, {pick('CRITICAL')} as tc, {pick('HIGH')} as th from {source} {group}),
v as (select *, case when n_critical > 0 then 'P1' when n_high > 0 then 'P2' when n_medium > 0 then 'P3' else 'P4' end as priority,
  case when n_critical > 0 then '{fv.VERDICTS['P1'][0]}' when n_high > 0 then '{fv.VERDICTS['P2'][0]}' when n_medium > 0 then '{fv.VERDICTS['P3'][0]}'
       when n_anomalies = 0 then '{fv.VERDICTS['quiet'][0]}' else '{fv.VERDICTS['P4'][0]}' end as verdict,
  case when n_critical > 0 then '{p1}' when n_high > 0 then '{p2}' when n_medium > 0 then '{_esc(fv.VERDICTS['P3'][1])}'
       when n_anomalies = 0 then '{fv.VERDICTS['quiet'][1]}' else '{fv.VERDICTS['P4'][1]}' end as final_action from v0)"""


# Anomalies re-graded over a wider range, so that every verdict occurs.
GRADED = f"{q.ANOM}, graded as (select * replace (case when abs(z_score) > 3.2 then 'CRITICAL' when abs(z_score) > 3 then 'HIGH' when abs(z_score) > 2.6 then 'MEDIUM' else 'LOW' end as severity) from anom)"


def graded(spark, sf):
    az = F.abs("z_score")
    sev = F.when(az > 3.2, "CRITICAL").when(az > 3, "HIGH").when(az > 2.6, "MEDIUM").otherwise("LOW")
    return anomalies(spark, sf).withColumn("severity", sev)


@query("verdict_by_group", f"""
with {GRADED}, {_verdict_sql('graded', 'region, category')}
select region, category, n_anomalies, n_critical, n_high, n_medium, {q.r4('max_z')}, priority, verdict, final_action from v""")
def verdict_by_group(spark, sf):
    v = decisions.verdict(graded(spark, sf), BY)
    return v.select(*BY, "n_anomalies", "n_critical", "n_high", "n_medium", *r4("max_z"), "priority", "verdict", "final_action")


@query("verdict_overall", f"""
with {GRADED}, {_verdict_sql('graded', '')} select n_anomalies, n_critical, n_high, n_medium, {q.r4('max_z')}, priority, verdict, final_action from v""")
def verdict_overall(spark, sf):
    v = decisions.verdict(graded(spark, sf))
    return v.select("n_anomalies", "n_critical", "n_high", "n_medium", *r4("max_z"), "priority", "verdict", "final_action")


RULE = "'" + X.RULE + "'"
NL = "chr(10)"


def _top5(by: str) -> str:
    part = f"partition by {by}" if by else ""
    return f"top as (select *, row_number() over ({part} order by abs(z_score) desc, metric_name, region, category) as pos from graded qualify pos <= 5)"


DETECT_LINES = f"""'  [' || pos || '] ' || severity || ' — ' || upper(metric_name) || {NL} || '      Region   : ' || region || {NL} ||
  '      Observed : ' || printf('%,.2f', round(metric_value, 2)) || {NL} || '      Expected : ' || printf('%,.2f', round(expected_value, 2)) || {NL} ||
  '      Delta    : ' || (case when round(metric_value - expected_value, 2) < 0 then '' else '+' end) || printf('%,.2f', round(metric_value - expected_value, 2)) || '  (z=' || printf('%.2f', round(abs(z_score), 2)) || 'σ)' || {NL} ||
  '      Signal   : ' || case when abs(z_score) > 4 then '🔴 CRITICAL BREACH' when abs(z_score) > 3 then '🟠 HIGH ALERT' else '🟡 ELEVATED' end || {NL}"""

ANALYST = f"""{_top5('region')}, lines as (select region, string_agg({DETECT_LINES}, {NL} order by pos) as body from top group by 1),
tot as (select region, count(*) as n, max(abs(z_score)) as mz, least(0.99, 0.60 + max(abs(z_score)) * 0.04) as conf from graded group by 1),
analyst as (select region, {RULE} || {NL} || '  ANOMALY EXPERT — DETECTION REPORT' || {NL} || {RULE} || {NL} || '' || {NL} || body || {NL} ||
  '  SUMMARY: ' || n || ' total anomalies detected.' || {NL} || '  Top z-score: ' || printf('%.2f', round(mz, 2)) || 'σ   Confidence: ' ||
  printf('%.0f%%', round(conf * 100, 0)) || {NL} || {RULE} as analyst_output, conf from lines join tot using (region))"""


@query("analyst_report", f"with {GRADED}, {ANALYST} select region, analyst_output, {q.n4('conf')} as confidence from analyst")
def analyst_report(spark, sf):
    """Detection report per region."""
    a = decisions.analyst(graded(spark, sf), adapters.order_kpis(spark, sf), ["region"])
    return a.select("region", "analyst_output", *r4("confidence"))


ATE = "(metric_value - expected_value)"
PCT = f"round({ATE} / greatest(abs(expected_value), 1e-9) * 100, 1)"
CAUSE_LINES = f"""'  METRIC  : ' || upper(metric_name) || {NL} ||
  '  ATE     : ' || (case when round({ATE}, 4) < 0 then '' else '+' end) || printf('%,.4f', round({ATE}, 4)) || '   (' || (case when {PCT} < 0 then '' else '+' end) || printf('%.1f%%', {PCT}) || ' from baseline)' || {NL} ||
  '  z-score : ' || printf('%.2f', round(abs(z_score), 2)) || 'σ      Confidence: ' || printf('%.0f%%', round(least(0.99, 0.50 + abs(z_score) * 0.07) * 100, 0)) || {NL} ||
  '  CAUSE   : ' || {_narrative('metric_name', ATE, 'z_score')} || {NL}"""


@query("causal_report", f"""
with {GRADED}, {_top5('region')}, b as (select avg(total_revenue) as b_rev, avg(return_rate) as b_ret from kpi),
once as (select * from top, b qualify row_number() over (partition by region, metric_name order by pos) = 1),
lines as (select region, string_agg({CAUSE_LINES}, {NL} order by pos) as body from once group by 1)
select region, {RULE} || {NL} || '  CAUSAL INFERENCE ENGINE — ATE ANALYSIS' || {NL} || {RULE} || {NL} || '' || {NL} || body || {NL} || {RULE} as causal_output from lines""")
def causal_report(spark, sf):
    """Effect report per region."""
    return decisions.causal_report(graded(spark, sf), adapters.order_kpis(spark, sf), ["region"])


@query("council", f"""
with {GRADED}, {ANALYST}, {_verdict_sql('graded', 'region')}
select v.region, priority, final_action, {q.n4('conf')} as confidence, analyst_output, true as completed,
  {RULE} || {NL} || '  EXECUTIVE REVIEWER — VERDICT' || {NL} || {RULE} || {NL} || {NL} || '  VERDICT    : ' || verdict || {NL} || '  PRIORITY   : ' || priority || {NL} ||
  '  CONFIDENCE : ' || printf('%.0f%%', round(conf * 100, 0)) || '   AGENTS: 3/3 consensus' || {NL} || {NL} || '  ANOMALY BREAKDOWN:' || {NL} ||
  '    Critical: ' || n_critical || '  |  High: ' || n_high || '  |  Medium: ' || n_medium || {NL} || {NL} || '  RECOMMENDED ACTION:' || {NL} || '  ' || final_action || {NL} || {RULE} as decision_output
from v join analyst using (region)""")
def council(spark, sf):
    """All three reports per region."""
    c = decisions.council(adapters.order_kpis(spark, sf), graded(spark, sf), ["region"])
    return c.select("region", "priority", "final_action", *r4("confidence"), "analyst_output", "completed", "decision_output")


@query("council_prompt", f"""
with {GRADED}, top as (select *, row_number() over (order by abs(z_score) desc, metric_name, region, category) as pos from graded qualify pos <= 5),
b as (select avg(total_revenue) as r, avg(total_orders) as o, avg(return_rate) as t, avg(avg_order_val) as a from kpi)
select 'You are analyzing a business KPI dashboard.' || {NL} || {NL} || 'KPI BASELINE (averages):' || {NL} ||
  '- total_revenue: ' || printf('%.2f', round(r, 2)) || {NL} || '- total_orders: ' || printf('%.2f', round(o, 2)) || {NL} || '- return_rate: ' || printf('%.2f', round(t, 2)) || {NL} ||
  '- avg_order_val: ' || printf('%.2f', round(a, 2)) || {NL} || {NL} || 'DETECTED ANOMALIES:' || {NL} ||
  (select string_agg('- ' || metric_name || ' in ' || region || ': observed=' || printf('%.2f', round(metric_value, 2)) || ', expected=' || printf('%.2f', round(expected_value, 2)) ||
     ', z-score=' || printf('%.2f', round(abs(z_score), 2)) || ', severity=' || severity, {NL} order by pos) from top) || {NL} || {NL} || 'Total anomalies: ' || (select count(*) from graded) || {NL} || {NL} ||
  'Please analyze these anomalies, identify root causes, and recommend actions.' as prompt from b""")
def council_prompt(spark, sf):
    return decisions.council_prompt(adapters.order_kpis(spark, sf), graded(spark, sf))


@query("anomaly_prompts", f"""
with {GRADED}
select metric_name, region, category, {q.ts('window_end')}, 'ANOMALY REPORT:' || {NL} || '  Metric:    ' || metric_name || {NL} || '  Value:     ' || floor(metric_value)::bigint::varchar || {NL} ||
  '  Expected:  ' || floor(expected_value)::bigint::varchar || {NL} || '  Z-score:   ' || (floor(z_score * 100))::bigint::varchar || {NL} || '  Severity:  ' || severity || {NL} || '  Region:    ' || region || {NL} ||
  '  Category:  ' || category || {NL} || '  Detected:  ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || {NL} || {NL} || 'CAUSAL ANALYSIS:' || {NL} || '  No causal analysis available.' as prompt
from graded where metric_name in ('total_revenue', 'total_orders')""")
def anomaly_prompts(spark, sf):
    """Prompt per volume anomaly; values are cut to whole numbers to be written alike by both engines."""
    a = graded(spark, sf).where(F.col("metric_name").isin("total_revenue", "total_orders"))
    whole = {
        "metric_value": F.floor("metric_value"), "expected_value": F.floor("expected_value"),
        "z_score": F.floor(F.col("z_score") * 100), "detected_at": F.date_format("window_end", "yyyy-MM-dd HH:mm:ss"),
        "explanation": F.lit(None).cast("string"),
    }
    return decisions.prompt_table(a.withColumns(whole)).select(*KEY, ts("window_end"), "prompt")


@query("event_prompts", f"""
with {q.EANOM}
select metric_name, category, {q.ts('window_end')}, 'SINGLE EVENT ALERT:' || {NL} || 'Metric  : ' || metric_name || {NL} || 'Region  : ' || region || {NL} || 'Severity: ' || severity || {NL} ||
  'Observed: ' || {q.exact2('metric_value')} || '  (Expected: ' || {q.exact2('expected_value')} || ')' || {NL} || 'Z-score : ' || {q.exact2('z_score')} || 'σ' || {NL} || {NL} ||
  'Provide: (1) what this anomaly means, (2) likely root cause, (3) immediate action in 3 bullet points.' as prompt
from anom""")
def event_prompts(spark, sf):
    """Prompt per anomaly. Values are taken at six digits, where the order of a sum no longer shows, then worded with two."""
    from workload.anomaly_queries import event_anomalies

    a = event_anomalies(spark, sf).withColumns({c: F.round(c, 6) for c in ("metric_value", "expected_value", "z_score")})
    prompt = X.event_prompt("metric_name", "severity", "region", "metric_value", "expected_value", "z_score")
    return a.select("metric_name", "category", ts("window_end"), prompt.alias("prompt"))


@query("scripted_decisions", f"""
with {IDS}, {_verdict_sql('best', 'anomaly_id')}
select anomaly_id, priority, final_action, 'PENDING' as status, 4 as rounds_logged, 'Analyst,Causal,Decision' as agents from v""")
def scripted_decisions(spark, sf):
    """Rule-based decision for every anomaly, with its cause attached."""
    orders = adapters.raw_orders(spark, sf)
    a = with_ids(spark, sf).withColumn("detected_at", F.col("window_end"))
    joined = causal.attach_findings(a, cycle.findings_for(orders, None, "month"))
    d = decisions.decision_records(joined, adapters.order_kpis(spark, sf))
    return d.select(
        "anomaly_id", "priority", "final_action", "status", F.size("debate_history").alias("rounds_logged"),
        F.array_join(decisions.agents_in("debate_history"), ",").alias("agents"),
    )


@query("map_agent_results", f"""
with t as (select conv_id, arg_max(text, turn) as txt, max(turn) as z from conversations where role = 'assistant' group by 1), u as (select *, upper(txt) as up from t)
select conv_id, {q.n4('least(0.99, 0.65 + z * 0.04)')} as confidence, substring(txt, 1, 300) as final_action, length(txt) as n_chars,
  case when regexp_matches(up, 'REJECT|CRITICAL|IMMEDIATE|P1') then 'P1' when regexp_matches(up, 'FLAG|URGENT|HIGH|P2') then 'P2'
       when regexp_matches(up, 'APPROVE|MONITOR|MEDIUM|P3') then 'P3' else 'P4' end as priority, 'Agent did not return causal output.' as causal_output from u""")
def map_agent_results(spark, sf):
    """Last assistant turn of each conversation taken as an external decision text."""
    turns = adapters.table(spark, sf, "conversations").where("role = 'assistant'")
    said = turns.groupBy("conv_id").agg(F.max_by("text", "turn").alias("final_decision"), F.max("turn").alias("max_z"))
    m = decisions.map_agent_result(said)
    return m.select("conv_id", *r4("confidence"), "final_action", F.length("decision_output").alias("n_chars"), "priority", "causal_output")


# -- alerts --------------------------------------------------------------------------------


ROUTED = f"""{IDS}, {DECIDED}, routed as (
  select b.anomaly_id, b.metric_name, b.region, b.category, severity, z_score, window_end, coalesce(m.priority, 'P2') as priority,
         coalesce(m.final_action, 'Review manually') as action,
         case coalesce(m.priority, 'P2') when 'P0' then 'pagerduty,slack,email' when 'P1' then 'slack,email' when 'P2' then 'slack' else '' end as channels,
         severity || ' anomaly in ' || b.region || '/' || b.category || ': ' || b.metric_name || ' deviated ' || printf('%.1f', round(z_score, 1)) || 'σ' as title
  from best b left join made m using (anomaly_id))"""


def routed(spark, sf):
    return alerts.route_alerts(with_ids(spark, sf), decision_rows(spark, sf), F.col("window_end"))


@query("route_alerts", f"with {ROUTED} select anomaly_id, title, priority, severity, action, channels, {q.r4('z_score')} from routed")
def route_alerts(spark, sf):
    r = routed(spark, sf)
    return r.select("anomaly_id", "title", "priority", "severity", "action", F.array_join("channels", ",").alias("channels"), *r4("z_score"))


@query("alert_payloads", f"""
with {ROUTED}, c as (select *, unnest(string_split(channels, ',')) as channel from routed where channels <> '')
select anomaly_id, priority, channel, case channel when 'pagerduty' then title when 'slack' then
  case priority when 'P0' then '🚨' when 'P1' then '🔴' when 'P2' then '🟡' when 'P3' then '🟢' else '⚪' end || ' *[' || priority || '] ' || title || '*'
  else '[' || priority || '] ' || title end as headline from c""")
def alert_payloads(spark, sf):
    """Headline of the message per alert and channel, read back from its JSON."""
    p = alerts.alert_payloads(routed(spark, sf))
    field = lambda path: F.get_json_object("payload", path)
    head = F.coalesce(field("$.text"), field("$.payload.summary"))
    head = F.when(F.col("channel") == "email", field("$.subject")).otherwise(head)
    return p.select("anomaly_id", "priority", "channel", head.alias("headline"))


@query("alert_summary", f"""
with {ROUTED}, a as (select priority, severity, title, window_end from routed)
select 'priority' as dimension, priority as value, count(*) as total, arg_max(title, {{'t': window_end, 'n': title}}) as latest from a group by 2
union all select 'severity', severity, count(*), arg_max(title, {{'t': window_end, 'n': title}}) from a group by 2
union all select 'all', 'all', count(*), arg_max(title, {{'t': window_end, 'n': title}}) from a""")
def alert_summary(spark, sf):
    return analytics.alert_summary(routed(spark, sf))


@query("mark_alerted", f"""
with {ROUTED}
select m.anomaly_id, case when r.priority = 'P0' then 'ALERTED' else 'PENDING' end as status,
       'batch' as origin, case when r.priority = 'P0' then '["pagerduty","slack","email"]' else 'none' end as alert_channels
from made m left join routed r using (anomaly_id)""")
def mark_alerted(spark, sf):
    """Decisions whose alert went to the pager become ALERTED; their metadata keeps its other keys."""
    made = decision_rows(spark, sf).withColumns(
        {"status": F.lit("PENDING"), "metadata": F.create_map(F.lit("origin"), F.lit("batch"), F.lit("alert_channels"), F.lit("none"))}
    )
    fired = routed(spark, sf).where(F.array_contains("channels", "pagerduty"))
    m = alerts.mark_alerted(made, fired)
    return m.select("anomaly_id", "status", F.col("metadata")["origin"].alias("origin"), F.col("metadata")["alert_channels"].alias("alert_channels"))
