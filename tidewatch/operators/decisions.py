"""From anomalies and causes to verdicts, reports and decision records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch import schemas
from tidewatch.config import Settings
from tidewatch.functions import scalars as S
from tidewatch.functions import text as X
from tidewatch.operators import analytics

TIES = ("metric_name", "region", "category")
# Anomalies that a report lists, characters of an answer that become the action.
LISTED, ACTION_CHARS = 5, 300


def _order() -> list[Column]:
    return [F.abs(F.col("z_score")).desc(), *[F.col(c) for c in TIES]]


def top_per_group(anomalies: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """k strongest anomalies per group; tasks drop the rest before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*_order())
    return anomalies.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)


def _top_list(anomalies: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """Top k as one sorted array per group (at most k elements), over all rows when ``by`` is empty."""
    fields = ["metric_name", "metric_value", "expected_value", "z_score", "severity", "region", "category"]
    if by:
        top = top_per_group(anomalies, by, k)
        grouped = top.groupBy(*by)
        item = F.struct("_rank", *fields)
    else:
        top = anomalies.orderBy(*_order()).limit(k)
        grouped = top.groupBy()
        item = F.struct((-F.abs("z_score")).alias("_rank"), *TIES, *[f for f in fields if f not in TIES])
    return grouped.agg(F.sort_array(F.collect_list(item)).alias("top"))


def _totals(anomalies: DataFrame, by: Sequence[str]) -> DataFrame:
    sev = F.col("severity")
    first = F.struct((-F.abs(F.col("z_score"))).alias("o"), *TIES)
    pick = F.struct("metric_name", F.col("region").alias("at_region"))
    return anomalies.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_anomalies"),
        F.count_if(sev == "CRITICAL").alias("n_critical"),
        F.count_if(sev == "HIGH").alias("n_high"),
        F.count_if(sev == "MEDIUM").alias("n_medium"),
        F.max(F.abs("z_score")).alias("max_z"),
        F.min_by(pick, F.when(sev == "CRITICAL", first)).alias("top_critical"),
        F.min_by(pick, F.when(sev == "HIGH", first)).alias("top_high"),
    )


def _state(anomalies: DataFrame, kpi: DataFrame, by: Sequence[str], most: int) -> DataFrame:
    """Counts, the strongest few and KPI baseline of every group in one row: all reports are written from it."""
    totals = _totals(anomalies, by)
    top = _top_list(anomalies, by, most)
    joined = totals.join(top, list(by)) if by else _side_by_side(totals, top, ["top"])
    base = analytics.kpi_baseline(kpi).select(F.struct("*").alias("b")).scalar()
    # Lambdas cannot hold a subquery, so the baselines become columns.
    return joined.withColumns({f"_{m}": base.getField(m) for m in fv.BASELINE_METRICS})


def _side_by_side(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns of a one-row frame beside another one-row frame."""
    row = right.select(F.struct(*columns).alias("r")).scalar()
    return left.select("*", *[row.getField(c).alias(c) for c in columns])


def _judged(totals: DataFrame) -> DataFrame:
    """Adds priority, verdict and final_action to the counts."""
    priority = (
        F.when(F.col("n_critical") > 0, "P1")
        .when(F.col("n_high") > 0, "P2")
        .when(F.col("n_medium") > 0, "P3")
        .otherwise("P4")
    )
    quiet = F.col("n_anomalies") == 0

    def worded(p: str, chosen: str) -> Column:
        metric = F.coalesce(F.col(f"{chosen}.metric_name"), F.lit("metric"))
        place = F.coalesce(F.col(f"{chosen}.at_region"), F.lit("region"))
        return F.replace(F.replace(F.lit(fv.VERDICTS[p][1]), F.lit("{metric}"), metric), F.lit("{region}"), place)

    p = F.col("priority")
    action = (
        F.when(quiet, F.lit(fv.VERDICTS["quiet"][1]))
        .when(p == "P1", worded("P1", "top_critical"))
        .when(p == "P2", worded("P2", "top_high"))
        .when(p == "P3", F.lit(fv.VERDICTS["P3"][1]))
        .otherwise(F.lit(fv.VERDICTS["P4"][1]))
    )
    title = S.lookup(p, [(k, fv.VERDICTS[k][0]) for k in ("P1", "P2", "P3", "P4")])
    title = F.when(quiet, F.lit(fv.VERDICTS["quiet"][0])).otherwise(title)
    judged = totals.withColumn("priority", priority)
    return judged.withColumn("verdict", title).withColumn("final_action", action)


def _analyst_text() -> Column:
    rule = F.lit(X.RULE)
    conf = S.confidence("max_z", fv.CONFIDENCE_ANALYST)
    body = F.array_join(F.transform("top", lambda e, i: X.detection_lines(e, i + 1)), "\n")
    report = F.concat_ws(
        "\n",
        rule, F.lit("  ANOMALY EXPERT — DETECTION REPORT"), rule, F.lit(""), body,
        F.concat(F.lit("  SUMMARY: "), F.col("n_anomalies").cast("string"), F.lit(" total anomalies detected.")),
        F.concat(F.lit("  Top z-score: "), X.num("max_z", "%.2f", 2), F.lit("σ   Confidence: "), X.percent(conf)),
        rule,
    )

    def zero(name: str) -> Column:
        return F.coalesce(F.col(f"_{name}"), F.lit(0.0))

    calm = F.concat_ws(
        "\n",
        F.lit("✅ NO ANOMALIES DETECTED"), F.lit(""),
        F.concat(F.lit("  Revenue baseline : $"), F.lpad(X.num(zero("total_revenue"), "%,.0f", 0), 12, " ")),
        F.concat(F.lit("  Total orders     : "), F.lpad(X.num(zero("total_orders"), "%,.0f", 0), 12, " ")),
        F.concat(F.lit("  Return rate      : "), F.lpad(X.percent(zero("return_rate"), 1), 12, " ")),
        F.lit(""), F.lit("  System operating within normal parameters."),
        F.lit("  Recommendation: Continue standard monitoring."),
    )
    return F.when(F.col("n_anomalies") > 0, report).otherwise(calm)


def _analyst_confidence() -> Column:
    some = F.col("n_anomalies") > 0
    return F.when(some, S.confidence("max_z", fv.CONFIDENCE_ANALYST)).otherwise(F.lit(fv.CONFIDENCE_QUIET))


def _causal_text() -> Column:
    # Position of an element's metric in the list of metrics tells whether it is the first one.
    names = F.transform("top", lambda e: e["metric_name"])
    once = F.filter("top", lambda e, i: F.array_position(names, e["metric_name"]) == i + 1)
    rule = F.lit(X.RULE)
    head = F.concat_ws("\n", rule, F.lit("  CAUSAL INFERENCE ENGINE — ATE ANALYSIS"), rule, F.lit(""))
    lines = F.transform(once, lambda e: X.cause_lines(e, F.col("_total_revenue"), F.col("_return_rate")))
    full = F.concat_ws("\n", head, F.array_join(lines, "\n"), rule)
    none = F.concat_ws("\n", head, F.lit("  No anomalies to analyze. Causal chain not triggered."))
    return F.when(F.size("top") > 0, full).otherwise(none)


def _decision_text(confidence: str = "confidence") -> Column:
    rule = F.lit(X.RULE)

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(label), value)

    busy = F.concat_ws(
        "\n",
        rule, F.lit("  EXECUTIVE REVIEWER — VERDICT"), rule, F.lit(""),
        line("  VERDICT    : ", F.col("verdict")), line("  PRIORITY   : ", F.col("priority")),
        F.concat(F.lit("  CONFIDENCE : "), X.percent(confidence), F.lit("   AGENTS: 3/3 consensus")), F.lit(""),
        F.lit("  ANOMALY BREAKDOWN:"),
        F.format_string("    Critical: %d  |  High: %d  |  Medium: %d", "n_critical", "n_high", "n_medium"), F.lit(""),
        F.lit("  RECOMMENDED ACTION:"), line("  ", F.col("final_action")), rule,
    )
    calm = F.concat_ws(
        "\n",
        rule, F.lit("  EXECUTIVE REVIEWER — VERDICT"), rule, F.lit(""), line("  VERDICT  : ", F.col("verdict")),
        F.lit("  PRIORITY : P4 (Routine)"), F.lit("  AGENTS   : 3/3 in agreement"), F.lit(""),
        F.lit("  System nominal. Continue standard ops."), rule,
    )
    return F.when(F.col("n_anomalies") == 0, calm).otherwise(busy)


def verdict(anomalies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Priority, counts and action per group: P1 with any CRITICAL, then HIGH, MEDIUM, else P4."""
    return _judged(_totals(anomalies, by)).select(
        *by, "n_anomalies", "n_critical", "n_high", "n_medium", "max_z", "priority", "verdict", "final_action"
    )


def analyst(anomalies: DataFrame, kpi: DataFrame, by: Sequence[str] = (), most: int = LISTED) -> DataFrame:
    """Detection report over the ``most`` strongest anomalies, with its confidence; its counts are of all."""
    state = _state(anomalies, kpi, by, most)
    return state.select(*by, _analyst_text().alias("analyst_output"), _analyst_confidence().alias("confidence"))


def causal_report(anomalies: DataFrame, kpi: DataFrame, by: Sequence[str] = (), most: int = LISTED) -> DataFrame:
    """Effect report: the ``most`` strongest anomalies, each metric once."""
    return _state(anomalies, kpi, by, most).select(*by, _causal_text().alias("causal_output"))


def council(kpi: DataFrame, anomalies: DataFrame, by: Sequence[str] = (), most: int = LISTED) -> DataFrame:
    """Detection report, effect report and verdict as one record per group; the reports list the ``most`` strongest anomalies, verdict and counts are of all."""
    state = _judged(_state(anomalies, kpi, by, most)).withColumn("confidence", _analyst_confidence())
    return state.select(
        *by, "n_anomalies", "n_critical", "n_high", "n_medium", "max_z", "priority", "verdict", "final_action", "confidence",
        _analyst_text().alias("analyst_output"), _causal_text().alias("causal_output"),
        _decision_text().alias("decision_output"), F.lit(True).alias("completed"),
    )


# -- prompts and decision records -----------------------------------------------------------


def prompt_table(anomalies: DataFrame) -> DataFrame:
    """Context text per anomaly (joined with its finding), for whoever decides."""
    return anomalies.withColumn("prompt", X.anomaly_context())


def council_prompt(kpi: DataFrame, anomalies: DataFrame, most: int = LISTED) -> DataFrame:
    """One question over the KPI means and the ``most`` strongest anomalies."""
    base = analytics.kpi_baseline(kpi).select(F.struct("*").alias("b")).scalar()
    n = anomalies.agg(F.count(F.lit(1))).scalar()
    kpi_lines = F.concat_ws(
        "\n", *[F.concat(F.lit(f"- {m}: "), X.num(base.getField(m), "%.2f", 2)) for m in fv.BASELINE_METRICS]
    )

    def line(e: Column) -> Column:
        return F.concat(
            F.lit("- "), F.coalesce(e["metric_name"], F.lit("?")), F.lit(" in "), F.coalesce(e["region"], F.lit("?")),
            F.lit(": observed="), X.num(e["metric_value"], "%.2f", 2), F.lit(", expected="),
            X.num(e["expected_value"], "%.2f", 2), F.lit(", z-score="), X.num(F.abs(e["z_score"]), "%.2f", 2),
            F.lit(", severity="), F.coalesce(e["severity"], F.lit("?")),
        )

    top = _top_list(anomalies, (), most)
    listed = F.array_join(F.transform("top", line), "\n")
    found = F.when(F.size("top") > 0, listed).otherwise(F.lit("No anomalies detected."))
    return top.select(
        F.concat(
            F.lit("You are analyzing a business KPI dashboard.\n\nKPI BASELINE (averages):\n"), kpi_lines,
            F.lit("\n\nDETECTED ANOMALIES:\n"), found, F.lit("\n\nTotal anomalies: "), n.cast("string"),
            F.lit("\n\nPlease analyze these anomalies, identify root causes, and recommend actions."),
        ).alias("prompt")
    )


def rule_based(anomalies: DataFrame, kpi: DataFrame) -> DataFrame:
    """Each anomaly with the three reports, priority, action and confidence that the council would give it alone.

    Row by row, without a shuffle: counts and lists of a group of one are column expressions, the KPI baseline is one scalar
    subquery. A cause that is attached (``explanation``) ends the effect report.
    """
    sev = F.col("severity")
    pick = F.struct("metric_name", F.col("region").alias("at_region"))
    fields = ["metric_name", "metric_value", "expected_value", "z_score", "severity", "region", "category"]
    base = analytics.kpi_baseline(kpi).select(F.struct("*").alias("b")).scalar()
    own = {
        "n_anomalies": F.lit(1), "n_critical": (sev == "CRITICAL").cast("int"), "n_high": (sev == "HIGH").cast("int"),
        "n_medium": (sev == "MEDIUM").cast("int"), "max_z": F.abs("z_score"), "top_critical": F.when(sev == "CRITICAL", pick),
        "top_high": F.when(sev == "HIGH", pick), "top": F.array(F.struct(F.lit(1).alias("_rank"), *fields)),
        **{f"_{m}": base.getField(m) for m in fv.BASELINE_METRICS},
    }
    judged = _judged(anomalies.withColumns(own)).withColumn("analyst_confidence", _analyst_confidence())
    effect = _causal_text()
    if "explanation" in anomalies.columns:
        effect = F.concat(effect, F.coalesce(F.concat(F.lit("\n"), F.col("explanation")), F.lit("")))
    texts = {"analyst_output": _analyst_text(), "causal_output": effect, "decision_output": _decision_text("analyst_confidence")}
    return judged.withColumns(texts).drop(*own)


def decision_records(
    anomalies: DataFrame,
    kpi: DataFrame,
    settings: Settings = Settings(),
    model: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Decision record per anomaly: three texts, their history, priority and action.

    By default the rules decide (:func:`rule_based`). A caller's ``model`` gets the
    prompt table and returns it with ``analyst_output``, ``causal_output`` and
    ``decision_output`` (for example through ``mapInPandas``); priority and action
    are then read from its texts.
    """
    if model is None:
        answered = rule_based(anomalies, kpi)
    else:
        answered = model(prompt_table(anomalies)).withColumns(
            {"priority": S.extract_priority("decision_output"), "final_action": S.extract_action("decision_output")}
        )

    def entry(agent: str, rnd: int, text: str) -> Column:
        return F.struct(
            F.lit(agent).alias("agent"), F.lit(rnd).cast("int").alias("round"), F.col(text).alias("content")
        )

    first = [entry("Analyst", 1, "analyst_output"), entry("Causal", 1, "causal_output")]
    revisions = [entry("Analyst", r, "analyst_output") for r in range(2, settings.debate_rounds + 1)]
    said = F.filter(F.array(*revisions), lambda e: F.length(e["content"]) > 20) if revisions else F.array().cast(schemas.HISTORY)
    history = F.concat(F.array(*first), said, F.array(entry("Decision", 1, "decision_output")))
    return answered.withColumns({"debate_history": history, "status": F.lit("PENDING")})


def agents_in(history: str | Column) -> Column:
    """Distinct agents of a history, sorted."""
    return F.sort_array(F.array_distinct(F.transform(S.col(history), lambda e: e["agent"])))


def append_round(history: str | Column, agent: str, rnd: int, content: Column) -> Column:
    added = F.struct(F.lit(agent).alias("agent"), F.lit(rnd).cast("int").alias("round"), content.alias("content"))
    return F.concat(S.col(history), F.array(added))


def map_agent_result(results: DataFrame, max_z: str | Column = "max_z", action_chars: int = ACTION_CHARS) -> DataFrame:
    """External agent answers in the form of a council record.

    Either naming of the answers is accepted; empty texts get a notice,
    priority comes from key words, confidence from the largest z. An answer without
    an action of its own gives its first ``action_chars`` characters.
    """

    def text(*names: str) -> Column:
        known = [F.col(n) for n in names if n in results.columns]
        return F.coalesce(*known, F.lit("")) if known else F.lit("")

    decision = text("final_decision", "decision_output")

    def or_else(c: Column, notice: str) -> Column:
        return F.when(c == "", F.lit(notice)).otherwise(c)

    given = F.col("final_action") if "final_action" in results.columns else F.lit(None).cast("string")
    kept = [c for c in results.columns if c in ("anomaly_id", "region", "category", "doc_id", "conv_id")]
    return results.select(
        *kept,
        or_else(text("anomaly_report", "analyst_output"), "Agent did not return analyst output.").alias("analyst_output"),
        or_else(text("business_report", "causal_output"), "Agent did not return causal output.").alias("causal_output"),
        or_else(decision, "Agent did not return a decision.").alias("decision_output"),
        S.confidence(F.coalesce(S.col(max_z), F.lit(0.0)), fv.CONFIDENCE_PARSED).alias("confidence"),
        F.coalesce(given, F.substring(decision, 1, action_chars)).alias("final_action"),
        S.priority_from_keywords(decision).alias("priority"),
        F.lit(True).alias("completed"),
    )
