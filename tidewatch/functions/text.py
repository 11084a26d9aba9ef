"""Generated texts: explanations, narratives, alert bodies, reports, prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.scalars import ate_delta, ate_pct, col, confidence, lookup, magnitude, signal

RULE = "━" * 40


def num(c: str | Column, fmt: str, digits: int) -> Column:
    """Formatted number, rounded half-up before formatting so that engines agree.

    A negative number that rounds to zero keeps its sign."""
    x = col(c).cast("double")
    rounded = F.round(x, digits)
    return F.format_string(fmt, F.when((rounded == 0) & (x < 0), F.lit(-0.0)).otherwise(rounded))


def money(c: str | Column) -> Column:
    return num(c, "%,.2f", 2)


def percent(c: str | Column, digits: int = 0) -> Column:
    return num(col(c) * 100, f"%.{digits}f%%", digits)


def causal_explanation(cause, effect, region, category, ate, conf, hypothesis) -> Column:
    return F.concat(
        col(cause), F.lit(" caused "), col(effect), F.lit(" anomaly in "), col(region), F.lit("/"), col(category),
        F.lit(" with ATE="), num(ate, "%.4f", 4), F.lit(" and confidence="), percent(conf, 2),
        F.lit(". Hypothesis: "), col(hypothesis), F.lit("."),
    )


def inconclusive_explanation(region, category, reason) -> Column:
    return F.concat(
        F.lit("Causal analysis inconclusive for "), col(region), F.lit("/"), col(category), F.lit(": "), col(reason)
    )


def causal_narrative(metric, ate, z, baseline_revenue: Column | None = None, baseline_return: Column | None = None) -> Column:
    """Hypothesis for metric and direction, with the baseline where it is known and not 0."""
    m, a = col(metric), col(ate)
    direction = F.when(a > 0, "spike").otherwise("drop")
    base = lookup(
        F.concat_ws("|", m, direction),
        [(f"{name}|{way}", text) for name, way, text in fv.HYPOTHESES],
        F.lit(fv.HYPOTHESIS_UNKNOWN),
    )
    addendum = F.lit("")
    if baseline_return is not None:
        addendum = F.when(
            (m == "return_rate") & (F.coalesce(baseline_return, F.lit(0.0)) != 0),
            F.concat(F.lit(" Mean return rate "), percent(baseline_return, 1), F.lit("; breach threshold >15%.")),
        ).otherwise(addendum)
    if baseline_revenue is not None:
        addendum = F.when(
            (m == "total_revenue") & (F.coalesce(baseline_revenue, F.lit(0.0)) != 0),
            F.concat(
                F.lit(" Baseline avg $"), num(baseline_revenue, "%,.0f", 0), F.lit(" — deviation is "),
                percent(F.abs(a) / F.greatest(baseline_revenue, F.lit(1.0))), F.lit(" of mean."),
            ),
        ).otherwise(addendum)
    return F.concat(F.lit("["), magnitude(z), F.lit(" "), F.upper(direction), F.lit("] "), base, addendum)


def alert_title(sev, region, category, metric, z) -> Column:
    return F.concat(
        col(sev), F.lit(" anomaly in "), col(region), F.lit("/"), col(category), F.lit(": "), col(metric),
        F.lit(" deviated "), num(z, "%.1f", 1), F.lit("σ"),
    )


def alert_body(detected_at, value, expected, assessment, most_chars: int = 300) -> Column:
    """Body of an alert; of the assessment its first ``most_chars`` characters."""
    return F.concat(
        F.lit("Detected at "), col(detected_at).cast("string"), F.lit(".\nValue: "), col(value).cast("string"),
        F.lit(" (expected "), col(expected).cast("string"), F.lit(").\nAgent assessment: "),
        F.substring(F.coalesce(col(assessment), F.lit("")), 1, most_chars),
    )


def anomaly_context(a: str = "", explanation: str | Column = "explanation") -> Column:
    """Report of one anomaly and its cause, as handed to a decision maker."""
    fields = [
        ("Metric", "metric_name"), ("Value", "metric_value"), ("Expected", "expected_value"),
        ("Z-score", "z_score"), ("Severity", "severity"), ("Region", "region"),
        ("Category", "category"), ("Detected", "detected_at"),
    ]
    lines = [
        F.concat(F.lit(f"  {label + ':':<11}"), F.coalesce(F.col(a + name).cast("string"), F.lit("None")))
        for label, name in fields
    ]
    cause = F.concat(F.lit("  "), F.coalesce(col(explanation), F.lit("No causal analysis available.")))
    return F.concat_ws("\n", F.lit("ANOMALY REPORT:"), *lines, F.lit(""), F.lit("CAUSAL ANALYSIS:"), cause)


# -- report lines over an element of a top-k array -----------------------------------


def detection_lines(e: Column, position: Column) -> Column:
    """Six lines of the detection report for one anomaly struct."""
    diff = ate_delta(e["metric_value"], e["expected_value"])
    return F.concat_ws(
        "\n",
        F.concat(F.lit("  ["), position.cast("string"), F.lit("] "), e["severity"], F.lit(" — "), F.upper(e["metric_name"])),
        F.concat(F.lit("      Region   : "), e["region"]),
        F.concat(F.lit("      Observed : "), money(e["metric_value"])),
        F.concat(F.lit("      Expected : "), money(e["expected_value"])),
        F.concat(F.lit("      Delta    : "), num(diff, "%+,.2f", 2), F.lit("  (z="), num(F.abs(e["z_score"]), "%.2f", 2), F.lit("σ)")),
        F.concat(F.lit("      Signal   : "), signal(e["z_score"])),
        F.lit(""),
    )


def cause_lines(e: Column, baseline_revenue: Column | None, baseline_return: Column | None) -> Column:
    """Four lines of the effect report for one anomaly struct."""
    ate = ate_delta(e["metric_value"], e["expected_value"])
    pct = ate_pct(e["metric_value"], e["expected_value"])
    z = F.abs(e["z_score"])
    return F.concat_ws(
        "\n",
        F.concat(F.lit("  METRIC  : "), F.upper(e["metric_name"])),
        F.concat(F.lit("  ATE     : "), num(ate, "%+,.4f", 4), F.lit("   ("), num(pct, "%+.1f%%", 1), F.lit(" from baseline)")),
        F.concat(F.lit("  z-score : "), num(z, "%.2f", 2), F.lit("σ      Confidence: "), percent(confidence(z))),
        F.concat(F.lit("  CAUSE   : "), causal_narrative(e["metric_name"], ate, z, baseline_revenue, baseline_return)),
        F.lit(""),
    )


def event_prompt(metric, sev, region, observed, expected, z) -> Column:
    """Question about a single live event."""
    return F.concat(
        F.lit("SINGLE EVENT ALERT:\nMetric  : "), col(metric), F.lit("\nRegion  : "), col(region),
        F.lit("\nSeverity: "), col(sev), F.lit("\nObserved: "), num(observed, "%.2f", 2),
        F.lit("  (Expected: "), num(expected, "%.2f", 2), F.lit(")\nZ-score : "), num(z, "%.2f", 2),
        F.lit("σ\n\nProvide: (1) what this anomaly means, (2) likely root cause, "
              "(3) immediate action in 3 bullet points."),
    )
