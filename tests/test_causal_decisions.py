from __future__ import annotations

import json
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.frames import START
from tidewatch import fixed_values as fv
from tidewatch.functions import scalars as S
from tidewatch.operators import alerts, analytics, causal, decisions, windows


def features(spark, n=80, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.uniform(0, 25, n)
    pdf = pd.DataFrame(
        {
            "region": "North", "category": "Books", "hour_bucket": [START + timedelta(hours=i) for i in range(n)],
            "avg_discount": x, "revenue": 500 + 120 * x + rng.normal(0, 50, n), "return_rate": 0.05 + 0.002 * x + rng.normal(0, 0.02, n),
            "avg_price": rng.uniform(50, 60, n), "order_count": rng.integers(50, 60, n), "avg_qty": rng.uniform(2, 3, n),
        }
    )
    return spark.createDataFrame(pdf), pdf


def test_slopes_match_least_squares(spark):
    df, pdf = features(spark)
    rows = {r["pair_no"]: r for r in causal.ols_ate(df).collect()}
    for i, x, y, _ in causal.available_pairs(pdf.columns):
        assert rows[i]["ate"] == pytest.approx(np.polyfit(pdf[x], pdf[y], 1)[0])
    assert 5 not in rows  # its cause column is absent


def test_findings_repeat_the_plain_slopes(spark):
    df, _ = features(spark)
    plain = {r["pair_no"]: r["ate"] for r in causal.ols_ate(df).collect()}
    found = {r["pair_no"]: r for r in causal.ols_findings(df).collect()}
    for i, ate in plain.items():
        assert found[i]["ate"] == pytest.approx(ate)
        assert 0 <= found[i]["p_value"] <= 1


def test_bootstrap_error_near_the_classical_one(spark):
    df, pdf = features(spark, 200)
    se = {r["pair_no"]: r["se"] for r in causal.bootstrap_se(df).collect()}[1]
    x, y = pdf["avg_discount"], pdf["revenue"]
    b, a = np.polyfit(x, y, 1)
    classical = np.sqrt(((y - a - b * x) ** 2).sum() / 198 / ((x - x.mean()) ** 2).sum())
    assert se == pytest.approx(classical, rel=0.3)


def test_too_few_rows(spark):
    df, _ = features(spark, 4)
    r = causal.ols_findings(df).first()
    assert (r["ate"], r["p_value"], r["confidence"], r["method"]) == (0.0, 1.0, 0.0, "insufficient_data")
    assert causal.best_cause(causal.ols_findings(df)).count() == 0


def test_perfect_line_is_certain(spark):
    rows = [("A", "B", START + timedelta(hours=i), float(i), 3.0 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "region string, category string, hour_bucket timestamp, avg_discount double, revenue double")
    r = causal.ols_findings(df).first()
    assert r["ate"] == pytest.approx(3.0) and r["p_value"] < 0.05


def test_constant_cause_has_no_effect(spark):
    rows = [("A", "B", START + timedelta(hours=i), 5.0, 3.0 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "region string, category string, hour_bucket timestamp, avg_discount double, revenue double")
    assert causal.ols_findings(df).first()["ate"] == 0.0


def test_best_cause_and_attachment(spark):
    df, _ = features(spark)
    best = causal.best_cause(causal.ols_findings(df))
    r = best.first()
    assert r["cause_variable"] == "avg_discount" and r["confidence"] > 0.5 and "North/Books" in r["explanation"]
    a = spark.createDataFrame([("North", "Books", "m1"), ("South", "Books", "m2")], "region string, category string, metric_name string")
    got = {x["region"]: x for x in causal.attach_findings(a, best).collect()}
    assert got["North"]["cause_variable"] == "avg_discount"
    assert (got["South"]["cause_variable"], got["South"]["effect_variable"]) == ("unknown", "m2")
    assert "inconclusive" in got["South"]["explanation"]


def test_backdoor_matches_numpy(spark):
    df, pdf = features(spark)
    r = causal.backdoor_ate(df, "avg_discount", "revenue", limit=3).first()
    m = np.column_stack([np.ones(len(pdf)), pdf["avg_discount"], pdf["order_count"], pdf["avg_price"], pdf["return_rate"]])
    beta, sse, *_ = np.linalg.lstsq(m, pdf["revenue"], rcond=None)
    assert r["ate"] == pytest.approx(beta[1], rel=1e-6)
    se = np.sqrt(sse[0] / (len(pdf) - 5) * np.linalg.inv(m.T @ m)[1, 1])
    assert r["se"] == pytest.approx(se, rel=1e-5)
    every = causal.backdoor_ate(df, "avg_discount", "revenue").first()
    beta = np.linalg.lstsq(np.column_stack([m, pdf["avg_qty"]]), pdf["revenue"], rcond=None)[0]
    assert every["ate"] == pytest.approx(beta[1], rel=1e-6)


def test_random_cause_hardly_moves_the_effect(spark):
    df, _ = features(spark)
    r = causal.refute_random_common_cause(df, "avg_discount", "revenue").first()
    assert r["new_effect"] == pytest.approx(r["ate"], rel=0.05)


@pytest.mark.parametrize(
    "text,priority",
    [("This is P0 critical", "P0"), ("DECISION [P1]: go", "P1"), ("nothing", "P2"), ("P0 and P1", "P0"), ("P3", "P3")],
)
def test_priority(spark, text, priority):
    assert spark.range(1).select(S.extract_priority(F.lit(text)).alias("p")).first()["p"] == priority


@pytest.mark.parametrize(
    "text,action",
    [
        ("Plan:\n  1) Stop the sale \n2) Call", "Stop the sale"),
        ("1. First\n1) Second", "First"),
        ("1)\nrest", ""),
        ("no list " + "x" * 200, ("no list " + "x" * 200)[:128]),
        ("\n  padded  ", "padded"),
        ("1) " + "y" * 200, "y" * 128),
    ],
)
def test_action(spark, text, action):
    assert spark.range(1).select(S.extract_action(F.lit(text)).alias("a")).first()["a"] == action


def anomalies(spark, rows):
    return spark.createDataFrame(
        rows, "metric_name string, metric_value double, expected_value double, z_score double, severity string, region string, category string"
    )


ROWS = [
    ("total_revenue", 90000.0, 10000.0, 9.5, "CRITICAL", "North", "Books"),
    ("return_rate", 0.4, 0.1, -5.0, "MEDIUM", "North", "Books"),
    ("total_revenue", 1.0, 2.0, 3.1, "LOW", "South", "Books"),
]


def kpi(spark):
    return spark.createDataFrame([(10000.0, 100, 0.05, 99.0)], "total_revenue double, total_orders int, return_rate double, avg_order_val double")


def test_verdict_levels(spark):
    by = {r["region"]: r for r in decisions.verdict(anomalies(spark, ROWS), ["region"]).collect()}
    assert by["North"]["priority"] == "P1" and by["South"]["priority"] == "P4"
    assert by["North"]["final_action"].startswith("FREEZE promotions for total_revenue in North.")
    whole = decisions.verdict(anomalies(spark, ROWS)).first()
    assert (whole["n_anomalies"], whole["n_critical"], whole["n_medium"]) == (3, 1, 1)


def test_council_with_and_without_anomalies(spark):
    r = decisions.council(kpi(spark), anomalies(spark, ROWS)).first()
    assert r["priority"] == "P1" and r["confidence"] == pytest.approx(min(0.99, 0.6 + 9.5 * 0.04))
    assert "[1] CRITICAL — TOTAL_REVENUE" in r["analyst_output"] and "+80,000.00" in r["analyst_output"]
    assert r["causal_output"].count("METRIC") == 2  # each metric once
    assert "Critical: 1  |  High: 0  |  Medium: 1" in r["decision_output"]
    quiet = decisions.council(kpi(spark), anomalies(spark, ROWS).limit(0)).first()
    assert quiet["priority"] == "P4" and quiet["confidence"] == fv.CONFIDENCE_QUIET
    assert "NO ANOMALIES" in quiet["analyst_output"] and "$      10,000" in quiet["analyst_output"]
    assert quiet["final_action"] == fv.VERDICTS["quiet"][1]


def test_decision_records_equal_the_council_of_one(spark):
    """Each anomaly gets what the council says about it alone; its attached cause ends the effect report."""
    a = anomalies(spark, ROWS).withColumns({"detected_at": F.lit("t"), "explanation": F.lit("why")})
    said = decisions.decision_records(a, kpi(spark)).collect()
    for r in said:
        one = a.where((F.col("metric_name") == r["metric_name"]) & (F.col("region") == r["region"]))
        alone = decisions.council(kpi(spark), one).first()
        assert all(r[c] == alone[c] for c in ("priority", "final_action", "verdict", "analyst_output", "decision_output"))
        assert r["causal_output"] == alone["causal_output"] + "\nwhy" and r["analyst_confidence"] == alone["confidence"]
        assert [(h["agent"], h["round"]) for h in r["debate_history"]] == [("Analyst", 1), ("Causal", 1), ("Analyst", 2), ("Decision", 1)]
    assert {r["priority"] for r in said} == {"P1", "P3", "P4"}


def test_plugged_in_model(spark):
    a = anomalies(spark, ROWS).withColumns({"detected_at": F.lit("t"), "explanation": F.lit("why")})

    def model(asked):
        return asked.withColumns({"analyst_output": F.lit("ok"), "causal_output": F.lit("c"), "decision_output": F.lit("P0\n1) Act now")})

    r = decisions.decision_records(a, kpi(spark), model=model).first()
    assert (r["priority"], r["final_action"]) == ("P0", "Act now")
    assert len(r["debate_history"]) == 3  # a revision of 20 characters or less is not logged


def test_alert_routing_payloads_and_marking(spark):
    a = anomalies(spark, ROWS).withColumns({"anomaly_id": F.when(F.col("metric_name") == "return_rate", 2).when(F.col("region") == "North", 1).otherwise(3), "window_end": F.lit("2024")})
    d = spark.createDataFrame([(1, "P0", "Act", "Seen"), (2, "P3", "Wait", "Fine")], "anomaly_id int, priority string, final_action string, analyst_output string")
    fired = alerts.route_alerts(a, d, F.lit(datetime(2024, 1, 2)))
    by = {r["anomaly_id"]: r for r in fired.collect()}
    assert by[1]["channels"] == ["pagerduty", "slack", "email"] and by[2]["channels"] == []
    assert (by[3]["priority"], by[3]["action"], by[3]["channels"]) == ("P2", "Review manually", ["slack"])
    payloads = alerts.alert_payloads(fired).collect()
    assert len(payloads) == 4
    pager = json.loads(next(p["payload"] for p in payloads if p["channel"] == "pagerduty"))
    assert pager["dedup_key"] == "anomaly-1-total_revenue" and pager["payload"]["severity"] == "critical"
    made = d.withColumns({"status": F.lit("PENDING"), "metadata": F.create_map(F.lit("alert_fired_at"), F.lit("old"), F.lit("k"), F.lit("v"))})
    marked = {r["anomaly_id"]: r for r in alerts.mark_alerted(made, fired.where("priority = 'P0'")).collect()}
    assert marked[1]["status"] == "ALERTED" and marked[1]["metadata"]["k"] == "v" and marked[1]["metadata"]["alert_fired_at"] != "old"
    assert marked[2]["status"] == "PENDING"


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.1), (3.0, 5.0, None)], "a double, b double, c double")
    r = {(x["x"], x["y"]): x["r"] for x in analytics.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert r[("a", "b")] is None and r[("a", "c")] == pytest.approx(1.0)


def test_first_per_metric_after_top_k(spark):
    got = windows.first_per_metric(anomalies(spark, ROWS), 2).collect()
    assert {r["metric_name"] for r in got} == {"total_revenue", "return_rate"}
