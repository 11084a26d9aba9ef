"""Cases in which a search could run on, or rows could get lost."""

from datetime import datetime, timedelta

import __spark_entry__ as entry
from tidewatch import fixed_values as fv
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.operators import analytics, anomaly, causal, profile, quality, windows
from tidewatch.sources import adapters
import numpy as np
from pyspark.sql import functions as F


def test_neighbouring_doubles_and_wide_ranges_end(spark):
    for values in ([1.0000000000000002] * 15 + [1.0000000000000004] * 15, [-1.7e308] * 15 + [1.7e308] * 15, [5e-324] * 15 + [0.0] * 15, [3.0] * 40 + [7.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        want = sorted(values)
        got = exact_quantiles(df, ["v"], 0.25, small=1)["v"]
        at = 0.25 * (len(values) - 1)
        low, high = want[int(at)], want[min(int(at) + 1, len(want) - 1)]
        assert got == low + (high - low) * (at - int(at))


def test_blocks_keep_rows_without_key_or_time(spark):
    rows = [(None if i % 3 == 0 else "a", None if i % 5 == 0 else i, i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, t long, i long")
    got = windows.in_blocks(df, {"n": lambda w: F.count("i").over(w)}, ["k"], ["t", "i"], 2, F.floor(F.col("t") / 10))
    assert sorted(r.i for r in got.collect()) == list(range(30))


def test_all_columns_and_cells_have_outliers(spark):
    rows = [tuple(float(i % (k + 3)) for k in range(6)) for i in range(5000)] + [(900.0,) * 6] * 60
    df = spark.createDataFrame(rows, ", ".join(f"c{k} double" for k in range(6)))
    got = anomaly.column_outliers(df, df.columns, []).groupBy("metric_name").count().collect()
    assert {r["metric_name"]: r["count"] for r in got} == {f"c{k}": 60 for k in range(6)}
    few = spark.createDataFrame([(float(i % 3),) * 5 + (900.0 if i == 0 else 0.0,) for i in range(500)], df.schema)
    assert [r["metric_name"] for r in anomaly.column_outliers(few, few.columns, []).collect()] == ["c5"]


def test_insight_looks_at_all_categories(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")] * 9, "w string, x string, y string, z string")
    got = profile.insight(df, [], df.columns, "sales").orderBy("position").collect()
    assert [t["text"][:3] for t in got[:-1]] == ["`w`", "`x`", "`y`", "`z`"] and got[-1]["text"].startswith("Dataset is")
    assert [r["position"] for r in profile.insight(df, [], ["w"], "sales").orderBy("position").collect()] == [1, 3]


def test_all_confounders_are_held_fixed(spark):
    rng = np.random.default_rng(5)
    names = ["order_count", "avg_price", "avg_discount", "return_rate", "avg_qty", "evt_view"]
    x = rng.normal(size=(80, 6))
    y = x @ np.array([1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) + rng.normal(size=80)
    x[:, 2] += x[:, 4] + x[:, 5]
    rows = [("N", "B", datetime(2024, 1, 1) + timedelta(hours=i), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "region string, category string, hour_bucket timestamp, " + ", ".join(f"{n} double" for n in [*names, "revenue"]))
    beta = np.linalg.lstsq(np.column_stack([np.ones(80), x]), y, rcond=None)[0]
    assert abs(causal.backdoor_ate(df, "avg_discount", "revenue").first()["ate"] - beta[3]) < 1e-6
    assert abs(causal.refute_random_common_cause(df, "avg_discount", "revenue").first()["ate"] - beta[3]) < 1e-6


def test_row_count_without_upper_limit(spark):
    got = quality.validate(spark.range(3), "t", [quality.expect_row_count_between(1, None), quality.expect_row_count_between(1, 2)]).orderBy("check_no").collect()
    assert [(r["passed"], r["detail"]) for r in got] == [(True, "3 rows (expected at least 1)"), (False, "3 rows (expected 1–2)")]


def test_suites_have_no_row_limit(spark):
    o = quality.raw_orders_suite(datetime(2024, 1, 1))
    k = quality.kpi_snapshots_suite(datetime(2024, 1, 1))
    for suite in (o, k):
        first = quality.validate(spark.range(3), "t", suite[:1]).first()
        assert first["detail"] == "3 rows (expected at least 1)"


def test_gate_counts_all_distinct_values(spark, sf):
    """the counts of the query are whole, above the 20 values of the gate too."""
    df = spark.range(5000).select(F.col("id").alias("many"), (F.col("id") % 21).alias("over"), (F.col("id") % 3).alias("three"), F.lit(None).cast("string").alias("none"))
    gate = analytics.cardinality_gate(df.repartition(5), ["many", "gone", "over", "three", "none"], exact=True)
    assert gate.first().asDict() == {"chosen": "three", "many": 5000, "over": 21, "three": 3, "none": 0}
    got = entry.queries()["cardinality_gate"](spark, sf).first()
    assert got["product_id"] == adapters.raw_orders(spark, sf).select("product_id").distinct().count() > 21


def test_orders_quality_judges_both_ends_of_the_row_count(spark, sf, monkeypatch):
    """the query's row count has its upper limit."""
    run = lambda: {r["name"]: r for r in entry.queries()["orders_quality"](spark, sf).collect()}["row_count"]
    n = adapters.dirty_orders(spark, sf).count()
    assert (run()["passed"], run()["detail"]) == (True, f"{n} rows (expected 1–10000000)")
    monkeypatch.setattr(fv, "MOST_ORDERS", n - 1)
    assert (run()["passed"], run()["detail"]) == (False, f"{n} rows (expected 1–{n - 1})")


def test_quality_report_shows_the_row_limit(spark, sf, monkeypatch):
    """the report's row count has its upper limit, and counts among the failed checks beyond it."""
    run = lambda: entry.queries()["orders_quality_report"](spark, sf).first()
    n = adapters.dirty_orders(spark, sf).count()
    within = run()
    monkeypatch.setattr(fv, "MOST_ORDERS", n - 1)
    beyond = run()
    assert f"✅ row_count: {n} rows (expected 1–10000000)" in within["summary"]
    assert f"❌ row_count: {n} rows (expected 1–{n - 1})" in beyond["summary"]
    assert beyond["passed_checks"] == within["passed_checks"] - 1


def test_kpi_quality_judges_both_ends_of_the_row_count(spark, sf, monkeypatch):
    """the query's row count has its upper limit."""
    run = lambda: {r["name"]: r for r in entry.queries()["kpi_quality"](spark, sf).collect()}["row_count"]
    n = adapters.order_kpis(spark, sf).count()
    assert (run()["passed"], run()["detail"]) == (True, f"{n} rows (expected 1–5000000)")
    monkeypatch.setattr(fv, "MOST_SNAPSHOTS", n - 1)
    assert (run()["passed"], run()["detail"]) == (False, f"{n} rows (expected 1–{n - 1})")


def _features(seed: int, rows: int, group: str, **fixed):
    rng = np.random.default_rng(seed)
    names = ["order_count", "avg_price", "avg_discount", "return_rate", "avg_qty", "evt_view"]
    x = rng.normal(size=(rows, 6)) * [100, 20, 1, 0.01, 3, 50] + [500, 80, 5, 0.05, 4, 900]
    x[:, 2] += x[:, 4] / 3
    for name, like in fixed.items():
        x[:, names.index(name)] = x[:, names.index(like)] * 2 + 1
    y = x @ np.array([3.0, 10.0, 40.0, -500.0, 8.0, 0.1]) + rng.normal(size=rows)
    return names, x, y, [(group, "B", datetime(2024, 1, 1) + timedelta(hours=i), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]


def test_sweeping_gives_the_effects_of_least_squares(spark):
    """Every pair of every group against a regression of its own; a cause that another feature determines, and few rows, are not known."""
    names, x, y, rows = _features(1, 90, "N")
    _, x2, y2, rows2 = _features(2, 60, "S", avg_qty="avg_price")
    df = spark.createDataFrame([*rows, *rows2, *_features(3, 6, "W")[3]], "region string, category string, hour_bucket timestamp, " + ", ".join(f"{n} double" for n in [*names, "revenue"]))
    found = {(r["region"], r["cause_variable"], r["effect_variable"]): r for r in causal.adjusted_ate(df).collect()}
    table = np.column_stack([x, y])
    columns = [*names, "revenue"]
    for (region, cause, effect), r in found.items():
        if region != "N":
            continue
        others = [i for i, c in enumerate(columns) if c != effect]
        design = np.column_stack([np.ones(90), table[:, others]])
        target = table[:, columns.index(effect)]
        beta, sse = np.linalg.lstsq(design, target, rcond=None)[:2]
        at = 1 + others.index(columns.index(cause))
        se = np.sqrt(sse[0] / (90 - design.shape[1]) * np.linalg.inv(design.T @ design)[at, at])
        assert abs(r["ate"] - beta[at]) < 1e-6 * max(1, abs(beta[at])) and abs(r["se"] / se - 1) < 1e-5
    assert not any(r["known"] for (region, *_), r in found.items() if region == "W")
    twins = [r["known"] for (region, cause, effect), r in found.items() if region == "S" and cause in ("avg_price", "avg_qty") and effect not in ("avg_price", "avg_qty")]
    assert twins and not all(twins)
    both = {(r["region"], r["cause_variable"], r["effect_variable"]): r["method"] for r in causal.adjusted_findings(df).collect()}
    assert set(both) == set(found) and all((m == "backdoor_linear_regression") == found[k]["known"] for k, m in both.items())
