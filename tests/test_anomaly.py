from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.frames import kpi_frame, kpi_rows
from tidewatch.config import Settings
from tidewatch.functions import scalars as S
from tidewatch.operators import anomaly, forest, windows
from tidewatch.operators.quantiles import exact_quantiles


@pytest.mark.parametrize(
    "z,expected",
    [(3.1, "LOW"), (4.5, "MEDIUM"), (7.0, "HIGH"), (9.5, "CRITICAL"), (-5.0, "MEDIUM"), (3.0, "LOW"), (4.0, "MEDIUM"), (9.0, "CRITICAL"), (2.0, "CRITICAL")],
)
def test_severity_bands(spark, z, expected):
    row = spark.range(1).select(S.severity(F.lit(z)).alias("s"), S.severity(F.lit(z), below="NONE").alias("n")).first()
    assert row["s"] == expected
    assert row["n"] == ("NONE" if abs(z) < 3 else expected)


def test_spike_found_and_clean_group_silent(spark):
    k = kpi_frame(spark, kpi_rows(48, "North", spike=90_000.0), kpi_rows(48, "South"))
    found = anomaly.zscore_anomalies(k).collect()
    assert {r["region"] for r in found} == {"North"}
    assert {r["metric_name"] for r in found} == {"total_revenue"}
    assert found[0]["raw_context"]["method"] == "zscore"


def test_window_with_the_current_row_is_bounded(spark):
    k = kpi_frame(spark, kpi_rows(48, spike=9e9))
    z = anomaly.zscore_anomalies(k).first()["z_score"]
    assert z == pytest.approx(23 / 24**0.5, abs=1e-3)
    free = anomaly.zscore_anomalies(k, include_current=False).first()
    assert free["severity"] == "CRITICAL" and free["z_score"] > 1000


def test_rolling_z_matches_pandas(spark):
    k = kpi_frame(spark, kpi_rows(60, spike=30_000.0))
    got = windows.rolling_z(k, ["total_revenue"]).orderBy("snapshot_ts").toPandas()
    s = k.orderBy("snapshot_ts").toPandas()["total_revenue"]
    r = s.rolling(24, min_periods=3)
    want = (s - r.mean()) / r.std().replace(0, np.nan)
    assert np.allclose(got["total_revenue_z"], want, equal_nan=True)


def test_empty_short_and_constant_series(spark):
    assert anomaly.zscore_anomalies(kpi_frame(spark, [])).count() == 0
    assert anomaly.zscore_anomalies(kpi_frame(spark, kpi_rows(3, spike=9e9)), threshold=0.1).count() == 0
    flat = kpi_frame(spark, kpi_rows(30)).withColumn("total_revenue", F.lit(5.0))
    assert windows.rolling_z(flat, ["total_revenue"]).where("total_revenue_z is not null").count() == 0


def test_null_groups_and_nan_values(spark):
    k = kpi_frame(spark, kpi_rows(30), kpi_rows(30, region=None))
    k = k.withColumn("total_revenue", F.when(F.hour("snapshot_ts") == 5, float("nan")).otherwise(F.col("total_revenue")))
    z = windows.rolling_z(k, ["total_revenue"])
    assert z.where("region is null").count() == 0
    assert z.where("isnan(total_revenue_z)").count() == 0


def test_blocks_equal_plain_window(spark):
    df = spark.range(25_000).select(
        F.col("id"), (F.col("id") % 2).alias("g"), (F.col("id") % 97).cast("double").alias("v"), F.floor(F.col("id") / 50).alias("b")
    )
    plain = df.withColumn("m", F.avg("v").over(windows.Window.partitionBy("g").orderBy("id").rowsBetween(-23, 0)))
    cut = windows.in_blocks(df, {"m": lambda w: F.avg("v").over(w)}, ["g"], ["id"], 23, F.col("b"))
    both = plain.alias("p").join(cut.alias("c"), "id")
    assert both.count() == 25_000 == cut.count()
    assert both.where(F.abs(F.col("p.m") - F.col("c.m")) > 1e-9).count() == 0


def test_number_all(spark):
    df = spark.range(0, 30_000, 3).repartition(7)
    out = windows.number_all(df, "id", "n")
    assert out.where(F.col("n") != F.col("id") / 3 + 1).count() == 0 and out.count() == 10_000
    rows = [(None, "x"), (3.5, "b"), (3.5, "a"), (-1.0, None), (float("inf"), "z")]
    two = windows.number_all(spark.createDataFrame(rows, "v double, k string"), [F.col("v").desc(), "k"], "n")
    assert [r["k"] for r in two.orderBy("n").collect()] == ["z", "a", "b", None, "x"] and [r["n"] for r in two.orderBy("n").collect()] == [1, 2, 3, 4, 5]
    assert windows.number_all(df.limit(0), "id", "n").count() == 0


def test_distinct_values_are_counted_up_to_a_bound(spark):
    from tidewatch.operators import analytics

    df = spark.range(5000).select((F.col("id") % 3).alias("three"), F.col("id").alias("many"), F.lit(None).cast("string").alias("none"), (F.col("id") % 21).cast("string").alias("over"), F.when(F.col("id") == 7, "x").alias("one"))
    got = {r["column_name"]: r["n"] for r in analytics.bounded_distinct(df.repartition(5), df.columns, 20).collect()}
    assert got == {"three": 3, "many": 21, "over": 21, "one": 1}
    gate = analytics.cardinality_gate(df, ["many", "none", "gone", "over", "three", "one"])
    assert gate.first().asDict() == {"chosen": "three", "many": 21, "none": 0, "over": 21, "three": 3, "one": 1}
    assert "Expand" not in gate._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_the_largest(spark):
    k = kpi_frame(spark, kpi_rows(48, spike=90_000.0))
    events = anomaly.zscore_anomalies(k, threshold=1.0)
    best = windows.dedup_best(events)
    assert best.count() == events.select("region", "category", "metric_name").distinct().count()
    top = best.where("metric_name = 'total_revenue'").first()
    assert top["metric_value"] == 90_000.0


@pytest.mark.parametrize("q", [0.05, 0.5, 0.9])
@pytest.mark.parametrize("kind", ["smooth", "ties", "two values"])
def test_exact_quantiles_by_narrowing(spark, q, kind):
    rng = np.random.default_rng(3)
    n = 40_001
    x = {"smooth": rng.normal(size=n), "ties": np.round(rng.normal(size=n), 1), "two values": (rng.random(n) < 0.5).astype(float)}[kind]
    df = spark.createDataFrame(pd.DataFrame({"a": x, "b": x[::-1] * 2}))
    got = exact_quantiles(df, ["a", "b"], q, small=500)
    assert got["a"] == pytest.approx(np.quantile(x, q), abs=1e-12)
    assert got["b"] == pytest.approx(np.quantile(x * 2, q), abs=1e-12)


def test_quantiles_pass_over_gaps(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None), (float("inf"), None), (10.0, None), (11.0, None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"]) == {"a": 6.0, "b": None}


# -- isolation forest ----------------------------------------------------------


def _planted(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 2))
    x[17] = (9.0, -9.0)
    pdf = pd.DataFrame({"id": range(600), "a": x[:, 0], "b": x[:, 1]})
    return spark.createDataFrame(pdf)


SMALL_FOREST = Settings(forest_trees=50, forest_sample=128)


def test_forest_finds_the_planted_row(spark):
    df = _planted(spark)
    model = forest.fit(df, ["a", "b"], SMALL_FOREST, keys=["id"])
    scored = forest.score(df, model)
    assert scored.orderBy("isolation_score").first()["id"] == 17
    share = scored.where("is_anomaly").count() / 600
    assert 0.03 <= share <= 0.051


def test_forest_does_not_depend_on_partitioning(spark):
    df = _planted(spark)
    a = forest.fit(df.repartition(1), ["a", "b"], SMALL_FOREST, keys=["id"])
    b = forest.fit(df.repartition(5, "id"), ["a", "b"], SMALL_FOREST, keys=["id"])
    assert a.nodes == b.nodes and a.threshold == b.threshold


def test_trees_draw_from_all_rows_of_a_large_table(spark):
    """Independent samples of 256 of 400,000 rows overlap little; from any fixed part of the rows they would more."""
    n, settings = 400_000, Settings()
    rows = spark.range(n).select("id", F.col("id").cast("double").alias("a"))
    got = forest.tree_samples(rows, ["a"], n, ["id"], settings).toPandas()
    assert (got.groupby("tree").a.nunique() == settings.forest_sample).all() and got.tree.nunique() == settings.forest_trees
    drawn = settings.forest_sample * settings.forest_trees
    assert got.a.nunique() == pytest.approx(n * (1 - (1 - settings.forest_sample / n) ** settings.forest_trees), rel=0.01)
    assert np.histogram(got.a, bins=8, range=(0, n))[0] == pytest.approx(np.full(8, drawn / 8), rel=0.06)
    early, late = (got.loc[got.tree.between(lo, lo + 49), "a"] for lo in (0, 150))
    both = len(np.intersect1d(early, late))
    assert both == pytest.approx((50 * settings.forest_sample) ** 2 / n, rel=0.25)


def test_forest_needs_enough_rows(spark):
    assert forest.fit(kpi_frame(spark, kpi_rows(49))) is None
    assert forest.fit(kpi_frame(spark, kpi_rows(60)), settings=SMALL_FOREST) is not None


def test_mean_path_against_harmonic_numbers():
    assert forest.mean_path(1) == 0 and forest.mean_path(2) == 1
    assert forest.mean_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_detect_has_unique_keys_and_order(spark):
    k = kpi_frame(spark, kpi_rows(60, "North", spike=90_000.0), kpi_rows(60, "South")).checkpoint()
    rows = anomaly.detect(k, Settings(forest_trees=50)).collect()
    keys = [(r["region"], r["category"], r["metric_name"]) for r in rows]
    assert len(keys) == len(set(keys)) and len(rows) >= 1
    sizes = [abs(r["z_score"]) for r in rows]
    assert sizes == sorted(sizes, reverse=True)


def test_column_outliers_stop_rule(spark):
    # 60 outliers in the first column end the search, so the second is not looked at.
    rows = [(float(i % 3), float(i % 5), "x") for i in range(5000)] + [(500.0, 900.0, "y")] * 60
    df = spark.createDataFrame(rows, "a double, b double, c string")
    names = {r["metric_name"] for r in anomaly.column_outliers(df, ["a", "b"], ["c"]).collect()}
    assert names == {"a"}
    both = {r["metric_name"] for r in anomaly.column_outliers(df, ["a", "b"], ["c"], enough=61).collect()}
    assert both == {"a", "b"}
