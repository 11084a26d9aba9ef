"""Causal effects for every (region, category) at once, from bucketed features."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.config import Settings
from tidewatch.functions import scalars as S
from tidewatch.functions import text as X
from tidewatch.operators import analytics, windows

BY = ("region", "category")
# Column order from which the confounders are taken.
FEATURE_ORDER = ("order_count", "avg_price", "avg_discount", "return_rate", "revenue", "avg_qty")

# Poisson(1) distribution function at 0..9, in parts of 2^32.
POISSON_STEPS = (
    1580030169, 3160060337, 3950075422, 4213413783, 4279248374,
    4292415292, 4294609778, 4294923276, 4294962463, 4294966817,
)


def available_pairs(columns: Sequence[str], pairs=fv.CAUSAL_PAIRS) -> list[tuple[int, str, str, str]]:
    return [(i, x, y, why) for i, (x, y, why) in enumerate(pairs, 1) if x in columns and y in columns]


def causal_pairs(features: DataFrame, by: Sequence[str] = BY, pairs=fv.CAUSAL_PAIRS) -> DataFrame:
    """Long form: one row per bucket and candidate pair with cause ``x`` and effect ``y``."""
    cells = [
        F.struct(
            F.lit(i).alias("pair_no"), F.lit(x).alias("cause_variable"), F.lit(y).alias("effect_variable"),
            S.finite(x).alias("x"), S.finite(y).alias("y"),
        )
        for i, x, y, _ in available_pairs(features.columns, pairs)
    ]
    return features.select(*by, "hour_bucket", F.explode(F.array(*cells)).alias("p")).select(*by, "hour_bucket", "p.*")


def _pair_columns(pairs) -> dict[str, Column]:
    """Cause and effect per pair, both NULL unless both are present."""
    out = {}
    for i, x, y, _ in pairs:
        both = S.finite(x).isNotNull() & S.finite(y).isNotNull()
        out[f"x{i}"] = F.when(both, S.finite(x))
        out[f"y{i}"] = F.when(both, S.finite(y))
    return out


def ols_ate(features: DataFrame, by: Sequence[str] = BY, pairs=fv.CAUSAL_PAIRS) -> DataFrame:
    """Slope of effect on cause per group and pair, from one aggregation over the buckets."""
    chosen = available_pairs(features.columns, pairs)
    wide = features.select(*by, *[c.alias(n) for n, c in _pair_columns(chosen).items()])
    sums = []
    for i, *_ in chosen:
        sums += [F.count(f"x{i}").alias(f"n{i}"), F.regr_slope(F.col(f"y{i}"), F.col(f"x{i}")).alias(f"b{i}")]
    rows = wide.groupBy(*by).agg(*sums)
    cells = [
        F.struct(
            F.lit(i).alias("pair_no"), F.lit(x).alias("cause_variable"), F.lit(y).alias("effect_variable"),
            F.lit(why).alias("hypothesis"), F.col(f"n{i}").alias("n_samples"), F.col(f"b{i}").alias("slope"),
        )
        for i, x, y, why in chosen
    ]
    long = rows.select(*by, F.explode(F.array(*cells)).alias("p")).select(*by, "p.*")
    few = F.col("n_samples") < 5
    return long.select(
        *by, "pair_no", "cause_variable", "effect_variable", "hypothesis", "n_samples",
        F.when(few, 0.0).otherwise(F.coalesce("slope", F.lit(0.0))).alias("ate"),
        F.when(few, "insufficient_data").otherwise("ols_bootstrap").alias("method"),
    )


def replicate_draw(row_key: Column, replicate: Column) -> Column:
    """Uniform 32-bit number of a row in a replicate, from md5: the same on every engine."""
    head = F.substring(F.md5(F.concat_ws("|", row_key, replicate.cast("string"))), 1, 8)
    return F.conv(head, 16, 10).cast("bigint")


def poisson_weight(u: Column) -> Column:
    """Poisson(1) weight for a uniform 32-bit number."""
    weight = F.lit(0)
    for step in POISSON_STEPS:
        weight = weight + (u >= F.lit(step)).cast("int")
    return weight


def row_key(by: Sequence[str]) -> Column:
    return F.concat_ws("|", *by, F.date_format("hour_bucket", "yyyy-MM-dd HH:mm:ss"))


def replicate_slopes(
    features: DataFrame, by: Sequence[str] = BY, pairs=fv.CAUSAL_PAIRS, replicates: int = 200
) -> DataFrame:
    """Slope ``b<i>`` and size ``n<i>`` per group, pair and replicate; replicate -1 is the sample itself.

    Every bucket is repeated per replicate, but the weighted moments of all
    pairs are summed map-side, so groups x replicates rows cross the network.
    Values are centred on the group's means first, which keeps the moments
    exact; a group has at most one row per bucket, which bounds that window.
    """
    chosen = available_pairs(features.columns, pairs)
    wide = features.select(*by, row_key(by).alias("_key"), *[c.alias(n) for n, c in _pair_columns(chosen).items()])
    group = Window.partitionBy(*by)
    names = [f"{v}{i}" for i, *_ in chosen for v in "xy"]
    centred = wide.select(*by, "_key", *[(F.col(n) - F.avg(n).over(group)).alias(n) for n in names])
    # Few bytes become many rows below: spread them before, not after.
    spread = centred.repartition(features.sparkSession.sparkContext.defaultParallelism, "_key")
    reps = F.explode(F.sequence(F.lit(-1), F.lit(replicates - 1))).alias("rep")
    # The draw is a column of its own, so that it is computed once per row.
    drawn = spread.select("*", reps).withColumn("_u", replicate_draw(F.col("_key"), F.col("rep")))
    drawn = drawn.withColumn("w", F.when(F.col("rep") < 0, F.lit(1)).otherwise(poisson_weight(F.col("_u"))))
    w = F.col("w")
    sums = []
    for i, *_ in chosen:
        x, y = F.col(f"x{i}"), F.col(f"y{i}")
        sums += [
            F.count(x).alias(f"n{i}"), F.sum(F.when(x.isNotNull(), w)).cast("double").alias(f"w{i}"),
            F.sum(w * x).alias(f"sx{i}"), F.sum(w * y).alias(f"sy{i}"),
            F.sum(w * x * x).alias(f"sxx{i}"), F.sum(w * x * y).alias(f"sxy{i}"),
        ]
    moments = drawn.groupBy(*by, "rep").agg(*sums)

    def slope(i: int) -> Column:
        # No slope for a replicate that drew none of the rows.
        n, sx, sy = F.nullif(F.col(f"w{i}"), F.lit(0.0)), F.col(f"sx{i}"), F.col(f"sy{i}")
        var = F.col(f"sxx{i}") - sx * sx / n
        cov = F.col(f"sxy{i}") - sx * sy / n
        # A resample whose cause does not vary has slope 0.
        return F.when(n.isNotNull(), F.when(var > 1e-12 * F.col(f"sxx{i}"), cov / F.nullif(var, F.lit(0.0))).otherwise(0.0))

    return moments.select(*by, "rep", *[F.col(f"n{i}") for i, *_ in chosen], *[slope(i).alias(f"b{i}") for i, *_ in chosen])


def bootstrap_se(
    features: DataFrame, by: Sequence[str] = BY, pairs=fv.CAUSAL_PAIRS, replicates: int = 200
) -> DataFrame:
    """Standard error of each slope over weighted resamples of the buckets."""
    chosen = available_pairs(features.columns, pairs)
    slopes = replicate_slopes(features, by, pairs, replicates).where("rep >= 0")
    errors = slopes.groupBy(*by).agg(*[F.stddev_pop(f"b{i}").alias(f"se{i}") for i, *_ in chosen])
    cells = [F.struct(F.lit(i).alias("pair_no"), F.col(f"se{i}").alias("se")) for i, *_ in chosen]
    return errors.select(*by, F.explode(F.array(*cells)).alias("p")).select(*by, "p.*")


def p_value(ate: Column, se: Column) -> Column:
    """2 * (1 - min(|t| / 2, 0.999)), kept within [0, 1]."""
    t = F.abs(ate / (se + F.lit(1e-9)))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * (1 - F.least(t / 2, F.lit(0.999)))))


def ols_findings(features: DataFrame, by: Sequence[str] = BY, pairs=fv.CAUSAL_PAIRS, settings: Settings = Settings()) -> DataFrame:
    """Effect, error, p-value and confidence of every pair in every group, from one pass over the features."""
    chosen = available_pairs(features.columns, pairs)
    slopes = replicate_slopes(features, by, pairs, settings.bootstrap_replicates)
    whole = F.col("rep") < 0
    stats = []
    for i, *_ in chosen:
        stats += [
            F.max(F.when(whole, F.col(f"n{i}"))).alias(f"n{i}"), F.max(F.when(whole, F.col(f"b{i}"))).alias(f"a{i}"),
            F.stddev_pop(F.when(~whole, F.col(f"b{i}"))).alias(f"se{i}"),
        ]
    cells = [
        F.struct(
            F.lit(i).alias("pair_no"), F.lit(x).alias("cause_variable"), F.lit(y).alias("effect_variable"),
            F.lit(why).alias("hypothesis"), F.coalesce(f"n{i}", F.lit(0)).alias("n_samples"),
            F.col(f"a{i}").alias("slope"), F.col(f"se{i}").alias("se"),
        )
        for i, x, y, why in chosen
    ]
    both = slopes.groupBy(*by).agg(*stats).select(*by, F.explode(F.array(*cells)).alias("p")).select(*by, "p.*")
    few = F.col("n_samples") < 5
    out = both.withColumns(
        {
            "ate": F.when(few, 0.0).otherwise(F.coalesce("slope", F.lit(0.0))),
            "method": F.when(few, "insufficient_data").otherwise("ols_bootstrap"),
        }
    ).drop("slope")
    p = F.when(few, F.lit(1.0)).otherwise(p_value(F.col("ate"), F.coalesce("se", F.lit(0.0))))
    out = out.withColumn("p_value", p).withColumn("confidence", F.greatest(F.lit(0.0), 1 - F.col("p_value")))
    note = F.when(few, F.lit("")).otherwise(F.concat(F.lit("Bootstrap SE="), X.num("se", "%.4f", 4)))
    return out.withColumn("refutation", note)


# -- adjustment for confounders ------------------------------------------------------


def confounders(columns: Sequence[str], x: str, y: str, limit: int | None = None) -> list[str]:
    """The features besides x and y, the first ``limit`` of them; None for all."""
    ordered = [c for c in FEATURE_ORDER if c in columns] + [c for c in columns if c.startswith("evt_")]
    return [c for c in ordered if c not in (x, y)][:limit]


def _solver(width: int):
    """Regression of the last column on the others from centred cross-moments.

    One row per group arrives; a batch is solved with one stacked call.
    """

    def solve(n: pd.Series, flat: pd.Series) -> pd.DataFrame:
        k = width
        m = np.array(flat.tolist(), dtype=float).reshape(len(flat), k, k)
        count = n.to_numpy(dtype=float)
        a, b = m[:, : k - 1, : k - 1], m[:, : k - 1, k - 1]
        # Unit diagonal first: features differ by orders of magnitude.
        scale = np.sqrt(np.maximum(np.einsum("gii->gi", a), 1e-300))
        corr = a / scale[:, :, None] / scale[:, None, :]
        inverse = np.linalg.pinv(corr, rcond=1e-10, hermitian=True)
        beta = np.einsum("gij,gj->gi", inverse, b / scale) / scale
        sse = np.maximum(m[:, k - 1, k - 1] - np.einsum("gi,gi->g", beta, b), 0.0)
        dof = np.maximum(count - k, 1.0)
        var = sse / dof * np.einsum("gii->gi", inverse)[:, 0] / scale[:, 0] ** 2
        return pd.DataFrame({"ate": beta[:, 0], "se": np.sqrt(np.maximum(var, 0.0))})

    return solve


def backdoor_ate(
    features: DataFrame, x: str, y: str, controls: Sequence[str] | None = None, by: Sequence[str] = BY, limit: int | None = None
) -> DataFrame:
    """Effect of x on y with ``controls`` held fixed, per group; without them the first ``limit`` confounders, None for all.

    Means and cross-moments are aggregated by Spark; a task then solves one
    small linear system per group. Needs five complete rows.
    """
    controls = confounders(features.columns, x, y, limit) if controls is None else list(controls)
    cols = [x, *controls, y]
    rows = features.select(*by, *[S.finite(c).alias(f"c{i}") for i, c in enumerate(cols)]).dropna(
        subset=[f"c{i}" for i in range(len(cols))]
    )
    k = len(cols)
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        *[F.covar_pop(f"c{i}", f"c{j}").alias(f"m_{i}_{j}") for i, j in upper],
    )
    flat = F.array(*[F.col(f"m_{min(i, j)}_{max(i, j)}") * F.col("n_samples") for i in range(k) for j in range(k)])
    solve = F.pandas_udf("ate double, se double")(_solver(k))
    fitted = sums.withColumn("_fit", solve(F.col("n_samples"), flat))
    few = F.col("n_samples") < 5
    ate = F.when(few, 0.0).otherwise(F.col("_fit.ate"))
    se = F.when(few, 0.0).otherwise(F.col("_fit.se"))
    out = fitted.select(*by, "n_samples", ate.alias("ate"), se.alias("se")).withColumns(
        {"cause_variable": F.lit(x), "effect_variable": F.lit(y)}
    )
    few = F.col("n_samples") < 5
    p = F.when(few, F.lit(1.0)).otherwise(p_value(F.col("ate"), F.col("se")))
    return out.withColumn("confidence", F.greatest(F.lit(0.0), 1 - p)).withColumn(
        "method", F.when(few, "insufficient_data").otherwise("backdoor_linear_regression")
    )


def refute_random_common_cause(features: DataFrame, x: str, y: str, by: Sequence[str] = BY, seed: int = 42, limit: int | None = None) -> DataFrame:
    """Effect before and after adding an unrelated random confounder; a sound effect hardly moves."""
    head = F.substring(F.md5(F.concat_ws("|", row_key(by), F.lit(str(seed)))), 1, 8)
    noise = F.conv(head, 16, 10).cast("double") / F.lit(float(2**32))
    controls = confounders(features.columns, x, y, limit)
    before = backdoor_ate(features, x, y, controls, by)
    after = backdoor_ate(features.withColumn("random_cause", noise), x, y, [*controls, "random_cause"], by)
    return before.join(after.select(*by, F.col("ate").alias("new_effect")), list(by))


# -- every pair adjusted at once -----------------------------------------------------


def cross_moments(features: DataFrame, columns: Sequence[str], by: Sequence[str] = BY) -> DataFrame:
    """(by, n_samples, moments): centred sums of products of all columns over the complete rows of each group, row by row; one aggregation."""
    k = len(columns)
    rows = features.select(*by, *[S.finite(c).alias(f"c{i}") for i, c in enumerate(columns)]).dropna(subset=[f"c{i}" for i in range(k)])
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        *[F.covar_pop(f"c{i}", f"c{j}").alias(f"m_{i}_{j}") for i in range(k) for j in range(i, k)],
    )
    flat = F.array(*[F.col(f"m_{min(i, j)}_{max(i, j)}") * F.col("n_samples") for i in range(k) for j in range(k)])
    return sums.select(*by, "n_samples", flat.alias("moments"))


def sweep(m: np.ndarray, k: int, swept: np.ndarray, back: bool = False, least: float = 1e-10) -> np.ndarray:
    """Sweeps column k of a stack of symmetric matrices in place, or takes the sweep back; ``swept`` tells which matrices have it.

    A column that the ones swept before determine has next to no pivot left and is passed over.
    """
    pivot = m[:, k, k].copy()
    here = swept & (pivot < 0) if back else ~swept & (pivot > least)
    d = np.where(here, pivot, 1.0)
    row = m[:, k, :].copy()
    col = m[:, :, k].copy()
    out = m - col[:, :, None] * row[:, None, :] / d[:, None, None]
    sign = -1.0 if back else 1.0
    out[:, k, :] = sign * row / d[:, None]
    out[:, :, k] = sign * col / d[:, None]
    out[:, k, k] = -1.0 / d
    m[here] = out[here]
    return here


def swept_effects(moments: np.ndarray, counts: np.ndarray, pairs: Sequence[tuple[int, int]]) -> np.ndarray:
    """(ate, se, known) of y on x for each group and pair of columns, all other columns held fixed.

    All columns are swept once; taking back the sweep of y leaves the regression of y on all others, for each x at once.
    """
    scale = np.sqrt(np.maximum(np.einsum("gii->gi", moments), 1e-300))
    m = moments / scale[:, :, None] / scale[:, None, :]
    k = m.shape[1]
    done = np.zeros(m.shape[:2], dtype=bool)
    for i in range(k):
        done[:, i] = sweep(m, i, done[:, i])
    out = np.zeros((len(m), len(pairs), 3))
    for y in {y for _, y in pairs}:
        own = m.copy()
        sweep(own, y, done[:, y], back=True)
        for at, (x, target) in enumerate(pairs):
            if target != y:
                continue
            others = done.sum(axis=1) - done[:, y]
            dof = counts - others - 1
            sse = np.maximum(own[:, y, y], 0.0)
            spread = np.sqrt(np.maximum(-own[:, x, x], 0.0) * sse / np.maximum(dof, 1.0))
            ratio = scale[:, y] / scale[:, x]
            out[:, at] = np.stack([own[:, x, y] * ratio, spread * ratio, done[:, x] & (dof > 0) & (counts > k)], axis=1)
    return out


def adjusted_ate(features: DataFrame, by: Sequence[str] = BY, pairs=fv.CAUSAL_PAIRS) -> DataFrame:
    """Effect of every candidate pair with all other features held fixed, per group: one aggregation, one small solve per group.

    ``known`` is false where a group has no more complete rows than features, or the features before it determine the cause; effect and
    confidence are 0 there.
    """
    columns = [c for c in FEATURE_ORDER if c in features.columns] + [c for c in features.columns if c.startswith("evt_")]
    chosen = [p for p in available_pairs(features.columns, pairs) if p[1] in columns and p[2] in columns]
    places, k = [(columns.index(x), columns.index(y)) for _, x, y, _ in chosen], len(columns)

    @F.pandas_udf("array<array<double>>")
    def solve(n: pd.Series, flat: pd.Series) -> pd.Series:
        found = swept_effects(np.array(flat.tolist(), dtype=float).reshape(len(flat), k, k), n.to_numpy(dtype=float), places)
        return pd.Series(found.tolist())

    cells = [
        F.struct(F.lit(i).alias("pair_no"), F.lit(x).alias("cause_variable"), F.lit(y).alias("effect_variable"), F.lit(why).alias("hypothesis"), F.lit(at).alias("at"))
        for at, (i, x, y, why) in enumerate(chosen)
    ]
    fitted = cross_moments(features, columns, by).withColumn("_fit", solve("n_samples", "moments"))
    long = fitted.select(*by, "n_samples", "_fit", F.explode(F.array(*cells)).alias("p")).select(*by, "n_samples", "p.*", F.get("_fit", F.col("p.at")).alias("f")).drop("at")
    known = (F.col("f")[2] > 0) & (F.col("n_samples") >= 5)
    out = long.select(
        *by, "pair_no", "cause_variable", "effect_variable", "hypothesis", "n_samples", known.alias("known"),
        F.when(known, F.col("f")[0]).otherwise(0.0).alias("ate"), F.when(known, F.col("f")[1]).otherwise(0.0).alias("se"),
    )
    p = F.when(F.col("known"), p_value(F.col("ate"), F.col("se"))).otherwise(F.lit(1.0))
    out = out.withColumn("p_value", p).withColumn("confidence", F.greatest(F.lit(0.0), 1 - F.col("p_value")))
    return out.withColumn("method", F.when(F.col("known"), "backdoor_linear_regression").otherwise("insufficient_data"))


def adjusted_findings(features: DataFrame, by: Sequence[str] = BY, pairs=fv.CAUSAL_PAIRS, settings: Settings = Settings()) -> DataFrame:
    """The adjusted effect of each group and pair, and the plain slope with its bootstrap error where there is none."""
    adjusted = adjusted_ate(features, by, pairs)
    plain = ols_findings(features, by, pairs, settings)
    keys = [*by, "pair_no"]
    shared = ["cause_variable", "effect_variable", "hypothesis", "n_samples", "ate", "se", "p_value", "confidence", "method"]
    both = adjusted.select(*keys, "known", F.struct(*shared).alias("a")).join(plain.select(*keys, F.struct(*shared).alias("b")), keys, "full_outer")
    pick = F.when(F.coalesce("known", F.lit(False)), F.col("a")).otherwise(F.coalesce("b", "a"))
    return both.select(*keys, pick.alias("r")).select(*keys, "r.*")


# -- choice of the cause -----------------------------------------------------------------


def best_cause(findings: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Most confident pair per group, the earlier pair on ties; only confidences above 0 count."""
    useful = findings.where(F.col("confidence") > 0)
    best = windows.first_per_key(useful, list(by), [-F.col("confidence"), F.col("pair_no")])
    region, category = by
    return best.withColumn(
        "explanation",
        X.causal_explanation("cause_variable", "effect_variable", region, category, "ate", "confidence", "hypothesis"),
    )


def attach_findings(anomalies: DataFrame, findings: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Every anomaly with the finding of its group, or an inconclusive one where there is none."""
    found = findings.select(
        *by, "cause_variable", "effect_variable", "ate", "confidence", "method", "hypothesis",
        F.col("explanation").alias("_why"), F.lit(True).alias("_found"),
    )
    joined = anomalies.join(found, list(by), "left")
    reason = F.lit("no_causal_pairs_matched")
    return joined.withColumns(
        {
            "cause_variable": F.coalesce("cause_variable", F.lit("unknown")),
            "effect_variable": F.when(F.col("_found"), F.col("effect_variable")).otherwise(
                F.coalesce("metric_name", F.lit("unknown"))
            ),
            "ate": F.coalesce("ate", F.lit(0.0)),
            "confidence": F.coalesce("confidence", F.lit(0.0)),
            "method": F.coalesce("method", reason),
            "hypothesis": F.coalesce("hypothesis", F.lit("No causal structure identified")),
            "explanation": F.coalesce("_why", X.inconclusive_explanation("region", "category", reason)),
        }
    ).drop("_why", "_found")


# -- interactive variants -------------------------------------------------------------------


def correlation_impact(kpi: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation of every other numeric column with the target, strongest first."""
    others = [c for c in (columns or analytics.numeric_columns(kpi)) if c != target]
    clean = analytics.finite_columns(kpi, [*others, target])
    wide = clean.agg(*[analytics.pearson(c, target).alias(c) for c in others])
    return (
        wide.unpivot([], others, "cause_variable", "ate")
        .withColumns(
            {
                "confidence": F.abs("ate"),
                "effect_variable": F.lit(target),
                "method": F.lit("Correlation Proxy"),
                "explanation": F.lit("Derived from Pearson correlation with target metric."),
            }
        )
        .orderBy(F.col("confidence").desc_nulls_last(), "cause_variable")
    )


def anomaly_ate(anomalies: DataFrame, kpi: DataFrame, k: int = 8) -> DataFrame:
    """Effect against expectation for the top anomalies, one per metric."""
    top = windows.first_per_metric(anomalies, k)
    base = analytics.kpi_baseline(kpi).select(F.struct("total_revenue", "return_rate").alias("b")).scalar()
    z = F.abs("z_score")
    ate = S.ate_delta("metric_value", "expected_value")
    return top.select(
        F.col("metric_name").alias("cause_variable"),
        F.lit("business_outcome").alias("effect_variable"),
        F.round(ate, 4).alias("ate"),
        F.round(S.ate_pct("metric_value", "expected_value"), 1).alias("ate_pct"),
        F.round(S.confidence(z), 3).alias("confidence"),
        F.round(z, 2).alias("z_score"),
        F.coalesce("severity", F.lit("MEDIUM")).alias("severity"),
        "region",
        F.lit("Z-score + ATE (live)").alias("method"),
        X.causal_narrative("metric_name", ate, z, base.getField("total_revenue"), base.getField("return_rate")).alias("explanation"),
    )
