"""Isolation forest: sampled trees grown in parallel tasks, scored in Arrow batches.

Each tree sees ``forest_sample`` rows chosen by a hash of the row's content, so
the model does not depend on partitioning or run. A model has at most
``trees * (2 * sample - 1)`` nodes whatever the data size, which is the bound
that lets the nodes be shared with every task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.config import Settings
from tidewatch.functions.scalars import finite
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.session import stored

NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, path double"
EULER_GAMMA = 0.5772156649015329


@dataclass(frozen=True)
class ForestModel:
    features: tuple[str, ...]
    nodes: list[tuple]  # rows of NODE_SCHEMA, bounded by trees * (2 * sample - 1)
    sample: int
    trees: int
    threshold: float
    fitted_rows: int


def mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


def _complete(df: DataFrame, features: Sequence[str]) -> DataFrame:
    rows = df.withColumns({f: finite(f) for f in features})
    return rows.where(F.expr(" and ".join(f"`{f}` is not null" for f in features)))


def _unit(*parts: Column) -> Column:
    """Uniform number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(2**53)) / F.lit(float(2**53))


def tree_samples(rows: DataFrame, features: Sequence[str], n: int, keys: Sequence[str], settings: Settings) -> DataFrame:
    """Sample of each tree, drawn from all rows.

    Every row is offered to every tree at the same rate. One hash says which tree takes it first, if any; only
    rows that some tree takes are repeated, for the trees after that one. So rows x trees stays bounded.
    """
    psi = min(settings.forest_sample, n)
    # Half as many again as needed, then exactly psi by rank.
    rate = min(1.0, (1.5 * psi + 20 * math.sqrt(psi)) / n)
    key = [F.col(k) for k in keys]
    first = F.lit(0)
    if rate < 1.0:
        chance, missed = _unit(*key, F.lit(settings.seed)), math.log1p(-rate)
        rows = rows.where(chance < -math.expm1(settings.forest_trees * missed))
        first = F.least(F.floor(F.log1p(-chance) / missed), F.lit(settings.forest_trees - 1)).cast("int")
    trees = F.explode(F.sequence("_first", F.lit(settings.forest_trees - 1))).alias("tree")
    drawn = rows.select(*features, *[c.alias(f"_k{i}") for i, c in enumerate(key)], first.alias("_first"))
    drawn = drawn.select("*", trees)
    kept = [F.col(f"_k{i}") for i in range(len(keys))]
    drawn = drawn.where((F.col("tree") == F.col("_first")) | (_unit(*kept, F.lit(settings.seed + 2), F.col("tree")) < rate))
    drawn = drawn.withColumn("_u", _unit(*kept, F.lit(settings.seed + 1), F.col("tree")))
    # Growing costs far more than the few bytes of a sample suggest: one task per tree or core.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    drawn = drawn.repartition(min(settings.forest_trees, max(cores, 1)), "tree")
    ranked = drawn.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("_u", *features)))
    return ranked.where(F.col("_r") <= psi).select("tree", "_r", *features)


def _grower(features: tuple[str, ...], seed: int, sample: int):
    """Function that grows one tree from its sample (runs in a task, one group of <= sample rows)."""
    limit = max(1, math.ceil(math.log2(max(sample, 2))))
    c_of = [mean_path(i) for i in range(sample + 1)]

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("_r")[list(features)].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        rows = []
        todo = [(0, np.arange(len(x)), 0)]
        made = 1
        while todo:
            node, idx, depth = todo.pop()
            lo, hi = x[idx].min(axis=0), x[idx].max(axis=0)
            varied = np.flatnonzero(hi > lo)
            if depth >= limit or len(idx) <= 1 or len(varied) == 0:
                rows.append((tree, node, -1, 0.0, -1, -1, depth + c_of[len(idx)]))
                continue
            f = int(rng.choice(varied))
            split = float(rng.uniform(lo[f], hi[f]))
            goes_left = x[idx, f] <= split
            left, right = made, made + 1
            made += 2
            rows.append((tree, node, f, split, left, right, 0.0))
            todo.append((right, idx[~goes_left], depth + 1))
            todo.append((left, idx[goes_left], depth + 1))
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "split", "left", "right", "path"])

    return grow


def fit(
    df: DataFrame,
    features: Sequence[str] = fv.FOREST_FEATURES,
    settings: Settings = Settings(),
    keys: Sequence[str] = ("snapshot_ts", "region", "category"),
    min_rows: int | None = None,
) -> ForestModel | None:
    """Model on the complete rows of ``df``; None if there are too few of them."""
    fitted = fit_scored(df, features, settings, keys, min_rows, keep=())
    return None if fitted is None else fitted[0]


def fit_scored(
    df: DataFrame,
    features: Sequence[str] = fv.FOREST_FEATURES,
    settings: Settings = Settings(),
    keys: Sequence[str] = ("snapshot_ts", "region", "category"),
    min_rows: int | None = None,
    keep: Sequence[str] | None = None,
) -> tuple[ForestModel, DataFrame] | None:
    """Model and its scored training rows. The rows are scored once and stored,
    because the threshold takes several passes over the scores."""
    features = tuple(f for f in features if f in df.columns)
    rows = _complete(df, features) if features else df
    n = rows.count()
    least = settings.forest_min_rows if min_rows is None else min_rows
    if n < least or not features:
        return None
    sample = min(settings.forest_sample, n)
    samples = tree_samples(rows, features, n, keys, settings)
    nodes = samples.groupBy("tree").applyInPandas(_grower(features, settings.seed, sample), NODE_SCHEMA)
    found = [tuple(r) for r in nodes.orderBy("tree", "node").collect()]
    model = ForestModel(features, found, sample, settings.forest_trees, float("-inf"), n)
    kept = df.columns if keep is None else list(keep)
    scored = stored(rows.select(*kept, _score_column(model).alias("isolation_score")), "forest_scores")
    threshold = exact_quantiles(scored, ["isolation_score"], settings.contamination)["isolation_score"]
    model = ForestModel(features, found, sample, settings.forest_trees, threshold, n)
    return model, scored.withColumn("is_anomaly", F.col("isolation_score") < F.lit(threshold))


def _score_column(model: ForestModel) -> Column:
    """-2^(-mean depth / expected depth); lower is more isolated."""
    trees, norm = model.trees, mean_path(model.sample) or 1.0
    table = np.array(model.nodes, dtype=float)
    tree_of = table[:, 0].astype(int)
    bounds = np.searchsorted(tree_of, np.arange(trees + 1))
    feature, split = table[:, 2].astype(int), table[:, 3]
    left, right, path = table[:, 4].astype(int), table[:, 5].astype(int), table[:, 6]

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        line = np.arange(len(x))
        depth = np.zeros(len(x))
        for root in bounds[:-1]:
            at = np.full(len(x), root)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                goes_left = x[line, np.maximum(f, 0)] <= split[at]
                down = root + np.where(goes_left, left[at], right[at])
                at = np.where(inner, down, at)
            depth += path[at]
        return pd.Series(-np.power(2.0, -(depth / trees) / norm))

    return score(*[F.col(f) for f in model.features])


def score(df: DataFrame, model: ForestModel) -> DataFrame:
    """Complete rows with ``isolation_score`` and ``is_anomaly`` (score under the fitted threshold)."""
    rows = _complete(df, model.features).withColumn("isolation_score", _score_column(model))
    return rows.withColumn("is_anomaly", F.col("isolation_score") < F.lit(model.threshold))
