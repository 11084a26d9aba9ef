"""Exact top-k search by histogram selection of each query's k-th score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.session import stored

#: Bins of one refinement, queries of a block, candidates of a block. Memory of a task: about 8 bytes x (queries of a slice) x candidates.
BINS, QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192, 4096
_SLICE = 256


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of each component as long. Vectors that are null or hold null or non-finite components, and null keys, are left out.

    A key that occurs more than once counts once, with its smallest vector.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = df.filter(F.col(f"`{key}`").isNotNull() & x.isNotNull() & ~odd)
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    return good.select(F.col(f"`{key}`").cast("long").alias("id"), whole.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products; through floating point only where every sum is below 2^53."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(candidates)), dtype=np.int64)
    bound = float(np.abs(queries).astype(float).max()) * float(np.abs(candidates).astype(float).max()) * queries.shape[1]
    if bound < 2**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def _sliced(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """(queries of a slice, candidates' ids, scores); a query's own row scores the least possible and is never taken."""
    own = np.iinfo(np.int64).min
    ids = right["id"].to_numpy()
    all_candidates = np.array(right["v"].tolist(), dtype=np.int64).reshape(len(right), -1)
    for start in range(0, len(left), _SLICE):
        part = left.iloc[start : start + _SLICE]
        scores = _scores(np.array(part["v"].tolist(), dtype=np.int64).reshape(len(part), -1), all_candidates)
        scores[part["id"].to_numpy()[:, None] == ids[None, :]] = own
        yield part, ids, scores


def _histograms(k: int):
    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """For each query, rows (bin, number of scores in it) from the top of its open range down to the block's own k-th score: no bin below can hold the k-th of all."""
        own, found = np.iinfo(np.int64).min, []
        if len(left) and len(right):
            for part, _, scores in _sliced(left, right):
                low, width, bins = (part[c].to_numpy()[:, None] for c in ("low", "width", "bins"))
                place = np.where(scores < low, -1, np.minimum((scores - np.minimum(scores, low)) // width, bins))
                place[scores == own] = -1
                floor = np.full(len(part), 0) if place.shape[1] <= k else np.partition(place, place.shape[1] - k, axis=1)[:, place.shape[1] - k]
                row, col = np.nonzero(place >= np.maximum(floor, 0)[:, None])
                pairs, n = np.unique(row.astype(np.int64) * (1 << 32) + place[row, col], return_counts=True)
                found.append(pd.DataFrame({"id": part["id"].to_numpy()[pairs >> 32], "bin": pairs & 0xFFFFFFFF, "n": n.astype(np.int64)}))
        return pd.concat(found) if found else pd.DataFrame({"id": [], "bin": [], "n": []}).astype("int64")
    return count


def _take(k: int):
    def take(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Scores above the k-th, and of those equal to it as many as can be among the first k, smallest ids first."""
        found = []
        if len(left) and len(right):
            for part, ids, scores in _sliced(left, right):
                low = part["low"].to_numpy()
                row, col = np.nonzero((scores >= low[:, None]) & (scores != np.iinfo(np.int64).min))
                got = scores[row, col]
                order = np.lexsort((ids[col], -got, row))
                row, col, got = row[order], col[order], got[order]
                first = np.searchsorted(row, row)
                keep = np.arange(len(row)) - first < k
                found.append(pd.DataFrame({"query_id": part["id"].to_numpy()[row[keep]], "vec_id": ids[col[keep]], "score": got[keep]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    return take


def top_k(vectors: DataFrame, queries: DataFrame, k: int, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK, bins: int = BINS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products over all `vectors` but its own row, ties to the smaller vec_id.

    Both tables have (id long, v array of long), ids unique. Vectors are compared with queries of the same length only.
    Queries and candidates meet in blocks, so no task holds more than one block of each. Each pass scores every pair anew
    and counts scores in `bins` bins of each query's open range; counts of all blocks are added up, and the bin with the
    k-th largest score is the next open range, until it is a single value. The last pass keeps what reaches that value.
    All inner products must lie within +-2^62. A query with fewer than k candidates gets all of them, one with none no row.
    """
    spark = vectors.sparkSession
    vectors, queries = stored(vectors, "topk-vectors"), stored(queries, "topk-queries")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    facts = vectors.agg(F.count("*").alias("n"), F.max(norm).alias("m")).first()
    asked = queries.agg(F.count("*").alias("n"), F.max(norm).alias("m")).first()
    empty = "query_id long, rank int, vec_id long, score long"
    if not facts.n or not asked.n:
        return spark.createDataFrame([], empty)
    reach = int(facts.m * asked.m * (1 + 1e-9)) + 2
    query_blocks, blocks = -(-asked.n // query_block), -(-facts.n // candidate_block)
    right = vectors.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("part"))
    spread = queries.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(query_blocks)).cast("int").alias("part"))
    keys = ["dim", "part", "block"]

    def met(state: DataFrame):
        left = spread.join(state, "id").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys))

    width = -(-(2 * reach + 1) // bins)
    state = queries.select("id", F.lit(-reach).cast("long").alias("low"), F.lit(width).cast("long").alias("width"), F.lit(k).cast("long").alias("need"), F.lit(bins).cast("long").alias("bins"))
    while True:
        counts = met(state).applyInPandas(_histograms(k), "id long, bin long, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id").orderBy(F.desc("bin"))
        reached = counts.withColumn("upto", F.sum("n").over(down)).withColumn("all", F.sum("n").over(Window.partitionBy("id")))
        chosen = reached.join(state.select("id", "need"), "id").filter((F.col("upto") - F.col("n") < F.least("need", "all")) & (F.col("upto") >= F.least("need", "all"))).select("id", "bin")
        finer = -(-width // bins)
        low = F.col("low") + F.col("bin") * F.col("width")
        state = stored(state.join(chosen, "id").select("id", low.alias("low"), F.lit(finer).cast("long").alias("width"), "need", F.lit(-(-width // finer)).cast("long").alias("bins")), "topk-state")
        if width == 1:
            break
        width = finer
    found = met(state).applyInPandas(_take(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
