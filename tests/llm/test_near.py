"""Near copies by MinHash, against brute force and on odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_documents import SCHEMA, brute_components, frame, near_corpus
from tidewatch.llm import minhash, queries


def found(df) -> dict:
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize(("n", "percent", "seed", "few", "block"), [(5, 85, 1, 16, 512), (3, 80, 2, 2, 4), (1, 80, 3, 3, 2), (5, 90, 4, 2, 1)])
def test_components_equal_brute_force(spark, monkeypatch, n, percent, seed, few, block):
    """Small limits send most buckets to the cells."""
    monkeypatch.setattr(minhash, "FEW", few)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_corpus(seed, 150)
    got = minhash.near_copies(frame(spark, rows).repartition(3), n, percent)
    assert found(got) == brute_components(rows, n, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_chains_whose_ends_are_no_copies(spark, monkeypatch):
    """Each text differs from the next by one word, so links run along a chain and few reach the smallest of a bucket."""
    monkeypatch.setattr(minhash, "FEW", 4)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rnd = random.Random(5)
    words, rows = [f"w{i}" for i in range(60)], []
    for i in range(60):
        rows.append((i * 7 % 60, " ".join(words)))
        words[i] = f"x{rnd.random()}"
    assert found(minhash.near_copies(frame(spark, rows), 1, 90)) == brute_components(rows, 1, 90)


def test_components_of_a_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(queries.op11_minhash(spark, sf)) == brute_components(rows, 5, 85)


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(200_000))
    texts = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "A B C d e f g"), (None, "alone here"), (2, None), (3, ""), (4, " \t"), (9, long), (8, long + " end"), (7, "other text of the same id"), (7, "x y z"), (6, "x\ny\tz")]
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.near_copies(frame(spark, texts), 5, 85).collect()), key=repr)
    want = [(0, 1, None, True), (0, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (6, 1, 6, True), (7, 1, 6, False), (7, 2, 7, True), (8, 199_997, 8, True), (9, 199_996, 8, False)]
    assert got == sorted(want, key=repr)
    assert minhash.near_copies(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bits_estimate_similarity(spark):
    """The packed bits of random sets give their similarity within four standard deviations, in numpy and as columns."""
    rnd = np.random.default_rng(4)
    rows = []
    for share in (0.0, 0.3, 0.6, 0.85, 1.0):
        both = rnd.integers(1 << 63, size=int(2000 * share), dtype=np.uint64)
        rest = rnd.integers(1 << 63, size=(2, 1000 - len(both) // 2), dtype=np.uint64)
        a, b = np.concatenate([both, rest[0]]), np.concatenate([both, rest[1]])
        one, two = (minhash.packed(minhash.minima(np.unique(x))) for x in (a, b))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        m = int(minhash.equal(one, two))
        rows.append((one.view(np.int64).tolist(), two.view(np.int64).tolist(), m, float(true)))
    df = spark.createDataFrame(rows, "one array<long>, two array<long>, m int, true double")
    for r in df.select("m", "true", minhash._equal(F.col("one"), F.col("two")).alias("n"), minhash.similarity(F.col("m")).alias("s")).collect():
        assert r.m == r.n
        assert abs(r.s - r.true) < 4 * 0.5 / 128**0.5
    assert 75 < minhash.least_matches(85) < 100
