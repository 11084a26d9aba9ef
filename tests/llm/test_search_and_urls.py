"""Top-k search, url rules, sharding: against brute force and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import bpe, langid, pii, queries, shards, topk, urls

VECTORS = "vec_id long, embedding array<double>, id string, v int, low int"


def best(vectors: dict[int, list[int]], asked: list[int], k: int) -> list[tuple]:
    out = []
    for q in asked:
        scores = sorted(((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize(("n", "dim", "span", "block"), [(60, 3, 2, 16), (40, 5, 40, 7), (30, 2, 2**27, 64)])
def test_top_k_equals_brute_force(spark, n, dim, span, block):
    random = np.random.default_rng(n)
    vectors = {i: [int(x) for x in random.integers(-span, span + 1, dim)] for i in range(n)}
    for i in range(0, n, 3):
        vectors[i] = vectors[0]
    df = spark.createDataFrame(list(vectors.items()), "id long, v array<long>")
    asked = [i for i in vectors if i % 5 == 0]
    got = topk.top_k(df, df.filter("id % 5 = 0"), 5, query_block=4, candidate_block=block, bins=8)
    assert sorted(map(tuple, got.collect())) == best(vectors, asked, 5)


def test_top_k_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [0.5, -0.001]), (None, [1.0, 1.0]), (6, [1.0]), (5, [0.5, -0.001]), (7, [])]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)
    whole = topk.integer_vectors(df, "vec_id", "embedding")
    assert {r.id: r.v for r in whole.collect()} == {0: [256, 512], 5: [128, -1], 6: [256], 7: []}
    got = topk.top_k(whole, whole, 5).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 5, 256 * 128 - 512), (5, 1, 0, 256 * 128 - 512)]
    assert topk.top_k(whole.limit(0), whole.limit(0), 5).collect() == []
    assert topk.top_k(whole.filter("id = 0"), whole.filter("id = 0"), 5).collect() == []


def verdict(url: str | None, rules: list[tuple]) -> tuple:
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    address = rest[:cut]
    host, slash, path = address.partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = slash + path
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:] if fits else (None, "allow"))


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "http://COM/x", "https://a.b.Example.com/en/1?x=/en/#f", "http://example.com/en", "http://www.example.com/en/",
    "http://xwww.example.com/en/", "http://x.net/es/", "http://x.net/es", "http://x.net/ES/", "http://net/fr/a//b", "http://x.org/en/", "http://x.com?q=/", "http://x.com#/", "a://b://c.com/",
    "http://.com/", "http://x.com./", "http://x..net/fr/", "http://x.com:80/", "http://x.net/fr/" + "a/" * 300, "http://é.com/É", "http://x.NET/fr/?", "http://x.net/fr#", "ftp://net/es/es/", "http://İ.com/",
]


def test_urls_equal_brute_force(spark):
    rules = [*queries.RULES, ("example.com", "/en", "allow"), ("org", "/e", "block"), ("a.b.example.com", "/", "block"), ("", "/x", "block")]
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, rule string")
    got = urls.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(URLS) * 2
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == verdict(r.url, rules), r.url


def test_urls_without_rules_or_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame([(1, "http://a.com/"), (None, None)], "page_id long, url string")
    assert {(r.page_id, r.rule, r.verdict) for r in urls.judge(df, none, default="block").collect()} == {(1, None, "block"), (None, None, "block")}
    assert urls.judge(df.limit(0), none).count() == 0


def test_urls_use_no_python(spark, sf):
    plan = queries.op9_urls(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("rows", [0, 1, 15, 16, 17, 500])
def test_shards_match_the_mixture(spark, rows):
    data = [(i, None if i % 7 == 0 else f"s{min(i % 11, 3)}", 5) for i in range(rows)]
    df = spark.createDataFrame([*data, *data[:3]], "doc_id long, source string, shard int")
    got = shards.interleave(df, "source", ["doc_id"], 16).collect()
    total = len(data) + len(data[:3])
    assert sorted((r.doc_id, r.source) for r in got if True) == sorted(((d, s) for d, s, _ in [*data, *data[:3]])) if rows < 1 else len(got) == total
    assert collections.Counter((r.doc_id, r.source) for r in got) == collections.Counter((d, s) for d, s, _ in [*data, *data[:3]])
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    counts = [len(by[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    for source in {r.source for r in got}:
        share = sum(r.source == source for r in got)
        for own in by.values():
            assert abs(sum(r.source == source for r in own) - share * len(own) / total) <= 2


def test_shards_are_shuffled_and_stable(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    first = {r.doc_id: (r.shard, r.slot) for r in shards.interleave(df, "source", ["doc_id"], 4).collect()}
    again = {r.doc_id: (r.shard, r.slot) for r in shards.interleave(df.repartition(7), "source", ["doc_id"], 4).collect()}
    other = {r.doc_id: (r.shard, r.slot) for r in shards.interleave(df, "source", ["doc_id"], 4, seed=18).collect()}
    assert first == again != other
    assert len({first[i][0] for i in range(20)}) > 1


def test_columns_named_like_helpers_pass_through(spark):
    """Names that the operators use inside, in the table itself."""
    df = spark.createDataFrame([(1, "http://a.net/es/x", "u", "b", "c", "t")], "id long, url string, _url string, _best string, _changed string, _text string")
    rules = spark.createDataFrame(queries.RULES, "host string, path string, verdict string")
    r = urls.judge(df, rules).first()
    assert (r["_url"], r["_best"], r["rule"], r["verdict"]) == ("u", "b", "net/es/", "block")
    p = pii.pseudonymise(df.withColumn("text", F.lit("mail a.b@example.com")), "k").first()
    assert p["_changed"] == "c" and p["text"] != "mail a.b@example.com"
    e = bpe.encode(df.withColumn("text", F.lit("hello")), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).first()
    assert e["_text"] == "t" and len(e["ids"]) == 1
    said = langid.predict(df.withColumn("text", F.lit("\U000f0000")), {"en": np.ones(langid.DIMENSIONS)}).first()
    assert (said["_text"], said["lang_pred"], said["score"]) == ("t", "und", 0.0)


def test_shards_query_equals_a_plain_computation(spark, sf):
    """Size, checksum, shard and slot of every document against the definition in plain Python."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()
    strata = {}
    for r in docs:
        raw = (r.text or "").encode()
        size, crc = len(raw) + 1, zlib.crc32(raw)
        mixed = hashlib.md5("\x01".join(["17", str(r.doc_id), str(crc), str(size)]).encode()).hexdigest()
        strata.setdefault(r.source, []).append((mixed, r.doc_id, size, crc))
    line = []
    for name, rows in strata.items():
        for at, row in enumerate(sorted(rows)):
            line.append(((2 * at + 1) / (2 * len(rows)), name or "", *row))
    line.sort()
    n, want, slots = len(line), {}, collections.Counter()
    for at, (_, _, _, doc_id, size, crc) in enumerate(line):
        shard = at * 16 // n
        want[doc_id] = (size, crc, "rows", shard, slots[shard], None)
        slots[shard] += 1
    got = {r.doc_id: (r["size"], r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) for r in queries.op2_shards(spark, sf).collect()}
    assert got == want and max(slots.values()) - min(slots.values()) <= 1
