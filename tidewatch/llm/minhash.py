"""Near copies by b-bit MinHash: bands of minima find candidates, packed low bits estimate them, full sets confirm them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.common import components, lists, pieces, utf8
from tidewatch.llm.jaccard import _bitmap, _held, _slot, shingle_set
from tidewatch.session import stored

#: Minima of a signature, minima of a band, low bits that are kept of each minimum.
MINIMA, ROWS, BITS = 128, 4, 4
WORDS = MINIMA // 64
#: Chance that the estimate drops a pair of the wanted similarity.
MISSED = 1e-10
#: Sets of a bucket up to which its pairs are listed; sets, and shingles, of a block of a larger bucket.
FEW, BLOCK, BLOCK_SHINGLES = 16, 512, 4_000_000


@lru_cache(maxsize=1)
def _factors() -> np.ndarray:
    """Odd factors: multiplying by one permutes all 64-bit numbers."""
    random = np.random.Generator(np.random.PCG64(11))
    return random.integers(1 << 63, size=(MINIMA, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(shingles: np.ndarray, step: int = 256) -> np.ndarray:
    """Smallest value of a non-empty set of 64-bit hashes under each of MINIMA permutations, some hashes at a time so that products stay in the cache."""
    factors = _factors()
    products = np.empty((MINIMA, min(step, len(shingles))), dtype=np.uint64)
    out = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), step):
        part = shingles[start : start + step]
        here = np.multiply(factors, part, out=products[:, : len(part)])
        np.minimum(out, here.min(axis=1), out=out)
    return out


def bands(found: np.ndarray) -> np.ndarray:
    """One 64-bit key for each ROWS minima (whole ones, not only their low bits), different from band to band."""
    keys = np.arange(1, MINIMA // ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        keys = (keys ^ found[k::ROWS]) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(31)
    return keys


def packed(found: np.ndarray) -> np.ndarray:
    """BITS bits of each minimum, as BITS planes of WORDS 64-bit words."""
    low = (found >> np.uint64(20)).astype(np.uint8)
    planes = [np.packbits(low >> np.uint8(k) & 1) for k in range(BITS)]
    return np.concatenate(planes).view(np.uint64)


def equal(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minima whose bits agree, for packed signatures along the last axis: a minimum differs where any plane does."""
    other = (left ^ right).reshape(*np.broadcast_shapes(left.shape, right.shape)[:-1], BITS, WORDS)
    return MINIMA - np.bitwise_count(np.bitwise_or.reduce(other, axis=-2)).astype(np.int64).sum(axis=-1)


def _equal(left: Column, right: Column) -> Column:
    """The same on two columns array<long>."""
    words = []
    for w in range(WORDS):
        mixed = [left[k * WORDS + w].bitwiseXOR(right[k * WORDS + w]) for k in range(BITS)]
        any_plane = mixed[0]
        for m in mixed[1:]:
            any_plane = any_plane.bitwiseOR(m)
        words.append(F.bit_count(any_plane))
    return F.lit(MINIMA) - sum(words[1:], words[0])


def similarity(matches: Column) -> Column:
    """Estimated Jaccard similarity: the share of agreeing minima, less those that agree by chance in BITS bits."""
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (matches / MINIMA - chance) / (1 - chance))


def least_matches(percent: int) -> int:
    """Agreeing minima that a pair of the wanted similarity has, but for a chance of MISSED at most."""
    p = percent / 100 + (1 - percent / 100) * 2.0**-BITS
    total = 0.0
    for k in range(MINIMA + 1):
        total += comb(MINIMA, k) * p**k * (1 - p) ** (MINIMA - k)
        if total > MISSED:
            return k
    return MINIMA


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, mark, size, key, bands, bits, row) of (_id, _text): hash of the text, set size, digest of the set, keys of its bands, packed bits, row number; empty sets have null from key to bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "_text"):
                sizes, keys, found, bits = [], [], [], []
                for text in batch.column("_text"):
                    own = shingle_set(text.as_py(), n)
                    sizes.append(len(own))
                    keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                    if len(own):
                        least = minima(own)
                        found.append(bands(least))
                        bits.append(packed(least))
                full = [MINIMA // ROWS if s else 0 for s in sizes]
                flat = lambda x: np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64)
                columns = [batch.column("_id"), batch.column("_mark"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists(flat(found), full, pa.int64()), lists(flat(bits), [BITS * WORDS if s else 0 for s in sizes], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "size", "key", "bands", "bits"])

    marked = docs.select("_id", F.xxhash64("_text").alias("_mark"), "_text").mapInArrow(run, "doc_id long, mark long, size long, key binary, bands array<long>, bits array<long>")
    return stored(marked.withColumn("row", F.monotonically_increasing_id()), "minhash-signatures")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row, body) of the rows (row, id, mark). A bitmap of hashed ids keeps most other texts out of the shuffle."""
    packed_bits, bits = _bitmap(wanted.select(F.xxhash64("id").alias("place")))
    held = docs.sparkSession.sparkContext.broadcast(packed_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array(_held(held.value, batch.column("_slot").to_numpy(zero_copy_only=False) - 1)))
            yield pa.RecordBatch.from_arrays([kept.column("_id"), kept.column("_mark"), kept.column("_text")], names=["id", "mark", "body"])

    sent = docs.filter(F.col("_id").isNotNull()).select("_id", F.xxhash64("_text").alias("_mark"), "_text", _slot(F.xxhash64("_id"), bits))
    found = sent.mapInArrow(run, "id long, mark long, body binary")
    return wanted.join(found, ["id", "mark"]).dropDuplicates(["id", "mark"]).select("row", "body")


def _linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    both = len(left) + len(right) - len(np.union1d(left, right))
    return 100 * both >= percent * (len(left) + len(right) - both)


def _confirmed(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = pairs.join(texts.select(F.col("row").alias("a"), F.col("body").alias("left")), "a")
    two = one.join(texts.select(F.col("row").alias("b"), F.col("body").alias("right")), "b").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            keep = []
            for a, left, right in zip(batch.column("a").to_pylist(), batch.column("left"), batch.column("right"), strict=True):
                if a != last:
                    last, own = a, shingle_set(left.as_py(), n)
                keep.append(_linked(own, shingle_set(right.as_py(), n), percent))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    return two.mapInArrow(run, "a long, b long")


def _joined(n: int, percent: int, least: int):
    def verify(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """Links of a cell between sets of different labels, as a spanning forest: bits first, full sets only of pairs that are not connected yet."""
        _, low, high = key
        group = group.sort_values("row", kind="stable").reset_index(drop=True)
        rows, labels, blocks = (group[c].to_numpy() for c in ("row", "label", "block"))
        bits = np.stack([np.asarray(x, dtype=np.int64).view(np.uint64) for x in group["bits"]])
        sizes = group["size"].to_numpy()
        sets: dict[int, np.ndarray] = {}
        top = {label: label for label in labels.tolist()}

        def root(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        def own(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_set(group["body"][i], n)
            return sets[i]

        edges = []
        for i in range(len(rows) - 1):
            later = slice(i + 1, None)
            near = (labels[later] != labels[i]) & (equal(bits[later], bits[i]) >= least) & (100 * np.minimum(sizes[later], sizes[i]) >= percent * np.maximum(sizes[later], sizes[i]))
            if low != high:
                near &= blocks[later] != blocks[i]
            for j in (np.flatnonzero(near) + i + 1).tolist():
                p, q = root(int(labels[i])), root(int(labels[j]))
                if p != q and _linked(own(i), own(j), percent):
                    top[max(p, q)] = min(p, q)
                    edges.append((rows[i], rows[j]))
        return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")
    return verify


def _cells(members: DataFrame) -> DataFrame:
    """(band, low, high, block, row, label) of the members (band, row, label, size) of large buckets: every two members of different labels meet in exactly one cell.

    A label with a block's worth of members has blocks of its own, which never meet each other; the other members are dealt to common blocks.
    """
    many = lambda n, s: F.ceil(F.greatest(n / BLOCK, s / BLOCK_SHINGLES)).cast("int")
    labels = members.groupBy("band", "label").agg(F.count("*").alias("_n"), F.sum("size").alias("_s"))
    big = labels.filter((F.col("_n") >= BLOCK) | (F.col("_s") >= BLOCK_SHINGLES)).select("band", "label", many(F.col("_n"), F.col("_s")).alias("own"))
    ahead = Window.partitionBy("band").orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    big = big.withColumn("first", F.coalesce(F.sum("own").over(ahead), F.lit(0)).cast("int"))
    tail = labels.join(big.select("band", "label"), ["band", "label"], "left_anti").groupBy("band").agg(many(F.sum("_n"), F.sum("_s")).alias("common"))
    heads = big.groupBy("band").agg(F.sum("own").cast("int").alias("heads"))
    ends = tail.join(heads, "band", "full_outer").select("band", F.coalesce("heads", F.lit(0)).alias("heads"), F.coalesce("common", F.lit(0)).alias("common"))
    placed = members.join(big, ["band", "label"], "left").join(ends, "band")
    dealt = F.pmod(F.xxhash64("row"), F.coalesce("own", "common")).cast("int")
    placed = placed.withColumn("block", F.when(F.col("own").isNull(), F.col("heads") + dealt).otherwise(F.col("first") + dealt))
    others = F.filter(F.sequence(F.lit(0), F.col("heads") + F.col("common") - 1), lambda b: F.col("own").isNull() | (b < F.col("first")) | (b >= F.col("first") + F.col("own")))
    met = placed.withColumn("other", F.explode(others))
    return met.select("band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "row", "label", "size")


def near_copies(df: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row: the size of its set of n-word shingles, the smallest doc_id reachable by links, and whether that is its own.

    Two rows are linked when 100 * |intersection| >= percent * |union| of their sets. Rows whose text is null or has no word
    have an empty set and are linked with nothing. Rows of equal sets are one class; a row with a null doc_id takes part in no
    link, and has a null component and stays unless its class has other ids. Rows that share a doc_id are told apart. An empty
    table gives an empty one. Only the two named columns are read.

    A signature is MINIMA minima; ROWS of them make a band, and classes that share a band are candidates: a pair of similarity s
    shares none with a chance of (1 - s^ROWS)^(MINIMA / ROWS), 6e-11 at 85 and 5e-8 at 80 percent. Of the minima only BITS low bits are
    kept for the estimate, which drops a pair of the wanted similarity with a chance of MISSED. Links are confirmed on the
    full sets (64-bit hashes of all shingles of the whole texts).

    First each member of a bucket is compared with the bucket's smallest; for groups of near copies that connects them all. Only
    in buckets that then still hold different components the other pairs are compared: listed up to FEW members, beyond that in
    cells of two blocks, which return spanning forests. So no pairs of copies are listed, and no task sees a bucket.
    """
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), utf8(F.col(f"`{text}`")).alias("_text"))
    rows = signatures(docs, n)
    firsts = rows.filter("key is not null and doc_id is not null").groupBy("key").agg(F.min(F.struct("doc_id", "row")).alias("_c")).select("key", F.col("_c.doc_id").alias("id"), F.col("_c.row").alias("row"))
    firsts = stored(firsts, "minhash-classes")
    chosen = stored(rows.select("row", "mark", "size", "bands", "bits").join(firsts.select("row", "id"), "row"), "minhash-chosen")

    spread = chosen.select("row", "size", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.count("*").alias("n"), F.min("row").alias("first")).filter("n > 1")
    members = stored(spread.join(shared, "band"), "minhash-buckets")
    facts = chosen.join(members.select("row").distinct(), "row", "left_semi")
    facts = stored(facts.select("row", "id", "mark", "size", "bits"), "minhash-candidates")
    least = least_matches(percent)

    def likely(pairs: DataFrame) -> DataFrame:
        """The distinct pairs (a, b) whose sizes and low bits allow the wanted similarity."""
        side = lambda a: facts.select(F.col("row").alias(a), F.col("size").alias(f"{a}_size"), F.col("bits").alias(f"{a}_bits"))
        met = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
        fits = 100 * F.least("a_size", "b_size") >= percent * F.greatest("a_size", "b_size")
        return met.filter(fits & (_equal(F.col("a_bits"), F.col("b_bits")) >= least)).select("a", "b")

    def texts(*pairs: DataFrame) -> DataFrame:
        """(row, body) of the rows that occur in any column of the frames."""
        wanted = reduce(DataFrame.unionByName, [p.select(F.col(c).alias("row")) for p in pairs for c in p.columns]).distinct()
        return stored(_texts(docs, facts.select("row", "id", "mark").join(wanted, "row", "left_semi")), "minhash-texts")

    star = stored(likely(members.filter("row <> first").select(F.col("first").alias("a"), F.col("row").alias("b"))), "minhash-stars")
    links = stored(_confirmed(star, texts(star), n, percent), "minhash-links")
    label = components(links, "minhash-first").withColumnRenamed("id", "row").withColumnRenamed("component_id", "label")
    labelled = members.join(label, "row", "left").withColumn("label", F.coalesce("label", "row"))
    mixed = labelled.groupBy("band").agg((F.min("label") < F.max("label")).alias("mixed")).filter("mixed").select("band")
    open_ = stored(labelled.filter("n > 2").join(mixed, "band", "left_semi"), "minhash-open")

    few = open_.filter(F.col("n") <= FEW).groupBy("band").agg(F.sort_array(F.collect_list(F.struct("row", "label", "first"))).alias("g"))
    listed = F.transform("g", lambda y, i: F.transform(F.filter(F.slice("g", 1, i), lambda x: (x["label"] != y["label"]) & (x["row"] != x["first"])), lambda x: F.struct(x["row"].alias("a"), y["row"].alias("b"))))
    rest = likely(few.select(F.explode(F.flatten(listed)).alias("p")).select("p.a", "p.b"))
    rest = stored(rest.join(star, ["a", "b"], "left_anti"), "minhash-rest")
    large = open_.filter(F.col("n") > FEW).select("band", "row", "label", "size")
    later = texts(rest, large.select("row"))
    cells = _cells(large).join(facts.select("row", "bits"), "row").join(later, "row")
    crossed = cells.groupBy("band", "low", "high").applyInPandas(_joined(n, percent, least), "a long, b long")
    every = links.unionByName(_confirmed(rest, later, n, percent)).unionByName(crossed)
    found = components(every, "minhash-all").select(F.col("id").alias("row"), F.col("component_id").alias("label"))
    final = firsts.join(found, "row", "left").withColumn("label", F.coalesce("label", "row"))
    names = final.groupBy("label").agg(F.min("id").alias("component_id"))
    named = final.select("key", "label").join(names, "label").select("key", "component_id")
    out = rows.select("doc_id", "size", "key").join(named, "key", "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
