"""Exact Jaccard self-join of documents on word n-grams, by grouped prefix join, down to connected components."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import components, lists, pieces, utf8
from tidewatch.session import stored

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

#: Shingles of one counting window; a shingle counts as common from so many documents of one window on; most common shingles that are broadcast.
WINDOW, COMMON, COMMON_KEPT = 4_000_000, 3, 1_000_000
#: Signatures that the prefixes of a pair must share; groups that a signature may have to be paired one by one.
SHARED, FEW = 4, 32
#: From this percentage on, a signature is two shingles that follow each other in the common order, below it one shingle.
PAIRED = 75
#: Documents, and shingles, of one block of candidates that one task compares.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 4_000_000
#: Bits of a broadcast bitmap, 16 MB. It tells up to an eighth as many rows apart well.
MOST_BITS = 1 << 27


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's n-word shingles, A-Z lower-cased; with fewer words, of the whole sequence; without words, none."""
    words = [xxhash.xxh3_64_intdigest(w) for w in _WORD.findall(text.translate(_LOWER))]
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes, n = np.array(words, dtype=np.uint64), min(n, len(words))
    mixed = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        mixed = (mixed ^ hashes[i : len(words) - n + 1 + i]) * _ODD
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _common(docs: DataFrame, n: int, most: int = COMMON_KEPT) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, document counts) of shingles that many documents share, sorted by hash.

    Every window of every task counts its shingles over whole texts and reports those of COMMON documents or more; the
    sums are lower bounds of the true counts. They only set the order in which prefixes are taken, which may be any
    order, so links do not depend on them. At most `most` of them, those with the highest counts, leave Spark.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            keep = counts >= COMMON
            return pa.RecordBatch.from_arrays([pa.array(found[keep].view(np.int64)), pa.array(counts[keep].astype(np.int64))], names=["shingle", "n"])

        for batch in batches:
            for text in batch.column("_text"):
                held.append(shingle_set(text.as_py(), n))
                size += len(held[-1])
                if size >= WINDOW:
                    yield out()
                    held, size = [], 0
        yield out()

    counts = stored(docs.select("_text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")), "jaccard-common")
    levels = counts.groupBy(F.floor(F.log2("n") * 4).cast("int").alias("level")).count().collect()
    floor, total = 10**6, 0
    for level, rows in sorted(((r.level, r["count"]) for r in levels), reverse=True):
        if total + rows > most:
            break
        floor, total = level, total + rows
    table = counts.filter(F.floor(F.log2("n") * 4) >= floor).toArrow()
    hashes, n = table.column("shingle").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], n[order]


def _width(percent: int) -> int:
    """Shingles of a signature. Two only where different sets of the wanted similarity are sure to share a signature."""
    return 2 if percent >= PAIRED else 1


def _prefix_length(size: int, percent: int) -> int:
    """Signatures of a prefix. At most `own` shingles of a set of this size are missing in a partner, and at most `apart` are in one of both sets only.

    Common shingles in order are neighbours in both sets unless one of the `apart` lies between, so each of those spoils
    at most one signature of two. Of the first SHARED + apart common signatures SHARED are left, and `own` is how much
    later they may come in the set.
    """
    own, apart = size - -(-size * percent // 100), (100 - percent) * size // percent
    return own + (_width(percent) - 1) * apart + SHARED


def _needed(larger: Column, percent: int) -> Column:
    """Signatures that the prefixes of two different linked sets share at least, by the size of the larger one."""
    more = _width(percent) - 1
    return F.greatest(F.lit(1), F.least(F.lit(SHARED), F.ceil(larger * (percent - more * (100 - percent)) / 100) - more))


def _signatures(ordered: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of shingles in the common order: the shingles, or hashes of each two neighbours."""
    if _width(percent) == 1:
        return ordered
    mixed = (ordered[:-1] * _ODD) ^ ordered[1:]
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    return mixed ^ (mixed >> np.uint64(32))


def _prefixes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, size, key, gid, prefix, row): set size, digest of the set, hash of size and prefix, and the set's first signatures, rare shingles first."""
    common = docs.sparkSession.sparkContext.broadcast(_common(docs, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = common.value
        for whole in batches:
            for batch in pieces(whole, "_text"):
                sizes, keys, groups, found = [], [], [], []
                for text in batch.column("_text"):
                    own = shingle_set(text.as_py(), n)
                    first = _prefix_length(len(own), percent) + _width(percent) - 1
                    if len(own) and len(hashes):
                        at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                        rank = np.where(hashes[at] == own, counts[at], 0)
                        own_first = own[np.argsort(rank, kind="stable")[:first]]
                    else:
                        own_first = own[:first]
                    sizes.append(len(own))
                    keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                    groups.append(xxhash.xxh3_64_intdigest(own_first.tobytes(), seed=len(own)))
                    found.append(_signatures(own_first, percent))
                flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
                columns = [batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(np.array(groups, dtype=np.uint64).view(np.int64)), lists(flat, [len(x) for x in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "size", "key", "gid", "prefix"])

    marked = docs.mapInArrow(run, "doc_id long, size long, key binary, gid long, prefix array<long>")
    return stored(marked.withColumn("row", F.monotonically_increasing_id()), "jaccard-prefixes")


def _candidates(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between groups such that groups with linked classes are always connected; classes have (gid, row), `row` is where a class is found in `rows`.

    Classes of one prefix and size are one group, named by a hash. Groups that share enough prefix signatures are a
    candidate pair; of a signature with few groups all pairs are counted, one of many groups is a node of its own that
    they are tied to, which connects every pair that shares it. A group of several classes is tied to a node of its own
    too, so that it is found among the edges. Names that collide, and a group that is met more than once, only add candidates.
    """
    groups = stored(classes.groupBy("gid").agg(F.min("row").alias("row"), F.count("*").alias("classes")), "jaccard-first")
    inside = groups.filter("classes > 1").select(F.col("gid").alias("a"), F.xxhash64("gid").alias("b"))
    chosen, firsts = rows.filter("key is not null and doc_id is not null").select("row", "gid", F.col("size").cast("int").alias("size"), "prefix"), groups.select(F.xxhash64("row").alias("place"))
    if 8 * firsts.count() > MOST_BITS:
        chosen = stored(chosen.join(groups.select("row"), "row", "left_semi"), "jaccard-groups-prefixes")
    first = _bitmap(firsts)
    counted = _signatures_of(chosen, first).groupBy("sign").agg(F.count("*").alias("n"))
    shared = stored(counted.filter("n > 1"), "jaccard-shared")
    met = _signatures_of(chosen, first, _bitmap(shared.select("sign"))).join(shared, "sign")
    tied = met.filter(F.col("n") > FEW).select(F.col("gid").alias("a"), F.col("sign").alias("b"))
    listed = met.filter(F.col("n") <= FEW).groupBy("sign").agg(F.sort_array(F.collect_list(F.struct("size", "gid"))).alias("g"))
    close = lambda x, y: x["size"] * 100 >= y["size"] * percent  # noqa: E731  sorted: y is the larger
    pairs = F.transform("g", lambda y, i: F.transform(F.filter(F.slice("g", 1, i), lambda x: close(x, y)), lambda x: F.struct(x["gid"].alias("a"), y["gid"].alias("b"), y["size"].alias("size"))))
    together = listed.select(F.explode(F.flatten(pairs)).alias("p")).groupBy("p.a", "p.b", "p.size").count()
    near = together.filter(F.col("count") >= _needed(F.col("size"), percent)).select("a", "b")
    return inside.unionByName(tied).unionByName(near)


def _slot(place: Column, bits: int) -> Column:
    """Place in the bitmap, from 1 on, as Spark numbers bits."""
    return (F.pmod(place, F.lit(bits)) + 1).alias("_slot")


def _bitmap(places: DataFrame) -> tuple[np.ndarray, int]:
    """(bitmap, bits) of the hashes in the only column. It has MOST_BITS at most, so it may hold more than these, never less."""
    bits, place = 1 << 15, F.col(places.columns[0])
    n = places.count()
    while bits < 8 * n and bits < MOST_BITS:
        bits *= 2
    maps = places.select(_slot(place, bits)).groupBy(F.bitmap_bucket_number("_slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("map")).collect()
    packed = np.zeros(bits >> 3, dtype=np.uint8)
    for row in maps:
        packed[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(bytes(row.map), dtype=np.uint8)
    return packed, bits


def _held(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether the bitmap holds each slot, counted from 0."""
    return ((bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1).astype(bool)


def _signatures_of(chosen: DataFrame, first: tuple[np.ndarray, int], shared: tuple[np.ndarray, int] | None = None) -> DataFrame:
    """(sign) of the prefixes of the rows that the bitmap `first` holds; with `shared`, (gid, size, sign) of those signatures that it holds, so that few are shuffled once more."""
    bits = first[1]
    maps = chosen.sparkSession.sparkContext.broadcast((first[0], shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, wanted = maps.value
        for whole in batches:
            whole = whole.filter(pa.array(_held(rows, whole.column("_slot").to_numpy(zero_copy_only=False) - 1)))
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                prefix = batch.column("prefix")
                sign = prefix.flatten().to_numpy(zero_copy_only=False)
                if wanted is None:
                    yield pa.RecordBatch.from_arrays([pa.array(sign)], names=["sign"])
                    continue
                keep = _held(wanted[0], sign & np.int64(wanted[1] - 1))
                owner = np.repeat(np.arange(batch.num_rows), np.diff(prefix.offsets.to_numpy()))[keep]
                gid, size = (batch.column(c).to_numpy(zero_copy_only=False)[owner] for c in ("gid", "size"))
                yield pa.RecordBatch.from_arrays([pa.array(gid), pa.array(size), pa.array(sign[keep])], names=["gid", "size", "sign"])

    placed = chosen.select("gid", "size", "prefix", _slot(F.xxhash64("row"), bits))
    return placed.mapInArrow(run, "sign long" if shared is None else "gid long, size int, sign long")


def _member_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, body) of the documents in `ids`. A bitmap of hashed ids keeps most others out of the shuffle."""
    packed, bits = _bitmap(ids.select(F.xxhash64("id").alias("place")))
    wanted = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array(_held(wanted.value, batch.column("_slot").to_numpy(zero_copy_only=False) - 1)))
            yield pa.RecordBatch.from_arrays([kept.column("_id"), kept.column("_text")], names=["id", "body"])

    return docs.filter(F.col("_id").isNotNull()).withColumn("_slot", _slot(F.xxhash64("_id"), bits)).mapInArrow(run, "id long, body binary")


def _joined(n: int, percent: int):
    def verify(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """Links of a block, or across two blocks, as a spanning forest: whatever more links there are lies within its trees."""
        _, low, high = key
        group = group.sort_values("id", kind="stable")
        ids, blocks = group["id"].to_numpy(), group["block"].to_numpy()
        sets = [shingle_set(x, n) for x in group["body"]]
        sizes = np.array([len(x) for x in sets])
        owners = np.repeat(np.arange(len(sets)), sizes)
        found, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        number = np.cumsum(counts > 1) - 1
        keep = counts[place] > 1
        owners, place = owners[keep], number[place[keep]]
        order = np.argsort(place, kind="stable")
        owners, place = owners[order], place[order]
        both = np.zeros((len(sets), len(sets)), dtype=np.float64)
        step = max(256, (16 << 20) // (4 * max(len(sets), 1)))
        for start in range(0, int(place[-1]) + 1 if len(place) else 0, step):
            a, b = np.searchsorted(place, [start, start + step])
            part = np.zeros((len(sets), step), dtype=np.float32)
            part[owners[a:b], place[a:b] - start] = 1
            both += part @ part.T
        inside = both.astype(np.int64)
        linked = (inside > 0) & (inside * 100 >= percent * (sizes[:, None] + sizes[None, :] - inside))
        if low != high:
            linked &= blocks[:, None] != blocks[None, :]
        root = np.arange(len(sets))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        edges = []
        for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
            p, q = top(i), top(j)
            if p != q:
                root[max(p, q)] = min(p, q)
                edges.append((ids[i], ids[j]))
        return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")
    return verify


def near_components(df: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: the size of its set of n-word shingles and the smallest doc_id reachable by links.

    Two rows are linked when 100 * |intersection| >= percent * |union| of their sets. Rows whose text is null or has no
    word have an empty set and are linked with nothing. Component and links follow each row's own text; rows of equal
    sets are one class. A row with a null doc_id takes part in no link and has a null component unless its class has
    other ids. An empty table gives an empty one. Only the two named columns are read.

    Rows with the same set become one class: copies cost one row each from here on. Classes with the same prefix and size
    become one group, and groups that share enough signatures of their prefixes are candidates. Connected candidates are expanded to
    their members and sent, each once, to the task that compares them. A group of candidates beyond a block is cut into
    blocks, and pairs of blocks are compared, so no task grows with a group. Tasks return spanning forests of verified
    links, never all pairs; their components are the result. Sets are compared by 64-bit hashes of shingles.
    """
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), utf8(F.col(f"`{text}`")).alias("_text"))
    rows = _prefixes(docs, n, percent)
    classes = rows.filter("key is not null and doc_id is not null").groupBy("key").agg(F.min(F.struct(F.col("doc_id").alias("id"), "row", "size", "gid")).alias("c")).select("key", "c.id", "c.row", "c.size", "c.gid")
    classes = stored(classes, "jaccard-classes")
    touching = _candidates(rows, classes, percent)
    groups = components(touching, "jaccard-candidates").withColumnRenamed("id", "gid")
    sized = stored(classes.select("id", "size", "gid").join(groups, "gid").select("id", "size", "component_id"), "jaccard-groups")
    cuts = sized.groupBy("component_id").agg(F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = sized.join(cuts, "component_id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = placed.withColumn("other", other).select("component_id", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id")
    cells = cells.join(_member_texts(docs, sized), "id")
    links = cells.groupBy("component_id", "low", "high").applyInPandas(_joined(n, percent), "a long, b long")
    found = components(links, "jaccard-links")
    final = classes.select("key", "id").join(found, "id", "left").select("key", F.coalesce("component_id", "id").alias("component_id"))
    return rows.select("doc_id", "size", "key").join(final, "key", "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
