"""Audit of how the sources of a language differ in their words, from an index built in one pass."""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.common import pieces, utf8
from tidewatch.session import stored

#: Letters: A-Z, a-z and all bytes of characters beyond ASCII.
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Postings, and bytes of text, after which a task spills its block; terms of one row of a run; bytes of a text that are read at once.
POSTINGS, READ, ROW, PIECE = 800_000, 128 << 20, 128, 4 << 20
#: A probability is a whole number of parts of this.
PARTS = 1_000_000_000


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, A-Z lower-cased, in lists of those of some megabytes; a text is only cut where no term is."""
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + PIECE) if start + PIECE < len(text) else None
        stop = gap.start() if gap else len(text)
        yield _TERM.findall(text[start:stop].translate(_LOWER))
        start = stop


class Block:
    """Postings held in memory: for each group (language, source), the occurrences of its terms and the documents that have them."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.postings = self.bytes = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before, seen = len(counts), set()
        for found in terms(text):
            counts.update(found)
            seen.update(found)
        docs.update(seen)
        self.postings += len(counts) - before
        self.bytes += len(text)

    def full(self) -> bool:
        return self.postings >= POSTINGS or self.bytes >= READ

    def runs(self, shards: int) -> Iterator[tuple]:
        """The block as rows (shard, lang, source, terms, docs, counts), sorted by term within each shard of a group."""
        for (lang, source), (counts, docs) in self.groups.items():
            by: list[list[bytes]] = [[] for _ in range(shards)]
            for term in sorted(counts):
                by[zlib.crc32(term) % shards].append(term)
            for shard, listed in enumerate(by):
                for start in range(0, len(listed), ROW):
                    part = listed[start : start + ROW]
                    yield shard, lang, source, part, [docs[t] for t in part], [counts[t] for t in part]


_RUN = "shard int, lang string, source string, first binary, terms array<binary>, docs array<long>, counts array<long>"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    sizes = [len(r[3]) for r in rows]
    flat = lambda k, kind: pa.array([x for r in rows for x in r[k]], kind)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    lists_ = [pa.ListArray.from_arrays(offsets, flat(k, kind)) for k, kind in ((3, pa.binary()), (4, pa.int64()), (5, pa.int64()))]
    head = [pa.array([r[k] for r in rows], kind) for k, kind in ((0, pa.int32()), (1, pa.string()), (2, pa.string()))]
    return pa.RecordBatch.from_arrays([*head, pa.array([r[3][0] for r in rows], pa.binary()), *lists_], names=[x.split()[0] for x in _RUN.split(", ")])


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch. Terms are cut from the buffer they arrive in."""
    listed = batch.column("terms")
    flat = listed.flatten()
    ends = np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False)).tolist()
    place = np.frombuffer(flat.buffers()[1], dtype=np.int32)[flat.offset : flat.offset + len(flat) + 1].tolist() if len(flat) else []
    data = memoryview(flat.buffers()[2]) if len(flat) else b""
    docs, counts = (batch.column(c).flatten().to_numpy(zero_copy_only=False).tolist() for c in ("docs", "counts"))
    low = 0
    for shard, lang, source, high in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "source")), ends, strict=True):
        yield shard, lang, source, [bytes(data[place[i] : place[i + 1]]) for i in range(low, high)], docs[low:high], counts[low:high]
        low = high


def _rows(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def runs(df: DataFrame, shards: int = 128) -> DataFrame:
    """Term-sorted runs of postings of the columns (lang, source, _text), spilled by each task whenever its block is full."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()

        def spill() -> Iterator[pa.RecordBatch]:
            waiting: list[tuple] = []
            for row in block.runs(shards):
                waiting.append(row)
                if len(waiting) >= 512:
                    yield _packed(waiting)
                    waiting = []
            if waiting:
                yield _packed(waiting)

        for whole in batches:
            for batch in pieces(whole, "_text"):
                for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("_text"), strict=True):
                    block.add(lang, source, text.as_py())
                    if block.full():
                        yield from spill()
                        block = Block()
        yield from spill()

    return df.select("lang", "source", "_text").mapInArrow(index, _RUN)


def merged(rows: Iterator[tuple], least_docs: int = 1) -> Iterator[tuple[str, bytes, dict[str, int]]]:
    """(lang, term, occurrences by source) of the terms in at least `least_docs` documents, from rows of runs sorted by shard, language and first term.

    A row is opened once the heap holds no smaller term, so only rows whose ranges overlap are in memory: one of each run
    and group at most.
    """
    heap: list[tuple[bytes, int, int, tuple]] = []
    place = None
    opened = 0

    def drain(limit: bytes | None) -> Iterator[tuple[str, bytes, dict[str, int]]]:
        while heap and (limit is None or heap[0][0] < limit):
            term, docs, met = heap[0][0], 0, []
            while heap and heap[0][0] == term:
                _, number, at, row = heap[0]
                docs += row[4][at]
                met.append((row[2], row[5][at]))
                if at + 1 < len(row[3]):
                    heapq.heapreplace(heap, (row[3][at + 1], number, at + 1, row))
                else:
                    heapq.heappop(heap)
            if docs >= least_docs:
                by: dict[str, int] = {}
                for source, count in met:
                    by[source] = by.get(source, 0) + count
                yield place[1], term, by

    for row in rows:
        if (row[0], row[1]) != place:
            yield from drain(None)
            place = (row[0], row[1])
        yield from drain(row[3][0])
        opened += 1
        heapq.heappush(heap, (row[3][0], opened, 0, row))
    yield from drain(None)


def frequencies(df: DataFrame, least_docs: int = 3, shards: int = 128) -> DataFrame:
    """(lang, term, total, postings) of the terms in at least `least_docs` documents of a language; postings are (source, count).

    Each task indexes its documents in memory and spills term-sorted runs. Runs are shuffled by hash shard of the term in
    rows of some hundred terms, sorted by Spark, and merged by a heap. A frequent term costs one posting per run and source.
    """
    sent = runs(df, shards)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["lang", "term", "total", "postings"], [pa.string(), pa.string(), pa.int64(), pa.list_(pa.struct([("source", pa.string()), ("count", pa.int64())]))]
        waiting: list[tuple] = []

        listed = (row for batch in batches for start in range(0, batch.num_rows, 64) for row in _unpacked(batch.slice(start, 64)))
        for lang, term, by in merged(listed, least_docs):
            waiting.append((lang, term.decode("utf-8", "replace"), sum(by.values()), list(by.items())))
            if len(waiting) >= 4096:
                yield _rows(waiting, kinds, names)
                waiting = []
        yield _rows(waiting, kinds, names)

    return sent.repartition("shard").sortWithinPartitions("shard", "lang", "first").mapInArrow(merge, "lang string, term string, total long, postings array<struct<source: string, count: long>>")


def part_of(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(PARTS * (count + 1) / (n + v)); 1 where a language keeps no term."""
    up = F.lit(PARTS).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.when(v > 0, F.lit(1) + F.call_function("div", up, (n + v).cast("decimal(20,0)"))).otherwise(F.lit(1)).cast("long")


def squared(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _corrections(postings: DataFrame) -> DataFrame:
    """(lang, source, item, value): what the terms that two sources share add to a sum that takes one of the two as absent.

    The rows (lang, term, postings of p and p0) are streamed; each task adds up its pairs of sources and reports sums. No pair of
    a term becomes a row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple[str, str], int] = {}
        names: list[tuple[str, str]] = []
        sums: dict[int, int] = {}

        def out() -> pa.RecordBatch:
            rows = [(names[k >> 32][0], names[k >> 32][1], names[k & 0xFFFFFFFF][1], v) for k, v in sums.items()]
            sums.clear()
            return _rows(rows, [pa.string(), pa.string(), pa.string(), pa.int64()], ["lang", "source", "item", "value"])

        def add(number: np.ndarray, p: np.ndarray, p0: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
            own = np.repeat(sizes, sizes)
            left = np.repeat(np.arange(len(number)), own)
            first = np.repeat(np.repeat(starts, sizes), own)
            right = np.arange(len(left)) - np.repeat(np.cumsum(own) - own, own) + first
            left, right = left[(apart := left != right)], right[apart]
            f = lambda a, b: (a - b) ** 2 // b
            a, b, a0, b0 = p[left], p[right], p0[left], p0[right]
            value = f(a, b) - f(a, b0) - f(a0, b) + f(a0, b0)
            found, place = np.unique(number[left] << 32 | number[right], return_inverse=True)
            total = np.zeros(len(found), dtype=np.int64)
            np.add.at(total, place, value)
            for k, v in zip(found.tolist(), total.tolist(), strict=True):
                sums[k] = sums.get(k, 0) + v

        for batch in batches:
            listed = batch.column("postings")
            flat = listed.flatten()
            sizes = listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            langs = np.repeat(np.array(batch.column("lang").to_pylist(), dtype=object), sizes)
            number = np.zeros(len(langs), dtype=np.int64)
            for i, key in enumerate(zip(langs.tolist(), flat.field(0).to_pylist(), strict=True)):
                if key not in numbers:
                    numbers[key] = len(names)
                    names.append(key)
                number[i] = numbers[key]
            p, p0 = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2))
            starts, pairs = np.cumsum(sizes) - sizes, np.cumsum(sizes**2)
            low = 0
            while low < len(sizes):
                high = max(low + 1, int(np.searchsorted(pairs, (pairs[low - 1] if low else 0) + 1_000_000)))
                a, b = int(starts[low]), int(starts[high - 1] + sizes[high - 1])
                add(number[a:b], p[a:b], p0[a:b], starts[low:high] - a, sizes[low:high])
                low = high
                if len(sums) > 1_000_000:
                    yield out()
        yield out()

    return postings.mapInArrow(run, "lang string, source string, item string, value long")


def audit(df: DataFrame, least_docs: int = 3, most_terms: int = 200, shards: int = 128, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from the others (`pair`) and which terms set it apart (`term`).

    Terms are runs of letters, all characters beyond ASCII included, A-Z lower-cased. A language keeps the V terms in at
    least `least_docs` of its documents. A group (lang, source) and a language as a whole give a kept term that occurs
    count times there p = 1 + floor(10^9 * (count + 1) / (N + V)), N being all their occurrences of kept terms.
    For two of these, f = floor((p - q)^2 / q). `pair`: for each other source of the language the sum of f over all kept
    terms, q being the other's; 0 if V is 0. `term`: f of each kept term that occurs in the group and has p above the
    language's q, the `most_terms` largest. Ranks count from 1, by value descending, then item. Null lang, source and
    text count as empty. An empty table gives no rows. Only the three named columns are read.

    Terms that a source lacks all have one p, so a pair's sum is V times the f of two absent terms, plus differences that
    need one source's histogram of counts only, plus corrections for terms that both sources have, which are streamed.
    Sums are exact: whole numbers of 64 bits within a task, decimals of 38 digits across tasks, an error if a result overflows.
    """
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    docs = df.select(blank(lang).alias("lang"), blank(source).alias("source"), utf8(F.col(f"`{text}`")).alias("_text"))
    kept = stored(frequencies(docs, least_docs, shards), "divergence-frequencies")
    listed = kept.select("lang", "term", "total", F.explode("postings").alias("_p")).select("lang", "term", "total", "_p.source", "_p.count")
    sizes = listed.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    totals = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    seen = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(totals, "lang", "left")
    seen = seen.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "v", "n_lang")])
    groups = stored(seen.withColumn("p0", part_of(F.lit(0), F.col("n"), F.col("v"))), "divergence-groups")

    valued = listed.join(groups, ["lang", "source"])
    valued = valued.select("lang", "source", "term", "p0", part_of(F.col("count"), F.col("n"), F.col("v")).alias("p"), part_of(F.col("total"), F.col("n_lang"), F.col("v")).alias("q"))
    valued = stored(valued, "divergence-postings")

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    single = valued.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), squared(F.col("p"), F.col("q")).alias("value"))
    single = single.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most_terms)

    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("o0"))
    two = groups.join(other, "lang").filter("source <> item")
    absent = two.select("lang", "source", "item", (F.col("v").cast("decimal(19,0)") * squared(F.col("p0"), F.col("o0"))).cast("decimal(38,0)").alias("value"))
    bars = valued.groupBy("lang", "source", "p0", "p").agg(F.count("*").alias("terms")).join(other, "lang").filter("source <> item")
    p, p0, o0 = F.col("p"), F.col("p0"), F.col("o0")
    times = lambda c: (F.col("terms").cast("decimal(19,0)") * c).cast("decimal(38,0)").alias("value")
    sides = F.array(
        F.struct("lang", "source", "item", times(squared(p, o0) - squared(p0, o0))),
        F.struct("lang", F.col("item").alias("source"), F.col("source").alias("item"), times(squared(o0, p) - squared(o0, p0))),
    )
    alone = bars.select(F.explode(sides).alias("_s")).select("_s.*")
    shared = valued.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("postings")).filter(F.size("postings") > 1).drop("term")
    both = _corrections(shared).withColumn("value", F.col("value").cast("decimal(38,0)"))
    summed = absent.unionByName(alone).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    pairs = summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(single)
