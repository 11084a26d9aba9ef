"""Exact duplicates by composable polynomial fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import pieces, utf8
from tidewatch.session import stored

#: Moduli and bases of the two fingerprints; bytes of a chunk.
PRIMES, BASES, CHUNK = (2147483647, 2147483629), (1103515245, 1664525), 4096


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    value = 1
    for i in range(n):
        out[i], value = value, value * base % prime
    return out


_SHIFTS = [_powers(b, p, CHUNK) for b, p in zip(BASES, PRIMES, strict=True)]


def combine(left: int, right: int, length: int, which: int) -> int:
    """Fingerprint of a text from those of its two parts: the left one shifted by the right one's length."""
    return (left * pow(BASES[which], length, PRIMES[which]) + right) % PRIMES[which]


def chunk_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: int) -> np.ndarray:
    """Fingerprints of chunks of at most CHUNK bytes, all at once: sum of (byte + 1) x base^(bytes after it)."""
    after = np.repeat(starts + lengths, lengths) - np.arange(int(lengths.sum())) - 1 if len(starts) else np.zeros(0, np.int64)
    terms = (data.astype(np.uint64) + np.uint64(1)) * _SHIFTS[which][after]
    full = np.flatnonzero(lengths > 0)
    out = np.zeros(len(starts), dtype=np.uint64)
    if len(full):
        out[full] = np.add.reduceat(terms, starts[full]) % np.uint64(PRIMES[which])
    return out


def fingerprints(values: list[bytes]) -> list[tuple[int, int]]:
    """Two fingerprints of each text; chunk hashes of a piece of all texts are computed side by side and combined in order."""
    out = [(0, 0)] * len(values)
    waiting: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal waiting, size
        if waiting:
            lengths = np.array([len(x) for _, x in waiting], dtype=np.int64)
            starts = np.cumsum(lengths) - lengths
            data = np.frombuffer(b"".join(x for _, x in waiting), dtype=np.uint8)
            both = [chunk_hashes(data, starts, lengths, w).tolist() for w in (0, 1)]
            for k, (i, chunk) in enumerate(waiting):
                out[i] = tuple(combine(out[i][w], both[w][k], len(chunk), w) for w in (0, 1))
        waiting, size = [], 0

    for i, value in enumerate(values):
        for start in range(0, len(value), CHUNK):
            chunk = value[start : start + CHUNK]
            waiting.append((i, chunk))
            size += len(chunk)
            if size >= 1 << 20:
                flush()
    flush()
    return out


def _same(left: str, right: str, size: str, step: int = 1 << 16):
    """Whether two byte strings of one length agree, compared chunk by chunk."""
    chunks = F.sequence(F.lit(0), F.floor(F.col(size) / step).cast("int"))
    return F.forall(chunks, lambda i: F.substring(F.col(left), i * step + 1, step) == F.substring(F.col(right), i * step + 1, step))


def find_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row; of rows with equal text the one with the largest doc_id stays.

    Texts are compared as they are, byte by byte; null counts as empty. A null doc_id counts as smaller than all others
    (keep_id is null if no row of the group has one). Of rows that repeat both doc_id and text, each is marked by its
    doc_id, so kept may hold for several. An empty table gives an empty one. Only the two named columns are read.

    Fingerprints of chunks combine by shifting, so a text's fingerprint needs no pass over the whole text in one piece.
    Texts whose fingerprints and lengths agree with another one's are fetched and compared chunk by chunk with one of
    their group; those that differ from it, if there ever are any, are told apart by SHA-256. Groups are aggregated
    before they are shuffled and joined back, so a group may hold any share of the rows.
    """
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), utf8(F.col(f"`{text}`")).alias("body")).withColumn("sha", F.sha2("body", 256)).withColumn("size", F.length("body").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "body"):
                found = fingerprints(batch.column("body").to_pylist())
                joined = pa.array([a << 31 | b for a, b in found], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("size"), batch.column("sha"), joined], names=["doc_id", "size", "sha", "mark"])

    marked = stored(docs.mapInArrow(run, "doc_id long, size long, sha string, mark long"), "dedup-marks")
    groups = marked.groupBy("mark", "size").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "sha")).alias("model")).filter("n > 1").select("mark", "size", "n", F.col("model.doc_id").alias("model_id"), F.col("model.sha").alias("model_sha"))
    groups = stored(groups, "dedup-groups")
    suspects = marked.join(groups, ["mark", "size"]).select("doc_id", "sha", "mark", "size").distinct()
    bodies = docs.withColumnRenamed("doc_id", "d").withColumnRenamed("sha", "s").select("d", "s", "body")
    fetched = stored(suspects.join(bodies, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("sha") == F.col("s"))).select("doc_id", "sha", "mark", "size", "body"), "dedup-suspects")
    models = groups.join(fetched.withColumnRenamed("body", "model"), (F.col("model_id").eqNullSafe(F.col("doc_id"))) & (F.col("model_sha") == F.col("sha")) & (groups["mark"] == fetched["mark"])).select(groups["mark"].alias("m"), groups["size"].alias("z"), "model").dropDuplicates(["m", "z"])
    other = fetched.join(models, (F.col("mark") == F.col("m")) & (F.col("size") == F.col("z"))).filter(~_same("body", "model", "size")).select("mark", "size", "sha", F.lit(True).alias("odd")).distinct()
    classes = marked.join(other, ["mark", "size", "sha"], "left").withColumn("own", F.when(F.col("odd"), F.col("sha")).otherwise(F.lit("")))
    sizes = classes.groupBy("mark", "size", "own").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    judged = classes.join(sizes, ["mark", "size", "own"])
    return judged.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))
