"""Token counts of flat token files without an index, by scanning for end-of-document ids."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.bpe import read_ranks
from tidewatch.llm.common import pieces, texts, utf8


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def write_flat(df: DataFrame, folder: str, path: str, pattern: str, end: int, width: int = 2, docs_per_file: int = 5000, text: str = "text") -> None:
    """Token files in `folder`: the ids of each text, little-endian unsigned numbers of `width` bytes, then the id `end`; nothing else.

    Spark's own text writer writes them, so the folder may be in any store: a row is a document's bytes, the line
    separator is the end id. Null and empty texts are an end id alone. An id beyond the width raises OverflowError. Files
    hold whole documents, `docs_per_file` at most.
    """
    limit = 1 << 8 * width
    if end >= limit:
        raise OverflowError(f"id {end} does not fit {width} bytes")
    sent = df.select(utf8(F.col(f"`{text}`")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path, pattern)
        for whole in batches:
            for batch in pieces(whole, "_text"):
                rows = []
                for value in texts(batch, "_text"):
                    ids = np.array(encoding.encode_ordinary(value), dtype=np.int64)
                    if len(ids) and ids.max() >= limit:
                        raise OverflowError(f"id {ids.max()} does not fit {width} bytes")
                    rows.append(ids.astype(f"<u{width}").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["row"])

    separator = int(end).to_bytes(width, "little").decode("latin-1")
    flat = sent.mapInArrow(run, "row binary").select(F.col("row").cast("string").alias("row"))
    flat.write.option("encoding", "ISO-8859-1").option("lineSep", separator).option("maxRecordsPerFile", docs_per_file).text(folder)


def read_blocks(spark: SparkSession, folder: str, width: int = 2, block_ids: int = 1 << 20) -> DataFrame:
    """(file, block, ids): flat files cut into blocks of `block_ids` ids, wherever documents begin; the last block of a file may be shorter.

    A file whose length is no multiple of `width` raises ValueError. A file must fit a task (see docs_per_file).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                data = memoryview(content.as_buffer())
                if len(data) % width:
                    raise ValueError(f"{path.as_py()} ends within an id")
                for n, start in enumerate(range(0, len(data), width * block_ids)):
                    part = data[start : start + width * block_ids]
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([n], pa.int64()), pa.array([bytes(part)], pa.binary())], names=["file", "block", "ids"])

    return files.mapInArrow(run, "file string, block long, ids binary")


def token_counts(blocks: DataFrame, end: int, width: int = 2) -> DataFrame:
    """(file, doc_no, start, n_tokens, ended) of each document in the blocks (file, block, ids) of flat token files.

    A document is the ids up to an end id, without it; two end ids in a row enclose an empty document. Ids after a file's
    last end id are a document with ended = false; a file that ends with an end id has none. doc_no counts from 0 in the
    file, start is the place of the document's first id. An empty file, and an empty or null block, give no rows.

    Each block is searched for end ids at once and alone, wherever documents begin. What crosses its borders is settled by
    running totals over one small row per block: ids and end ids before it, and where the last end id before it lies.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, raw in zip(*batch.columns, strict=True):
                ids = np.frombuffer(raw.as_buffer(), dtype=f"<u{width}") if raw.is_valid else np.zeros(0, dtype=f"<u{width}")
                found = np.flatnonzero(ids == end)
                yield pa.RecordBatch.from_arrays([pa.array([file.as_py()], pa.string()), pa.array([block.as_py()], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([found.tolist()], pa.list_(pa.int64()))], names=["file", "block", "n", "ends"])

    seen = blocks.select("file", "block", "ids").mapInArrow(scan, "file string, block long, n long, ends array<long>")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = seen.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"), F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("docs"), F.lead("block").over(order).isNull().alias("final"))
    placed = placed.withColumn("last", F.when(F.size("ends") > 0, F.col("at") + F.element_at("ends", -1) + 1))
    placed = placed.withColumn("open", F.coalesce(F.max("last").over(before), F.lit(0))).withColumn("rest", F.col("at") + F.col("n") - F.coalesce("last", "open"))
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: F.col("at") + e + 1))
    stops = F.concat(F.transform("ends", lambda e: F.col("at") + e), F.when(F.col("final") & (F.col("rest") > 0), F.array(F.col("at") + F.col("n"))).otherwise(F.array().cast("array<long>")))
    each = placed.select("file", "docs", F.size("ends").alias("closed"), F.posexplode(F.transform(stops, lambda stop, i: F.struct(F.get(starts, i).alias("start"), stop.alias("stop")))).alias("i", "d"))
    return each.select("file", (F.col("docs") + F.col("i")).alias("doc_no"), "d.start", (F.col("d.stop") - F.col("d.start")).alias("n_tokens"), (F.col("i") < F.col("closed")).alias("ended"))
