"""Helpers of the corpus operators: columns, running totals over a whole table, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewatch.session import stored


def utf8(text: str | Column) -> Column:
    """The bytes of a text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no other column has, in any case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """Texts of a batch from a binary column; malformed bytes become U+FFFD."""
    return [b.decode("utf-8", "replace") if b else "" for b in batch.column(name).to_pylist()]


def pieces(batch: pa.RecordBatch, name: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `limit` bytes of a binary or text column, so that a task's memory is bounded by its longest row."""
    sizes = _lengths(batch.column(name))
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def _lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def lists(values: np.ndarray, lengths: list[int], kind: pa.DataType) -> pa.Array:
    """A list column from its flat values and the rows' lengths."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def _running(amount: str, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            values = batch.column(amount).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(values)
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, dtype=np.int32)), pa.array(ends - values)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            total = int(ends[-1]) if len(ends) else total
    return run


def running_total(df: DataFrame, order: list[str], amount: str, into: str, name: str) -> DataFrame:
    """Adds to each row the sum of `amount` over all rows before it in the order of the whole table.

    Rows are range-partitioned and summed within their partition; the partitions' totals (one row each) are
    added up and given back. No task sees more than its range, whichever keys are frequent, as long as
    `order` tells most rows apart. The ranges are written once, so both uses see the same cut.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_before", T.LongType())])
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_running(amount, to_arrow_schema(schema)), schema)
    cut = stored(cut, name)
    ends = cut.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    starts = ends.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_start"))
    return cut.join(starts, "_part").withColumn(into, F.col("_before") + F.col("_start")).drop("_part", "_before", "_start")


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(id, component_id) of every id that an edge (a, b) touches; component_id is the smallest id reachable.

    Alternating large-star and small-star steps: each round links neighbours to the smallest id around them, so
    the number of rounds grows with the logarithm of the longest path. Aggregates combine before the shuffle, so
    a hub costs no more than other ids. Each round is written to the shared folder, which also cuts the lineage.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), f"{name}-0")
    if now.isEmpty():
        return now.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    seen = None
    for k in range(1, most_rounds + 1):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a > b").distinct()
        now = stored(small, f"{name}-{k}")
        sums = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"), F.count_distinct("a").alias("d")).first()
        if seen == (sums.n, sums.h) and sums.n == sums.d:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())
        seen = (sums.n, sums.h)
    raise RuntimeError(f"no components after {most_rounds} rounds")
