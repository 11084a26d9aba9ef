"""Running a stream to the end of what its source holds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewatch.session import workspace


def drain_to_table(stream: DataFrame, name: str) -> tuple[DataFrame, StreamingQuery]:
    """Writes all available input through the stream into a new parquet table, exactly once."""
    spark = stream.sparkSession
    root = workspace(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(f"{root}/table")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/table"), query


def drain_batches(stream: DataFrame, name: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Runs ``sink`` on every batch of the available input."""
    root = workspace(stream.sparkSession, name)
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def every(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, seconds: int = 60) -> StreamingQuery:
    """The same, running on at a fixed interval."""
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
        .start()
    )
