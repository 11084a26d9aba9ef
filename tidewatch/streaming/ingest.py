"""Message streams: files or Kafka in, typed rows out, with a schema guard per batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas
from tidewatch.operators import setops
from tidewatch.session import stored
from tidewatch.sources.readers import decode_message


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of (topic, JSON) envelopes from a folder of JSON lines."""
    reader = spark.readStream.schema(schemas.TABLES["messages"])
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def kafka_messages(spark: SparkSession, servers: str, topics: Sequence[str], **options: str) -> DataFrame:
    """The same envelopes from Kafka (needs the Kafka connector on the class path)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .options(**options)
        .load()
    )
    return raw.select("topic", F.col("value").cast("string").alias("data"), F.col("timestamp").alias("produced_at"))


def ingest_stream(messages: DataFrame, topic: str, schema: T.StructType | str) -> DataFrame:
    """Rows of one topic. The checkpoint of the query that uses them keeps the read position."""
    return decode_message(messages, schema, topic)


REASON_TOPIC, REASON_BODY = "no topic", "malformed payload"


def judged_messages(messages: DataFrame, schema: T.StructType | str, topic: str | None = None) -> DataFrame:
    """Envelopes of one topic with their typed row ``m`` and why they are rejected, NULL where they are not.

    A payload that is missing or is not the JSON of a row of ``schema`` is rejected as a whole, also where single cells could be read.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*declared.fields, T.StructField("_corrupt", T.StringType())])
    read = F.from_json("data", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    if topic is not None:
        messages = messages.where((F.col("topic") == topic) | F.col("topic").isNull())
    reason = F.when(F.col("topic").isNull(), REASON_TOPIC).when(F.col("_m").isNull() | F.col("_m._corrupt").isNotNull(), REASON_BODY)
    kept = F.struct(*[F.col("_m")[f.name].alias(f.name) for f in declared.fields])
    return messages.withColumn("_m", read).select("topic", "data", kept.alias("m"), reason.alias("reason"))


def with_dead_letters(
    schema: T.StructType | str, topic: str, sink: Callable[[DataFrame, int], None], dead_path: str
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: rows go to ``sink``, rejected envelopes with their reason to ``dead_path``.

    The batch is parsed once and stored for both. What the same batch id rejected before is replaced.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        judged = stored(judged_messages(batch, schema, topic), "judged-messages")
        judged.where("reason is not null").select("topic", "data", "reason").write.mode("overwrite").parquet(f"{dead_path}/batch={batch_id}")
        sink(judged.where("reason is null").select("m.*"), batch_id)

    return run


def payload_columns(messages: DataFrame, table: str) -> DataFrame:
    """Columns seen in the JSON payloads of a batch, as schema rows."""
    names = messages.select(F.explode(F.json_object_keys("data")).alias("column_name")).distinct()
    return names.select(F.lit(table).alias("table_name"), "column_name", F.lit("JSON").alias("type_name"))


def drift_guard(messages: DataFrame, known: DataFrame, table: str, ignore: Sequence[str] = ()) -> DataFrame:
    """New and dropped columns of a batch against the known schema rows.

    Works on the payload text, so columns that typed parsing would drop are seen.
    """
    return setops.schema_diff(payload_columns(messages, table), known, ignore)


def guarded(
    known: DataFrame, table: str, sink: Callable[[DataFrame, int], None], on_drift: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: drift check first, then the batch goes to its sink."""

    def run(batch: DataFrame, batch_id: int) -> None:
        drift = drift_guard(batch, known, table)
        if not drift.isEmpty():
            on_drift(drift, batch_id)
        sink(batch, batch_id)

    return run
