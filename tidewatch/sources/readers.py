"""Reading stored tables, databases, CSV files, message envelopes and logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas

# Time column used by ``since`` per table.
TIME_COLUMNS = {
    "raw_orders": "order_ts",
    "raw_events": "event_ts",
    "kpi_snapshots": "snapshot_ts",
    "anomaly_events": "detected_at",
    "causal_findings": "analyzed_at",
    "agent_decisions": "decided_at",
    "schema_drift_log": "detected_at",
    "pipeline_runs": "event_ts",
}


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    since: datetime | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Stored table under ``root`` with its declared schema; ``since`` is pushed to the scan."""
    reader = spark.read
    declared = schema or schemas.TABLES.get(name)
    if declared is not None:
        reader = reader.schema(declared)
    df = reader.parquet(f"{root}/{name}")
    if since is not None:
        df = df.where(F.col(TIME_COLUMNS[name]) >= F.lit(since))
    return df


def jdbc_options(url: str, table: str, column: str, lower, upper, partitions: int = 64, **extra: str) -> dict[str, str]:
    """Options for a range-partitioned database read: ``spark.read.format('jdbc').options(**o).load()``."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        **extra,
    }


def read_csv_any(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV with a header; all cells stay strings until they are profiled."""
    return (
        spark.read.option("header", True).option("multiLine", False).option("inferSchema", False).csv(path)
    )


CORRUPT = "_corrupt"


def read_csv_rescued(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV with a header, each line that does not fit the header as a whole in ``_corrupt`` (NULL for the others).

    A line with too few or too many cells is kept, not cut or padded silently. Files
    whose headers differ from the first one's are an error.
    """
    header = read_csv_any(spark, path).schema
    schema = T.StructType([*header.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def read_alert_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines alert log; malformed lines are skipped."""
    return spark.read.schema(schemas.ALERT).option("mode", "DROPMALFORMED").json(path)


def encode_message(df: DataFrame, topic: str) -> DataFrame:
    """Rows as (topic, JSON) envelopes."""
    return df.select(F.lit(topic).alias("topic"), F.to_json(F.struct(*df.columns)).alias("data"))


def decode_message(df: DataFrame, schema: T.StructType | str, topic: str | None = None) -> DataFrame:
    """Envelopes of one topic back to rows; works on batch and on streams."""
    if topic is not None:
        df = df.where(F.col("topic") == topic)
    return df.select(F.from_json("data", schema).alias("m")).select("m.*")
