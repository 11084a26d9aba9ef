"""Writers. Every table is append-only or replaced by whole partitions."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas
from tidewatch.operators import windows
from tidewatch.session import path_exists, remove_path


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Append all rows and return how many were written, counted during the write."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(seen.get["rows"])


def shape(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in order and type; missing ones are NULL, extra ones are dropped."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.TABLES[table].fields
        ]
    )


# Raw tables: their time column, the date column that partitions them, and the date of rows without a time.
RAW_PARTITIONS = {"raw_orders": ("order_ts", "order_date"), "raw_events": ("event_ts", "event_date")}
NO_DATE = "1970-01-01"


def shape_raw(df: DataFrame, table: str, tagged: Mapping[str, str] = {}, unit: str = "day") -> DataFrame:
    """A raw batch in the form in which it is stored: declared columns in order and type, then tagged ones in theirs, then the partition date.

    A cell that cannot be cast becomes NULL, so the null checks see it. Declared columns that are missing are added, booleans as false.
    Rows are dealt by date, large dates over several tasks and small ones together, so that a date has few files.
    """
    time, date = RAW_PARTITIONS[table]
    have = dict(df.dtypes)

    def declared(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(False if f.dataType.simpleString() == "boolean" else None).cast(f.dataType).alias(f.name)
        return F.col(f.name).try_cast(f.dataType).alias(f.name)

    rest = [F.col(f"`{c}`").try_cast(k).alias(c) for c, k in tagged.items() if c in have and c not in schemas.TABLES[table].names]
    shaped = df.select(*[declared(f) for f in schemas.TABLES[table].fields], *rest)
    shaped = shaped.withColumn(date, F.to_date(F.date_trunc(unit, F.coalesce(time, F.to_timestamp(F.lit(NO_DATE))))))
    return shaped.hint("rebalance", date)


def raw_schema(table: str, extra: Mapping[str, str]) -> T.StructType:
    """Schema under which a raw table is read: declared columns, columns added since by name and type, partition date."""
    schema = T.StructType(list(schemas.TABLES[table].fields))
    for name, kind in extra.items():
        if name not in schema.names:
            schema = schema.add(name, T.DataType.fromDDL(kind))
    return schema.add(RAW_PARTITIONS[table][1], "date")


def read_raw(spark: SparkSession, path: str, table: str, extra: Mapping[str, str], dates: Sequence | None = None) -> DataFrame:
    """A stored raw table, or only the partitions of the given dates."""
    df = spark.read.schema(raw_schema(table, extra)).parquet(path)
    return df if dates is None else df.where(F.col(RAW_PARTITIONS[table][1]).isin(list(dates)))


# -- snapshots ----------------------------------------------------------------------

SNAPSHOT_KEYS = ("snapshot_ts", "period", "region", "category")


def merge_snapshots(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str] = SNAPSHOT_KEYS, version: str = "created_at"
) -> DataFrame:
    """Union in which each key keeps its newest version; new columns are added."""
    both = current.withColumn("_src", F.lit(0)).unionByName(incoming.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    newest = F.struct(F.col(version), F.col("_src")) if version in both.columns else F.struct("_src")
    rest = [c for c in both.columns if c not in keys and c != "_src"]
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def insert_new(current: DataFrame, incoming: DataFrame, keys: Sequence[str] = SNAPSHOT_KEYS) -> DataFrame:
    """Incoming rows whose key is not stored yet, one per key."""
    fresh = incoming.join(current.select(*keys), list(keys), "left_anti")
    return windows.first_per_key(fresh, list(keys), [F.col(c) for c in fresh.columns if c not in keys])


def upsert_snapshots(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    partition: str = "snapshot_date",
    keys: Sequence[str] = SNAPSHOT_KEYS,
    run_id: str | None = None,
) -> None:
    """Merge into a date-partitioned table, rewriting only the partitions that change.

    The merged partitions go to a staging folder first. The table is touched
    only by the final copy, so a failed job leaves the old version readable.
    """
    incoming = incoming.withColumn(partition, F.to_date("snapshot_ts"))
    if not path_exists(spark, path):
        once = merge_snapshots(incoming.limit(0), incoming, keys)
        once.write.mode("append").partitionBy(partition).parquet(path)
        return
    current = spark.read.option("mergeSchema", "true").parquet(path)
    touched = incoming.select(partition).distinct()
    affected = current.join(touched, partition, "left_semi")
    staging = staging_path(path, run_id)
    merge_snapshots(affected, incoming, keys).write.mode("overwrite").partitionBy(partition).parquet(staging)
    publish(spark.read.parquet(staging), path, partition)
    remove_path(spark, staging)


def staging_path(path: str, run_id: str | None = None) -> str:
    """Folder beside a table for one run; runs never share it."""
    return f"{path.rstrip('/')}__staging_{run_id or uuid.uuid4().hex}"


def publish(staged: DataFrame, path: str, partition: str) -> None:
    """Replaces the table's partitions that the staged frame holds, and no others."""
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


# -- records ------------------------------------------------------------------------


def as_anomaly_records(df: DataFrame) -> DataFrame:
    """Rounded values, context as JSON."""
    out = df
    for c in ("metric_value", "expected_value", "z_score"):
        out = out.withColumn(c, F.round(c, 4))
    out = out.withColumn("isolation_score", F.round("isolation_score", 6))
    if dict(df.dtypes)["raw_context"] != "string":
        out = out.withColumn("raw_context", F.to_json("raw_context"))
    return out


def write_anomalies(df: DataFrame, path: str) -> int:
    return append(shape(as_anomaly_records(df), "anomaly_events"), path)


def write_findings(df: DataFrame, path: str) -> int:
    if "supporting_data" in df.columns and dict(df.dtypes)["supporting_data"] != "string":
        df = df.withColumn("supporting_data", F.to_json("supporting_data"))
    return append(shape(df, "causal_findings"), path)


def write_decisions(df: DataFrame, path: str) -> int:
    if "debate_history" in df.columns and "metadata" not in df.columns:
        df = df.withColumn("metadata", F.to_json(F.struct("debate_history")))
    if "status" not in df.columns:
        df = df.withColumn("status", F.lit("PENDING"))
    return append(shape(df, "agent_decisions"), path)


def write_drift(df: DataFrame, path: str) -> int:
    return append(shape(df, "schema_drift_log"), path)


# -- run audit -----------------------------------------------------------------------


def start_run(spark: SparkSession, run_id: str, pipeline: str, now) -> DataFrame:
    """RUNNING event of a run. Runs are logged as events and never updated."""
    row = [(run_id, now, now, None, pipeline, "RUNNING", 0, 0, None, None)]
    return spark.createDataFrame(row, schemas.TABLES["pipeline_runs"])


def finish_run(
    spark: SparkSession, run_id: str, pipeline: str, status: str, started, now, rows: int = 0, anomalies: int = 0, error: str | None = None
) -> DataFrame:
    row = [(run_id, now, started, now, pipeline, status, rows, anomalies, error, None)]
    return spark.createDataFrame(row, schemas.TABLES["pipeline_runs"])


def latest_runs(events: DataFrame) -> DataFrame:
    """Present state of every run: its last event, a final state winning over RUNNING."""
    final = (F.col("status") != "RUNNING").cast("int")
    rest = [c for c in events.columns if c != "run_id"]
    picked = events.groupBy("run_id").agg(F.max_by(F.struct(*rest), F.struct("event_ts", final)).alias("_r"))
    return picked.select("run_id", *[F.col("_r")[c].alias(c) for c in rest])


# -- logs and reports -----------------------------------------------------------------


def append_alert_log(alerts: DataFrame, path: str) -> int:
    """Alerts as JSON lines; written for every priority."""
    return append(alerts, path, fmt="json")


def audit_rows(orders: DataFrame, now: Column) -> DataFrame:
    """Audit records with defaults for what an order lacks; ``now`` to the second, as text."""

    def pick(name: str, default) -> Column:
        known = F.col(name) if name in orders.columns else F.lit(None)
        return F.coalesce(known.cast("string" if isinstance(default, str) else "double"), F.lit(default)).alias(name)

    return orders.select(
        pick("order_id", "N/A"),
        pick("item", "N/A"),
        pick("amount", 0.0),
        F.col("ai_decision").cast("string").alias("ai_decision"),
        F.col("action_taken").cast("string").alias("action_taken"),
        F.date_format(now, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )


def append_audit(orders: DataFrame, path: str, now: Column) -> int:
    return append(audit_rows(orders, now), path)


def write_report_json(report: DataFrame, path: str) -> None:
    """One-row nested run summary as a single JSON document. Lists go into files of their own, see :func:`write_lists_json`."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_lists_json(frames: Mapping[str, DataFrame], path: str) -> None:
    """Each list of a report as JSON lines in a folder of its name, written by as many tasks as it has partitions."""
    for name, df in frames.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


# -- columns added since ------------------------------------------------------------------

BASELINE = "table_name string, column_name string, spark_type string, comment string, tagged_at timestamp"


def read_baseline(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Columns that were found and tagged by earlier runs: type by table and column. As many rows as such columns."""
    if not path_exists(spark, path):
        return {}
    found: dict[str, dict[str, str]] = {}
    for r in spark.read.schema(BASELINE).parquet(path).orderBy("tagged_at").collect():
        found.setdefault(r["table_name"], {}).setdefault(r["column_name"], r["spark_type"])
    return found


def tag_columns(spark: SparkSession, table: str, columns: Mapping[str, str], path: str, now) -> int:
    """Adds columns to the baseline, with a comment on where they come from; later runs know them."""
    note = f"AUTO_DETECTED: new column added outside baseline schema at {now.isoformat()}"
    return append(spark.createDataFrame([(table, c, kind, note, now) for c, kind in columns.items()], BASELINE), path)
