"""One monitoring cycle: ingest, roll up, detect, explain, decide, alert, heal, report."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch import schemas
from tidewatch.config import Settings
from tidewatch.operators import alerts as alert_ops
from tidewatch.operators import anomaly as anomaly_ops
from tidewatch.operators import causal, decisions, healing, setops, windows
from tidewatch.operators import kpi as kpi_ops
from tidewatch.session import checkpoint_dir, prepare, remove_path, stored
from tidewatch.sources import readers, sinks


def findings_for(orders: DataFrame, events: DataFrame | None, period: str = "hour", types: Sequence[str] = (), settings: Settings = Settings(), adjusted: bool = True) -> DataFrame:
    """Best cause of every region and category from its bucketed features: effects with all other features held fixed, plain slopes where these are not known, or everywhere if not ``adjusted``."""
    features = kpi_ops.order_features(orders, period)
    if events is not None and types:
        features = kpi_ops.join_event_features(features, kpi_ops.event_features(events, types, period))
    found = causal.adjusted_findings if adjusted else causal.ols_findings
    return causal.best_cause(found(features, settings=settings))


def decide(anomalies: DataFrame, findings: DataFrame, kpi: DataFrame, settings: Settings = Settings(), limit: int | None = None) -> DataFrame:
    """Decision records of all anomalies, or of the ``limit`` strongest, each with its cause."""
    n = settings.decisions_per_cycle if limit is None else limit
    top = anomalies if n is None else windows.top_abs(anomalies, "z_score", n, ("metric_name", "region", "category"))
    joined = causal.attach_findings(top.withColumn("detected_at", F.col("window_end")), findings)
    return decisions.decision_records(joined, kpi, settings)


def _utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _dates(df: DataFrame, column: str) -> list:
    """Distinct partition dates of a batch: as many as days, whatever the number of rows."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def _bucket_dates(spark: SparkSession, dates: Sequence, period: str, partition: str) -> list:
    """Partition dates of all buckets that the given partitions touch."""
    days = spark.createDataFrame([(d,) for d in dates], "d date")
    step = lambda unit: F.make_interval(**{f"{unit}s": F.lit(1)})
    end = F.to_date(F.col("d").cast("timestamp") + step(partition) - F.make_interval(secs=F.lit(1)))
    first = F.to_date(F.date_trunc(period, F.col("d").cast("timestamp")))
    last = F.to_date(F.date_trunc(period, end.cast("timestamp")) + step(period) - F.make_interval(secs=F.lit(1)))
    listed = days.select(F.explode(F.sequence(first, F.greatest(last, end))).alias("d"))
    return _dates(listed.select(F.to_date(F.date_trunc(partition, F.col("d").cast("timestamp"))).alias("d")), "d")


def run_cycle(
    spark: SparkSession,
    store: str,
    orders: DataFrame,
    events: DataFrame,
    now: datetime,
    settings: Settings = Settings(),
    period: str = "hour",
    event_types: Sequence[str] = ("page_view", "add_to_cart", "remove_from_cart", "checkout", "purchase"),
    pipeline: str = "orders",
    lookback_hours: int | None = None,
    clock: Callable[[], datetime] = _utc_now,
    partition: str = "day",
) -> DataFrame:
    """Runs one cycle on the batch ``orders``/``events`` against the tables under ``store``.

    Returns the summary as one row of counts and writes it as JSON; the lists
    (anomalies, causes, decisions, drift) are JSON files beside it. Each stage
    writes its table and later stages read what was stored, so a lost executor
    never replays the whole cycle. Raw tables are partitioned by date (the first of its
    ``partition``: day, week or month) and read under their declared schema. A cycle reads the dates of the buckets its batch
    touches, and those of the look-back, never the whole history. ``now`` is the
    time the data is looked at from, ``clock`` gives the times of the run itself.

    Columns the batch lacks are added on writing, unknown ones are kept and
    tagged in ``schema_baseline``, nulls in required columns are repaired in the
    partitions the batch touched: written beside the table, audited by a second
    scan, then put in their place. A second cycle on the same store reports none
    of these again.
    """
    prepare(spark)
    checkpoint_dir(spark)
    run_id = uuid.uuid4().hex
    at = lambda name: f"{store}/{name}"
    hours = lookback_hours or settings.lookback_hours
    started, rows, n_anomalies = clock(), 0, 0
    sinks.append(sinks.start_run(spark, run_id, pipeline, started), at("pipeline_runs"))
    try:
        # 1. Drift of the batch against declared and tagged columns, from metadata only; then ingest.
        tagged = sinks.read_baseline(spark, at("schema_baseline"))
        batch = {"raw_orders": orders, "raw_events": events}
        expected = {t: _expected(df, t, tagged.get(t, {})) for t, df in batch.items()}
        drift = healing.drift_vs_baseline(setops.schema_rows(spark, batch), setops.expected_rows(spark, expected))
        log = [r for t in batch for r in healing.schema_log(drift, t)]
        for t, df in batch.items():
            kinds = {**{f.name: f.dataType.simpleString() for f in schemas.TABLES[t].fields}, **dict(df.dtypes)}
            new = {r[1]: kinds[r[1]] for r in log if r[0] == t and r[2] in ("NEW_COLUMN", "DROPPED_COLUMN")}
            if new:
                sinks.tag_columns(spark, t, new, at("schema_baseline"), now)
                tagged[t] = {**tagged.get(t, {}), **new}
        shaped = {t: sinks.shape_raw(df, t, tagged.get(t, {}), partition) for t, df in batch.items()}
        dates = {t: _dates(df, sinks.RAW_PARTITIONS[t][1]) for t, df in shaped.items()}
        rows = sinks.append(shaped["raw_orders"], at("raw_orders"), [sinks.RAW_PARTITIONS["raw_orders"][1]])
        sinks.append(shaped["raw_events"], at("raw_events"), [sinks.RAW_PARTITIONS["raw_events"][1]])
        raw = lambda t, days: sinks.read_raw(spark, at(t), t, tagged.get(t, {}), days)

        # 2. Rebuild the buckets the new orders touch, late ones included, from the dates of these buckets.
        near = raw("raw_orders", _bucket_dates(spark, dates["raw_orders"], period, partition))
        buckets = shaped["raw_orders"].select(F.date_trunc(period, "order_ts").alias("_b")).distinct()
        touched = near.join(buckets, F.date_trunc(period, "order_ts") == F.col("_b"), "left_semi")
        snapshots = kpi_ops.kpi_by_period(touched, period).withColumn("created_at", F.lit(now).cast("timestamp"))
        sinks.upsert_snapshots(spark, sinks.shape(snapshots, "kpi_snapshots"), at("kpi_snapshots"), run_id=run_id)

        # 3. Detect on the recent snapshots of this period.
        kpis = readers.read_table(spark, store, "kpi_snapshots")
        recent = kpi_ops.by_period(kpi_ops.lookback(kpis, hours, now), kpi_ops.PERIOD_NAMES.get(period, period))
        since = F.lit((now - timedelta(hours=hours)).date())
        recent = recent.where(F.col("snapshot_date") >= since)
        found = stored(anomaly_ops.detect(recent, settings).withColumn("detected_at", F.lit(now).cast("timestamp")), "cycle-anomalies")
        n_anomalies = sinks.write_anomalies(found, at("anomaly_events"))

        # 4. Explain and decide.
        since = F.to_date(F.date_trunc(partition, since.cast("timestamp")))
        past_orders = kpi_ops.lookback(raw("raw_orders", None).where(F.col("order_date") >= since), hours, now, "order_ts")
        past_events = kpi_ops.lookback(raw("raw_events", None).where(F.col("event_date") >= since), hours, now, "event_ts")
        findings = findings_for(past_orders, past_events, period, event_types, settings)
        made = stored(decide(found, findings, recent, settings), "cycle-decisions")
        finding_rows = made.select("anomaly_id", "cause_variable", "effect_variable", "ate", "confidence", "method", "explanation")
        sinks.write_findings(finding_rows.withColumn("analyzed_at", F.lit(now)), at("causal_findings"))
        sinks.write_decisions(made.withColumn("decided_at", F.lit(now)), at("agent_decisions"))

        # 5. Alerts of the decided anomalies.
        decided = found.join(made.select("anomaly_id"), "anomaly_id", "left_semi")
        fired = alert_ops.route_alerts(decided, made, F.lit(now).cast("timestamp"))
        sinks.append_alert_log(fired, at("alerts"))

        # 6. Repair the touched partitions: write, audit, publish.
        for t in batch:
            log += _repair(spark, raw(t, dates[t]), at(t), t, run_id, expected[t])
        healed = healing.as_log(spark, log, expected, now)
        sinks.write_drift(healed, at("schema_drift_log"))

        report = f"{at('reports')}/{run_id}"
        lists = {
            "anomalies": found.select("anomaly_id", "metric_name", "metric_value", "expected_value", "z_score", "severity", "region", "category"),
            "causal_findings": finding_rows, "decisions": made.select("anomaly_id", "priority", "final_action"), "drift": healed,
        }
        sinks.write_lists_json(lists, report)
        sinks.write_report_json(_summary(spark, run_id, now, rows, n_anomalies, made, log), f"{report}/summary")
        sinks.append(sinks.finish_run(spark, run_id, pipeline, "SUCCESS", started, clock(), rows, n_anomalies, None), at("pipeline_runs"))
        return spark.read.json(f"{report}/summary")
    except Exception as failure:
        sinks.append(sinks.finish_run(spark, run_id, pipeline, "FAILED", started, clock(), rows, n_anomalies, str(failure)), at("pipeline_runs"))
        raise


def _expected(df: DataFrame, table: str, tagged: dict[str, str]) -> dict[str, str]:
    """What a batch is compared with: the declared columns but for those that earlier batches lacked too, and the unknown ones that are tagged."""
    declared = {c: k for c, k in fv.EXPECTED_SCHEMAS[table].items() if c in df.columns or c not in tagged}
    return declared | {f.name: setops.sql_name(f.dataType) for f in df.schema.fields if f.name in tagged and f.name not in declared}


def _repair(spark: SparkSession, part: DataFrame, path: str, table: str, run_id: str, expected: dict[str, str]) -> list[tuple]:
    """Log rows of the repair of some partitions of a stored raw table."""
    partition, staging = sinks.RAW_PARTITIONS[table][1], sinks.staging_path(path, run_id)

    def stage(df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").partitionBy(partition).parquet(staging)
        return spark.read.schema(part.schema).parquet(staging)

    log = healing.heal_partitions(part, table, partition, stage, lambda df: sinks.publish(df, path, partition), expected)
    if log:
        remove_path(spark, staging)
    return log


def _summary(spark: SparkSession, run_id: str, now: datetime, rows: int, n_anomalies: int, made: DataFrame, log: list[tuple]) -> DataFrame:
    """One row of counts; what is counted is in the list files and tables."""
    by = made.groupBy().agg(F.count(F.lit(1)).alias("decisions"), *[F.count_if(F.col("priority") == p).alias(p) for p in ("P1", "P2", "P3", "P4")])
    return by.select(
        F.lit(now.isoformat()).alias("timestamp"),
        F.struct(F.lit(run_id).alias("run_id"), F.lit(rows).alias("rows"), F.lit("SUCCESS").alias("status")).alias("ingestion"),
        F.lit(n_anomalies).alias("anomalies_found"),
        "decisions",
        F.struct("P1", "P2", "P3", "P4").alias("priorities"),
        F.struct(F.lit(len(log)).alias("drifts"), F.lit(sum(r[5] for r in log)).alias("healed")).alias("healing"),
    )
