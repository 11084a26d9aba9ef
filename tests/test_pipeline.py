from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import START, kpi_frame, kpi_rows
from tidewatch import fixed_values as fv
from tidewatch import schemas
from tidewatch.config import Settings
from tidewatch.functions import scalars as S
from tidewatch.operators import analytics, healing, profile, quality, setops
from tidewatch.operators import kpi as kpi_ops
from tidewatch.plans import cycle
from tidewatch.sources import readers, sinks
from tidewatch.streaming import anomalies as stream_anomalies
from tidewatch.streaming import ingest, kpis, timed
from tidewatch.streaming.run import drain_batches, drain_to_table

NOW = datetime(2024, 1, 10)

ORDER_SCHEMA = (
    "order_id bigint, customer_id bigint, product_id bigint, category string, region string, order_ts timestamp, quantity int, "
    "unit_price double, discount_pct double, payment_method string, is_returned boolean"
)


def orders(spark, hours=72, per_hour=6):
    rows = []
    for h in range(hours):
        for i in range(per_hour):
            n = h * per_hour + i
            price = 20.0 + (n * 7) % 13
            if h == hours - 1 and i % 2 == 0:
                price *= 40
            region, category = ("North", "Books") if i % 2 == 0 else ("South", "Sports")
            rows.append((n, n % 50, n % 9, category, region, START + timedelta(hours=h, minutes=7 * i), 1 + n % 4, price, float(5 * (n % 5)), "paypal", n % 11 == 0))
    return spark.createDataFrame(rows, ORDER_SCHEMA)


def events(spark, n=300):
    kinds = ["page_view", "add_to_cart", "purchase"]
    rows = [(i, i % 50, f"s{i}", kinds[i % 3], i % 9, START + timedelta(minutes=13 * i), None) for i in range(n)]
    return spark.createDataFrame(rows, "event_id bigint, customer_id bigint, session_id string, event_type string, product_id bigint, event_ts timestamp, metadata string")


# -- sources and sinks ------------------------------------------------------------


def test_append_counts_and_reads_back(spark, tmp_path):
    path = str(tmp_path)
    df = sinks.shape(orders(spark), "raw_orders")
    assert sinks.append(df, f"{path}/raw_orders") == 432
    assert sinks.append(df.limit(0), f"{path}/raw_orders") == 0
    recent = readers.read_table(spark, path, "raw_orders", since=START + timedelta(hours=71))
    assert recent.count() == 6
    assert "PushedFilters: [IsNotNull(order_ts), GreaterThanOrEqual" in recent._jdf.queryExecution().toString()


def test_upsert_is_idempotent_and_adds_columns(spark, tmp_path):
    path = f"{tmp_path}/kpi"
    k = kpi_frame(spark, kpi_rows(48)).withColumn("created_at", F.lit(NOW))
    sinks.upsert_snapshots(spark, k, path)
    late = k.where(F.hour("snapshot_ts") == 3).withColumns({"total_orders": F.lit(7), "created_at": F.lit(NOW + timedelta(hours=1)), "extra": F.lit("x")})
    for _ in range(2):
        sinks.upsert_snapshots(spark, late, path)
    got = spark.read.option("mergeSchema", "true").parquet(path)
    assert got.count() == 48 and got.where("total_orders = 7").count() == 2
    assert got.where("extra = 'x'").count() == 2
    fresh = sinks.insert_new(got, k.withColumn("region", F.lit("West")).unionByName(k))
    assert fresh.count() == 48 and fresh.where("region <> 'West'").count() == 0


def test_run_log_keeps_events(spark, tmp_path):
    path = f"{tmp_path}/runs"
    sinks.append(sinks.start_run(spark, "a", "p", NOW), path)
    sinks.append(sinks.start_run(spark, "b", "p", NOW), path)
    sinks.append(sinks.finish_run(spark, "a", "p", "SUCCESS", NOW, NOW, 10, 2), path)
    log = spark.read.parquet(path)
    assert log.count() == 3
    assert {r["run_id"]: r["status"] for r in sinks.latest_runs(log).collect()} == {"a": "SUCCESS", "b": "RUNNING"}
    assert {r["status"]: r["n"] for r in analytics.run_health(sinks.latest_runs(log), NOW).collect()} == {"SUCCESS": 1, "RUNNING": 1}


def test_alert_log_skips_malformed_lines(spark, tmp_path):
    path = tmp_path / "alerts.jsonl"
    good = [{"title": f"t{i}", "priority": p, "severity": "HIGH", "fired_at": f"2024-01-0{i + 1}"} for i, p in enumerate(["P0", "P1", "P1"])]
    path.write_text("\n".join([json.dumps(g) for g in good] + ["{broken", json.dumps({"title": "t9", "fired_at": "2024-01-09"})]))
    s = {(r["dimension"], r["value"]): r for r in analytics.alert_summary(readers.read_alert_log(spark, str(path))).collect()}
    assert s[("all", "all")]["total"] == 4 and s[("all", "all")]["latest"] == "t9"
    assert s[("priority", "P1")]["total"] == 2 and s[("priority", "?")]["total"] == 1


def test_messages_round_trip(spark):
    o = orders(spark, 2)
    sent = readers.encode_message(o, "orders").unionByName(readers.encode_message(o, "other"))
    back = readers.decode_message(sent, o.schema, "orders")
    assert back.count() == 12 and back.exceptAll(o).count() == 0


def test_records_are_rounded_json(spark, tmp_path):
    row = spark.range(1).select(
        F.lit("m").alias("metric_name"), F.lit(1.23456789).alias("metric_value"), F.lit(2.0).alias("expected_value"), F.lit(3.14159265).alias("z_score"),
        F.lit(-0.123456789).alias("isolation_score"), F.lit("LOW").alias("severity"), F.lit("r").alias("region"), F.lit("c").alias("category"),
        F.create_map(F.lit("method"), F.lit("zscore")).alias("raw_context"),
    )
    assert sinks.write_anomalies(row, f"{tmp_path}/anomaly_events") == 1
    r = readers.read_table(spark, str(tmp_path), "anomaly_events").first()
    assert float(r["z_score"]) == 3.1416 and float(r["isolation_score"]) == -0.123457
    assert json.loads(r["raw_context"]) == {"method": "zscore"}


def test_effects_of_a_million_and_more_are_stored(spark, tmp_path):
    # Revenue per unit of quantity grows with the orders of a bucket. Files of stores from before, with a narrower effect, are read beside the new ones.
    path = f"{tmp_path}/causal_findings"
    spark.sql("select 1L as anomaly_id, cast(947263.093245 as decimal(12, 6)) as ate").write.parquet(path)
    found = spark.createDataFrame([(2, 2149603.9385651797), (3, -6948816.300298364), (4, 1.5e20), (5, 0.0000004)], "anomaly_id long, ate double")
    assert sinks.write_findings(found, path) == 4
    got = {r["anomaly_id"]: float(r["ate"]) for r in readers.read_table(spark, str(tmp_path), "causal_findings").collect()}
    assert got == {1: 947263.093245, 2: 2149603.938565, 3: -6948816.300298, 4: 1.5e20, 5: 0.0}


def test_every_table_schema_is_unique():
    for name, schema in schemas.TABLES.items():
        assert len(set(schema.names)) == len(schema.names), name


# -- KPI ---------------------------------------------------------------------------


def test_last_hour_snapshot_equals_the_rollup(spark):
    o = orders(spark)
    snap = kpi_ops.kpi_snapshot(o, START + timedelta(hours=5, minutes=20))
    whole = kpi_ops.kpi_by_period(o, "hour", label="end").where(F.col("snapshot_ts") == F.lit(START + timedelta(hours=5)))
    cols = ["snapshot_ts", "region", "category", "total_orders", "total_revenue", "avg_order_val", "return_rate"]
    assert snap.count() == 2 and snap.select(cols).exceptAll(whole.select(cols)).count() == 0


def test_newer_than_an_empty_target(spark):
    o = orders(spark, 3)
    k = kpi_ops.kpi_by_period(o)
    assert kpi_ops.newer_than_target(o, k.limit(0)).count() == 18
    assert kpi_ops.newer_than_target(o, k).count() == 5  # the order on the full hour is not newer


def test_rollup_shuffles_once(spark):
    plan = kpi_ops.kpi_by_period(orders(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan


# -- quality and healing --------------------------------------------------------------


def test_quality_suites(spark):
    o = orders(spark)
    checks = quality.validate(o, "raw_orders", quality.raw_orders_suite(NOW)).collect()
    assert len(checks) == 12 and all(c["passed"] for c in checks)
    bad = o.withColumns({"customer_id": F.when(F.col("order_id") > 5, F.col("customer_id")), "region": F.lit("Moon"), "order_ts": F.lit(NOW + timedelta(minutes=6))})
    by = {c["name"]: c for c in quality.validate(bad, "raw_orders", quality.raw_orders_suite(NOW)).collect()}
    assert by["no_nulls:customer_id"]["failing_rows"] == 6 and by["no_nulls:customer_id"]["detail"] == "6 null rows"
    assert by["values_in_set:region"]["failing_rows"] == 432 and not by["no_future_ts:order_ts"]["passed"]
    k = kpi_frame(spark, kpi_rows(200))
    assert quality.report(quality.validate(k, "kpi_snapshots", quality.kpi_snapshots_suite(NOW))).first()["pass_rate"] == 1.0


def test_unique_and_mean_of_empty(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "a int")
    assert quality.validate(df, "t", [quality.expect_unique("a")]).first()["failing_rows"] == 2
    empty = quality.validate(df.limit(0), "t", [quality.expect_mean_between("a", 0, 1), quality.expect_unique("a")]).collect()
    assert [c["passed"] for c in empty] == [False, True]


def test_drift_types_and_plan(spark):
    o = orders(spark).withColumn("surprise_col", F.lit(1)).withColumn("quantity", F.col("quantity").cast("string")).drop("product_id")
    drift = healing.scan(spark, {"raw_orders": o, "raw_events": None})
    got = {(r["column_name"], r["drift_type"]) for r in drift.collect()}
    assert got == {("surprise_col", "NEW_COLUMN"), ("product_id", "DROPPED_COLUMN"), ("created_at", "DROPPED_COLUMN"), ("quantity", "TYPE_CHANGE")}
    plan = {r["column_name"]: r for r in healing.heal_plan(drift).collect()}
    assert plan["quantity"]["heal_query"] is None and not plan["quantity"]["auto_heal"]
    assert "ADD COLUMN product_id BIGINT" in plan["product_id"]["heal_query"]


def test_heal_repairs_and_validates(spark):
    o = orders(spark).withColumns({"customer_id": F.when(F.col("order_id") > 5, F.col("customer_id")), "order_ts": F.when(F.col("order_id") > 3, F.col("order_ts")), "surprise_col": F.lit(1)})
    healed, log = healing.heal(spark, o, "raw_orders", NOW)
    assert healed.where("customer_id is null or order_ts is null").count() == 0
    assert healed.where("order_ts = timestamp '1970-01-01 00:00:00'").count() == 4
    assert "created_at" in healed.columns and "AUTO_DETECTED" in healed.schema["surprise_col"].metadata["comment"]
    by = {r["column_name"]: r for r in log.collect()}
    assert all(r["auto_healed"] and r["validated"] for r in by.values())
    assert by["customer_id"]["heal_query"].endswith("SET customer_id = 0 WHERE customer_id IS NULL")


def test_health_totals(spark):
    rows = [(NOW, "NEW_COLUMN", i < 2) for i in range(3)] + [(NOW, "NULL_VIOLATION", True), (NOW - timedelta(days=2), "NEW_COLUMN", True)]
    h = analytics.drift_health(spark.createDataFrame(rows, "detected_at timestamp, drift_type string, auto_healed boolean"), NOW)
    total = h.where("is_total = 1").first()
    assert (total["total"], total["healed"]) == (4, 3)


def test_schema_diff(spark):
    known = setops.expected_rows(spark, {"t": {"a": "BIGINT", "ghost_column": "BIGINT", "revenue": "NUMERIC"}})
    live = setops.schema_rows(spark, {"t": spark.range(1).select(F.col("id").alias("a"), F.lit("x").alias("surprise_col"))})
    got = {(r["column_name"], r["drift_type"]) for r in setops.schema_diff(live, known, ignore=["revenue"]).collect()}
    assert got == {("surprise_col", "NEW_COLUMN"), ("ghost_column", "DROPPED_COLUMN")}


# -- untidy tables ---------------------------------------------------------------------


def test_dirty_csv(spark, tmp_path):
    lines = ["  Unit Price ,Qty,Cost$,Order Date,Region,Half"]
    for i in range(20):
        price = "n/a" if i == 0 else f'"$1,2{i:02d}.50"'
        lines.append(f"{price},{i % 4 + 1},₹ {i}.5,2024-01-{i + 1:02d},{'' if i == 3 else 'EU' if i < 16 else 'US'},{i if i < 10 else 'x'}")
    (tmp_path / "dirty.csv").write_text("\n".join(lines), encoding="utf-8")
    raw = readers.read_csv_any(spark, str(tmp_path / "dirty.csv"))
    df, p = profile.process(raw)
    assert p.kinds == {"unit_price": "numeric", "qty": "numeric", "cost": "numeric", "order_date": "date", "region": "categorical", "half": "categorical"}
    assert p.dataset_type == "sales" and p.row_count == 20
    assert df.where("unit_price is null").count() == 0 and df.where("region = 'Unknown'").count() == 1
    assert "auto_revenue" in df.columns
    texts = [r["text"] for r in profile.insight(df, p.of_kind("numeric"), p.of_kind("categorical"), p.dataset_type).orderBy("position").collect()]
    assert any("`region` dominated by **EU** (75%)" in t for t in texts) and texts[-1] == fv.DATASET_HINTS["sales"]
    k = profile.to_kpi(df, p)
    assert k.columns == ["snapshot_ts", "region", "category", "total_revenue", "total_orders", "return_rate", "avg_order_val"]
    assert k.first()["category"] == "Sales"


@pytest.mark.parametrize("cell,value", [("$1,200.50", 1200.5), ("12%", 12.0), ("₹ 99", 99.0), ("", None), ("n/a", None), ("nan", None), ("inf", None), ("5f", None), ("-1.5e3", -1500.0), (".5", 0.5)])
def test_clean_numeric(spark, cell, value):
    assert spark.range(1).select(S.clean_numeric(F.lit(cell)).alias("v")).first()["v"] == value


def test_repeated_names_get_suffixes(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A b", "a_b", "?"])
    assert profile.normalize_columns(df).columns == ["a_b", "a_b_2", "column"]


def test_missing_time_counts_hours_back(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("value"))
    p = profile.Profile("general", {"value": "numeric"}, 10, 1)
    t = [r["snapshot_ts"] for r in profile.to_kpi(df, p, order_by="value").orderBy("total_revenue").collect()]
    assert t[-1] - t[0] == timedelta(hours=9)


# -- streams ------------------------------------------------------------------------------


def _files(df, path, parts, ts):
    """The rows in time order as separate files, oldest first."""
    rows = df.orderBy(ts).collect()
    size = -(-len(rows) // parts)
    for i in range(parts):
        df.sparkSession.createDataFrame(rows[i * size : (i + 1) * size], df.schema).coalesce(1).write.mode("append").json(path)


def test_stream_of_messages_to_closed_windows(spark, tmp_path):
    o = orders(spark, 12)
    _files(readers.encode_message(o, "orders").withColumn("produced_at", F.from_json("data", "order_ts timestamp")["order_ts"]), f"{tmp_path}/in", 3, "produced_at")
    rows = ingest.ingest_stream(ingest.file_messages(spark, f"{tmp_path}/in", 1), "orders", o.schema)
    table, _ = drain_to_table(kpis.kpi_stream(rows, delay="1 hour"), "t")
    whole = kpi_ops.kpi_by_period(o)
    cols = ["snapshot_ts", "region", "category", "total_orders", "return_rate"]
    got = table.select(*cols)
    assert got.exceptAll(whole.select(*cols)).count() == 0
    assert 18 <= got.count() <= 22  # the last hour or two stay open


def test_stateful_stream_equals_batch_over_several_batches(spark, tmp_path):
    from tidewatch.operators import anomaly

    k = kpi_frame(spark, kpi_rows(60, "North", spike=90_000.0), kpi_rows(60, "South"))
    _files(k, f"{tmp_path}/k", 4, "snapshot_ts")
    stream = spark.readStream.schema(k.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/k")
    table, _ = drain_to_table(stream_anomalies.stateful_anomalies(stream, threshold=1.5), "s")
    key = ["region", "metric_name", F.date_format("snapshot_ts", "yyyy-MM-dd HH").alias("t"), F.round("z_score", 6).alias("z")]
    batch = anomaly.zscore_anomalies(k, threshold=1.5).withColumnRenamed("window_end", "snapshot_ts")
    assert table.count() == batch.count() > 0
    assert table.select(*key).exceptAll(batch.select(*key)).count() == 0


def test_late_snapshots_take_their_place(spark, tmp_path):
    """Three batches, one snapshot late but within the delay: the same events as in one batch. One later than the delay is dropped and counted."""
    from tidewatch.operators import anomaly

    k = kpi_frame(spark, kpi_rows(60, "North", spike=90_000.0), kpi_rows(60, "South"))
    rows = sorted(k.collect(), key=lambda r: (r["snapshot_ts"], r["region"]))
    late = next(r for r in rows if r["region"] == "North" and r["snapshot_ts"] == START + timedelta(hours=19))
    rest = [r for r in rows if r != late]
    stale = {**rows[0].asDict(), "total_revenue": 1e9}
    parts = [rest[:40], [*rest[40:80], late], [*rest[80:], stale]]
    for i, part in enumerate(parts):
        spark.createDataFrame([tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in part], k.schema).coalesce(1).write.mode("append").json(f"{tmp_path}/{i}")
    for i in range(3):
        (tmp_path / "k").mkdir(exist_ok=True)
        for f in sorted((tmp_path / str(i)).glob("*.json")):
            (tmp_path / "k" / f"{i}.json").write_text(f.read_text())
            os.utime(tmp_path / "k" / f"{i}.json", (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    stream = spark.readStream.schema(k.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/k")
    table, q = drain_to_table(timed.timed_anomalies(stream, "3 hours", threshold=1.2), "t")
    key = ["region", "metric_name", F.date_format("snapshot_ts", "yyyy-MM-dd HH").alias("t"), F.round("z_score", 6).alias("z")]
    batch = anomaly.zscore_anomalies(k, threshold=1.2).withColumnRenamed("window_end", "snapshot_ts")
    batch = batch.where(F.col("snapshot_ts") <= F.lit(START + timedelta(hours=56)))
    assert table.count() == batch.count() > 0
    assert table.select(*key).exceptAll(batch.select(*key)).count() == 0
    assert kpis.late_rows(q) == 1


def test_rolling_scores_are_those_of_plain_windows():
    rnd = np.random.default_rng(1)
    values = rnd.normal(size=(50, 3))
    values[rnd.random((50, 3)) < 0.2] = np.nan
    values[:, 2] = 5.0
    mean, z = timed.rolling_scores(values, 10, 24, 3)
    for i in range(10, 50):
        for j in range(3):
            own = values[max(0, i - 23) : i + 1, j]
            own = own[~np.isnan(own)]
            sd = own.std(ddof=1) if len(own) > 1 else 0.0
            if len(own) < 3 or sd == 0 or np.isnan(values[i, j]):
                assert np.isnan(z[i - 10, j])
            else:
                assert z[i - 10, j] == pytest.approx((values[i, j] - own.mean()) / sd) and mean[i - 10, j] == pytest.approx(own.mean())


def test_best_row_of_a_key_is_emitted_when_its_window_closes(spark, tmp_path):
    rows = [("a", START, 3.0), ("a", START + timedelta(minutes=10), -9.0), ("b", START + timedelta(minutes=20), 1.0), ("a", START + timedelta(minutes=30), 9.0), ("a", START + timedelta(hours=2), 2.0), ("b", START + timedelta(hours=5), 1.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp, z double")
    _files(df, f"{tmp_path}/b", 3, "t")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/b")
    table, _ = drain_to_table(kpis.best_stream(stream, ["k"], "t", [F.abs("z")], "1 hour", "1 hour"), "best")
    got = {(r["k"], r["window_start"].hour): r["z"] for r in table.collect()}
    assert got == {("a", 0): -9.0, ("b", 0): 1.0, ("a", 2): 2.0}  # of equal ranks the earlier; the last hour is open


def test_malformed_messages_are_kept_apart(spark, tmp_path):
    good = [("orders", json.dumps({"a": i, "b": "x"})) for i in range(3)]
    bad = [("orders", "{broken"), ("orders", None), ("orders", '{"a": "text"}'), (None, '{"a": 1}'), ("orders", ""), ("other", "{broken")]
    seen = []
    run = ingest.with_dead_letters("a int, b string", "orders", lambda df, i: seen.extend(df.collect()), f"{tmp_path}/dead")
    for _ in range(2):  # a repeated batch leaves the same
        run(spark.createDataFrame(good + bad, "topic string, data string"), 0)
    assert sorted(r["a"] for r in seen) == [0, 0, 1, 1, 2, 2]
    dead = spark.read.parquet(f"{tmp_path}/dead").groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in dead} == {"malformed payload": 4, "no topic": 1}


def test_batch_detection_over_several_batches(spark, tmp_path):
    k = kpi_frame(spark, kpi_rows(60, "North", spike=90_000.0))
    _files(k, f"{tmp_path}/k", 3, "snapshot_ts")
    stream = spark.readStream.schema(k.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/k")
    run = stream_anomalies.detect_batches(f"{tmp_path}/h", f"{tmp_path}/e", forest=False)
    drain_batches(stream, "b", run)
    found = spark.read.parquet(f"{tmp_path}/e")
    assert found.where("metric_name = 'total_revenue'").first()["metric_value"] == 90_000.0
    run(k.limit(0), 99)  # an empty batch is harmless


def test_late_rows_are_counted_and_repeats_dropped(spark, tmp_path):
    o = orders(spark, 12)
    _files(o, f"{tmp_path}/o", 2, "order_ts")
    stale = o.limit(3).withColumn("order_ts", F.lit(datetime(2023, 1, 1)))
    stale.coalesce(1).write.mode("append").json(f"{tmp_path}/o")
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/o")
    _, q = drain_to_table(kpis.kpi_stream(stream, delay="1 hour"), "late")
    assert kpis.late_rows(q) >= 1
    table, _ = drain_to_table(kpis.dedup_stream(stream.where("order_ts > '2023-06-01'").select("customer_id", "order_ts"), ["customer_id"], "order_ts", "30 days"), "dedup")
    assert table.count() == 50


def test_recent_log_is_bounded(spark, tmp_path):
    e = events(spark)
    _files(e.drop("metadata"), f"{tmp_path}/e", 3, "event_ts")
    stream = spark.readStream.schema(e.drop("metadata").schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/e")
    drain_batches(stream, "r", stream_anomalies.recent_batches(f"{tmp_path}/log", 30, "event_ts", ["event_id"]))
    ids = sorted(r["event_id"] for r in stream_anomalies.read_recent(spark, f"{tmp_path}/log").collect())
    assert ids == list(range(270, 300))


def test_guard_reports_payload_drift(spark):
    known = setops.expected_rows(spark, {"raw_orders": {c: "X" for c in orders(spark, 1).columns if c != "region"}})
    seen, kept = [], []
    run = ingest.guarded(known, "raw_orders", lambda b, i: kept.append(b.count()), lambda d, i: seen.extend(r["column_name"] for r in d.collect()))
    run(readers.encode_message(orders(spark, 1), "orders"), 0)
    assert seen == ["region"] and kept == [6]


# -- the whole cycle -------------------------------------------------------------------------


def test_cycle(spark, tmp_path):
    now = START + timedelta(hours=72)
    settings = Settings(forest_trees=20)
    ticks = iter(datetime(2024, 2, 1) + timedelta(minutes=i) for i in range(4))
    run = lambda o: cycle.run_cycle(spark, str(tmp_path), o, events(spark), now, settings, lookback_hours=72, clock=lambda: next(ticks)).first()
    r = run(orders(spark))
    assert r["ingestion"]["rows"] == 432 and r["ingestion"]["status"] == "SUCCESS"
    assert r["anomalies_found"] >= 1 and r["decisions"] == r["anomalies_found"] == sum(r["priorities"])
    assert r["healing"]["drifts"] >= 1
    run(orders(spark).where(F.col("order_ts") >= F.lit(START + timedelta(hours=70))))
    k = readers.read_table(spark, str(tmp_path), "kpi_snapshots")
    assert k.count() == 144 and k.groupBy("snapshot_ts", "region", "category").count().where("count > 1").count() == 0
    assert k.where(F.col("snapshot_ts") >= F.lit(START + timedelta(hours=70))).agg(F.sum("total_orders")).first()[0] == 24
    runs = sinks.latest_runs(spark.read.schema(schemas.TABLES["pipeline_runs"]).parquet(f"{tmp_path}/pipeline_runs")).collect()
    assert [x["status"] for x in runs] == ["SUCCESS", "SUCCESS"]
    assert sorted((x["started_at"].minute, x["finished_at"].minute) for x in runs) == [(0, 1), (2, 3)]
    assert readers.read_table(spark, str(tmp_path), "raw_orders").count() == 432 + 12
    made = readers.read_table(spark, str(tmp_path), "agent_decisions")
    assert made.where("priority is null or final_action is null or not decision_output like '%EXECUTIVE REVIEWER%'").count() == 0
    assert not list(tmp_path.glob("*__staging*"))


def test_cycle_with_effects_beyond_a_million(spark, tmp_path):
    dear = orders(spark).withColumn("unit_price", F.col("unit_price") * 1_000_000)
    report = cycle.run_cycle(spark, str(tmp_path), dear, events(spark), START + timedelta(hours=72), Settings(forest_trees=0), lookback_hours=72).first()
    assert report["ingestion"]["status"] == "SUCCESS" and report["decisions"] == report["anomalies_found"] >= 1
    listed = {r["anomaly_id"]: r["ate"] for r in spark.read.json(f"{tmp_path}/reports/{report['ingestion']['run_id']}/causal_findings").collect()}
    kept = {r["anomaly_id"]: float(r["ate"]) for r in readers.read_table(spark, str(tmp_path), "causal_findings").collect()}
    assert max(abs(v) for v in kept.values()) > 1e6 and kept == pytest.approx(listed, abs=1e-6)


def dirty(spark, day: int = 0):
    """Orders with gaps in one of two days, an unknown column, and text where numbers belong."""
    o = orders(spark, 48).withColumn("order_ts", F.col("order_ts") + F.make_interval(days=F.lit(day)))
    gap = F.to_date("order_ts") == F.lit((START + timedelta(days=day)).date())
    return o.withColumns({
        "customer_id": F.when(~(gap & (F.col("order_id") % 5 == 0)), F.col("customer_id")),
        "unit_price": F.when(gap & (F.col("order_id") % 7 == 0), "n/a").otherwise(F.col("unit_price").cast("string")),
        "surprise_col": F.col("order_id").cast("int"),
    }).drop("payment_method")


def drift_of(spark, path, run: int):
    log = readers.read_table(spark, path, "schema_drift_log").collect()
    times = sorted({r["detected_at"] for r in log})
    return {(r["table_name"], r["column_name"], r["drift_type"]): (r["auto_healed"], r["validated"]) for r in log if r["detected_at"] == times[run]}


def test_repair_is_written_audited_and_published(spark, tmp_path):
    settings, path = Settings(forest_trees=0), str(tmp_path)
    cycle.run_cycle(spark, path, dirty(spark), events(spark), START + timedelta(days=2), settings)
    first = drift_of(spark, path, 0)
    for key in [("customer_id", "NULL_VIOLATION"), ("unit_price", "NULL_VIOLATION"), ("surprise_col", "NEW_COLUMN"), ("payment_method", "DROPPED_COLUMN")]:
        assert first[("raw_orders", *key)] == (True, True), key
    assert first[("raw_orders", "unit_price", "TYPE_CHANGE")] == (False, False)
    stored = readers.read_table(spark, path, "raw_orders")
    assert stored.count() == 288 and stored.where("customer_id is null or unit_price is null").count() == 0
    assert stored.where("customer_id = 0 and order_id % 5 = 0 and order_date = '2024-01-01'").count() >= 29
    assert stored.where("unit_price = 0").count() == 21
    plan = readers.read_table(spark, path, "raw_orders").where("order_date = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan

    # The same batch form again, a day later: what was repaired or tagged is not reported again, clean partitions are not rewritten.
    files = {f.name for f in tmp_path.glob("raw_orders/order_date=2024-01-01/*.parquet")}
    clean = dirty(spark, 3).withColumn("customer_id", F.lit(7)).withColumn("unit_price", F.lit("12.5"))
    cycle.run_cycle(spark, path, clean, events(spark), START + timedelta(days=5), settings)
    assert drift_of(spark, path, 1).keys() & {k for k, v in first.items() if v[0]} == set()
    assert {f.name for f in tmp_path.glob("raw_orders/order_date=2024-01-01/*.parquet")} == files
    again = sinks.read_raw(spark, f"{path}/raw_orders", "raw_orders", sinks.read_baseline(spark, f"{path}/schema_baseline")["raw_orders"])
    assert again.count() == 576 and again.where("surprise_col is null").count() == 0


def test_repair_that_fails_its_audit_is_not_published(spark):
    from tidewatch.operators import healing

    part = spark.createDataFrame([(1, 1, "a"), (None, 1, "b"), (3, 2, "c")], "customer_id long, d int, x string")
    published = []
    log = healing.heal_partitions(part, "raw_orders", "d", lambda df: df.where("x <> 'a'"), published.append, {"customer_id": "BIGINT"})
    assert not published and log == [("raw_orders", "customer_id", "NULL_VIOLATION", "NOT NULL", "1 NULL rows found", False, False, "rows lost in staging")]
    log = healing.heal_partitions(part, "raw_orders", "d", lambda df: part.where("d = 1"), published.append, {"customer_id": "BIGINT"})
    assert not published and log[0][-1] == "nulls left in staging"
    log = healing.heal_partitions(part, "raw_orders", "d", lambda df: df, published.append, {"customer_id": "BIGINT"})
    assert [r["customer_id"] for r in published[0].orderBy("x").collect()] == [1, 0] and log[0][5:] == (True, True, None)


def test_failed_cycle_is_logged(spark, tmp_path):
    with pytest.raises(Exception):
        cycle.run_cycle(spark, str(tmp_path), orders(spark).drop("order_ts"), events(spark), NOW)
    runs = sinks.latest_runs(spark.read.schema(schemas.TABLES["pipeline_runs"]).parquet(f"{tmp_path}/pipeline_runs")).collect()
    assert [r["status"] for r in runs] == ["FAILED"]
