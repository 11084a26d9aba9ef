"""Explicit schemas of the stored tables and of the record types."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _type(name: str) -> T.DataType:
    if name.startswith("decimal"):
        precision, scale = name[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _TYPES[name]


def _struct(spec: str) -> T.StructType:
    """Schema from ``name type [not null], ...``; unlike Spark's own parser it needs no session."""
    fields = []
    for part in spec.split(", "):
        name, kind, *rest = part.split()
        fields.append(T.StructField(name, _type(kind), nullable=not rest))
    return T.StructType(fields)


TABLES: dict[str, T.StructType] = {
    "raw_orders": _struct(
        "order_id bigint, customer_id bigint not null, product_id bigint not null, category string, "
        "region string, order_ts timestamp not null, quantity int, unit_price decimal(12,2), "
        "discount_pct decimal(5,2), revenue decimal(14,2), payment_method string, "
        "is_returned boolean, created_at timestamp"
    ),
    "raw_events": _struct(
        "event_id bigint, customer_id bigint, session_id string, event_type string, "
        "product_id bigint, event_ts timestamp, metadata string"
    ),
    "kpi_snapshots": _struct(
        "snapshot_id bigint, snapshot_ts timestamp, period string, region string, category string, "
        "total_orders int, total_revenue decimal(16,2), avg_order_val decimal(12,2), "
        "return_rate decimal(6,4), conversion_rt decimal(6,4), created_at timestamp"
    ),
    "anomaly_events": _struct(
        "anomaly_id bigint, detected_at timestamp, metric_name string, metric_value decimal(18,4), "
        "expected_value decimal(18,4), z_score decimal(8,4), isolation_score decimal(8,6), "
        "severity string, region string, category string, window_start timestamp, "
        "window_end timestamp, raw_context string"
    ),
    "causal_findings": _struct(
        "finding_id bigint, anomaly_id bigint, analyzed_at timestamp, cause_variable string, "
        "effect_variable string, ate decimal(38,6), confidence decimal(6,4), method string, "
        "explanation string, supporting_data string"
    ),
    "agent_decisions": _struct(
        "decision_id bigint, anomaly_id bigint, decided_at timestamp, analyst_output string, "
        "causal_output string, decision_output string, final_action string, priority string, "
        "status string, assigned_to string, metadata string"
    ),
    "schema_drift_log": _struct(
        "drift_id bigint, detected_at timestamp, table_name string, column_name string, "
        "drift_type string, old_definition string, new_definition string, auto_healed boolean, "
        "heal_query string, validated boolean"
    ),
    "pipeline_runs": _struct(
        "run_id string, event_ts timestamp, started_at timestamp, finished_at timestamp, "
        "pipeline_name string, status string, rows_ingested bigint, anomalies_found bigint, "
        "error_message string, metrics string"
    ),
    "audit_log": _struct(
        "order_id string, item string, amount double, ai_decision string, action_taken string, timestamp string"
    ),
    "messages": _struct("topic string, data string, produced_at timestamp"),
}

ALERT = _struct(
    "title string, body string, priority string, severity string, anomaly_id bigint, "
    "metric_name string, region string, category string, z_score double, action string, "
    "source string, fired_at string, channels array<string>, errors array<string>"
)

DRIFT = _struct(
    "table_name string, column_name string, drift_type string, old_definition string, new_definition string"
)

CHECK = _struct("table string, name string, passed boolean, detail string, failing_rows bigint")

HISTORY = T.ArrayType(_struct("agent string, round int, content string"))
