"""Alert records, routing and payloads. Nothing is sent from here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions import scalars as S
from tidewatch.functions import text as X

SOURCE = "KPI monitor"


def channels_for(priority: str | Column) -> Column:
    """Channels of a priority; unknown priorities go nowhere."""
    p = S.col(priority)
    none = F.array().cast("array<string>")
    out = none
    for name, channels in reversed(fv.ALERT_ROUTES):
        here = F.array(*[F.lit(c) for c in channels]) if channels else none
        out = F.when(p == name, here).otherwise(out)
    return out


def route_alerts(anomalies: DataFrame, decisions: DataFrame, fired_at: Column, source: str = SOURCE) -> DataFrame:
    """One alert per anomaly with its decision, defaults where a field is missing."""
    made = decisions.select(
        "anomaly_id", F.col("priority").alias("_p"), F.col("final_action").alias("_a"), F.col("analyst_output").alias("_t")
    )
    j = anomalies.join(made, "anomaly_id", "left")
    sev = F.coalesce("severity", F.lit("MEDIUM"))
    z = F.coalesce("z_score", F.lit(0.0))
    j = j.withColumns({"_sev": sev, "_z": z, "_p": F.coalesce("_p", F.lit("P2"))})
    return j.select(
        X.alert_title("_sev", "region", "category", "metric_name", "_z").alias("title"),
        X.alert_body("window_end", "metric_value", "expected_value", "_t").alias("body"),
        F.col("_p").alias("priority"),
        F.col("_sev").alias("severity"),
        "anomaly_id",
        F.coalesce("metric_name", F.lit("")).alias("metric_name"),
        F.coalesce("region", F.lit("")).alias("region"),
        F.coalesce("category", F.lit("")).alias("category"),
        F.col("_z").alias("z_score"),
        F.coalesce("_a", F.lit("Review manually")).alias("action"),
        F.lit(source).alias("source"),
        F.date_format(fired_at, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fired_at"),
        channels_for("_p").alias("channels"),
        F.array().cast("array<string>").alias("errors"),
    )


def alert_payloads(alerts: DataFrame, sender: str = "alerts@localhost", recipient: str = "oncall@localhost") -> DataFrame:
    """One row per alert and channel with the message that channel takes, as JSON."""
    tagged = F.concat(F.lit("["), F.col("priority"), F.lit("] "), F.col("title"))
    sigma = F.concat(X.num("z_score", "%.2f", 2), F.lit("σ"))
    anomaly = F.coalesce(F.col("anomaly_id").cast("string"), F.lit("None"))

    def field(title: str, value: Column, short: bool = True) -> Column:
        return F.struct(F.lit(title).alias("title"), value.alias("value"), F.lit(short).alias("short"))

    slack = F.struct(
        F.concat(S.lookup("priority", fv.PRIORITY_ICONS, F.lit(fv.PRIORITY_ICON_DEFAULT)), F.lit(" *"), tagged, F.lit("*")).alias("text"),
        F.array(
            F.struct(
                S.lookup("severity", fv.SEVERITY_COLORS, F.lit(fv.SEVERITY_COLOR_DEFAULT)).alias("color"),
                F.array(
                    field("Metric", F.col("metric_name")), field("Region", F.col("region")),
                    field("Category", F.col("category")), field("Z-score", sigma), field("Anomaly ID", anomaly),
                    field("Fired At", F.col("fired_at")), field("Action", F.col("action"), False),
                ).alias("fields"),
                F.col("source").alias("footer"),
            )
        ).alias("attachments"),
    )
    pager = F.struct(
        F.lit("trigger").alias("event_action"),
        S.dedup_key("anomaly_id", "metric_name").alias("dedup_key"),
        F.struct(
            F.col("title").alias("summary"), S.pager_level("severity").alias("severity"), "source",
            F.col("fired_at").alias("timestamp"),
            F.struct("body", "action", "region", "category", "z_score", "anomaly_id").alias("custom_details"),
        ).alias("payload"),
    )
    email = F.struct(
        tagged.alias("subject"), F.lit(sender).alias("from"), F.lit(recipient).alias("to"),
        F.concat_ws(
            "\n", tagged, F.concat(F.lit("Metric: "), F.col("metric_name")),
            F.concat(F.lit("Region / Category: "), F.col("region"), F.lit(" / "), F.col("category")),
            F.concat(F.lit("Z-score: "), sigma), F.concat(F.lit("Anomaly ID: "), anomaly),
            F.concat(F.lit("Fired At: "), F.col("fired_at")), F.lit(""), F.col("body"), F.lit(""),
            F.concat(F.lit("Recommended action: "), F.col("action")),
        ).alias("text"),
    )
    channel = F.col("channel")
    payload = (
        F.when(channel == "slack", F.to_json(slack)).when(channel == "pagerduty", F.to_json(pager)).otherwise(F.to_json(email))
    )
    return alerts.withColumn("channel", F.explode("channels")).select("anomaly_id", "priority", "channel", payload.alias("payload"))


def mark_alerted(decisions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Decisions of alerted anomalies get status ALERTED and the alert's channels in their metadata."""
    fired = alerts.where(F.col("anomaly_id").isNotNull()).groupBy("anomaly_id").agg(
        F.max_by(F.struct("channels", "fired_at"), F.col("fired_at")).alias("_alert")
    )
    j = decisions.join(fired, "anomaly_id", "left")
    hit = F.col("_alert").isNotNull()
    patch = F.create_map(
        F.lit("alert_channels"), F.to_json(F.col("_alert.channels")), F.lit("alert_fired_at"), F.col("_alert.fired_at")
    )
    return j.withColumns(
        {
            "status": F.when(hit, F.lit("ALERTED")).otherwise(F.col("status")),
            "metadata": F.when(hit, S.merge_maps("metadata", patch)).otherwise(F.col("metadata")),
        }
    ).drop("_alert")
