"""The benchmark tables seen as orders, events and KPI snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import kpi


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, for work bound by cores, when the input has fewer files than cores.

    A big input already has more splits than cores and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order line per row, with region and category resolved.

    The two big joins are left to the planner: sort-merge with run-time skew
    splitting when both sides are big, broadcast when a side turns out small.
    """
    regions = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    buyers = table(spark, sf_dir, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    heads = (
        table(spark, sf_dir, "orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "r_name")
    )
    kinds = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        table(spark, sf_dir, "lineitem")
        .join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(kinds, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("r_name").alias("region"),
            F.col("o_orderdate").cast("timestamp").alias("order_ts"),
            F.col("l_quantity").alias("quantity"),
            # A zero quantity has no unit price; the order filters drop it.
            F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
            # + 0.0 turns a negative zero into zero.
            (F.col("l_discount") * 100 + F.lit(0.0)).alias("discount_pct"),
            F.col("o_orderpriority").alias("payment_method"),
            (F.col("l_returnflag") == "R").alias("is_returned"),
        )
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        "event_type",
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("props").alias("metadata"),
        "value",
    )


def order_kpis(spark: SparkSession, sf_dir: str, period: str = "month") -> DataFrame:
    """KPI snapshots of the orders; order dates are day-grained, so months are the natural bucket."""
    return kpi.kpi_by_period(raw_orders(spark, sf_dir), period)


def event_kpis(spark: SparkSession, sf_dir: str, period: str = "hour") -> DataFrame:
    """Event volume and value per bucket and event type, in KPI form."""
    return (
        raw_events(spark, sf_dir)
        .groupBy(F.date_trunc(period, "event_ts").alias("snapshot_ts"), F.col("event_type").alias("category"))
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("value").alias("total_revenue"),
            F.avg("value").alias("avg_order_val"),
        )
        .withColumn("region", F.lit("ALL"))
        .withColumn("period", F.lit(kpi.PERIOD_NAMES.get(period, period)))
    )


def customer_event_kpis(spark: SparkSession, sf_dir: str, period: str = "day") -> DataFrame:
    """Event KPIs per bucket, customer region and market segment, with all five forest features."""
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("region"), F.col("c_mktsegment").alias("category"))
    )
    events = raw_events(spark, sf_dir).join(places, F.col("customer_id") == F.col("c_custkey"))
    is_type = lambda t: F.col("event_type") == t
    return (
        events.groupBy(F.date_trunc(period, "event_ts").alias("snapshot_ts"), "region", "category")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("value").alias("total_revenue"),
            F.avg("value").alias("avg_order_val"),
            F.avg(is_type("error").cast("int")).alias("return_rate"),
            F.coalesce(
                F.try_divide(F.count_if(is_type("purchase")), F.count_if(is_type("view"))), F.lit(0.0)
            ).alias("conversion_rt"),
        )
        .withColumn("period", F.lit(kpi.PERIOD_NAMES.get(period, period)))
    )


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with gaps, made from values in the data: unspecified priorities have no
    payment method and no customer, the largest quantity has no price, deep
    discounts on returned lines have no time."""
    orders = raw_orders(spark, sf_dir)
    unspecified = F.col("payment_method").startswith("4-")
    untimed = (F.col("discount_pct") >= 9.5) & F.col("is_returned")
    return orders.withColumns(
        {
            "customer_id": F.when(~unspecified, F.col("customer_id")),
            "unit_price": F.when(F.col("quantity") < 50, F.col("unit_price")),
            "order_ts": F.when(~untimed, F.col("order_ts")),
            "payment_method": F.when(~unspecified, F.col("payment_method")),
        }
    )


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders seen as pipeline runs: a run starts with the order and ends with its last shipment."""
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").cast("timestamp").alias("shipped"), F.count(F.lit(1)).alias("lines")
    )
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("FAILED")
    return (
        table(spark, sf_dir, "orders")
        .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("run_id"),
            F.col("o_orderpriority").alias("pipeline_name"),
            F.col("o_orderdate").cast("timestamp").alias("started_at"),
            F.col("shipped").alias("finished_at"),
            status.alias("status"),
            F.coalesce("lines", F.lit(0)).alias("rows_ingested"),
            # Order totals serve as run seconds.
            (F.col("o_totalprice") / 1000).alias("seconds"),
        )
    )


def order_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines the way a spreadsheet export looks: untidy names, all cells text, gaps and junk."""
    heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    lines = spread(table(spark, sf_dir, "lineitem").join(heads, F.col("l_orderkey") == F.col("o_orderkey")))
    price = F.concat(F.lit("$"), F.format_string("%,.2f", "l_extendedprice"))
    return lines.select(
        F.when(F.col("l_quantity") == 50, "n/a").otherwise(price).alias(" Unit Price "),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("int").cast("string")).alias("Qty"),
        F.concat(F.lit("€ "), F.format_string("%.2f", F.col("l_extendedprice") * 0.8)).alias("Cost$"),
        F.format_string("%.2f", F.col("l_extendedprice") + 10).alias("Sales-Amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order Date"),
        F.when(~F.col("o_orderpriority").startswith("4-"), F.col("o_orderpriority")).alias("Region"),
        F.when(F.col("l_tax") < 0.06, "std").otherwise("high").alias("Tax Band"),
    )


def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of the dirty orders as drift records: one per missing customer, one per missing price."""
    orders = raw_orders(spark, sf_dir)
    dirty = orders.select(
        "order_ts",
        "is_returned",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("payment_method").startswith("4-"), F.lit("NULL_VIOLATION")),
                    F.when(F.col("quantity") == 50, F.lit("TYPE_CHANGE")),
                )
            )
        ).alias("drift_type"),
    )
    healed = (F.col("drift_type") == "NULL_VIOLATION") & F.col("is_returned")
    return dirty.select(F.col("order_ts").alias("detected_at"), "drift_type", healed.alias("auto_healed"))
