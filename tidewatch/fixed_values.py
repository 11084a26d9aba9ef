"""Fixed values.

Everything in this file is a constant that must keep exactly this value for
results to be right: thresholds, lookup tables, expected schemas, channel
tables and the wording of generated texts.
"""

# Severity bands on |z|: name, lower bound (inclusive), upper bound (exclusive).
SEVERITY_BANDS = (
    ("LOW", 3.0, 4.0),
    ("MEDIUM", 4.0, 6.0),
    ("HIGH", 6.0, 9.0),
    ("CRITICAL", 9.0, float("inf")),
)

# Metrics watched by the rolling z-score, in reporting order.
Z_METRICS = ("total_revenue", "avg_order_val", "return_rate", "total_orders")

# Columns of the isolation forest.
FOREST_FEATURES = ("total_revenue", "avg_order_val", "return_rate", "total_orders", "conversion_rt")

# KPI columns summarised as a baseline.
BASELINE_METRICS = ("total_revenue", "total_orders", "return_rate", "avg_order_val")

# Candidate cause -> effect pairs, in order of preference on ties.
CAUSAL_PAIRS = (
    ("avg_discount", "revenue", "High discount → revenue anomaly"),
    ("avg_discount", "return_rate", "Deep discounts → more returns"),
    ("avg_price", "order_count", "Price shock → order volume drop"),
    ("avg_qty", "revenue", "Bulk orders → revenue spike"),
    ("evt_add_to_cart", "order_count", "Cart activity → conversion"),
)

# Likely explanation by metric and direction.
HYPOTHESES = (
    ("total_revenue", "spike", "Promotional burst, flash-sale, or pricing engine over-discount."),
    ("total_revenue", "drop", "Payment gateway fault, cart abandonment surge, or SLA breach."),
    ("return_rate", "spike", "Product quality issue, mis-shipped SKUs, or organised fraud."),
    ("return_rate", "drop", "Return-policy tightening; verify no pipeline suppression."),
    ("avg_order_val", "spike", "B2B order cluster or A/B price variant in production."),
    ("avg_order_val", "drop", "Coupon stacking, bot micro-orders, or rounding error."),
    ("total_orders", "spike", "Marketing burst, SEO/viral event, or bot traffic influx."),
    ("total_orders", "drop", "Stockout, checkout regression, or mis-attribution."),
)
HYPOTHESIS_UNKNOWN = "Confounding factors under investigation."

# Confidence = min(0.99, base + slope * z).
CONFIDENCE_CAP = 0.99
CONFIDENCE_ANALYST = (0.60, 0.04)
CONFIDENCE_CAUSAL = (0.50, 0.07)
CONFIDENCE_PARSED = (0.65, 0.04)
CONFIDENCE_QUIET = 0.92

# Channels per alert priority.
ALERT_ROUTES = (
    ("P0", ("pagerduty", "slack", "email")),
    ("P1", ("slack", "email")),
    ("P2", ("slack",)),
    ("P3", ()),
)
PAGER_LEVELS = (("CRITICAL", "critical"), ("HIGH", "error"), ("MEDIUM", "warning"), ("LOW", "info"))
PAGER_LEVEL_DEFAULT = "warning"
SEVERITY_COLORS = (("CRITICAL", "#ef4444"), ("HIGH", "#f97316"), ("MEDIUM", "#eab308"), ("LOW", "#22c55e"))
SEVERITY_COLOR_DEFAULT = "#6b7280"
PRIORITY_ICONS = (("P0", "🚨"), ("P1", "🔴"), ("P2", "🟡"), ("P3", "🟢"))
PRIORITY_ICON_DEFAULT = "⚪"

# Words that decide a priority, tested on upper-cased text, first match wins.
PRIORITY_WORDS = (
    ("P1", ("REJECT", "CRITICAL", "IMMEDIATE", "P1")),
    ("P2", ("FLAG", "URGENT", "HIGH", "P2")),
    ("P3", ("APPROVE", "MONITOR", "MEDIUM", "P3")),
)
# Words that decide an action, case-sensitive, first match wins.
ACTION_WORDS = (("ACCOUNT_BLOCKED", ("Reject", "Fraud")), ("FUNDS_HELD", ("Flag", "Review")))
ACTION_DEFAULT = "APPROVED"

# Wording of the verdict per priority: {metric} and {region} are filled in.
VERDICTS = {
    "P1": (
        "🔴 REJECT — IMMEDIATE ACTION",
        "FREEZE promotions for {metric} in {region}.\n"
        "  • Activate circuit breaker — halt automated discounting.\n"
        "  • Alert on-call ops team within 15 minutes.\n"
        "  • Rollback last deployment if revenue anomaly persists > 30min.\n"
        "  • Escalate to P1 incident channel.",
    ),
    "P2": (
        "🟠 FLAG — URGENT INVESTIGATION",
        "INVESTIGATE {metric} spike in {region}.\n"
        "  • Pull last 6h of raw transaction logs.\n"
        "  • Check payment gateway status and error rates.\n"
        "  • Review recent A/B test variants for pricing leaks.\n"
        "  • Schedule 30-min team review within 2 hours.",
    ),
    "P3": (
        "🟡 MONITOR — ELEVATED WATCH",
        "Increase anomaly sampling to 1-minute intervals for 4 hours.\n"
        "  • Set alert threshold to 1.5σ for affected metrics.\n"
        "  • Review trend in next scheduled standup.\n"
        "  • No immediate escalation required.",
    ),
    "P4": ("🟢 APPROVE — ROUTINE", "Standard monitoring. No escalation needed."),
    "quiet": ("✅ APPROVE — No action required", "No action — system nominal."),
}

# Expected columns and type fragments per managed table.
EXPECTED_SCHEMAS = {
    "raw_orders": {
        "order_id": "BIGINT",
        "customer_id": "BIGINT",
        "product_id": "BIGINT",
        "category": "VARCHAR",
        "region": "VARCHAR",
        "order_ts": "TIMESTAMP",
        "quantity": "INTEGER",
        "unit_price": "NUMERIC",
        "discount_pct": "NUMERIC",
        "payment_method": "VARCHAR",
        "is_returned": "BOOLEAN",
        "created_at": "TIMESTAMP",
    },
    "raw_events": {
        "event_id": "BIGINT",
        "customer_id": "BIGINT",
        "session_id": "UUID",
        "event_type": "VARCHAR",
        "product_id": "BIGINT",
        "event_ts": "TIMESTAMP",
        "metadata": "JSONB",
    },
    "kpi_snapshots": {
        "snapshot_id": "BIGINT",
        "snapshot_ts": "TIMESTAMP",
        "period": "VARCHAR",
        "region": "VARCHAR",
        "category": "VARCHAR",
        "total_orders": "INTEGER",
        "total_revenue": "NUMERIC",
        "avg_order_val": "NUMERIC",
        "return_rate": "NUMERIC",
        "conversion_rt": "NUMERIC",
        "created_at": "TIMESTAMP",
    },
}
# Computed column that never counts as new.
DRIFT_IGNORED = ("revenue",)
# Columns that must not hold nulls.
NOT_NULL_CHECKS = (
    ("raw_orders", "customer_id"),
    ("raw_orders", "order_ts"),
    ("raw_orders", "unit_price"),
    ("kpi_snapshots", "snapshot_ts"),
)

# Value domains of the quality suites.
ORDER_CATEGORIES = ("Electronics", "Apparel", "Home & Kitchen", "Sports", "Books", "Beauty")
ORDER_REGIONS = ("North", "South", "East", "West", "International")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "crypto", "bank_transfer")
KPI_PERIODS = ("hourly", "daily")
#: Rows that a checked table may have at most. Nothing is cut there: all rows are counted and checked.
MOST_ORDERS = 10_000_000
MOST_SNAPSHOTS = 5_000_000
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")

# Column-name words that tell what a dataset is about, first match wins.
DATASET_WORDS = (
    ("sales", ("revenue", "sales", "amount", "price", "order")),
    ("logs", ("log", "level", "severity", "error", "event")),
    ("metrics", ("cpu", "memory", "latency", "rps", "metric")),
    ("analytics", ("user", "session", "click", "conversion")),
)
DATASET_DEFAULT = "general"
DATASET_HINTS = {
    "sales": "Dataset is **sales/revenue** data. KPI and anomaly views pre-loaded.",
    "logs": "Dataset resembles **event logs**. Filter by severity for anomaly detection.",
    "metrics": "Dataset looks like **system metrics**. Time-series trends charted below.",
    "analytics": "Dataset contains **user analytics** signals.",
    "general": "Dataset schema is **general-purpose**. Numeric columns mapped to KPI cards.",
}
REVENUE_WORDS = ("revenue", "sales", "amount")
KPI_REVENUE_WORDS = ("revenue", "sales", "amount", "total", "value", "auto_revenue")
KPI_ORDER_WORDS = ("order", "count", "qty")
# Characters dropped before a text cell is read as a number.
NUMERIC_NOISE = "₹$€£,% \t\n\r\f\v\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Upper bounds of the run-duration histogram, in seconds.
DURATION_BOUNDS = (1, 5, 10, 30, 60, 120, 300)
