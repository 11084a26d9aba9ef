"""Expectations on tables: all checks of a suite are measured in one aggregation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv


@dataclass(frozen=True)
class Expectation:
    """A named measure over the table and how to judge it.

    ``measure`` is an aggregate. ``passed`` and ``detail`` map the measured
    column to a verdict and a text. ``counts`` tells whether the measure is a
    number of failing rows.
    """

    name: str
    measure: Column
    passed: Callable[[Column], Column]
    detail: Callable[[Column], Column]
    counts: bool = True


def _count_detail(noun: str, clean: str) -> Callable[[Column], Column]:
    def detail(n: Column) -> Column:
        return F.when(n == 0, F.lit(clean)).otherwise(F.concat(n.cast("bigint").cast("string"), F.lit(f" {noun}")))

    return detail


def _none(n: Column) -> Column:
    return n == 0


def _plain(x: float) -> str:
    return f"{x:g}" if abs(x) < 1e6 else f"{x:.0f}"


def expect_no_nulls(col: str) -> Expectation:
    return Expectation(
        f"no_nulls:{col}", F.count_if(F.col(col).isNull()), _none, _count_detail("null rows", "clean")
    )


def expect_values_in_set(col: str, valid: Sequence[str]) -> Expectation:
    """Rows outside the set; a NULL counts as outside."""
    inside = F.coalesce(F.col(col).isin(*valid), F.lit(False))
    listed = "all in {" + ", ".join(sorted(valid)) + "}"
    return Expectation(f"values_in_set:{col}", F.count_if(~inside), _none, _count_detail("invalid values", listed))


def expect_column_between(col: str, lo: float, hi: float) -> Expectation:
    """Rows outside the closed range; a NULL counts as outside."""
    inside = F.coalesce(F.col(col).between(lo, hi), F.lit(False))
    a, b = _plain(lo), _plain(hi)
    return Expectation(
        f"between:[{a},{b}]:{col}", F.count_if(~inside), _none,
        _count_detail("out-of-range values", f"all in [{a}, {b}]"),
    )


def expect_unique(col: str) -> Expectation:
    """Repeats beyond the first; NULLs equal each other."""
    distinct = F.count_distinct(col) + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))
    return Expectation(f"unique:{col}", F.count(F.lit(1)) - distinct, _none, _count_detail("duplicates", "unique"))


def expect_row_count_between(lo: int, hi: int | None) -> Expectation:
    """Without ``hi`` there is no upper limit."""
    wanted = f"at least {lo}" if hi is None else f"{lo}–{hi}"
    return Expectation(
        "row_count", F.count(F.lit(1)), lambda n: (n >= lo) if hi is None else (n >= lo) & (n <= hi),
        lambda n: F.concat(n.cast("bigint").cast("string"), F.lit(f" rows (expected {wanted})")), counts=False,
    )


def expect_mean_between(col: str, lo: float, hi: float) -> Expectation:
    a, b = _plain(lo), _plain(hi)
    return Expectation(
        f"mean_between:[{a},{b}]:{col}", F.avg(col), lambda m: (m >= lo) & (m <= hi),
        lambda m: F.coalesce(F.concat(F.lit("mean="), F.format_string("%.4f", F.round(m, 4))), F.lit("mean=nan")),
        counts=False,
    )


def expect_no_future_timestamps(col: str, now: datetime | Column) -> Expectation:
    limit = (now if isinstance(now, Column) else F.lit(now)) + F.expr("interval 5 minutes")
    return Expectation(
        f"no_future_ts:{col}", F.count_if(F.col(col) > limit), _none, _count_detail("future timestamps", "clean")
    )


# -- suites -------------------------------------------------------------------------


def raw_orders_suite(
    now: datetime | Column,
    categories: Sequence[str] = fv.ORDER_CATEGORIES,
    regions: Sequence[str] = fv.ORDER_REGIONS,
    payments: Sequence[str] = fv.PAYMENT_METHODS,
    most_rows: int | None = None,
) -> list[Expectation]:
    return [
        expect_row_count_between(1, most_rows),
        expect_no_nulls("customer_id"),
        expect_no_nulls("order_ts"),
        expect_no_nulls("unit_price"),
        expect_column_between("unit_price", 0.01, 1_000_000),
        expect_column_between("quantity", 1, 10_000),
        expect_column_between("discount_pct", 0, 100),
        expect_values_in_set("category", categories),
        expect_values_in_set("region", regions),
        expect_values_in_set("payment_method", payments),
        expect_mean_between("unit_price", 5, 1_000),
        expect_no_future_timestamps("order_ts", now),
    ]


def kpi_snapshots_suite(now: datetime | Column, periods: Sequence[str] = fv.KPI_PERIODS, most_rows: int | None = None) -> list[Expectation]:
    return [
        expect_row_count_between(1, most_rows),
        expect_no_nulls("snapshot_ts"),
        expect_no_nulls("total_revenue"),
        expect_column_between("return_rate", 0, 1),
        expect_column_between("total_revenue", 0, 1e9),
        expect_values_in_set("period", periods),
        expect_no_future_timestamps("snapshot_ts", now),
    ]


def anomaly_events_suite() -> list[Expectation]:
    return [
        expect_no_nulls("metric_name"),
        expect_no_nulls("severity"),
        expect_values_in_set("severity", fv.SEVERITIES),
        expect_column_between("z_score", -100, 100),
    ]


def validate(df: DataFrame, table: str, suite: Sequence[Expectation]) -> DataFrame:
    """One row per check: name, verdict, detail, failing rows. One scan for the whole suite."""
    measured = df.agg(*[e.measure.cast("double").alias(f"m{i}") for i, e in enumerate(suite)])
    cells = []
    for i, e in enumerate(suite):
        m = F.col(f"m{i}")
        cells.append(
            F.struct(
                F.lit(i).alias("check_no"),
                F.lit(e.name).alias("name"),
                F.coalesce(e.passed(m), F.lit(False)).alias("passed"),
                e.detail(m).alias("detail"),
                (m if e.counts else F.lit(0.0)).cast("bigint").alias("failing_rows"),
            )
        )
    return measured.select(F.lit(table).alias("table"), F.explode(F.array(*cells)).alias("c")).select("table", "c.*")


def report(checks: DataFrame) -> DataFrame:
    """Pass rate and summary text per table."""
    icon = F.when(F.col("passed"), F.lit("✅")).otherwise(F.lit("❌"))
    line = F.concat(F.lit("  "), icon, F.lit(" "), F.col("name"), F.lit(": "), F.col("detail"))
    grouped = checks.groupBy("table").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("passed").alias("passed_checks"),
        F.sort_array(F.collect_list(F.struct("check_no", line.alias("line")))).alias("_lines"),
    )
    rate = F.col("passed_checks") / F.greatest(F.col("checks"), F.lit(1))
    head = F.concat(F.lit("Data Quality Report: "), F.col("table"))
    share = F.format_string("  Pass rate: %.0f%%  (%d/%d)", F.round(rate * 100, 0), "passed_checks", "checks")
    return grouped.select(
        "table", "checks", "passed_checks", rate.alias("pass_rate"),
        F.concat_ws("\n", head, share, F.array_join(F.transform("_lines", lambda x: x["line"]), "\n")).alias("summary"),
    )
