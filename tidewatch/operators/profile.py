"""Any table of text columns: type it, fill it, derive metrics, map it to KPI form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed_values as fv
from tidewatch.functions import scalars as S
from tidewatch.operators import windows
from tidewatch.operators.quantiles import exact_medians
from tidewatch.session import stored


@dataclass(frozen=True)
class Profile:
    dataset_type: str
    kinds: Mapping[str, str]
    row_count: int
    col_count: int

    def of_kind(self, kind: str) -> list[str]:
        return [c for c, k in self.kinds.items() if k == kind]


# -- names and types ----------------------------------------------------------------


def normalize_columns(df: DataFrame) -> DataFrame:
    """Normalised column names; repeated results get a running suffix."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        name = S.normalize_name(c) or "column"
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)


def parse_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per text column: share of rows that read as a number, whether any digit occurs,
    share of rows that read as a time but not as a number."""
    columns = list(columns or _text_columns(df))
    n = F.count(F.lit(1))
    # Numbers first, in their own projection: each cell is parsed once, and cells
    # that are numbers are not tried as times.
    parsed = df.select(*columns, *[S.clean_numeric(c).alias(f"_n{i}") for i, c in enumerate(columns)])
    parts = []
    for i, c in enumerate(columns):
        time = F.when(F.col(f"_n{i}").isNull(), dated(c))
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.try_divide(F.count(f"_n{i}"), n).alias("numeric_rate"),
                F.coalesce(F.max(F.col(c).rlike("[0-9]")), F.lit(False)).alias("has_digit"),
                F.try_divide(F.count(time), n).alias("time_rate"),
            ).alias(c)
        )
    wide = parsed.agg(*parts)
    return wide.select(F.explode(F.array(*columns)).alias("p")).select("p.*")


def dated(c: str) -> Column:
    """Time in a text cell that begins with a date; a time of day alone, which a cast would place on today, is none."""
    return F.when(F.col(c).rlike(r"^\s*[+-]?[0-9]{4,}-"), F.col(c).try_cast("timestamp"))


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def typed(df: DataFrame, least: float = 0.5) -> tuple[DataFrame, dict[str, str]]:
    """Text columns as numbers or timestamps where more than ``least`` of the rows read as such.

    One job measures all columns (its result has one row per column), then one
    projection converts them. Returns the frame and the kind of each column.
    """
    columns = _text_columns(df)
    rates = {r["column_name"]: r for r in parse_rates(df, columns).collect()} if columns else {}
    out, kinds = {}, {}
    for f in df.schema.fields:
        r = rates.get(f.name)
        if r is None:
            kinds[f.name] = _kind_of(f.dataType)
        elif r["has_digit"] and (r["numeric_rate"] or 0.0) > least:
            out[f.name], kinds[f.name] = S.clean_numeric(f.name), "numeric"
        elif (r["time_rate"] or 0.0) > least:
            out[f.name], kinds[f.name] = dated(f.name), "date"
        else:
            kinds[f.name] = "categorical"
    return (df.withColumns(out) if out else df), kinds


def _kind_of(t: T.DataType) -> str:
    if isinstance(t, T.NumericType):
        return "numeric"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "date"
    return "categorical"


def coerce_numeric(df: DataFrame, least: float = 0.5) -> DataFrame:
    """Only the numeric half of :func:`typed`."""
    converted, kinds = typed(df, least)
    return df.withColumns({c: S.clean_numeric(c) for c in _text_columns(df) if kinds[c] == "numeric"})


def detect_kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: _kind_of(f.dataType) for f in df.schema.fields}


# -- filling and deriving -----------------------------------------------------------------


def impute(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Numbers to the column median, categories to Unknown; dates stay."""
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    medians = exact_medians(df, numeric)
    out = {c: F.coalesce(S.finite(c), F.lit(medians[c]).cast("double")) for c in numeric}
    out |= {c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c, k in kinds.items() if k == "categorical"}
    return df.withColumns(out) if out else df


def derive_metrics(df: DataFrame) -> DataFrame:
    """``auto_revenue`` from a price and a quantity, ``auto_profit_margin`` from revenue and cost.

    The last price and quantity in column order are taken, the first revenue
    and the first cost. A margin over zero revenue is NULL.
    """
    cols = list(df.columns)
    prices = [c for c in cols if "price" in c]
    amounts = [c for c in cols if "quantity" in c or "qty" in c]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    out: dict[str, Column] = {}
    if "revenue" not in cols and "total" not in cols:
        pairs = [(p, q) for p in prices for q in amounts if p in numeric and q in numeric]
        if pairs:
            p, q = pairs[-1]
            out["auto_revenue"] = S.finite(p) * S.finite(q)
    revenue = [c for c in cols if any(w in c for w in fv.REVENUE_WORDS)]
    cost = [c for c in cols if "cost" in c]
    if revenue and cost and "profit_margin" not in cols and revenue[0] in numeric and cost[0] in numeric:
        r, c = S.finite(revenue[0]), S.finite(cost[0])
        out["auto_profit_margin"] = S.finite(F.try_divide(r - c, r))
    return df.withColumns(out) if out else df


def infer_dataset_type(columns: Sequence[str]) -> str:
    text = " ".join(columns).lower()
    for name, words in fv.DATASET_WORDS:
        if any(w in text for w in words):
            return name
    return fv.DATASET_DEFAULT


def process(raw: DataFrame) -> tuple[DataFrame, Profile]:
    """Typed, filled and extended table with its profile.

    The typed cells are stored once; what follows reads them column by column
    instead of parsing the text again.
    """
    named, kinds = typed(normalize_columns(raw))
    named = stored(named, "typed")
    df = derive_metrics(impute(named, kinds))
    return df, Profile(infer_dataset_type(df.columns), kinds, df.count(), len(df.columns))


def profile(df: DataFrame, kinds: Mapping[str, str], dataset_type: str | None = None) -> DataFrame:
    """Row count, column count, columns per kind and dataset type in one row."""
    known = dataset_type or infer_dataset_type(df.columns)

    def names(kind: str) -> Column:
        return F.lit(",".join(c for c, k in kinds.items() if k == kind))

    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("col_count"),
        names("date").alias("date_cols"),
        names("numeric").alias("numeric_cols"),
        names("categorical").alias("cat_cols"),
        F.lit(known).alias("dataset_type"),
    )


# -- insight ----------------------------------------------------------------------------------


def insight(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], dataset_type: str) -> DataFrame:
    """Findings as rows (position, text): spikes, each dominated category, dataset hint last."""
    spark = df.sparkSession
    parts = []
    if numeric:
        c = numeric[0]
        x = S.finite(c)
        s = df.agg(F.struct(F.avg(x).alias("m"), F.stddev_samp(x).alias("sd"), F.count(x).alias("n")).alias("s")).scalar()
        z = S.safe_z(x, s.getField("m"), s.getField("sd"))
        hits = df.agg(F.count_if((s.getField("n") > 5) & (F.abs(z) > 2.5)).alias("hits")).where("hits > 0")
        text = F.concat(
            F.lit("**"), F.col("hits").cast("string"),
            F.lit(f" spike(s)** in `{c}` (z>2.5σ) — investigate anomalies."),
        )
        parts.append(hits.select(F.lit(0).alias("position"), text.alias("text")))
    for i, c in enumerate(categorical, 1):
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        top = counts.agg(F.max_by(c, F.struct("n", c)).alias("value"), F.max("n").alias("n"), F.sum("n").alias("all"))
        share = F.try_divide(F.col("n"), F.col("all"))
        text = F.concat(
            F.lit(f"`{c}` dominated by **"), F.col("value").cast("string"), F.lit("** ("),
            F.format_string("%.0f%%", F.round(share * 100, 0)), F.lit(") — skewed distribution."),
        )
        parts.append(top.where(share > 0.55).select(F.lit(i).alias("position"), text.alias("text")))
    hint = spark.range(1).select(F.lit(max(3, len(categorical) + 1)).alias("position"), F.lit(fv.DATASET_HINTS.get(dataset_type, "")).alias("text"))
    out = hint
    for p in parts:
        out = out.unionByName(p)
    return out


# -- KPI form ----------------------------------------------------------------------------------


def to_kpi(df: DataFrame, p: Profile, order_by: str | None = None) -> DataFrame:
    """Columns of the table that best fit the KPI form, defaults for the rest.

    Without any date column the time is one hour per row when ``order_by``
    names a column that orders the rows, and NULL otherwise.
    """
    taken: dict[str, Column] = {}
    cols, used = set(df.columns), set()

    def take(target: str, source: str) -> None:
        taken[target] = F.col(source)
        used.add(source)

    dates, numeric, cats = p.of_kind("date"), p.of_kind("numeric"), p.of_kind("categorical")
    if "snapshot_ts" in cols:
        take("snapshot_ts", "snapshot_ts")
    elif dates:
        take("snapshot_ts", dates[0])
    elif order_by is not None:
        df = _hour_per_row(df, order_by)
        taken["snapshot_ts"] = F.col("_hour")
    else:
        taken["snapshot_ts"] = F.lit(None).cast("timestamp")
    if "region" in cols:
        take("region", "region")
    elif cats:
        take("region", cats[0])
    else:
        taken["region"] = F.lit("Default")
    if "total_revenue" in cols:
        take("total_revenue", "total_revenue")
    else:
        fits = [c for c in numeric if any(w in c for w in fv.KPI_REVENUE_WORDS)] or numeric
        if fits:
            take("total_revenue", fits[0])
        else:
            taken["total_revenue"] = F.lit(0.0)
    if "total_orders" in cols:
        take("total_orders", "total_orders")
    else:
        fits = [c for c in numeric if c not in used and any(w in c for w in fv.KPI_ORDER_WORDS)]
        if fits:
            take("total_orders", fits[0])
        else:
            taken["total_orders"] = F.lit(1)
    for c in ("return_rate", "avg_order_val"):
        taken[c] = F.col(c) if c in cols else F.lit(None).cast("double")
    taken["category"] = F.col("category") if "category" in cols - used else F.lit(p.dataset_type.title())
    order = ["snapshot_ts", "region", "category", "total_revenue", "total_orders", "return_rate", "avg_order_val"]
    return df.select(*[taken[c].alias(c) for c in order])


def _hour_per_row(df: DataFrame, order_by: str, last: str = "2024-01-01 00:00:00") -> DataFrame:
    """Hourly times that end at ``last``, in the order of a numeric column."""
    n = df.agg(F.count(F.lit(1))).scalar()
    numbered = windows.number_all(df, order_by, "_pos")
    hour = F.lit(last).cast("timestamp") - F.make_interval(hours=(n - F.col("_pos")).cast("int"))
    return numbered.withColumn("_hour", hour).drop("_pos")
