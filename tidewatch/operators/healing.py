"""Schema drift and null violations: find, plan, repair, validate, log."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.operators import setops

DRIFT_COLUMNS = ["table_name", "column_name", "drift_type", "old_definition", "new_definition"]

# Spark type and default of a column that is added back, by expected type fragment.
ADDED_TYPES = {
    "BIGINT": ("bigint", None),
    "INTEGER": ("int", None),
    "VARCHAR": ("string", None),
    "NUMERIC": ("decimal(14,4)", None),
    "BOOLEAN": ("boolean", False),
    "TIMESTAMP": ("timestamp", None),
    "UUID": ("string", None),
    "JSONB": ("string", None),
}
# Other names under which a fragment counts as present in a Spark schema.
EQUIVALENTS = {
    "NUMERIC": ("NUMERIC", "DOUBLE PRECISION", "REAL"),
    "UUID": ("UUID", "VARCHAR"),
    "JSONB": ("JSONB", "VARCHAR", "MAP", "STRUCT"),
}


# -- detection ------------------------------------------------------------------------


def drift_vs_baseline(live: DataFrame, expected: DataFrame, ignore: Sequence[str] = fv.DRIFT_IGNORED) -> DataFrame:
    """Dropped, changed and new columns against the expected schema rows.

    A type changed when the expected fragment is not part of the live type. A
    table without live columns is passed over.
    """
    keys = ["table_name", "column_name"]
    present = live.select("table_name").distinct()
    both = live.alias("a").join(expected.join(present, "table_name", "left_semi").alias("b"), keys, "full_outer")
    now, want = F.col("a.type_name"), F.col("b.type_name")
    matches = now.contains(want)
    for fragment, names in EQUIVALENTS.items():
        for other in names:
            matches = matches | ((want == fragment) & now.contains(other))
    kind = (
        F.when(now.isNull(), "DROPPED_COLUMN")
        .when(want.isNull() & ~F.col("column_name").isin(*ignore), "NEW_COLUMN")
        .when(want.isNotNull() & ~matches, "TYPE_CHANGE")
    )
    return both.select(*keys, kind.alias("drift_type"), want.alias("old_definition"), now.alias("new_definition")).where(
        F.col("drift_type").isNotNull()
    )


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, from one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "n_null").withColumn("table_name", F.lit(table))


def null_violations(
    tables: Mapping[str, DataFrame], checks: Sequence[tuple[str, str]] = fv.NOT_NULL_CHECKS
) -> DataFrame | None:
    """Columns that must not be null but are, as drift rows; None if no checked table is given."""
    parts = []
    for table, df in tables.items():
        cols = [c for t, c in checks if t == table and c in df.columns]
        if cols:
            parts.append(null_counts(df, table, cols))
    if not parts:
        return None
    found = setops.concat_tables(*parts).where("n_null > 0")
    text = F.concat(F.col("n_null").cast("string"), F.lit(" NULL rows found"))
    return found.select(
        "table_name", "column_name", F.lit("NULL_VIOLATION").alias("drift_type"),
        F.lit("NOT NULL").alias("old_definition"), text.alias("new_definition"),
    )


def scan(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    expected: Mapping[str, Mapping[str, str]] = fv.EXPECTED_SCHEMAS,
    checks: Sequence[tuple[str, str]] = fv.NOT_NULL_CHECKS,
) -> DataFrame:
    """All drift of the managed tables: schema first, then nulls."""
    schema = drift_vs_baseline(setops.schema_rows(spark, tables), setops.expected_rows(spark, expected))
    nulls = null_violations(tables, checks)
    return schema if nulls is None else setops.concat_tables(schema, nulls)


# -- plan ----------------------------------------------------------------------------------


def fill_kind(type_name: Column) -> Column:
    """What replaces a null of an expected type: epoch, 0 or UNKNOWN."""
    return (
        F.when(type_name.contains("TIMESTAMP"), "epoch")
        .when(type_name.isin("BIGINT", "INTEGER", "NUMERIC"), "0")
        .otherwise("UNKNOWN")
    )


def heal_plan(drifts: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Action per drift; a changed type is left to a person.

    ``heal_query`` words the change in SQL for the log.
    """
    kind = F.col("drift_type")
    wanted = F.col("old_definition")
    if expected is not None:
        known = expected.withColumnRenamed("type_name", "_expected")
        drifts = drifts.join(known, ["table_name", "column_name"], "left")
        wanted = F.coalesce("_expected", F.lit("NUMERIC"))
    action = (
        F.when(kind == "NEW_COLUMN", "TAG_COLUMN")
        .when(kind == "DROPPED_COLUMN", "ADD_COLUMN")
        .when(kind == "NULL_VIOLATION", "FILL_NULLS")
        .otherwise("MANUAL_REVIEW")
    )
    add_type = F.lit("STRING")
    for fragment, (spark_type, default) in ADDED_TYPES.items():
        clause = spark_type.upper() + ("" if default is None else f" DEFAULT {str(default).upper()}")
        add_type = F.when(F.col("old_definition") == fragment, clause).otherwise(add_type)
    kind_of_fill = fill_kind(wanted)
    value = F.when(kind_of_fill == "epoch", "TIMESTAMP '1970-01-01 00:00:00'").when(kind_of_fill == "0", "0").otherwise("'UNKNOWN'")
    t, c = F.col("table_name"), F.col("column_name")
    query = (
        F.when(kind == "NEW_COLUMN", F.concat(F.lit("ALTER TABLE "), t, F.lit(" ALTER COLUMN "), c, F.lit(" COMMENT 'AUTO_DETECTED'")))
        .when(kind == "DROPPED_COLUMN", F.concat(F.lit("ALTER TABLE "), t, F.lit(" ADD COLUMN "), c, F.lit(" "), add_type))
        .when(
            kind == "NULL_VIOLATION",
            F.concat(F.lit("UPDATE "), t, F.lit(" SET "), c, F.lit(" = "), value, F.lit(" WHERE "), c, F.lit(" IS NULL")),
        )
    )
    return drifts.withColumns(
        {"action": action, "auto_heal": action != "MANUAL_REVIEW", "heal_query": query}
    ).select(*DRIFT_COLUMNS, "action", "auto_heal", "heal_query")


# -- repair ----------------------------------------------------------------------------------


def heal_add_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Adds dropped columns with their expected type; booleans are false, the rest NULL."""
    added = {}
    for name, fragment in columns.items():
        if name not in df.columns:
            spark_type, default = ADDED_TYPES.get(fragment, ("string", None))
            added[name] = F.lit(default).cast(spark_type)
    return df.withColumns(added) if added else df


def heal_fill_nulls(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Fills nulls by expected type: timestamps with the epoch, numbers with 0, else UNKNOWN."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    filled = {}
    for name, fragment in columns.items():
        if "TIMESTAMP" in fragment:
            value = F.lit("1970-01-01 00:00:00")
        elif fragment in ("BIGINT", "INTEGER", "NUMERIC"):
            value = F.lit(0)
        else:
            value = F.lit("UNKNOWN")
        filled[name] = F.coalesce(F.col(name), value.cast(kinds[name]))
    return df.withColumns(filled) if filled else df


def heal_tag_new(df: DataFrame, columns: Sequence[str], now: datetime) -> DataFrame:
    """Keeps unknown columns and marks them in their metadata."""
    for name in columns:
        note = f"AUTO_DETECTED: new column added outside baseline schema at {now.isoformat()}"
        df = df.withMetadata(name, {**_metadata(df, name), "comment": note})
    return df


def _metadata(df: DataFrame, name: str) -> dict:
    return dict(next(f.metadata for f in df.schema.fields if f.name == name) or {})


def heal(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    now: datetime,
    expected: Mapping[str, Mapping[str, str]] = fv.EXPECTED_SCHEMAS,
    checks: Sequence[tuple[str, str]] = fv.NOT_NULL_CHECKS,
) -> tuple[DataFrame, DataFrame]:
    """Repaired table and the log of what was done.

    The repair is a lazy transform of the input. It is validated by scanning
    the repaired frame again before anyone publishes it: a drift counts as
    healed only if the second scan no longer reports it (a tagged new column
    stays visible by design and is validated by its tag).
    """
    wanted = expected[table]
    drifts = scan(spark, {table: df}, {table: wanted}, checks)
    found = drifts.collect()  # a few rows per table: bounded by its columns
    by_kind = {k: [r["column_name"] for r in found if r["drift_type"] == k] for k in
               ("NEW_COLUMN", "DROPPED_COLUMN", "NULL_VIOLATION")}
    healed = heal_add_missing(df, {c: wanted[c] for c in by_kind["DROPPED_COLUMN"]})
    healed = heal_fill_nulls(healed, {c: wanted.get(c, "NUMERIC") for c in by_kind["NULL_VIOLATION"]})
    healed = heal_tag_new(healed, by_kind["NEW_COLUMN"], now)

    again = scan(spark, {table: healed}, {table: wanted}, checks).collect()
    left = {(r["column_name"], r["drift_type"]) for r in again}
    log = []
    for r in found:
        auto = r["drift_type"] != "TYPE_CHANGE"
        if r["drift_type"] == "NEW_COLUMN":
            ok = "comment" in _metadata(healed, r["column_name"])
        else:
            ok = auto and (r["column_name"], r["drift_type"]) not in left
        log.append((*[r[c] for c in DRIFT_COLUMNS], auto and ok, ok, None if auto else "No auto-heal strategy"))
    schema = (
        "table_name string, column_name string, drift_type string, old_definition string, "
        "new_definition string, auto_healed boolean, validated boolean, error string"
    )
    rows = spark.createDataFrame(log, schema)
    plan = heal_plan(drifts, setops.expected_rows(spark, {table: wanted})).select("table_name", "column_name", "drift_type", "heal_query")
    results = rows.join(plan, ["table_name", "column_name", "drift_type"], "left").withColumn("detected_at", F.lit(now))
    return healed, results


# -- repair of a stored table ---------------------------------------------------------------

LOG = (
    "table_name string, column_name string, drift_type string, old_definition string, new_definition string, "
    "auto_healed boolean, validated boolean, error string"
)


def partition_nulls(df: DataFrame, partition: str, columns: Sequence[str]) -> DataFrame:
    """Rows and nulls of the checked columns per partition, from one scan of these columns."""
    return df.groupBy(partition).agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def heal_partitions(
    stored: DataFrame,
    table: str,
    partition: str,
    stage: Callable[[DataFrame], DataFrame],
    publish: Callable[[DataFrame], None],
    expected: Mapping[str, str],
    checks: Sequence[tuple[str, str]] = fv.NOT_NULL_CHECKS,
) -> list[tuple]:
    """Write, audit, publish: repairs the null violations of ``stored`` and returns the log rows.

    Only partitions with a violation are rewritten: their repaired rows go to a
    staging table (``stage`` writes it and gives it back), a second scan of the
    staging table counts rows and nulls again, and only if each partition has as
    many rows as before and no null is left, ``publish`` replaces them. Otherwise
    the table stays as it is and the log says so. The counts reach the driver as
    one row per scanned partition.
    """
    columns = [c for t, c in checks if t == table and c in stored.columns]
    if not columns:
        return []
    before = {r[partition]: r for r in partition_nulls(stored, partition, columns).where(" or ".join(f"`{c}` > 0" for c in columns)).collect()}
    if not before:
        return []
    nulls = {c: sum(r[c] for r in before.values()) for c in columns}
    broken = {c: expected.get(c, "NUMERIC") for c, n in nulls.items() if n}
    staged = stage(heal_fill_nulls(stored.where(F.col(partition).isin(list(before))), broken))
    after = {r[partition]: r for r in partition_nulls(staged, partition, columns).collect()}
    sound = after.keys() == before.keys() and all(after[k]["_rows"] == before[k]["_rows"] for k in before)
    left = {c: sum(r[c] for r in after.values()) for c in columns}
    fine = sound and not any(left.values())
    if fine:
        publish(staged)
    error = None if fine else "rows lost in staging" if not sound else "nulls left in staging"
    return [(table, c, "NULL_VIOLATION", "NOT NULL", f"{nulls[c]} NULL rows found", fine, fine and left[c] == 0, error) for c in broken]


def schema_log(drift: DataFrame, table: str) -> list[tuple]:
    """Log rows of the schema drift of a batch: dropped columns are added on writing, new ones are tagged, changed types wait for a person."""
    return [
        (*[r[c] for c in DRIFT_COLUMNS], auto, auto, None if auto else "No auto-heal strategy")
        for r in drift.where(F.col("table_name") == table).collect()  # as many rows as columns
        for auto in [r["drift_type"] != "TYPE_CHANGE"]
    ]


def as_log(spark: SparkSession, rows: Sequence[tuple], expected: Mapping[str, Mapping[str, str]], now: datetime) -> DataFrame:
    """Log rows with the statement that words each repair."""
    log = spark.createDataFrame(list(rows), LOG)
    plan = heal_plan(log.select(*DRIFT_COLUMNS), setops.expected_rows(spark, expected)).select("table_name", "column_name", "drift_type", "heal_query")
    return log.join(plan, ["table_name", "column_name", "drift_type"], "left").withColumn("detected_at", F.lit(now))
