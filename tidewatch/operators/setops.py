"""Schemas as rows, and set operations on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of Spark types in the vocabulary of the expected schemas.
SQL_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "double": "DOUBLE PRECISION",
    "float": "REAL", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}

SCHEMA_ROWS = "table_name string, column_name string, type_name string"


def sql_name(dtype: T.DataType) -> str:
    simple = dtype.simpleString()
    if simple.startswith("decimal"):
        return simple.replace("decimal", "NUMERIC")
    return SQL_NAMES.get(simple, simple.upper())


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """(table, column, type) of live tables, from metadata only; a missing table gives no rows."""
    rows = [(t, f.name, sql_name(f.dataType)) for t, df in tables.items() if df is not None for f in df.schema.fields]
    return spark.createDataFrame(rows, SCHEMA_ROWS)


def expected_rows(spark: SparkSession, expected: Mapping[str, Mapping[str, str]]) -> DataFrame:
    rows = [(t, c, kind) for t, cols in expected.items() for c, kind in cols.items()]
    return spark.createDataFrame(rows, SCHEMA_ROWS)


def schema_diff(incoming: DataFrame, known: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Columns that are new or dropped in the incoming schema; types are not compared."""
    a, b = incoming.alias("a"), known.alias("b")
    keys = ["table_name", "column_name"]
    both = a.join(b, keys, "full_outer").where(~F.col("column_name").isin(*ignore) if ignore else F.lit(True))
    new, old = F.col("a.type_name"), F.col("b.type_name")
    kind = F.when(old.isNull(), "NEW_COLUMN").when(new.isNull(), "DROPPED_COLUMN")
    return both.select(
        *keys, kind.alias("drift_type"), old.alias("old_definition"), new.alias("new_definition")
    ).where(F.col("drift_type").isNotNull())


def concat_tables(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def observed_columns(df: DataFrame, table: str) -> DataFrame:
    """Columns that hold at least one value, with how many rows do; one scan of the data."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = counted.unpivot([], df.columns, "column_name", "filled")
    kinds = {f.name: sql_name(f.dataType) for f in df.schema.fields}
    type_name = F.lit(None).cast("string")
    for c, kind in kinds.items():
        type_name = F.when(F.col("column_name") == c, F.lit(kind)).otherwise(type_name)
    return long.where("filled > 0").select(
        F.lit(table).alias("table_name"), "column_name", type_name.alias("type_name"), "filled"
    )
