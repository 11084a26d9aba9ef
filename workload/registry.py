"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query, and the DuckDB SQL with the same result if there is one."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def ts(c: str | Column, alias: str | None = None) -> Column:
    """Timestamp as text, the same in both engines."""
    out = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return out.alias(alias or (c if isinstance(c, str) else "ts"))


# Means of amounts with four decimals often end exactly on a rounding tie, where
# the last bit decides. Both engines add the same small offset before rounding.
TIE_4 = 0.00001371
TIE_6 = 0.0000001371


def r4(*names: str) -> list[Column]:
    return [(F.round(F.col(n).cast("double") + F.lit(TIE_4), 4) + F.lit(0.0)).alias(n) for n in names]


def r6(*names: str) -> list[Column]:
    return [(F.round(F.col(n).cast("double") + F.lit(TIE_6), 6) + F.lit(0.0)).alias(n) for n in names]
