"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import running_total


def interleave(df: DataFrame, strata: str, key: list[str], shards: int, seed: int = 17) -> DataFrame:
    """`df` with `shard` (0 to shards - 1) and `slot` (gapless from 0 within the shard), every shard a copy of the whole mixture in small.

    Rows are shuffled within their stratum by a seeded hash of `key`, ranked, and all strata are merged by fractional
    rank (rank - 1/2) / rows of the stratum; the merged order is cut into pieces whose lengths differ by at most one.
    A stratum with share p of all rows has p times its shard's rows in each shard, give or take about one per stratum.

    Both ranks are running totals over range-partitioned rows, so a stratum with a third of all rows is spread like the
    rest. Null strata form a stratum of their own. Rows that agree in `key` are interchangeable and may be dealt either
    way round; all rows are kept. An empty table gives an empty table. Give only the columns to be shuffled; other
    columns pass through, and existing columns `shard` and `slot` are replaced.
    """
    rest = [c for c in df.columns if c not in ("shard", "slot")]
    mixed = F.md5(F.concat_ws("\u0001", F.lit(str(seed)), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0002")) for c in key]))
    named = df.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), F.col(f"`{strata}`").alias("_stratum"), mixed.alias("_mixed"), F.lit(1).alias("_one"))
    ranked = running_total(named, ["_stratum", "_mixed"], "_one", "_at", "shards-rank")
    sizes = ranked.groupBy("_stratum").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first")).withColumnRenamed("_stratum", "_name")
    placed = ranked.join(sizes, F.col("_stratum").eqNullSafe(F.col("_name")))
    rank = F.col("_at") - F.col("_first")
    merged = placed.select("_row", "_one", "_stratum", "_mixed", ((2 * rank + 1) / (2 * F.col("_rows"))).alias("_share"))
    ordered = running_total(merged, ["_share", "_stratum", "_mixed"], "_one", "_at", "shards-merge")
    total = ordered.count()
    cut = ordered.withColumn("shard", F.expr(f"cast((_at * {shards}L) div {max(total, 1)}L as int)"))
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return cut.select("_row.*", "shard", (F.col("_at") - first).alias("slot"))
