"""Exact quantiles that stay distributed at any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalars import finite

# Up to this many candidate values an exact aggregate may hold them in one buffer.
SMALL = 20_000
ACCURACY = 10_000


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float = 0.5, small: int = SMALL) -> dict[str, float | None]:
    """Interpolated quantile per column, NULL, NaN and infinities left out.

    All columns share each pass. The first pass counts the values and takes
    approximate quantiles on both sides of the target. The next one counts the
    values below and inside that interval, and so on until the interval holds at
    most ``small`` values, which the built-in exact percentile then finishes.
    Only a few numbers per pass reach the driver.
    """
    columns = list(columns)
    if not columns:
        return {}
    names = [f"v{i}" for i in range(len(columns))]
    values = df.select(*[finite(c).alias(v) for c, v in zip(columns, names)])
    margin = 4.0 / ACCURACY
    probes = [max(0.0, q - margin), min(1.0, q + margin)]
    first = _row(values, {
        v: F.struct(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.approx_percentile(v, probes, ACCURACY).alias("p"))
        for v in names
    })
    searches = {v: _Search(r["n"], q, r["lo"], r["hi"], r["p"], small) for v, r in first.items() if r["n"]}
    while True:
        open_ones = {v: s for v, s in searches.items() if s.is_open()}
        if not open_ones:
            break
        counted = _row(values, {v: s.counts(F.col(v)) for v, s in open_ones.items()})
        for v, s in open_ones.items():
            s.take(counted[v])
        still = {v: s for v, s in open_ones.items() if s.is_open()}
        if still:
            cuts = _row(values, {v: s.cut(F.col(v)) for v, s in still.items()})
            for v, s in still.items():
                s.probe = tuple(cuts[v]["p"])
    last = _row(values, {v: s.finish(F.col(v)) for v, s in searches.items()}) if searches else {}
    return {c: searches[v].value(last[v]) if v in searches else None for c, v in zip(columns, names)}


def exact_medians(df: DataFrame, columns: Sequence[str], small: int = SMALL) -> dict[str, float | None]:
    return exact_quantiles(df, columns, 0.5, small)


def _row(values: DataFrame, parts: dict[str, Column]) -> dict:
    """One aggregation; each part is a struct."""
    return values.agg(*[c.alias(v) for v, c in parts.items()]).first().asDict(recursive=True)


class _Search:
    """Interval [lo, hi] that holds the value at ``rank`` of one column, and how much is in it."""

    def __init__(self, n: int, q: float, lo: float, hi: float, probe, small: int) -> None:
        self.position = (n - 1) * q
        self.rank = int(self.position)
        self.n, self.lo, self.hi, self.below, self.inside = n, lo, hi, 0, n
        self.probe = tuple(probe)
        self.small = small

    def is_open(self) -> bool:
        return self.inside > self.small and self.lo < self.hi

    def counts(self, v: Column) -> Column:
        a, b = self.probe
        # Halves before adding, so that the sum cannot overflow; between neighbouring doubles the lower one cuts.
        middle = self.lo / 2 + self.hi / 2
        middle = middle if self.lo <= middle < self.hi else self.lo
        live = v.between(self.lo, self.hi)
        left, right = live & (v <= middle), live & (v > middle)
        return F.struct(
            F.count_if(live & (v < a)).alias("under"), F.count_if(v.between(a, b)).alias("within"),
            F.count_if(left).alias("left"), F.max(F.when(left, v)).alias("last"), F.min(F.when(right, v)).alias("next"),
        )

    def take(self, c: dict) -> None:
        """Shrinks to the probed interval, or halves the value range where ties leave nothing to cut off."""
        a, b = self.probe
        if self.below + c["under"] <= self.rank < self.below + c["under"] + c["within"] and c["within"] < self.inside:
            self.lo, self.hi, self.below, self.inside = a, b, self.below + c["under"], c["within"]
        elif self.rank < self.below + c["left"]:
            self.hi, self.inside = c["last"], c["left"]
        else:
            self.lo, self.below, self.inside = c["next"], self.below + c["left"], self.inside - c["left"]

    def share(self) -> float:
        return (self.rank - self.below) / max(self.inside - 1, 1)

    def cut(self, v: Column) -> Column:
        margin = 4.0 / ACCURACY
        spots = [max(0.0, self.share() - margin), min(1.0, self.share() + margin)]
        live = F.when(v.between(self.lo, self.hi), v)
        return F.struct(F.approx_percentile(live, spots, ACCURACY).alias("p"))

    def finish(self, v: Column) -> Column:
        """Value at the rank, and the next larger one with the count up to the interval's end."""
        live = F.when(v.between(self.lo, self.hi), v)
        # One value only: nothing to sort.
        at = F.lit(self.lo) if self.lo == self.hi else F.percentile(live, self.share())
        beyond = F.min(F.when(v > self.hi, v))
        return F.struct(at.alias("at"), beyond.alias("beyond"), self._after(live).alias("after"))

    def _after(self, live: Column) -> Column:
        after = self.rank + 1 - self.below
        if self.lo == self.hi or after > self.inside - 1:
            return F.lit(None).cast("double")
        return F.percentile(live, after / max(self.inside - 1, 1))

    def value(self, r: dict) -> float:
        low = r["at"]
        if self.rank + 1 > self.n - 1:
            return low
        if self.rank + 1 < self.below + self.inside:
            high = low if self.lo == self.hi else r["after"]
        else:
            high = r["beyond"]
        return low + (high - low) * (self.position - self.rank)
