"""Scalar rules on numbers, strings and timestamps."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: str | Column) -> Column:
    """Double value, with NaN and infinities turned into NULL."""
    x = col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None)).otherwise(x)


def lookup(key: str | Column, pairs: Iterable[tuple[str, str]], default: Column | None = None) -> Column:
    """Value of ``key`` in a fixed list of pairs, as one CASE expression."""
    k = col(key)
    out = default if default is not None else F.lit(None).cast("string")
    for name, value in reversed(list(pairs)):
        out = F.when(k == name, F.lit(value)).otherwise(out)
    return out


# -- severity ---------------------------------------------------------------


def severity(
    z: str | Column,
    bands: Sequence[tuple[str, float, float]] = fv.SEVERITY_BANDS,
    below: str = "CRITICAL",
) -> Column:
    """Band of |z|. Values outside every band get ``below`` (also |z| under the lowest bound)."""
    az = F.abs(col(z))
    out = F.lit(below)
    for name, lo, hi in reversed(bands):
        hit = az >= lo if hi == float("inf") else (az >= lo) & (az < hi)
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def severity_simple(z: str | Column) -> Column:
    """Three cut points on a global z; null counts as LOW."""
    x = col(z)
    return F.when(x > 3, "CRITICAL").when(x > 2, "HIGH").when(x > 1, "MEDIUM").otherwise("LOW")


def severity_csv(z: str | Column) -> Column:
    az = F.abs(col(z))
    return F.when(az > 4, "CRITICAL").when(az > 3, "HIGH").otherwise("MEDIUM")


def magnitude(z: str | Column) -> Column:
    az = F.abs(col(z))
    return F.when(az > 4, "EXTREME").when(az > 3, "HIGH").otherwise("MODERATE")


def signal(z: str | Column) -> Column:
    az = F.abs(col(z))
    return F.when(az > 4, "🔴 CRITICAL BREACH").when(az > 3, "🟠 HIGH ALERT").otherwise("🟡 ELEVATED")


# -- names and cells ----------------------------------------------------------


def normalize_name(name: str) -> str:
    """Column name in lower case, other characters as ``_``, outer ``_`` removed."""
    return re.sub(r"[^a-z0-9_]", "_", name.strip().lower()).strip("_")


def normalize_text(c: str | Column) -> Column:
    """The same rule on a string column."""
    cleaned = F.regexp_replace(F.lower(F.trim(col(c))), r"[^a-z0-9_]", "_")
    return F.regexp_replace(cleaned, r"^_+|_+$", "")


def strip(c: str | Column) -> Column:
    """Text without outer white space of any kind."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def clean_numeric(c: str | Column) -> Column:
    """Number in a text cell after dropping currency signs, %, commas, blanks; bad cells are NULL.

    Cells that do not look like a number never reach the cast: a failing cast
    costs ten times a matching one.
    """
    text = F.translate(col(c).cast("string"), fv.NUMERIC_NOISE, "")
    return F.regexp_substr(text, F.lit(NUMBER)).cast("double")


# -- time -----------------------------------------------------------------------


def hour_bucket(ts: str | Column) -> Column:
    return F.date_trunc("hour", col(ts))


def window_start(ts: str | Column, hours: int) -> Column:
    return col(ts) - F.make_interval(hours=F.lit(hours))


def window_bounds(ts: str | Column, hours: int) -> Column:
    return F.struct(window_start(ts, hours).alias("window_start"), col(ts).alias("window_end"))


# -- decision texts ---------------------------------------------------------------


def extract_priority(text: str | Column) -> Column:
    """First of P0..P3 that the text contains, else P2."""
    t = col(text)
    out = F.lit("P2")
    for p in ("P3", "P2", "P1", "P0"):
        out = F.when(t.contains(p), F.lit(p)).otherwise(out)
    return out


def extract_action(text: str | Column, limit: int = 128) -> Column:
    """Rest of the first line that starts with ``1)`` or ``1.``, else the head of the text."""
    t = col(text)
    marked = r"(?md)^[ \t]*1[).](.*)$"
    rest = F.substring(strip(F.regexp_extract(t, marked, 1)), 1, limit)
    return F.when(t.rlike(marked), rest).otherwise(strip(F.substring(t, 1, limit)))


def priority_from_keywords(text: str | Column) -> Column:
    """P1..P3 by the first list with a word in the upper-cased text, else P4."""
    upper = F.upper(col(text))
    out = F.lit("P4")
    for p, words in reversed(fv.PRIORITY_WORDS):
        out = F.when(upper.rlike("|".join(words)), F.lit(p)).otherwise(out)
    return out


def action_from_decision(text: str | Column) -> Column:
    t = col(text)
    out = F.lit(fv.ACTION_DEFAULT)
    for action, words in reversed(fv.ACTION_WORDS):
        hit = F.lit(False)
        for w in words:
            hit = hit | t.contains(w)
        out = F.when(hit, F.lit(action)).otherwise(out)
    return out


# -- effect sizes -----------------------------------------------------------------


def ate_delta(observed: str | Column, expected: str | Column) -> Column:
    return col(observed) - col(expected)


def ate_pct(observed: str | Column, expected: str | Column) -> Column:
    """Effect in percent of the expected value; the guard keeps the denominator above 0."""
    return ate_delta(observed, expected) / F.greatest(F.abs(col(expected)), F.lit(1e-9)) * 100


def confidence(z: str | Column, rule: tuple[float, float] = fv.CONFIDENCE_CAUSAL) -> Column:
    base, slope = rule
    return F.least(F.lit(fv.CONFIDENCE_CAP), F.lit(base) + F.abs(col(z)) * F.lit(slope))


def safe_z(x: str | Column, mean: Column, sd: Column, eps: float = 1e-9) -> Column:
    """(x - mean) / (sd + eps)."""
    return (col(x) - mean) / (sd + F.lit(eps))


# -- alert keys ----------------------------------------------------------------------


def dedup_key(anomaly_id: str | Column, metric: str | Column, prefix: str = "anomaly") -> Column:
    return F.concat_ws("-", F.lit(prefix), col(anomaly_id).cast("string"), col(metric))


def pager_level(sev: str | Column) -> Column:
    return lookup(sev, fv.PAGER_LEVELS, F.lit(fv.PAGER_LEVEL_DEFAULT))


# -- maps as JSON ------------------------------------------------------------------------


def merge_maps(base: str | Column, patch: str | Column) -> Column:
    """JSON-object merge: keys of ``patch`` win. Needs no session setting."""
    b, p = col(base), col(patch)
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    b, p = F.coalesce(b, empty), F.coalesce(p, empty)
    kept = F.map_filter(b, lambda k, v: ~F.array_contains(F.map_keys(p), k))
    return F.map_concat(kept, p)


def parse_map(json_text: str | Column) -> Column:
    return F.from_json(col(json_text), "map<string,string>")
