"""URL filtering by hashed host-suffix and path-prefix expressions, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import fresh

#: Hex digits of a digest that the join uses.
PREFIX = 8


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; then up to `?`, `#` or the end. Both empty if there is no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))
    whole = F.coalesce(rest, F.lit(""))
    address = F.substring_index(F.substring_index(whole, "?", 1), "#", 1)
    host = F.substring_index(address, "/", 1)
    return lower_ascii(host), F.substr(address, F.length(host) + 1, F.length(address))


def _folder(path: Column) -> Column:
    """A path up to its last slash, with it; the form under which rules and pages meet."""
    return F.substr(path, F.lit(1), F.length(path) - F.length(F.substring_index(path, "/", -1)))


def _expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rules_table(rules: DataFrame) -> DataFrame:
    """(rule, verdict, rule_host, rule_path, digest, prefix) of rules (host, path, verdict); of equal (host, path), block goes before allow."""
    host, path = lower_ascii(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit(""))
    one = rules.select(host.alias("rule_host"), path.alias("rule_path"), "verdict").groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    digest = _expression(F.col("rule_host"), _folder(F.col("rule_path")))
    # a rule reads host, then path: net with /es/ is `net/es/`
    return one.select(F.concat("rule_host", "rule_path").alias("rule"), "verdict", "rule_host", "rule_path", digest.alias("digest")).withColumn("prefix", F.substr("digest", F.lit(1), F.lit(PREFIX)))


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`df` with host, path, rule and verdict of the longest rule that fits each url; rule is null and the verdict `default` if none fits.

    A rule (host, path, verdict) fits its host and all subdomains, if the url's path starts with the rule's path. The
    longest rule wins, and of equally long ones the one with the longer host. A null url, or one without `://`, has empty
    host and path. Existing columns of the four names are replaced, others pass through; every row is kept.

    Each distinct url is expanded into its host suffixes times its path's folders; expressions meet rules on a short
    prefix of their digest, so a long list of rules joins by narrow keys, and the full digest and the rule's whole path
    decide. Distinct urls are judged once, so a url that holds a third of all rows costs one.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = split_url(F.col(f"`{url}`"))
    key, won = fresh("_url", df.columns), fresh("_best", df.columns)
    places = df.filter(F.col(f"`{url}`").isNotNull()).select(F.col(f"`{url}`").alias("_url")).distinct().select("_url", *(c.alias(n) for c, n in zip(split_url(F.col("_url")), ("_host", "_path"), strict=True)))
    labels = F.split("_host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.split(_folder(F.col("_path")), "/")
    folders = F.concat(F.array(F.lit("")), F.transform(F.filter(F.sequence(F.lit(0), F.size(steps) - 1), lambda i: i >= 1), lambda i: F.concat(F.array_join(F.slice(steps, 1, i), "/"), F.lit("/"))))
    hosts = places.select("_url", "_path", F.explode(F.array_distinct(suffixes)).alias("_suffix"))
    digests = hosts.select("_url", "_path", "_suffix", F.explode(F.array_distinct(folders)).alias("_start")).withColumn("_digest", _expression(F.col("_suffix"), F.col("_start"))).withColumn("_prefix", F.substr("_digest", F.lit(1), F.lit(PREFIX)))
    listed = rules_table(rules)
    met = digests.join(listed, digests["_prefix"] == listed["prefix"]).filter((F.col("_digest") == F.col("digest")) & F.col("_path").startswith(F.col("rule_path")) & (F.col("_suffix") == F.col("rule_host")))
    order = F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), F.col("rule"), F.col("verdict"))
    best = met.groupBy(F.col("_url").alias(key)).agg(F.max(order).alias(won))
    sent = df.select(*rest, host.alias("host"), path.alias("path"))
    return sent.join(best, F.col(f"`{url}`") == F.col(key), "left").select(*[F.col(f"`{c}`") for c in sent.columns], F.col(won)["rule"].alias("rule"), F.coalesce(F.col(won)["verdict"], F.lit(default)).alias("verdict"))
