"""The registered queries of the corpus operators, with their production parameters, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, dedup, divergence, fim, jaccard, langid, minhash, packing, pii, shards, tokencount, topk, urls
from tidewatch.session import prepare, stored, workspace

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
PSEUDONYM_KEY = "corpus-release-1"
END_OF_DOCUMENT = 50256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of the whole mixture; counts differ by at most one."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    dealt = shards.interleave(docs, "source", ["doc_id", "text_crc32", "size"], 16)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of each fiftieth vector with all others."""
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter("id % 50 = 0"), 5)


OP3_SQL = """
WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.id AS query_id, c.id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.id % 50 = 0 AND q.id <> c.id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from four fifths of the documents."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    prototypes = langid.fit(docs.filter(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), prototypes).select("doc_id", "held_out", "lang_pred", "score")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles have a Jaccard similarity of 0.9 or more."""
    return jaccard.near_components(table(spark, sf_dir, "documents"), 3, 90)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document of flat files written from all documents, found by scanning for the end id."""
    folder = workspace(prepare(spark), "token-files")
    tokencount.write_flat(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, END_OF_DOCUMENT)
    counts = tokencount.token_counts(tokencount.read_blocks(spark, folder), END_OF_DOCUMENT)
    name = lambda g: F.regexp_extract("file", r"part-(\d+)-.*?-c(\d+)", g).cast("int")
    return counts.select(name(1).alias("part"), name(2).alias("piece"), "doc_no", "start", "n_tokens", "ended")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids along a Hilbert curve."""
    found = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), lasting=False)
    return found.select("doc_id", F.col("piece_start").alias("start"), F.col("piece_length").alias("length"), F.crc32("piece_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by pseudonyms, and their number."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY, count="n_pseudonyms").select("doc_id", "text", "n_pseudonyms")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = """
WITH u AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
a AS (SELECT page_id, split_part(split_part(rest, '?', 1), '#', 1) AS address FROM u),
p AS (SELECT page_id, split_part(address, '/', 1) AS raw, substr(address, length(split_part(address, '/', 1)) + 1) AS path FROM a),
h AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p),
r(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
b AS (SELECT h.*, r.rule_host || r.rule_path AS rule, r.verdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST, length(rule_host) DESC) AS n
      FROM h LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM b WHERE n = 1
"""


def op10_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest doc_id stays."""
    return dedup.find_copies(table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.text) AS text_sha256 FROM d JOIN g ON d.text = g.text
"""


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of five-word shingles have a Jaccard similarity of 0.85 or more, found by b-bit MinHash."""
    return minhash.near_copies(table(spark, sf_dir, "documents"), 5, 85)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ, and the terms that set each apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS count, 1 + CAST(1000000000 * (coalesce(c.n, 0) + 1) AS HUGEINT) // CAST(g.n + v.v AS HUGEINT) AS p
      FROM g JOIN v USING (lang) JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT lang, term, 1 + CAST(1000000000 * (t + 1) AS HUGEINT) // CAST(sum(t) OVER (PARTITION BY lang) + v AS HUGEINT) AS q FROM (SELECT lang, term, sum(n) AS t FROM c GROUP BY lang, term) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p JOIN l USING (lang, term) WHERE count > 0 AND p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
      UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-the-middle form, from its stored frames."""
    framed = stored(fim.frames(table(spark, sf_dir, "documents")), "fim-frames")
    return fim.fill_in_middle(fim.draws(framed), output=False)


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units, list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS r FROM d),
n AS (SELECT *, len(units) AS n, least(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS a, greatest(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS b FROM u),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 50 THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
      array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM n)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM f
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, one after another."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_shards, op3_topk, op4_language, op5_jaccard, op6_token_counts, op7_packing, op8_pii, op9_urls, op10_copies, op11_minhash, op12_divergence, op13_fim, pipeline)
}
ORACLES: dict[str, str] = {"op3_topk": OP3_SQL, "op9_urls": OP9_SQL, "op10_copies": OP10_SQL, "op12_divergence": OP12_SQL, "op13_fim": OP13_SQL}
