"""The corpus pipeline: language, exact copies, near copies, personal data, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import dedup, jaccard, langid, packing, pii
from tidewatch.session import prepare, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PSEUDONYM_KEY = "corpus-release-1"
#: Rows of an Arrow batch. Spark and Python hold a batch of whole texts several times over, in each task at once.
BATCH_ROWS = 1000
#: Chunks of text whose ids a Python worker keeps in each of two generations, some 40 MB each. Other stages run in the same workers.
CHUNKS_KEPT = 150_000


def small_batches(spark: SparkSession) -> None:
    """Sets the session's batch size for the stages with Python; it bounds memory, not results."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter. Those without, and null texts, have no language and go. `lang` becomes the predicted one where it is null."""
    small_batches(spark)
    prototypes = langid.fit(docs.filter(~langid.held_out()))
    said = langid.predict(docs.select(*COLUMNS), prototypes, lang_pred="_lang", score="_score")
    known = F.col("_lang") != langid.UNKNOWN if prototypes else F.col("text").rlike(r"\p{L}")
    return said.filter(known).select(*[F.coalesce("lang", F.when(F.col("_lang") != langid.UNKNOWN, F.col("_lang"))).alias("lang") if c == "lang" else F.col(c) for c in COLUMNS])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id. Of rows that repeat doc_id and text, the one with the smallest other columns."""
    small_batches(spark)
    kept = dedup.find_copies(docs).filter("kept").groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(F.count("*").alias("_n"))
    kept = stored(kept, "pipeline-kept")
    body = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (body == F.col("_sha"))
    single = docs.select(*COLUMNS).join(kept.filter("_n = 1"), same, "left_semi")
    repeated = kept.filter("_n > 1")
    if repeated.isEmpty():
        return single
    one = docs.select(*COLUMNS).join(repeated, same).groupBy("_id", "_sha").agg(F.min(F.struct("lang", "source", "n_chars", "doc_id", "text")).alias("_row"))
    return single.unionByName(one.select(*[F.col(f"_row.{c}").alias(c) for c in COLUMNS]))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest doc_id. Five-word shingles, similarity 0.8 or more."""
    small_batches(spark)
    found = jaccard.near_components(docs, 5, 80)
    gone = found.filter("component_id < doc_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data; a pseudonym is as long as what it replaces, but for IPv4 addresses, so n_chars is counted anew."""
    changed = pii.pseudonymise(docs.select(*COLUMNS), PSEUDONYM_KEY)
    return changed.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 2048 along a Hilbert curve."""
    small_batches(spark)
    found = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), kept=CHUNKS_KEPT, lasting=False)
    return found.select("doc_id", F.col("piece_start").alias("start"), F.col("piece_length").alias("length"), F.crc32("piece_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("personal_data", personal_data), ("sequences", sequences)]

#: The stages 1, 3, 4 and 5 are beyond SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of `sf_dir`, each one's rows written to the shared folder."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
