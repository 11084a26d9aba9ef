"""Each stage of the corpus pipeline against a brute-force version on its own input."""

from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_documents import brute_components
from tidewatch.llm import packing, pii

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string"
PROSE = "the shop at the corner sells bread and milk to all who come in before noon on a cold winter day and stays shut later"
ROWS = [
    (1, PROSE, "en", "a", 5, "k"), (2, PROSE, "en", "a", 5, "k"), (3, PROSE + " today", None, None, None, "k"), (4, None, "en", "a", 0, "k"), (5, "", "en", "a", 0, "k"),
    (6, "123 456 !!", "de", "a", 1, "k"), (7, "der Hund und die Katze", "de", "b", 5, "k"), (8, "le", "fr", "b", 2, "k"), (9, "mail hein.19@mail5.example.com now", "en", "b", 3, "k"), (9, "mail hein.19@mail5.example.com now", "en", "b", 3, "k"),
    (None, "no id here", "en", "b", 3, "k"), (12, "日本", "ja", "b", 3, "k"),
]


def stages(spark, docs, sf_dir, folder):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        yield name, docs, (docs := spark.read.parquet(f"{folder}/{name}"))


def check(name, before, after):
    rows, got = before.collect(), after.collect()
    if name != "sequences":
        assert after.columns == corpus_pipeline.COLUMNS
    if name == "language":
        wanted = [r for r in rows if r.text and re.search(r"[^\W\d_]", r.text)]
        assert collections.Counter((r.doc_id, r.text, r.source, r.n_chars) for r in got) == collections.Counter((r.doc_id, r.text, r.source, r.n_chars) for r in wanted)
        given = {(r.doc_id, r.text): r.lang for r in rows}
        assert all(r.lang == (given[r.doc_id, r.text] or r.lang) and r.lang for r in got)
    elif name == "exact_copies":
        last: dict = {}
        for r in rows:
            last[r.text] = max([x for x in (last.get(r.text), r.doc_id) if x is not None], default=None)
        least = lambda r: tuple((r[c] is not None, r[c]) for c in ("lang", "source", "n_chars"))
        one: dict = {}
        for r in rows:
            if last[r.text] == r.doc_id:
                one[r.text or ""] = min(one.get(r.text or "", r), r, key=least)
        assert collections.Counter(map(tuple, got)) == collections.Counter(tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in one.values())
    elif name == "near_copies":
        found = brute_components([(r.doc_id, r.text) for r in rows if r.doc_id is not None], 5, 80)
        assert collections.Counter(map(tuple, got)) == collections.Counter(tuple(r) for r in rows if r.doc_id is None or found[r.doc_id][1] == r.doc_id)
    elif name == "personal_data":
        assert collections.Counter((r.doc_id, r.lang, r.source) for r in got) == collections.Counter((r.doc_id, r.lang, r.source) for r in rows)
        old = collections.defaultdict(list)
        for r in rows:
            old[r.doc_id].append(r.text)
        for r in got:
            assert all(not re.fullmatch(pii.EMAIL, m) or m not in r.text for m in re.findall(pii.EMAIL, old[r.doc_id][0] or ""))
            assert r.n_chars is None or r.n_chars == len(r.text)
            if not re.search(r"[@0-9]", old[r.doc_id][0] or ""):
                assert r.text == old[r.doc_id][0]
    else:
        tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
        ids = collections.defaultdict(list)
        for r in rows:
            ids[r.doc_id].append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1])
        assert sum(r.length for r in got) == sum(len(x) for own in ids.values() for x in own)
        for r in got:
            assert any(len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start : r.start + r.length], dtype="<u4").tobytes()) == r.ids_crc32 for x in ids[r.doc_id])
        assert max(collections.Counter([(r.sequence_id, r.offset) for r in got]).values(), default=1) == 1


def test_stages_on_odd_rows(spark, sf, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for name, before, after in stages(spark, docs, sf, str(tmp_path)):
        check(name, before, after)
    kept = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/near_copies").collect()}
    assert kept == {2, 7, 8, 9, None, 12}


def test_stages_on_a_table(spark, sf, tmp_path):
    for name, before, after in stages(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf, str(tmp_path)):
        assert after.count() > 0
        check(name, before, after)


def test_stages_on_an_empty_table(spark, sf, tmp_path):
    for _, _, after in stages(spark, spark.createDataFrame([], SCHEMA), sf, str(tmp_path)):
        assert after.count() == 0


def test_run_gives_the_last_stage(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {r.sequence_id for r in rows} == set(range(max(r.sequence_id for r in rows) + 1))


def test_stages_set_small_batches(spark):
    """Spark and Python hold several copies of a batch of whole texts in each task."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.createDataFrame([(1, "some words", "en", "s", 10)], "doc_id long, text string, lang string, source string, n_chars long")
    try:
        for stage in (corpus_pipeline.language, corpus_pipeline.exact_copies, corpus_pipeline.near_copies, corpus_pipeline.sequences):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
            stage(spark, docs, "")
            assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(corpus_pipeline.BATCH_ROWS)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_sequences_leave_no_chunks_in_the_workers(spark):
    """The chunks that are kept are bounded, forgotten after the ids are stored, and have no say in the result."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"word{i * 50 + k}x" for k in range(50)) for i in range(40)]
    packing.forget()
    small = [packing.encode_texts([t], path, kept=200)[0].tolist() for t in texts]
    held = packing._chunks(path, True, 200)
    assert len(held.young) <= 300 and len(held.old) <= 300
    assert small == [x.tolist() for x in packing.encode_texts(texts, path)]
    packing.forget()
    assert packing._chunks.cache_info().currsize == packing._tokenizer.cache_info().currsize == 0

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = lambda **how: sorted(map(tuple, packing.pack(df, path, **how).collect()))
    assert rows(kept=200, lasting=False) == rows()
