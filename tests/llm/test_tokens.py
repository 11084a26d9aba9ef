"""Encoding, decoding, token files and packing: against the public libraries and by exact round trips."""

from __future__ import annotations

import hashlib
import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidewatch.llm import bpe, packing, queries, tokencount
from tidewatch.session import workspace

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, " ", "\n\n  x", "a" * 5000, "é" * 300, "日本語 テキスト", "😀👍🏽 mixed 123 ١٢٣", "<|endoftext|>", "\x1c\x85  　x", "it's I'll 'S", "don't" * 50, "ab " * 4000, "�́é", "ΑΣ ΣΑΣ İI ß ǅ"]
SCHEMA = "doc_id long, text string, ids string, place long, start long"


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate([*ODD, "same", "same"])], SCHEMA)


def test_transducer_equals_definition():
    machine, rnd = bpe.Transducer(bpe.read_ranks(RANKS), most=2000), random.Random(4)
    for _ in range(3000):
        word = bytes(rnd.choice(b"aabbcdet hein\xc3\xa9\x00 ") for _ in range(rnd.randrange(0, 70)))
        assert machine.encode(word, block=rnd.choice([4, 64, 1 << 16])) == machine.merged(word)


def test_transducer_on_a_small_vocabulary():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 257, b"aaa": 258, b"ba": 259, b"abab": 260}
    machine, rnd = bpe.Transducer(ranks), random.Random(5)
    for _ in range(2000):
        word = bytes(rnd.choice(b"aab") for _ in range(rnd.randrange(0, 30)))
        assert machine.encode(word) == machine.merged(word)


def test_encode_and_decode(spark, odd, reference):
    coded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    assert set(coded.columns) == {"doc_id", "ids", "place", "start"}
    for r in bpe.decode(coded, RANKS).collect():
        text = [*ODD, "same", "same"][r.doc_id] or ""
        assert r.ids == reference.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode() and r.decoded_text == text
    assert bpe.decode(bpe.encode(odd.limit(0), RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_utf8_stream_replaces_as_the_codec():
    rnd, machine = random.Random(6), bpe.Transducer(bpe.read_ranks(RANKS))
    for _ in range(2000):
        ids = [rnd.randrange(50256) for _ in range(rnd.randrange(30))]
        stream = bpe.Utf8Stream(machine.bytes, most=500)
        text = "".join(map(stream.push, ids)) + stream.end()
        assert text == b"".join(machine.bytes[i] for i in ids).decode("utf-8", "replace")


def test_query_digests(spark, sf, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op1_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_token_files_hold_ids_and_end_marks(spark, odd, reference):
    folder = workspace(spark, "flat")
    tokencount.write_flat(odd.repartition(3), folder, RANKS, public_tokenizers.PATTERN, 50256, docs_per_file=4)
    data = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).orderBy("path").collect())
    flat = np.frombuffer(data, dtype="<u2").tolist()
    docs, now = [], []
    for i in flat:
        if i == 50256:
            docs.append(now)
            now = []
        else:
            now.append(i)
    assert not now and sorted(docs) == sorted(reference.encode_ordinary(t or "") for t in [*ODD, "same", "same"])
    for block in (1, 3, 1 << 20):
        counts = tokencount.token_counts(tokencount.read_blocks(spark, folder, block_ids=block), 50256).collect()
        assert sorted(r.n_tokens for r in counts) == sorted(map(len, docs)) and all(r.ended for r in counts)


@pytest.mark.parametrize("width", [2, 4])
def test_token_counts_across_blocks(spark, width):
    rnd = random.Random(width)
    files = {f"f{n}": [rnd.choice([0, 0, 1, 2, 9]) for _ in range(n)] for n in (0, 1, 2, 5, 40, 41)} | {"none": [1] * 12, "ends": [9] * 7, "open": [9, 1, 1, 1]}
    rows = [(f, b, np.array(ids[s : s + 5], dtype=f"<u{width}").tobytes(), "x") for f, ids in files.items() for b, s in enumerate(range(0, len(ids), 5))]
    rows += [("f40", 99, None, "x"), ("empty", 0, b"", "x")]
    got = tokencount.token_counts(spark.createDataFrame(rows, "file string, block long, ids binary, docs string").repartition(4), 9, width).collect()
    wanted = []
    for f, ids in files.items():
        start, n = 0, 0
        for i, x in enumerate(ids):
            if x == 9:
                wanted.append((f, n, start, i - start, True))
                start, n = i + 1, n + 1
        if start < len(ids):
            wanted.append((f, n, start, len(ids) - start, False))
    assert sorted(map(tuple, got)) == sorted(wanted)


def test_id_beyond_the_width(spark):
    with pytest.raises(OverflowError):
        tokencount.write_flat(spark.createDataFrame([("a",)], "text string"), workspace(spark, uuid.uuid4().hex), RANKS, public_tokenizers.PATTERN, 1 << 16)


def test_query_counts_all_tokens(spark, sf, reference):
    wanted = sorted(len(reference.encode_ordinary(r.text or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = queries.op6_token_counts(spark, sf).collect()
    assert sorted(r.n_tokens for r in got) == wanted and all(r.ended for r in got)


@pytest.mark.parametrize("bits", [1, 2, 4])
def test_hilbert_curve_visits_all_cells_in_steps_of_one(bits):
    side = 1 << bits
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = packing.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(side**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def pieces_fit(rows: list, texts: list[tuple[int, str | None]], length: int) -> None:
    tokenizer = Tokenizer.from_file(WORDS)
    wanted = sorted((doc, [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]) for doc, text in texts)
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    assert sorted(by) == list(range(len(by)))
    line = []
    for s in sorted(by):
        own = sorted(by[s], key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.piece_length == len(r.piece_ids) // 4
            at += r.piece_length
        assert at == length or (s == max(by) and at <= length)
        line += own
    docs, now = [], []
    for r in line:
        assert r.piece_start == len(now)
        now += np.frombuffer(bytes(r.piece_ids), dtype="<u4").tolist()
        if len(now) == r.doc_tokens:
            docs.append((r.doc_id, now))
            now = []
    assert not now and sorted(docs) == wanted


def test_packing_odd_rows(spark, odd):
    texts = [(i, t) for i, t in enumerate([*ODD, "same", "same"])]
    pieces_fit(packing.pack(odd.repartition(3), WORDS, length=64).collect(), texts, 64)
    doubled = odd.filter("doc_id > 8").unionByName(odd.filter("doc_id > 8"))
    pieces_fit(packing.pack(doubled, WORDS, length=100).collect(), [t for t in texts if t[0] > 8] * 2, 100)
    assert packing.pack(odd.limit(0), WORDS).count() == 0
    none = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert {r.doc_tokens for r in packing.pack(none, WORDS).collect()} == {3, 1}


def test_packing_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs, WORDS).collect()
    pieces_fit(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    got = {(r.doc_id, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset) for r in queries.op7_packing(spark, sf).collect()}
    assert {(d, s, n, c) for d, s, n, c, _, _ in got} >= set() and len(got) == len(rows)
    assert sum(n for _, _, n, _, _, _ in got) == sum(r.piece_length for r in rows)


def test_neighbours_along_the_curve_share_a_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = sorted(packing.pack(docs, WORDS).filter("piece_start = 0").collect(), key=lambda r: (r.sequence_id, r.offset))
    same = sum(lang[a.doc_id] == lang[b.doc_id] for a, b in zip(rows, rows[1:], strict=False)) / (len(rows) - 1)
    share = [list(lang.values()).count(x) / len(lang) for x in set(lang.values())]
    assert same > sum(s * s for s in share) + 0.1


def test_checksum_is_of_four_byte_ids():
    assert zlib.crc32(np.array([5, 1], dtype="<u4").tobytes()) == zlib.crc32(b"\x05\0\0\0\x01\0\0\0")


SPECIAL = ["end <|endoftext|> start", "a<|endoftext|>, <|startoftext|>b.", "<|ENDOFTEXT|> <|EndOfText|>!", "<|endoftext|><|endoftext|>", "<|endoftext|", "é<|endoftext|>É.", "plain Text."]


def test_special_tokens_in_texts_as_by_a_plain_call(spark, tmp_path):
    """The reference has no switch: special tokens in a text are one id, in other case they are not."""
    plain = Tokenizer.from_file(WORDS)
    wanted = [plain.encode(t, add_special_tokens=False).ids for t in [*SPECIAL, *[t or "" for t in ODD]]]
    for _ in range(2):
        assert [x.tolist() for x in packing.encode_texts([*SPECIAL, *[t or "" for t in ODD]], WORDS, special=True)] == wanted
    assert wanted[0] == [806, 49407, 1572] and 49407 not in packing.encode_texts(SPECIAL[:1], WORDS, special=False)[0]
    spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in queries.op7_packing(spark, str(tmp_path)).collect()}
    assert got == {i: (len(w) + 1, zlib.crc32(np.array([*w, 1], dtype="<u4").tobytes())) for i, w in enumerate(wanted[: len(SPECIAL)])}


def drawn(rnd: random.Random, letters: str, n: int) -> list[str]:
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(80))) for _ in range(n)]


def test_latin_chunks_go_to_the_model_in_pieces(monkeypatch):
    """Marks, digits, contractions and accents in any mixture have the ids of a plain call, without the whole tokenizer; other scripts and composed letters still go to it."""
    plain, rnd, asked = Tokenizer.from_file(WORDS), random.Random(6), []
    lines = packing.Chunks._lines
    monkeypatch.setattr(packing.Chunks, "_lines", lambda self, forms, *more: asked.extend(forms) or lines(self, forms, *more))
    latin = [*drawn(rnd, "aAstTreEvmlLdé ÉßÿÞx019''.,;:!?-_<|>&% ", 1500), *drawn(rnd, "".join(map(chr, range(32, 127))), 500), "+1 (716) 555-8176, it's we've!'s 'S", "x" * 300 + "," + "y" * 300 + " ab" * 99]
    mixed = [*drawn(rnd, "aAstT'é ÉЖжΣσς\u0301\u0308日\u00a0’×÷K5.,\x1c", 1500), *SPECIAL, *[t or "" for t in ODD]]
    for special in (True, False):
        plain.encode_special_tokens = not special
        packing.forget()
        asked.clear()
        for texts, beyond in ((latin, False), (mixed, True)):
            wanted = [plain.encode(t, add_special_tokens=False).ids for t in texts]
            assert [x.tolist() for x in packing.encode_texts(texts, WORDS, special)] == wanted
            assert [packing.encode_texts([t], WORDS, special, kept=20)[0].tolist() for t in texts[:200]] == wanted[:200]
            assert bool(asked) == beyond
    packing.forget()


def test_marks_after_letters_that_end_in_a_combining_character():
    """Such letters are one piece with the marks behind them once they are lower-cased or composed anew."""
    plain = Tokenizer.from_file(WORDS)
    texts = [f"{before}{letter}{mark} {letter}" for letter in "İ\u0958\u09dc\ufb1d\ufb2aЖж日" for before in ("", "A", "ж") for mark in (",", ".!", "")]
    assert [x.tolist() for x in packing.encode_texts(texts, WORDS)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_query_has_the_workers_forget(spark, sf, monkeypatch):
    """Workers that go on to other jobs do not hold the query's remembered chunks."""
    pack, asked = packing.pack, {}
    monkeypatch.setattr(packing, "pack", lambda *tables, **how: asked.update(how) or pack(*tables, **how))
    rows = queries.op7_packing(spark, sf).collect()
    assert asked["lasting"] is False
    plain = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sum(r.length for r in rows) == sum(len(plain.encode(t, add_special_tokens=False).ids) + 1 for t in texts.values())
