"""Fill-in-the-middle forms and the audit of sources, against brute force and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import pytest

from tidewatch.llm import divergence, fim, queries

SCHEMA = "doc_id long, text string, lang string, source string, n long, frames string, _text string, term string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 1, "f", "t", "x") for i, t, lang, source in rows], SCHEMA)


# -- fill in the middle ----------------------------------------------------------------


def plain_fim(doc_id, text):
    """The contract in plain Python: (n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_texts() -> list:
    rnd = random.Random(3)
    made = ["".join(rnd.choice("ab é\n\t <PSM>x\U0001f600") for _ in range(rnd.choice([0, 1, 5, 30, 300]))) for _ in range(300)]
    made += [None, "", " ", "\x0b\x0c", "one", " one ", "a<P>b", "x" * 200_000, "word  nbsp " * 30_000, "ends in blanks \n\n", "\x00 zero"]
    return [(i, t, "en", "s") for i, t in enumerate(made)] + [(None, "no id here", "en", "s"), (5, "again five", "en", "s"), (5, "again five", "en", "s")]


@pytest.mark.parametrize("size", [1, 5, 64, 1 << 16])
def test_forms_equal_brute_force(spark, size):
    rows = [r for r in fim_texts() if size > 5 or len(r[1] or "") < 1000]
    got = fim.fill_in_middle(fim.draws(fim.frames(frame(spark, rows).repartition(3), frame=size))).collect()
    want = collections.Counter()
    for i, t, *_ in rows:
        n, form, p, m, out = plain_fim(i, t)
        want[i, n, form, p, m, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), out.encode()] += 1
    assert collections.Counter((*r[:7], b"".join(fim.read([bytes(x) for x in r.output]))) for r in got) == want
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_frames_are_seekable(spark):
    """Counts are cumulative, and a frame is read without those before it."""
    text = "word étude " * 5000
    row = fim.frames(frame(spark, [(1, text, "en", "s")]), frame=1000).first()
    assert row.n == 10_001
    part = row.frames[7]
    assert b"".join(fim.read([bytes(part.data)])) == text.encode()[7000:8000]
    assert part.chars == len(text.encode()[:8000].decode("utf-8", "ignore")) and row.frames[-1].units == row.n


def test_rates_and_empty_table(spark):
    rows = [(i, f"some words {i} here", "en", "s") for i in range(2000)]
    forms = collections.Counter(r.form for r in fim.draws(fim.frames(frame(spark, rows)), rate=100, spm=0).collect())
    assert forms == {"psm": 2000}
    mixed = collections.Counter(r.form for r in fim.draws(fim.frames(frame(spark, rows))).collect())
    assert abs(mixed["plain"] - 1000) < 150 and abs(mixed["spm"] - 800) < 150
    assert fim.fill_in_middle(fim.draws(fim.frames(frame(spark, [])))).collect() == []


# -- divergence ----------------------------------------------------------------------------


def plain_audit(rows, least=3, most=200) -> set:
    """The contract in plain Python, with every term of every pair."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        seen = collections.Counter(t for name, _, words in docs if name == lang for t in set(words))
        kept = sorted(t for t, c in seen.items() if c >= least)
        groups = sorted({s for name, s, _ in docs if name == lang})
        counts = {s: collections.Counter(t for name, own, words in docs if (name, own) == (lang, s) for t in words if seen[t] >= least) for s in groups}
        whole = sum(counts.values(), collections.Counter())

        def share(c, t, kept=kept):
            return 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def f(p, q):
            return (p - q) ** 2 // q

        def ranked(part, s, values):
            order = sorted(values, key=lambda x: (-x[1], x[0].encode()))
            return {(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(order, 1) if part == "pair" or rank <= most}

        for s in groups:
            out |= ranked("pair", s, [(o, sum(f(share(counts[s], t), share(counts[o], t)) for t in kept)) for o in groups if o != s])
            single = [(t, share(counts[s], t), share(whole, t)) for t in kept if counts[s][t]]
            out |= ranked("term", s, [(t, f(p, q)) for t, p, q in single if p > q])
    return out


def audit_rows(seed: int) -> list:
    rnd = random.Random(seed)
    words = [f"{rnd.choice(['Word', 'term', 'été', 'ß', '語'])}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.choice([0, 1, 20, 80]))) + rnd.choice(["", ", x_y 12", "!"]), rnd.choice(["en", "de", None, ""]), rnd.choice(["a", "b", "c", None])) for i in range(120)]
    return rows + [(1, None, "fr", "only"), (2, "lonely words", "it", "p"), (3, "12 34", "it", "q"), (4, "same same", "en", "a"), (4, "same same", "en", "a"), (5, "same", "en", "b")]


@pytest.mark.parametrize(("seed", "postings", "row"), [(1, 400_000, 128), (2, 20, 3), (3, 1, 1)])
def test_audit_equals_brute_force(spark, monkeypatch, seed, postings, row):
    """Small limits make many runs of many rows, so that the heap merges them."""
    monkeypatch.setattr(divergence, "POSTINGS", postings)
    monkeypatch.setattr(divergence, "ROW", row)
    rows = audit_rows(seed)
    got = divergence.audit(frame(spark, rows).repartition(4), shards=3)
    assert {tuple(r) for r in got.collect()} == plain_audit(rows)
    assert got.count() == len(plain_audit(rows))


def test_audit_limits_ranks_and_takes_empty_tables(spark):
    rows = audit_rows(4)
    assert {tuple(r) for r in divergence.audit(frame(spark, rows), most_terms=2, least_docs=1).collect()} == plain_audit(rows, 1, 2)
    assert divergence.audit(frame(spark, [])).collect() == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "Some wörds, ande-verylongtermwithoutend x".encode()
    assert [t for part in divergence.terms(text) for t in part] == [b"some", "wörds".encode(), b"ande", b"verylongtermwithoutend", b"x"]


def test_runs_are_sorted_and_merge_by_term():
    block = divergence.Block()
    for k, text in enumerate([b"b a c a", b"c d", b"a"]):
        block.add("en", f"s{k}", text)
    rows = list(block.runs(2))
    assert all(r[3] == sorted(r[3]) and all(zlib.crc32(t) % 2 == r[0] for t in r[3]) for r in rows)
    assert [tuple(r) for r in divergence._unpacked(divergence._packed(rows))] == rows
    twice = sorted(rows + rows, key=lambda r: (r[0], r[1], r[3][0]))
    assert {t: by for _, t, by in divergence.merged(iter(twice))} == {b"a": {"s0": 4, "s2": 2}, b"b": {"s0": 2}, b"c": {"s0": 2, "s1": 2}, b"d": {"s1": 2}}
    assert {t for _, t, _ in divergence.merged(iter(twice), 3)} == {b"a", b"c"}


def test_queries_read_whole_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    assert {tuple(r) for r in queries.op12_divergence(spark, sf).collect()} == plain_audit(rows)
    made = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) for r in queries.op13_fim(spark, sf).collect()}
    assert made == {i: (*(x := plain_fim(i, t))[:4], hashlib.sha256(x[4].encode()).hexdigest()) for i, t, *_ in rows}
