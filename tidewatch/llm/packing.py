"""Packing of documents into token sequences along a Hilbert curve."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import pieces, running_total, utf8
from tidewatch.session import stored

#: Dimensions of the curve, bits of each, features that ids are hashed to.
AXES, BITS, FEATURES = 3, 16, 1024
_MARKS = ".,;:!?"
#: Stands between chunks that are encoded together.
_MARK = "\u241e"
#: Chunks of text whose ids a Python worker keeps in each of two generations. Bounds memory, not results.
CHUNKS_KEPT = 600_000


@lru_cache(maxsize=4)
def _tokenizer(path: str, special: bool):
    """The tokenizer, and a pattern of the added tokens it finds in texts, in any case."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    added = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()] if special else []
    return tokenizer, re.compile("|".join(added), re.IGNORECASE) if added else None


#: All bytes but those that begin characters from U+0300 on, among which are those that letters may be composed with.
_SIMPLE = bytes(range(0xCC))
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
#: Chunks that may be cut into pieces here, and the pieces that the tokenizer would cut their lower case into.
_DIRECT = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Bytes of a chunk up to which it is remembered beyond its batch.
_LONGEST = 64


def _parts(chunk: str) -> tuple[str, ...]:
    """A chunk in the form in which it is remembered: ASCII in lower case, marks after a letter or digit apart; both give the same ids. A letter that the tokenizer's normal form ends with a combining character is joined with marks."""
    low = chunk.lower() if chunk.isascii() else chunk
    core = low.rstrip(_MARKS)
    if core == low or not core or not normalize("NFC", core[-1].lower())[-1].isalnum():
        return (low,)
    return core, low[len(core) :]


class _Known(dict):
    """Ids of chunks, as bytes. A new chunk is looked up in the last generation, or goes to the tokenizer's model in pieces; if neither can be, it waits and gives nothing until it is put in."""

    def __init__(self, model, letters: dict[int, str], kind: str, special, old: dict[bytes, bytes]):
        super().__init__()
        self.model, self.letters, self.kind, self.special, self.old = model, letters, kind, special, old
        self.waiting: dict[bytes, None] = {}
        self.long: list[bytes] = []
        self.missed = False

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self._direct(chunk) if self.letters and chunk not in self.waiting else None
            if ids is None:
                self.waiting[chunk] = None
                self.missed = True
                return b""
        self.put(chunk, ids)
        return ids

    def put(self, chunk: bytes, ids: bytes) -> None:
        self[chunk] = ids
        if len(chunk) > _LONGEST:
            self.long.append(chunk)

    def _direct(self, chunk: bytes) -> bytes | None:
        text = chunk.decode("utf-8", "replace")
        if not _PLAIN.fullmatch(text):
            if not _DIRECT.fullmatch(text) or self.special(chunk):
                return None
            text = text.lower()
            pieces = _PIECES.findall(text)
            if len(pieces) > 1:
                return b"".join([self[piece.encode()] for piece in pieces])
        if not text.isascii():
            letters = self.letters
            text = "".join([letters[b] for b in text.encode()])
        return array(self.kind, [t.id for t in self.model.tokenize(text)]).tobytes()


class Chunks:
    """Ids of chunks by one tokenizer, as bytes, 2 for each id if all of its ids fit, else 4. Chunks not met since the last but one change of generation are forgotten."""

    def __init__(self, path: str, special: bool, kept: int | None = None):
        self.kept = kept
        self.tokenizer, self.added = _tokenizer(path, special)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "H" if max(vocabulary.values(), default=0) < 1 << 16 else "I"
        tokens = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.hints = tuple({re.match(r"[^A-Za-z]*", t)[0].encode() for t in tokens})
        alone, apart = (self._alone([x])[0] for x in (_MARK, f"a {_MARK} a"))
        self.mark = np.frombuffer(alone, dtype=self.kind)
        self.joins = len(alone) > 0 and apart == self._alone(["a"])[0] + alone + self._alone(["a"])[0]
        self.letters: dict[int, str] = {}
        self.young = self._generation({})
        self.letters = self._byte_letters(vocabulary)
        self.young = self._generation({})

    @property
    def old(self) -> dict[bytes, bytes]:
        return self.young.old

    def _generation(self, old: dict[bytes, bytes], letters: dict[int, str] | None = None) -> _Known:
        added, hints = self.added, self.hints
        special = lambda chunk: any(h in chunk for h in hints) and added.search(chunk.decode("utf-8", "replace"))
        return _Known(self.tokenizer.model, self.letters if letters is None else letters, self.kind, special, old)

    def _alone(self, forms: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(forms, add_special_tokens=False)]

    def _byte_letters(self, vocabulary: dict[str, int]) -> dict[int, str]:
        """The letters by which a byte-level model writes bytes, if plain words and pieces then give the same ids as by the whole tokenizer; else none. Tried with words made of the vocabulary's own tokens, and with all marks between letters and digits."""
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in printed)}
        tokens = sorted({t for t in (x.removesuffix("</w>") for x in vocabulary) if re.fullmatch("[a-z]+", t)})[::40]
        tried = [a + b for a, b in zip(tokens, ["é", "ß", "", "ing", "àç", *tokens], strict=False)]
        marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
        tried += [x for m, n in zip(marks, [*marks[7:], *marks[:7]], strict=True) for x in (f"to{m}s", f"É{m}{n}1{n}", f"{m}Ve7{m}'s", f"{n}'{m}ll{m}{m}")]
        tried += [f"{a}'{b}{c}" for a in ("", "i", "1", "!", "ö'") for b in ("s", "t", "re", "ve", "m", "ll", "d", "S", "r", "l", "x", "é") for c in ("", "s", "'d", "2", ".")]
        known = self._generation({}, letters)
        try:
            return letters if [known[w.encode()] for w in tried] == self._alone(tried) else {}
        except Exception:
            return {}

    def _lines(self, forms: list[str], at_once: int = 256) -> list[bytes]:
        """Ids of forms. Many go to the tokenizer as one line with a mark of known ids between them, unless one holds the mark or a special token."""
        plain = [f for f in forms if _MARK not in f and (self.added is None or not self.added.search(f))] if self.joins else []
        lines = [plain[k : k + at_once] for k in range(0, len(plain), at_once)]
        width = self.mark.itemsize
        found: dict[str, bytes] = {}
        for start in range(0, len(lines), 64):
            part = lines[start : start + 64]
            for line, coded in zip(part, self.tokenizer.encode_batch_fast([f" {_MARK} ".join(x) for x in part], add_special_tokens=False), strict=True):
                ids, n = np.array(coded.ids, dtype=self.kind), len(self.mark)
                hit = np.ones(max(len(ids) - n + 1, 0), dtype=bool)
                for k in range(n):
                    hit &= ids[k : k + len(hit)] == self.mark[k]
                at = np.flatnonzero(hit).tolist()
                if len(at) == len(line) - 1:
                    raw = ids.tobytes()
                    found.update((f, raw[width * low : width * high]) for f, low, high in zip(line, [0, *[a + n for a in at]], [*at, len(ids)], strict=True))
        rest = [f for f in forms if f not in found]
        for start in range(0, len(rest), 20_000):
            found.update(zip(rest[start : start + 20_000], self._alone(rest[start : start + 20_000]), strict=True))
        return [found[f] for f in forms]

    def split(self, text: bytes) -> list[bytes]:
        """The chunks of a text. A-Z become lower case where that leaves the ids of a tokenizer that lower-cases as they are: not in texts with special tokens or with characters that letters may be composed with."""
        if any(h in text for h in self.hints) and self.added.search(text.decode("utf-8", "replace")):
            return text.split()
        return (text if text.translate(None, _SIMPLE) else text.lower()).split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts. Those with chunks that had to wait are put together once more when all are known."""
        if len(self.young) >= (CHUNKS_KEPT if self.kept is None else self.kept):
            last, last.old = self.young, {}
            self.young = self._generation(last)
        young, get, split = self.young, self.young.__getitem__, self.split
        found: list[bytes] = []
        later: list[tuple[int, list[bytes]]] = []
        for text in texts:
            parts = split(text)
            young.missed = False
            ids = b"".join(map(get, parts))
            if young.missed:
                later.append((len(found), parts))
                if len(young.waiting) >= 20_000:
                    self._settle()
            found.append(ids)
        self._settle()
        for at, parts in later:
            found[at] = b"".join(map(get, parts))
        for chunk in young.long:
            young.pop(chunk, None)
        young.long.clear()
        return found

    def _settle(self) -> None:
        """Has the chunks that wait encoded by their reduced forms; forms that are not known go to the tokenizer together."""
        young = self.young
        slow: dict[bytes, tuple[str, ...]] = {}
        new: dict[str, bytes | None] = {}
        for chunk in young.waiting:
            text = chunk.decode("utf-8", "replace")
            slow[chunk] = parts = (text,) if self.added is not None and self.added.search(text) else _parts(text)
            for form in parts:
                if form not in new:
                    raw = form.encode()
                    new[form] = None if raw == chunk else young.get(raw) or young.old.get(raw)
        young.waiting.clear()
        unknown = [form for form, known in new.items() if known is None]
        coded = dict(zip(unknown, self._lines(unknown), strict=True))
        new.update(coded)
        for form, ids in coded.items():
            young.put(form.encode(), ids)
        for chunk, parts in slow.items():
            young.put(chunk, new[parts[0]] if len(parts) == 1 else b"".join([new[form] for form in parts]))


@lru_cache(maxsize=2)
def _chunks(path: str, special: bool, kept: int | None = None) -> Chunks:
    return Chunks(path, special, kept)


def forget() -> None:
    """Lets go of this Python worker's tokenizers and remembered chunks, and of what Arrow holds back for later. They come again when needed."""
    _chunks.cache_clear()
    _tokenizer.cache_clear()
    pa.default_memory_pool().release_unused()


def encode_texts(values: list[str | bytes], path: str, special: bool = True, kept: int | None = None) -> list[np.ndarray]:
    """Ids of texts, given as such or in UTF-8, by a tokenizer that lower-cases, and for which white space only separates: chunks between blanks are encoded once and remembered.

    With `special`, special tokens written out in a text are their one id; chunks that hold one, in any case, are encoded
    as they stand. Malformed bytes count as U+FFFD. `kept` stands for CHUNKS_KEPT.
    """
    chunks = _chunks(path, special, kept)
    found = chunks.encode([text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text for text in values])
    return [np.frombuffer(raw, dtype=chunks.kind).astype(np.int64) for raw in found]


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates below 2^bits, by turning each level's cell as the curve turns."""
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(axes):
            upper = (x[i] & bit) != 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[i] >> level & 1)
    return key


class Projection:
    """Few coordinates of a document: its ids, hashed with a sign to FEATURES counts, times a random matrix, per token."""

    def __init__(self, seed: int = 3):
        random = np.random.Generator(np.random.PCG64(seed))
        self.matrix = random.standard_normal((FEATURES, AXES))
        self.odd = np.uint64(random.integers(1 << 62) * 2 + 1)
        self.slots = self._slots(np.arange(1 << 16))

    def _slots(self, ids: np.ndarray) -> np.ndarray:
        """Twice the feature of each id, one more where its sign is negative."""
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * self.odd
        mixed ^= mixed >> np.uint64(32)
        return (mixed % np.uint64(FEATURES) * np.uint64(2) + (mixed >> np.uint64(20) & np.uint64(1))).astype(np.int64)

    def point(self, ids: np.ndarray) -> np.ndarray:
        if not len(ids):
            return np.zeros(AXES, dtype=np.int64)
        signed = np.bincount(self.slots[ids] if ids.dtype == np.uint16 else self._slots(ids), minlength=2 * FEATURES)
        mean = (signed[::2] - signed[1::2]).astype(float) @ self.matrix / len(ids)
        return np.clip((0.5 + 0.5 * np.tanh(4 * mean)) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def pack(df: DataFrame, path: str, length: int = 2048, end: int = 1, text: str = "text", doc_id: str = "doc_id", special: bool = True, kept: int | None = None, lasting: bool = True) -> DataFrame:
    """Pieces (doc_id, piece_start, piece_length, piece_ids, doc_tokens, sequence_id, offset) of sequences of `length` tokens.

    A document is its ids by the tokenizers file `path` and then the id `end`; null and empty texts are that id alone.
    Special tokens written out in a text are their one id, as in a plain call of the tokenizer; without `special` they are plain text.
    Documents are laid one after another along a Hilbert curve through their projected vectors, so neighbours in a sequence
    resemble each other, and the line is cut every `length` tokens: only the last sequence may be short. piece_ids are
    little-endian unsigned numbers of 32 bits. Rows are kept apart even if they share a doc_id; a null doc_id stays null;
    equal places on the curve are ordered by hash. An empty table gives no pieces. Only the two named columns are read.

    A Python worker remembers the ids of `kept` chunks (CHUNKS_KEPT, if None) in each of two generations. Workers are used
    again by other jobs; without `lasting` they forget all as soon as the ids are stored. Neither changes the result.

    Ids are computed once and stored, 2 bytes each where they fit. Places come from a running total over the range-sorted
    (place, tokens) rows, without the ids, which are then joined to them: one shuffle of the ids.
    """
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), utf8(F.col(f"`{text}`")).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection, chunks = Projection(), _chunks(path, special, kept)
        for whole in batches:
            for batch in pieces(whole, "_text", 4 << 20):
                found = [np.frombuffer(raw, dtype=chunks.kind) for raw in chunks.encode(batch.column("_text").to_pylist())]
                places = hilbert(np.array([projection.point(ids) for ids in found]).reshape(len(found), AXES))
                wide = [end >= 1 << 16 or ids.itemsize > 2 and len(ids) > 0 and ids.max() >= 1 << 16 for ids in found]
                raw = [np.append(ids, np.array(end, dtype=kind)).astype(kind, copy=False).tobytes() for ids, kind in zip(found, ["<u4" if w else "<u2" for w in wide], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(places), pa.array([len(x) + 1 for x in found], pa.int64()), pa.array([4 if w else 2 for w in wide], pa.int32()), pa.array(raw, pa.binary())], names=["doc_id", "place", "tokens", "width", "raw"])

    coded = docs.mapInArrow(encode, "doc_id long, place long, tokens long, width int, raw binary").withColumn("row", F.monotonically_increasing_id())
    coded = stored(coded, "packing-ids")
    line = coded.select("row", "place", "tokens", F.xxhash64("doc_id", "row").alias("tie"))
    at = running_total(line, ["place", "tie", "row"], "tokens", "at", "packing-line").select("row", "at")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "piece_start", "piece_length", "piece_ids", "doc_tokens", "sequence_id", "offset"]
        if not lasting:
            forget()
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc, tokens, width, raw, at in zip(*(batch.column(c) for c in ("doc_id", "tokens", "width", "raw", "at")), strict=True):
                ids, place, total = np.frombuffer(raw.as_buffer(), dtype=f"<u{width.as_py()}"), at.as_py(), tokens.as_py()
                start = 0
                while start < total:
                    take = min(total - start, length - (place + start) % length)
                    rows.append((doc.as_py(), start, take, ids[start : start + take].astype("<u4").tobytes(), total, (place + start) // length, (place + start) % length))
                    start, held = start + take, held + 4 * take
                    if held > 8 << 20:
                        yield _table(rows, names)
                        rows, held = [], 0
            yield _table(rows, names)

    return coded.select("doc_id", "tokens", "width", "raw", "row").join(at, "row").mapInArrow(cut, T.StructType.fromDDL("doc_id long, piece_start long, piece_length long, piece_ids binary, doc_tokens long, sequence_id long, offset long"))


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


