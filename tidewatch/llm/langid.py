"""Language identification by hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import fresh, pieces, texts, utf8

#: Length of the vectors. Unrelated vectors have a cosine of about 1 / sqrt(DIMENSIONS).
DIMENSIONS = 512
UNKNOWN = "und"
_PLANES = 0x20000
_BLANK = 0x20
_BITS = 21
_LETTERS_KEPT, _GRAMS_KEPT, _AT_ONCE = 20_000, 20_000, 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point of the first two planes, blank for other characters."""
    return np.array([_letter(code) for code in range(_PLANES)], dtype=np.int64)


def _letter(code: int) -> int:
    char = chr(code)
    return ord(char.lower()[0]) if char.isalpha() else _BLANK


def grams(text: str) -> np.ndarray:
    """Trigrams of a text's letters as numbers; each run of other characters, and either end, is one blank."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    low = _letters()[np.minimum(code, _PLANES - 1)]
    above = np.flatnonzero(code >= _PLANES)
    if len(above):
        known, place = np.unique(code[above], return_inverse=True)
        low[above] = np.array([_letter(int(c)) for c in known], dtype=np.int64)[place]
    low = np.concatenate([[_BLANK], low, [_BLANK]])
    low = low[np.concatenate([[True], (low[1:] != _BLANK) | (low[:-1] != _BLANK)])]
    if len(low) < 3:
        return np.zeros(0, dtype=np.int64)
    return low[:-2] << 2 * _BITS | low[1:-1] << _BITS | low[2:]


class Space:
    """Random vectors of +1 and -1 for letters, and of trigrams by binding: the elementwise product of the first letter's
    vector permuted twice, the second's permuted once, and the third's. All follow from the code points and `seed`."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 5):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.kept: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        found = self.letters.get(code)
        if found is None:
            if len(self.letters) > _LETTERS_KEPT:
                self.letters.clear()
            bits = np.random.Generator(np.random.PCG64([self.seed, code])).integers(0, 2, self.dimensions, dtype=np.int8)
            found = self.letters[code] = 2 * bits - 1
        return found

    def bound(self, gram: int) -> np.ndarray:
        found = self.kept.get(gram)
        if found is None:
            if len(self.kept) > _GRAMS_KEPT:
                self.kept.clear()
            mask = (1 << _BITS) - 1
            first, second, third = (self.letter(gram >> s & mask) for s in (2 * _BITS, _BITS, 0))
            found = self.kept[gram] = np.roll(first, 2) * np.roll(second, 1) * third
        return found

    def bundled(self, keys: np.ndarray, owners: np.ndarray, rows: int, weights: np.ndarray | None = None) -> np.ndarray:
        """Sums of the vectors of trigrams by owner, exact."""
        out = np.zeros((rows, self.dimensions))
        if not len(keys):
            return out
        known, place = np.unique(keys, return_inverse=True)
        for start in range(0, len(known), 8192):
            part = known[start : start + 8192]
            inside = (place >= start) & (place < start + len(part))
            counts = np.bincount(owners[inside] * len(part) + place[inside] - start, weights=None if weights is None else weights[inside], minlength=rows * len(part))
            out += counts.reshape(rows, len(part)).astype(np.float32 if weights is None else np.float64) @ np.stack([self.bound(int(g)) for g in part]).astype(np.float32 if weights is None else np.float64)
        return out

    def profiles(self, values: list[str]) -> np.ndarray:
        """Vectors of texts; a long text is bundled piece by piece."""
        out = np.zeros((len(values), self.dimensions))
        keys, owners, waiting = [], [], 0
        for i, text in enumerate(values):
            for start in range(0, max(len(text), 1), _AT_ONCE):
                found = grams(text[max(0, start - 2) : start + _AT_ONCE] if start else text[:_AT_ONCE])
                keys.append(found)
                owners.append(np.full(len(found), i))
                waiting += len(found)
                if waiting >= 200_000:
                    out += self.bundled(np.concatenate(keys), np.concatenate(owners), len(values))
                    keys, owners, waiting = [], [], 0
        if keys:
            out += self.bundled(np.concatenate(keys), np.concatenate(owners), len(values))
        return out


def _blocks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    for part in pieces(batch, text, 1 << 20):
        for start in range(0, part.num_rows, 64):
            yield part.slice(start, 64)


def fit(df: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = 5, most_mb: int = 64) -> dict[str, np.ndarray]:
    """Prototype of each non-null value of `lang`: the bundle of all trigrams of all its texts, as a vector of length 1.

    Trigrams are counted per language in the tasks and summed by Spark; their bound vectors are added up once per distinct
    trigram. Only the prototypes reach the driver: languages x dimensions numbers. More than `most_mb` of them, a sign of
    a wrong column, is an error. Languages without any letter have no prototype; no rows give none.
    """
    sent = df.filter(F.col(f"`{lang}`").isNotNull()).select(utf8(F.col(f"`{text}`")).alias("_text"), F.col(f"`{lang}`").cast("string").alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], int] = {}

        def out() -> pa.RecordBatch:
            keys = list(held)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(held.values()), pa.int64())], names=["lang", "gram", "n"])

        for whole in batches:
            for batch in pieces(whole, "_text", 4 << 20):
                by: dict[str, list[np.ndarray]] = {}
                for value, name in zip(texts(batch, "_text"), batch.column("lang").to_pylist(), strict=True):
                    by.setdefault(name, []).extend(grams(value[max(0, s - 2) if s else 0 : s + _AT_ONCE]) for s in range(0, max(len(value), 1), _AT_ONCE))
                for name, found in by.items():
                    for key, n in zip(*(x.tolist() for x in np.unique(np.concatenate(found), return_counts=True)), strict=True):
                        held[name, key] = held.get((name, key), 0) + n
                if len(held) > 300_000:
                    yield out()
                    held.clear()
        yield out()

    counts = sent.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(dimensions, seed), {}
        for batch in batches:
            names, keys, n = (np.array(c.to_pylist(), dtype=t) for c, t in zip(batch.columns, (object, np.int64, np.float64), strict=True))
            for name in set(names.tolist()):
                own = names == name
                sums[name] = sums.get(name, 0) + space.bundled(keys[own], np.zeros(own.sum(), dtype=np.int64), 1, n[own])[0]
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.astype(np.int64).tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    parts = counts.mapInArrow(bundle, "lang string, v array<long>")
    sums = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).limit(most_mb * 1_000_000 // (8 * dimensions) + 1).collect()
    if len(rows) * dimensions * 8 > most_mb * 1_000_000:
        raise ValueError(f"{len(rows)} languages or more: their prototypes would take over {most_mb} MB")
    found = {}
    for row in sorted(rows, key=lambda r: r.lang):
        v = np.array([x for _, x in row.v], dtype=float)
        if np.linalg.norm(v) > 0:
            found[row.lang] = v / np.linalg.norm(v)
    return found


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", lang_pred: str = "lang_pred", score: str = "score", dimensions: int = DIMENSIONS, seed: int = 5) -> DataFrame:
    """`df` with the language whose prototype is nearest to the whole text by cosine, and that cosine cut to 0 to 1.

    Texts that are null or have no letter, and all texts if there are no prototypes, get `und` and 0. Equal cosines go to
    the first language by name. Other columns pass through, whatever their names; existing columns of the two names are
    replaced. The text is sent to Python once.
    """
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] for n in names]) if names else np.zeros((0, dimensions))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (lang_pred, score)]
    passed = text in df.columns and text not in (lang_pred, score) and dict(df.dtypes)[text] == "string"
    body = text if passed else fresh("_text", df.columns)
    sent = df.select(*rest) if passed else df.select(*rest, F.col(f"`{text}`").cast("string").alias(body))
    schema = df.select(*rest, F.lit("").alias(lang_pred), F.lit(0.0).alias(score)).schema
    width = len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(dimensions, seed)
        for whole in batches:
            for batch in _blocks(whole, body):
                values = [x or "" for x in batch.column(body).to_pylist()]
                vectors = space.profiles(values)
                length = np.linalg.norm(vectors, axis=1)
                known = (length > 0) & (len(names) > 0)
                best, cosine = np.zeros(len(values), dtype=int), np.zeros(len(values))
                if known.any():
                    near = vectors[known] @ matrix.T / length[known, None]
                    best[known] = near.argmax(axis=1)
                    cosine[known] = np.clip(near.max(axis=1), 0.0, 1.0)
                said = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(said, pa.string()), pa.array(cosine)], names=[*batch.schema.names[:width], lang_pred, score])

    return sent.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """Whether a row is kept from training: crc32 of its id as text divides by `folds`. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % folds == 0
