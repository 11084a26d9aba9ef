"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by an incremental UTF-8 machine."""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import fresh, lists, pieces, texts, utf8


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


_LOW = 0xFFFFFFFF


def _guess(node: int, before: int) -> int:
    """An open guess in one number: place in the trie, token before it (-1: none)."""
    return node << 32 | before + 1


class Transducer:
    """Byte-level BPE by ranks as a finite-state transducer, determinised while texts are read.

    A sequence of tokens is what BPE gives if and only if each two neighbours stay apart when BPE is applied to
    the two alone. So an undetermined machine can guess where a token starts, read it along a trie of the
    vocabulary and check it against the token before; of the guesses that end at a byte exactly one survives, and
    its token is the last one of the input so far. A state of the determinised machine is the set of guesses still
    open, each a place in the trie and the token before. A transition yields that last token; tokens become final, and are
    emitted, once all open guesses lead back to them, at the latest when no token reaches back so far.
    Transitions are computed when first met and kept; beyond `most` of them the machine starts anew, which changes
    its speed and not its result.
    """

    def __init__(self, ranks: dict[bytes, int], most: int = 600_000):
        self.ranks, self.most = ranks, most
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.ends_at, self.depth = [-1], [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                after = self.children[node].get(byte)
                if after is None:
                    after = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.ends_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = after
            self.ends_at[node] = rank
        self.edges: dict = {}
        self._reset()

    def _reset(self) -> None:
        self.apart: dict[int, bool] = {}
        self.states: dict[tuple[int, ...], int] = {}
        self.live: list[tuple[int, ...]] = []
        self.moves: dict[int, tuple[int, int]] = {}
        self.start = self._state((_guess(0, -1),))

    def _state(self, live: tuple[int, ...]) -> int:
        state = self.states.get(live)
        if state is None:
            state = self.states[live] = len(self.live)
            self.live.append(live)
        return state

    def merged(self, word: bytes) -> list[int]:
        """BPE by its definition: join the adjacent pair of lowest rank until no pair has one. For short inputs."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _edges(self, token: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]] | None:
        """The parts that begin and that end a token while BPE builds it, smallest first, each with its rank; None if BPE never builds it."""
        found = self.edges.get(token, 0)
        if found == 0:
            word = self.bytes[token]
            starts, ends = [(word[:1], -1)], [(word[-1:], -1)]
            parts = [word[i : i + 1] for i in range(len(word))]
            while len(parts) > 1:
                rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
                if rank == 1 << 60:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                if i == 0:
                    starts.append((parts[0], rank))
                if i == len(parts) - 1:
                    ends.append((parts[-1], rank))
            found = self.edges[token] = (starts, ends) if len(parts) == 1 else None
        return found

    def _allowed(self, before: int, token: int) -> bool:
        """Whether BPE keeps the two tokens apart. Only parts beside their border can join across it, so it is enough to
        replay how both grow there; of equal ranks the leftmost pair joins first."""
        right = self._edges(token)
        if before < 0 or right is None:
            return right is not None
        pair = before << 32 | token
        found = self.apart.get(pair)
        if found is None:
            ends, starts = self._edges(before)[1], right[0]
            i = j = 0
            never, found = 1 << 60, True
            while True:
                grows_left = ends[i + 1][1] if i + 1 < len(ends) else never
                grows_right = starts[j + 1][1] if j + 1 < len(starts) else never
                joins = self.ranks.get(ends[i][0] + starts[j][0])
                if joins is not None and joins < grows_left and joins <= grows_right:
                    found = False
                    break
                if grows_left == grows_right == never:
                    break
                if grows_left <= grows_right:
                    i += 1
                else:
                    j += 1
            self.apart[pair] = found
        return found

    def _extend(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state by a byte: (next state, last token of the input so far); states are numbers shifted by a byte."""
        live, last = [], -1
        for guess in self.live[state >> 8]:
            before = (guess & _LOW) - 1
            after = self.children[guess >> 32].get(byte)
            if after is not None:
                if last < 0 and self.ends_at[after] >= 0 and self._allowed(before, self.ends_at[after]):
                    last = self.ends_at[after]
                if self.children[after]:
                    live.append(_guess(after, before))
        if last < 0:
            raise ValueError(f"no token for byte {byte}: the vocabulary must hold every single byte")
        live.append(_guess(0, last))
        found = self.moves[state | byte] = (self._state(tuple(live)) << 8, last)
        return found

    def _final(self, lasts: list[int], live: tuple[int, ...]) -> int:
        """Bytes of the input that all open guesses cut alike."""
        at = {len(lasts) - self.depth[guess >> 32] for guess in live}
        while len(at) > 1:
            furthest = max(at)
            at.remove(furthest)
            at.add(furthest - self.size[lasts[furthest - 1]])
        return at.pop()

    def _cut(self, lasts: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(lasts[end - 1])
            end -= self.size[out[-1]]
        out.reverse()
        return out

    def encode(self, word: bytes, block: int = 1 << 16) -> list[int]:
        """Ids of one stretch of bytes, in time linear in its length and memory for about a block of it."""
        if len(self.moves) > self.most or len(self.apart) > self.most:
            self._reset()
        out: list[int] = []
        lasts: list[int] = []
        state, moves, add = self.start << 8, self.moves, lasts.append
        for start in range(0, len(word), block):
            for byte in word[start : start + block]:
                try:
                    state, last = moves[state | byte]
                except KeyError:
                    state, last = self._extend(state, byte)
                add(last)
            if start + block < len(word):
                final = self._final(lasts, self.live[state >> 8])
                out += self._cut(lasts, final)
                del lasts[:final]
        return out + self._cut(lasts, len(lasts))


class Utf8Stream:
    """Text from ids, piece by piece: a token's bytes join what is left of an unfinished character.

    A transition is (unfinished bytes, id) -> (finished text, unfinished bytes), computed when first met and kept.
    Malformed bytes become U+FFFD, as the codec's replacement rule has it.
    """

    def __init__(self, table: dict[int, bytes], most: int = 50_000):
        self.table, self.most, self.moves, self.rest = table, most, {}, b""
        self.whole: dict[int, str] = {}
        for token, data in table.items():
            try:
                self.whole[token] = data.decode("utf-8")
            except UnicodeDecodeError:
                pass

    @staticmethod
    def unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character and may still become one."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                need = 4 if 0xF0 <= byte <= 0xF4 else 3 if 0xE0 <= byte <= 0xEF else 2 if 0xC2 <= byte <= 0xDF else 1
                if need <= back:
                    return 0
                second = data[-back + 1] if back > 1 else None
                low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(byte, (0x80, 0xBF))
                return back if second is None or low <= second <= high else 0
        return 0

    def push(self, token: int) -> str:
        move = self.moves.get((self.rest, token))
        if move is None:
            if len(self.moves) > self.most:
                self.moves.clear()
            data = self.rest + self.table[token]
            cut = len(data) - self.unfinished(data)
            move = self.moves[self.rest, token] = (data[:cut].decode("utf-8", "replace"), data[cut:])
        text, self.rest = move
        return text

    def feed(self, tokens: list[int]) -> str:
        """The text of many ids. Where no character is unfinished, tokens of whole characters are taken as they are."""
        whole = self.whole
        parts = [whole.get(t) for t in tokens]
        if self.rest or None in parts:
            for i, part in enumerate(parts):
                if self.rest or part is None:
                    parts[i] = self.push(tokens[i])
        return "".join(parts)

    def end(self) -> str:
        text, self.rest = self.rest.decode("utf-8", "replace"), b""
        return text


def splitter(pattern: str) -> regex.Pattern:
    """The pattern with white space read as Unicode's property, as the public tokenizers do."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


# The patterns in which no match runs from other characters into white space, so that a text may be cut
# where white space begins; and Unicode's white space.
CUT_AT_BLANKS = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",)
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MARKS = set("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
_CHUNK = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")

#: Words, and chunks, that a Python worker keeps in each of two generations; longer ones are not kept; ids that are handed on at once. They bound memory, not results.
WORDS_KEPT, KEPT, LONGEST, AT_ONCE = 350_000, 200_000, 64, 1 << 18


class Remembered:
    """The ids of texts met lately. What was not asked for since the last but one change of generation is forgotten."""

    def __init__(self, compute: Callable[[str], bytes], most: int):
        self.compute, self.most, self.young, self.old = compute, most, {}, {}

    def miss(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            ids = self.compute(text)
        if len(text) <= LONGEST:
            if len(self.young) >= self.most:
                self.young, self.old = {}, self.young
            self.young[text] = ids
        return ids

    def one(self, text: str) -> bytes:
        ids = self.young.get(text)
        return self.miss(text) if ids is None else ids

    def all(self, texts_: list[str]) -> list[bytes]:
        get = self.young.get
        found = [get(t) for t in texts_]
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self.one(texts_[i])
        return found


class Encoder:
    """Ids of texts, each match of the pattern separately, as little-endian numbers of 32 bits."""

    def __init__(self, path: str, pattern: str):
        self.machine, self.split = Transducer(read_ranks(path)), splitter(pattern)
        self.words = Remembered(lambda word: array("i", self.machine.encode(word.encode("utf-8", "surrogatepass"))).tobytes(), WORDS_KEPT)
        self.chunks = Remembered(self._chunk, KEPT)
        self.cut = pattern in CUT_AT_BLANKS

    def _chunk(self, chunk: str) -> bytes:
        """Ids of white space and what follows up to the next. Letters after a blank are one match, and so is a mark behind them."""
        core, mark = (chunk[:-1], chunk[-1]) if chunk[-1] in _MARKS else (chunk, "")
        if core[core[:1] == " " :].isalpha():
            return self.words.one(core) + (self.words.one(mark) if mark else b"")
        return b"".join(self.words.all(self.split.findall(chunk)))

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids of a text, some at a time."""
        kept, find = (self.chunks, _CHUNK) if self.cut else (self.words, self.split)
        if len(text) <= AT_ONCE:
            yield b"".join(kept.all(find.findall(text)))
            return
        waiting: list[str] = []
        size = 0
        for match in find.finditer(text):
            waiting.append(match.group())
            size += len(waiting[-1])
            if size >= AT_ONCE:
                yield b"".join(kept.all(waiting))
                waiting, size = [], 0
        yield b"".join(kept.all(waiting))


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(maxsize=2)
def _table(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


def encode_texts(values: list[str], path: str, pattern: str) -> tuple[np.ndarray, list[int]]:
    """(flat ids, ids per text)."""
    encoder = _encoder(path, pattern)
    found = [b"".join(encoder.stream(text)) for text in values]
    return np.frombuffer(b"".join(found), dtype="<i4"), [len(x) // 4 for x in found]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the column `text` replaced by its token ids (array of int).

    Each match of `pattern` is encoded separately by the ranks in the file `path`; text between matches, if the
    pattern leaves any, gives no ids. Null and empty texts give an empty array; malformed bytes count as U+FFFD.
    Other columns pass through, whatever their names; an existing column `ids` is replaced.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (text, ids)]
    sent_text = fresh("_text", df.columns)
    sent = df.select(*rest, utf8(F.col(f"`{text}`")).alias(sent_text))
    schema = df.select(*rest, F.array().cast("array<int>").alias(ids)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, sent_text):
                flat, lengths = encode_texts(texts(batch, sent_text), path, pattern)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists(flat, lengths, pa.int32())], names=[*batch.schema.names[:-1], ids])

    return sent.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", data: str = "decoded", text: str = "decoded_text") -> DataFrame:
    """`df` with the bytes that the ids stand for and their text, read as a stream of UTF-8.

    Null ids and an empty array give empty results; an id that the vocabulary lacks raises KeyError. In the text,
    malformed bytes become U+FFFD; the bytes are exact. Other columns pass through.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (data, text)]
    sent = df.select(*rest)
    at = sent.columns.index(ids)
    schema = sent.select("*", F.lit(b"").alias(data), F.lit("").alias(text)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(path)
        stream = Utf8Stream(table)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                raw, read = [], []
                for row in part.column(at).to_pylist():
                    row = row or []
                    read.append(stream.feed(row) + stream.end())
                    raw.append(b"".join([table[i] for i in row]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary()), pa.array(read, pa.string())], names=[*part.schema.names, data, text])

    return sent.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row: its ids, and what they decode to, as digests.

    Encodes as `encode` does and decodes the ids as a stream, in one pass: a long text is in memory as text, but never as
    ids or decoded text as a whole. ids_sha256 is of the decimal ids joined by one space, decoded_sha256 of the decoded
    text in UTF-8. Only the two named columns are read.
    """
    sent = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), utf8(F.col(f"`{text}`")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stream = _encoder(path, pattern), Utf8Stream(_table(path))
        for whole in batches:
            for batch in pieces(whole, "_text", 2 << 20):
                counts, coded, decoded = [], [], []
                for value in texts(batch, "_text"):
                    n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
                    for raw in encoder.stream(value):
                        ids = np.frombuffer(raw, dtype="<i4").tolist()
                        if ids:
                            ids_sha.update((" " if n else "").encode() + " ".join(map(str, ids)).encode())
                            text_sha.update(stream.feed(ids).encode())
                            n += len(ids)
                    text_sha.update(stream.end().encode())
                    counts.append(n)
                    coded.append(ids_sha.hexdigest())
                    decoded.append(text_sha.hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return sent.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
