"""Fill-in-the-middle transformation over seekable compressed frames."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import pieces, utf8

#: Bytes of text in a frame, and the level at which frames are compressed.
FRAME, LEVEL = 1 << 16, 3
#: What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def unit_ends(data: np.ndarray, after: int | None) -> np.ndarray:
    """Places behind the words of a stretch of bytes. `after` is the byte that follows it, None at the end of the text, where blanks that no word follows are a unit too."""
    blank = np.append(_BLANK[data], True if after is None else _BLANK[after])
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(data)) if after is None and len(data) and blank[-2] else ends


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def frames(df: DataFrame, doc_id: str = "doc_id", text: str = "text", frame: int = FRAME) -> DataFrame:
    """(doc_id, n, marked, frames) for each row: its text as a list of frames (units, chars, data) that can be decompressed one by one.

    A unit is a word with the blanks before it, or the blanks at the end of the text; n is their number. `data` is an
    independent zstandard frame of at most `frame` bytes of the text, `units` and `chars` are the units that end, and the
    code points that begin, up to its end. `marked` tells whether one of the three markers occurs in the text.
    A null text counts as empty and has no frame. Rows are kept apart, whatever their ids. Only the two named columns
    are read. A task holds one text and its frames at a time.
    """
    sent = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), utf8(F.col(f"`{text}`")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for whole in batches:
            for batch in pieces(whole, "_text"):
                total, marked, counts, units, chars, stored = [], [], [], [], [], []
                for value in batch.column("_text"):
                    data = np.frombuffer(value.as_buffer(), dtype=np.uint8)
                    raw = value.as_py()
                    ended = begun = 0
                    for start in range(0, len(data), frame):
                        part = data[start : start + frame]
                        ended += len(unit_ends(part, int(data[start + frame]) if start + frame < len(data) else None))
                        begun += _chars(part)
                        units.append(ended)
                        chars.append(begun)
                        stored.append(press.compress(part))
                    total.append(ended)
                    counts.append(-(-len(data) // frame))
                    marked.append(any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)))
                both = pa.StructArray.from_arrays([pa.array(units, pa.int64()), pa.array(chars, pa.int64()), pa.array(stored, pa.binary())], names=["units", "chars", "data"])
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                columns = [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(marked, pa.bool_()), pa.ListArray.from_arrays(offsets, both)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "marked", "frames"])

    return sent.mapInArrow(run, "doc_id long, n long, marked boolean, frames array<struct<units: long, chars: long, data: binary>>")


def draws(framed: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """`framed` with `form` and the units before the first and the second cut, all from SHA-256 of seed and doc_id (null: empty).

    Texts without a unit, texts with a marker, and all but `rate` percent of the others stay plain; of the rest `spm`
    percent begin with the suffix.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)

    def drawn(k: int) -> Column:
        return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")

    one, two = drawn(1) % (F.col("n") + 1), drawn(2) % (F.col("n") + 1)
    form = F.when((F.col("n") == 0) | F.col("marked") | (drawn(3) % 100 >= rate), PLAIN).when(drawn(4) % 100 < spm, SPM).otherwise(PSM)
    return framed.withColumns({"form": form, "first": F.least(one, two), "second": F.greatest(one, two)})


class Store:
    """One text's frames. Cuts are found by the cumulative counts; only the frames that hold one are decompressed and pressed anew."""

    def __init__(self, units: np.ndarray, chars: np.ndarray, data: list[bytes]):
        self.units, self.chars, self.data = units, chars, data
        self.press, self.open = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()

    def seek(self, units: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) of the place behind so many units."""
        if not units:
            return 0, 0, 0
        at = int(np.searchsorted(self.units, units))
        inside = units - (int(self.units[at - 1]) if at else 0)
        part = np.frombuffer(self.open.decompress(self.data[at]), dtype=np.uint8)
        ends = unit_ends(part, 0)
        byte = int(ends[inside - 1]) if inside <= len(ends) and ends[inside - 1] < len(part) else len(part)
        return at, byte, (int(self.chars[at - 1]) if at else 0) + _chars(part[:byte])

    def between(self, start: tuple[int, int], stop: tuple[int, int]) -> list[bytes]:
        """Frames of the text from one place to another; whole frames are passed on as they are."""
        out = []
        for k in range(start[0], min(stop[0] + 1, len(self.data))):
            low, high = start[1] if k == start[0] else 0, stop[1] if k == stop[0] else None
            if low == 0 and high is None:
                out.append(self.data[k])
            elif high is None or low < high:
                part = self.open.decompress(self.data[k])[low:high]
                out += [self.press.compress(part)] if part else []
        return out

    def cut(self, first: int, second: int, form: str) -> tuple[list[bytes], int, int]:
        """(frames of the output in order, code points of the prefix, of the middle)."""
        one, two = self.seek(first), self.seek(second)
        end = (len(self.data), 0)
        prefix, middle, suffix = self.between((0, 0), one[:2]), self.between(one[:2], two[:2]), self.between(two[:2], end)
        mark = {m: self.press.compress(m) for m in (PREFIX, SUFFIX, MIDDLE)}
        head = [mark[PREFIX], *prefix, mark[SUFFIX], *suffix] if form == PSM else [mark[SUFFIX], *suffix, mark[PREFIX], *prefix]
        return [*head, mark[MIDDLE], *middle], one[2], two[2] - one[2]


def read(data: Iterable[bytes]) -> Iterator[bytes]:
    """The text of frames, frame by frame."""
    tool = zstandard.ZstdDecompressor()
    for part in data:
        yield tool.decompress(part)


def restore(data: list[bytes], form: str) -> Iterator[bytes]:
    """The original text of an output's frames, in parts. The markers are looked for in the output itself, also across frames; then each section is read again in its old place."""
    if form == PLAIN:
        yield from read(data)
        return
    at: dict[bytes, int] = {}
    sizes, tail, seen = [], b"", 0
    for part in read(data):
        joined = tail + part
        for mark in (PREFIX, SUFFIX, MIDDLE):
            found = joined.find(mark) if mark not in at else -1
            if found >= 0:
                at[mark] = seen - len(tail) + found
        tail, seen = joined[-2:], seen + len(part)
        sizes.append(len(part))
    stops = np.cumsum(sizes)
    order = sorted(at, key=at.get)
    for mark in (PREFIX, MIDDLE, SUFFIX):
        low = at[mark] + len(mark)
        later = order[order.index(mark) + 1 :]
        high = at[later[0]] if later else seen
        first = int(np.searchsorted(stops, low, side="right"))
        place = int(stops[first - 1]) if first else 0
        for part in read(data[first : int(np.searchsorted(stops, high)) + 1]):
            yield part[max(low - place, 0) : max(high - place, 0)]
            place += len(part)


def _digest(parts: Iterable[bytes]) -> str:
    found = hashlib.sha256()
    for part in parts:
        found.update(part)
    return found.hexdigest()


def fill_in_middle(drawn: DataFrame, output: bool = True) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256, output) of each row of `draws`.

    `output` is the transformed text as independent zstandard frames in order: their decompressed texts one after another
    are the text (plain), or marker and section three times. Both digests are computed frame by frame: of the output, and
    of the text that is rebuilt from output and form. Lengths are code points, null if plain. An empty table gives no
    rows. With output=False the frames are left out.
    """
    sent = drawn.select("doc_id", "n", "form", "first", "second", "frames")
    kinds = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                listed = batch.column("frames")
                flat = listed.flatten()
                units, chars, stored = (flat.field(k) for k in range(3))
                units, chars = units.to_numpy(zero_copy_only=False), chars.to_numpy(zero_copy_only=False)
                offsets = np.concatenate([[0], np.cumsum(listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(int)
                prefix, middle, shas, rebuilt, outputs, counts = [], [], [], [], [], []
                for k, (form, first, second) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("form", "first", "second")), strict=True)):
                    low, high = offsets[k], offsets[k + 1]
                    own = stored.slice(low, high - low).to_pylist()
                    made, before, inside = (own, None, None) if form == PLAIN else Store(units[low:high], chars[low:high], own).cut(first, second, form)
                    prefix.append(before)
                    middle.append(inside)
                    shas.append(_digest(read(made)))
                    rebuilt.append(_digest(restore(made, form)))
                    if output:
                        outputs += made
                        counts.append(len(made))
                columns = [batch.column("doc_id"), batch.column("n"), batch.column("form"), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(shas, pa.string()), pa.array(rebuilt, pa.string())]
                names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
                if output:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(outputs, pa.binary())))
                    names.append("output")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return sent.mapInArrow(run, kinds + (", output array<binary>" if output else ""))
