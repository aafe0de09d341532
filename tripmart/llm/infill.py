"""Fill-in-middle transformation over seekable compressed texts.

A text is stored as independent zstandard frames (:func:`frame_store`) with
cumulative counts of units and code points before each frame, so that a unit
is found by a binary search and one decompressed frame. :func:`transform`
decompresses only the frames in which a cut falls; every other frame moves
to the output as it is, still compressed. :func:`digests` streams a
document's frames in order, one decompressed frame at a time; the text is
rebuilt from the output and its form alone.

Units are runs of ASCII letters and single other code points. The hex
sha256 of ``seed:id`` gives four numbers: two cuts (the smaller ends the
prefix, the larger the middle), and the form. psm is ``<P>prefix<S>suffix<M>middle``,
spm ``<S>suffix<P>prefix<M>middle``. In an output of a text without marks the
first occurrence of each mark is the mark itself: a mark's first character
occurs nowhere else in a mark, so none can begin before it or end behind it.

Defined cases: a null text is empty; an empty text, and one that holds a
mark, is plain (output is the text; its cuts are null); a null id is hashed
like the text ``null``; repeated ids and rows are kept, each on its own; an
empty table gives an empty result; columns other than id and text are not
read. A text of any length is handled one frame at a time besides its own
compressed bytes; a run of letters may span frames and counts once.

Scale: one pass over the texts writes the store (smaller than the texts);
another reads it. Nothing shuffles.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, text_bytes

FRAME_BYTES = 1 << 16
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM = 90       # of 100: documents whose third number is this or more stay plain
SPM_BELOW = 20        # of 100: suffix first

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_FIRST = np.ones(256, bool)          # bytes that start a code point
_FIRST[0x80:0xC0] = False


def unit_starts(raw: np.ndarray, after_letter: bool = False) -> np.ndarray:
    """Byte positions where a unit starts; ``after_letter``: the byte before is a letter."""
    letter = _LETTER[raw]
    goes_on = letter.copy()
    goes_on[1:] &= letter[:-1]
    goes_on[:1] &= after_letter
    return np.flatnonzero(_FIRST[raw] & ~goes_on)


@dataclass
class Frames:
    """A stored text: counts before each frame (and in all, last), frames end to end."""
    units: np.ndarray
    chars: np.ndarray
    ends: np.ndarray
    data: bytes

    def __len__(self) -> int:
        return len(self.ends) - 1

    def packed(self, i: int) -> bytes:
        return self.data[self.ends[i]:self.ends[i + 1]]

    def read(self, i: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.packed(i))

    def seek(self, unit: int) -> tuple[int, int, int]:
        """Frame, byte in it, and code point at which a unit starts."""
        if unit >= self.units[-1]:
            return len(self), 0, int(self.chars[-1])
        f = int(np.searchsorted(self.units, unit, side="right")) - 1
        raw = np.frombuffer(self.read(f), np.uint8)
        starts = unit_starts(raw)
        if len(starts) > self.units[f + 1] - self.units[f]:      # it begins within a run of letters
            starts = starts[1:]
        at = int(starts[unit - self.units[f]])
        return f, at, int(self.chars[f] + np.count_nonzero(_FIRST[raw[:at]]))


def to_frames(text: bytes, size: int = FRAME_BYTES) -> Frames:
    """Cut a text into frames of at most ``size`` bytes (whole code points)."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    units, chars, ends, out, at, letter = [0], [0], [0], [], 0, False
    while at < len(text):
        stop = min(at + size, len(text))
        while stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop -= 1
        raw = np.frombuffer(text, np.uint8, stop - at, at)
        out.append(packer.compress(text[at:stop]))
        units.append(units[-1] + len(unit_starts(raw, letter)))
        chars.append(chars[-1] + int(np.count_nonzero(_FIRST[raw])))
        ends.append(ends[-1] + len(out[-1]))
        letter, at = bool(_LETTER[raw[-1]]), stop
    return Frames(np.array(units), np.array(chars), np.array(ends), b"".join(out))


class _Writer:
    """Collects an output: bytes are compressed in frames, whole frames copied."""

    def __init__(self, size: int):
        self.size, self.frames, self.open = size, [], bytearray()
        self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def flush(self) -> None:
        if self.open:
            self.frames.append(self.packer.compress(bytes(self.open)))
            self.open = bytearray()

    def add(self, data: bytes) -> None:
        self.open += data
        if len(self.open) >= self.size:
            self.flush()

    def part(self, text: Frames, start: tuple[int, int], stop: tuple[int, int]) -> None:
        """The text from (frame, byte) ``start`` up to ``stop``."""
        (f, a), (g, b) = start, stop
        if f == g:
            if b > a:
                self.add(text.read(f)[a:b])
            return
        for i in range(f, g):
            if i == f and a:
                self.add(text.read(i)[a:])
            elif len(text) == 1:
                self.add(text.read(i))                 # a short text makes one frame again
            else:
                self.flush()
                self.frames.append(text.packed(i))
        if b:
            self.add(text.read(g)[:b])


def infill(text: Frames, first: int, second: int, form: str, size: int = FRAME_BYTES) -> tuple[list[bytes], int | None, int | None]:
    """Output frames of a text, and the code points of prefix and middle."""
    out, whole = _Writer(size), (len(text), 0)
    if form == "plain":
        out.part(text, (0, 0), whole)
        out.flush()
        return out.frames, None, None
    *cut_a, chars_a = text.seek(min(first, second))
    *cut_b, chars_b = text.seek(max(first, second))
    a, b = tuple(cut_a), tuple(cut_b)
    parts = {PREFIX: ((0, 0), a), SUFFIX: (b, whole), MIDDLE: (a, b)}
    for mark in (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE):
        out.add(mark)
        out.part(text, *parts[mark])
    out.flush()
    return out.frames, chars_a, chars_b - chars_a


def _bytes_of(frames: list[bytes]) -> Iterator[bytes]:
    reader = zstandard.ZstdDecompressor()
    return (reader.decompress(f) for f in frames)


def _ranges(frames: list[bytes], form: str) -> list[tuple[int, int]]:
    """Byte ranges of an output that make up the text, in the text's order."""
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    found, carry, base, total = [], b"", 0, 0
    for data in _bytes_of(frames):
        total += len(data)
        window = carry + data                  # carry: the last bytes, in which a mark may begin
        at = max(0, found[-1] + 3 - base) if found else 0
        while len(found) < 3 and (at := window.find(order[len(found)], at)) >= 0:
            found.append(base + at)
            at += 3
        carry = window[-2:]
        base = total - len(carry)
    stops = [*found[1:], total]
    part = {m: (s + 3, e) for m, s, e in zip(order, found, stops)}
    return [part[PREFIX], part[MIDDLE], part[SUFFIX]]


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The text of an output, piece by piece."""
    if form == "plain":
        yield from _bytes_of(frames)
        return
    for start, stop in _ranges(frames, form):
        at = 0
        for data in _bytes_of(frames):
            if at < stop and at + len(data) > start:
                yield data[max(0, start - at):stop - at]
            at += len(data)
            if at >= stop:
                break


# --- DataFrames ---------------------------------------------------------------------

STORE = "id {}, marked boolean, units array<long>, chars array<long>, ends array<long>, frames binary"
OUTPUT = "id {}, n long, form string, prefix_chars long, middle_chars long, ends array<long>, frames binary"


def _longs(rows: list) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int64()))


def frame_store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = FRAME_BYTES) -> DataFrame:
    """One row per document: its text as frames with their counts. Write it once."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            texts = [t or b"" for t in text_bytes(b, "text")]
            made = [to_frames(t, size) for t in texts]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([PREFIX in t or SUFFIX in t or MIDDLE in t for t in texts]),
                _longs([m.units for m in made]), _longs([m.chars for m in made]), _longs([m.ends for m in made]),
                pa.array([m.data for m in made], pa.binary())], ["id", "marked", "units", "chars", "ends", "frames"])

    return rows.mapInArrow(run, STORE.format(kind))


def transform(store: DataFrame, seed: int = 1, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
              size: int = FRAME_BYTES) -> DataFrame:
    """One row per stored document: units, form, lengths, and the output as frames."""
    kind = store.schema["id"].dataType.simpleString()
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))).cast("binary"), 256)
    h = [F.conv(F.substring("_key", 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    n = F.element_at("units", -1)
    rows = store.withColumn("_key", key).withColumn("n", n).select(
        "id", "n", F.when(F.col("marked") | (n == 0) | (h[2] % 100 >= plain_from), "plain")
        .when(h[3] % 100 < spm_below, "spm").otherwise("psm").alias("form"),
        (h[0] % (n + 1)).alias("first"), (h[1] % (n + 1)).alias("second"), "units", "chars", "ends", "frames")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "frames"):
            form, first, second, units, chars, ends, data = (b.column(i).to_pylist() for i in range(2, 9))
            made = [infill(Frames(np.array(u), np.array(c), np.array(e), d), x, y, f, size)
                    for f, x, y, u, c, e, d in zip(form, first, second, units, chars, ends, data)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), b.column(2), pa.array([m[1] for m in made], pa.int64()),
                pa.array([m[2] for m in made], pa.int64()),
                _longs([np.cumsum([0, *map(len, m[0])]) for m in made]),
                pa.array([b"".join(m[0]) for m in made], pa.binary())],
                ["id", "n", "form", "prefix_chars", "middle_chars", "ends", "frames"])

    return rows.mapInArrow(run, OUTPUT.format(kind))


def _with_frames(out: DataFrame, make, names: list[str], ddl: str) -> DataFrame:
    """``out`` with what ``make(frames, form)`` gives instead of the frames."""
    kind = out.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "frames"):
            cells = []
            for form, ends, data in zip(b.column(2).to_pylist(), b.column(5).to_pylist(), b.column(6).to_pylist()):
                cells.append(make([data[s:e] for s, e in zip(ends, ends[1:])], form))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], *(pa.array([c[i] for c in cells], pa.string()) for i in range(len(names)))],
                [*b.schema.names[:5], *names])

    return out.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, {ddl}")


def _sha256(parts: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for p in parts:
        digest.update(p)
    return digest.hexdigest()


def digests(out: DataFrame) -> DataFrame:
    """The rows of :func:`transform` with output_sha256 and restored_sha256 instead of the frames."""
    return _with_frames(out, lambda frames, form: (_sha256(_bytes_of(frames)), _sha256(restored(frames, form))),
                        ["output_sha256", "restored_sha256"], "output_sha256 string, restored_sha256 string")


def texts(out: DataFrame) -> DataFrame:
    """The rows of :func:`transform` with output and restored text instead of the frames."""
    return _with_frames(out, lambda frames, form: (b"".join(_bytes_of(frames)).decode(), b"".join(restored(frames, form)).decode()),
                        ["output", "restored"], "output string, restored string")
