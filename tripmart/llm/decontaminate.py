"""Benchmark decontamination by suffix arrays over shards of the training text.

Each task builds a word-level suffix array over one shard of documents at a
time and binary-searches the suffixes of the benchmark items in it. Words
that no item holds cannot be part of a match, so only suffixes that start
with enough benchmark words in a row are sorted, and only as deep as the
longest item: that loses no match. An occurrence of an item's window of
``window`` words (the whole item if shorter) gives a location; occurrences
next to each other on the same diagonal join into the longest verbatim
matches.

Words are runs of characters other than ASCII punctuation, blanks and
controls, after lower-casing A-Z only.

Defined cases: null or word-less texts have no words and no match; items
without words match nothing; a null item id is called ``null``; items of one
text with several ids and repeated documents are each reported; benchmark rows
that share an id are searched each on its own, and a match inside a longer one
of that id on the same diagonal is dropped; an empty benchmark leaves every
document clean.

Scale: no shuffle and no join for a benchmark of at most ``block_words``
words (40 MB in a task). A larger one is read in such blocks: the documents
are written once with row numbers to the shared folder, each block takes a
pass over them that writes its matches there and is then dropped, and the last
block's pass joins the matches by row number. The driver holds two blocks at
most, whatever the benchmark's size.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import repeat
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import extended, numbered, pieces, release_kept, rename_clashes, staged, text_bytes

WINDOW = 10
BLOCK_WORDS = 1_000_000
SHARD_BYTES = 4 << 20
MATCH = "struct<item_id:string,item_start:int,doc_start:int,length:int>"
_MATCH_ARROW = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()),
                                   ("doc_start", pa.int32()), ("length", pa.int32())]))

# byte -> lower-case letter, digit or non-ASCII byte as it is; others blank
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


@dataclass
class Block:
    """Some benchmark items, ready for the search (picklable, bounded)."""
    vocab: dict[bytes, int]              # word -> number from 1
    windows: np.ndarray                  # distinct windows, padded with 0: one a row
    lengths: np.ndarray                  # words of each window
    places: list[list[tuple[int, int]]]  # (row, offset) of each window
    items: list[str]                     # item id of each row
    depth: int                           # words of the longest item


def make_block(items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> Block:
    vocab: dict[bytes, int] = {}
    places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    depth = 1
    for row, (_, words) in enumerate(items):
        ids = [vocab.setdefault(w, len(vocab) + 1) for w in words]
        depth = max(depth, len(ids))
        w = min(window, len(ids))
        for j in range(len(ids) - w + 1 if w else 0):
            places.setdefault(tuple(ids[j:j + w]), []).append((row, j))
    keys = sorted(places)
    windows = np.zeros((len(keys), max(1, window)), np.int32)
    for i, k in enumerate(keys):
        windows[i, :len(k)] = k
    return Block(vocab, windows, np.array([len(k) for k in keys], np.int64),
                 [places[k] for k in keys], [item for item, _ in items], depth)


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                     window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """Read the benchmark on the driver, one bounded block after the other."""
    held: list[tuple[str, list[bytes]]] = []
    size = 0
    rows = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")),
                            F.col(f"`{text_col}`").cast("binary"))
    for item, text in rows.toLocalIterator():
        words = words_of(bytes(text) if text is not None else None)
        if held and size + len(words) > block_words:
            yield make_block(held, window)
            held, size = [], 0
        held.append((item, words))
        size += len(words)
    yield make_block(held, window)


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` sorted by the suffixes they begin, compared over ``depth``
    words (prefix doubling; ``words`` ends in zeros, which sort first)."""
    rank = words.astype(np.int64)
    span = 1
    while span < depth:
        ahead = np.zeros_like(rank)
        ahead[:-span] = rank[span:]
        key = rank * (int(rank.max()) + 1) + ahead
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        span *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def search(words: np.ndarray, order: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """First and last place in the suffix array of the suffixes that begin
    with each window (vectorised binary search)."""
    across = np.arange(block.windows.shape[1])
    inside = across < block.lengths[:, None]

    def bound(after: bool) -> np.ndarray:
        lo = np.zeros(len(block.windows), np.int64)
        hi = np.full(len(block.windows), len(order), np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            at = order[np.minimum(mid, len(order) - 1)]
            seen = np.where(inside, words[at[:, None] + across], 0)
            differ = seen != block.windows
            first = differ.argmax(axis=1)
            rows = np.arange(len(first))
            less = seen[rows, first] < block.windows[rows, first]
            right = np.where(differ.any(axis=1), less, after)
            lo = np.where(open_ & right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)
        return lo

    return bound(False), bound(True)


def word_ids(words: list[bytes], block: Block) -> np.ndarray:
    """The number of each word in the block's vocabulary, 0 for any other."""
    return np.fromiter(map(block.vocab.get, words, repeat(0)), np.int32, len(words))


def shard_matches(ids: list[np.ndarray], block: Block) -> list[list[tuple[str, int, int, int]]]:
    """For each document (its word numbers) its longest verbatim matches."""
    found: list[list[tuple[str, int, int, int]]] = [[] for _ in ids]
    if not len(block.windows):
        return found
    width = block.windows.shape[1]
    sizes = np.array([len(d) + 1 for d in ids], np.int64)          # a zero after each document
    begins = np.concatenate([[0], np.cumsum(sizes)])
    words = np.zeros(int(begins[-1]) + max(width, block.depth) + 1, np.int32)
    for b, i in zip(begins, ids):
        words[b:b + len(i)] = i
    # how many benchmark words follow in a row, at most ``width``
    run = (words > 0).astype(np.int64)
    least = int(block.lengths.min())
    ahead, span = run.copy(), 1
    while span < width:
        more = np.zeros_like(ahead)
        more[:-span] = ahead[span:]
        ahead = np.where(ahead == span, ahead + more, ahead)
        span *= 2
    starts = np.flatnonzero(ahead >= least)
    if not len(starts):
        return found
    # keep only those suffixes' words: close up the rest
    used = np.zeros(len(words) + 1, np.int64)
    np.add.at(used, starts, 1)
    np.add.at(used, np.minimum(starts + np.maximum(block.depth, width) + 1, len(words)), -1)
    keep = np.flatnonzero(np.cumsum(used[:-1]) > 0)
    place = np.full(len(words), -1, np.int64)
    place[keep] = np.arange(len(keep))
    small = np.concatenate([words[keep], np.zeros(max(width, block.depth) + 1, np.int32)])
    order = suffix_array(small, place[starts], block.depth)
    lo, hi = search(small, order, block)
    hit = np.flatnonzero(hi > lo)
    if not len(hit):
        return found
    n = hi[hit] - lo[hit]
    which = np.repeat(hit, n)
    at = order[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[hit], n)]
    at = keep[at]
    doc = np.searchsorted(begins, at, side="right") - 1
    # an occurrence for each row the window comes from, by diagonal (the windows of a row are of one length)
    by: dict[tuple[int, int, int], list[tuple[int, int, int]]] = {}
    for w, p, d in zip(which.tolist(), at.tolist(), doc.tolist()):
        p -= int(begins[d])
        for row, j in block.places[w]:
            by.setdefault((d, row, p - j), []).append((p, j, int(block.lengths[w])))
    for (d, row, _), spots in by.items():
        spots.sort()
        item = block.items[row]
        first, item_first, last, length = spots[0][0], spots[0][1], spots[0][0], spots[0][2]
        for p, j, _ in spots[1:]:
            if p > last + 1:
                found[d].append((item, item_first, first, last - first + length))
                first, item_first = p, j
            last = p
        found[d].append((item, item_first, first, last - first + length))
    return [longest(m) for m in found]


def longest(matches: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int, int]]:
    """``matches`` without those inside another of their item and diagonal."""
    kept: list[tuple[str, int, int, int]] = []
    end: dict[tuple[str, int], int] = {}
    for m in sorted(matches, key=lambda m: (m[2], -m[3])):
        line, stop = (m[0], m[2] - m[1]), m[2] + m[3]
        if stop > end.get(line, 0):
            kept.append(m)
            end[line] = stop
    return kept


def hit_words(matches: list[tuple[str, int, int, int]]) -> int:
    """Words covered by any of the matches."""
    total, end = 0, 0
    for start, length in sorted((m[2], m[3]) for m in matches):
        total += max(0, start + length - max(end, start))
        end = max(end, start + length)
    return total


def _listed(matches: list[list[tuple[str, int, int, int]]]) -> pa.Array:
    return pa.array([[dict(zip(("item_id", "item_start", "doc_start", "length"), m))
                      for m in sorted(x, key=lambda m: (m[2], m[0], m[1]))] for x in matches], _MATCH_ARROW)


def _scanned(batches: Iterator[pa.RecordBatch], text_col: str, block: Block) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    """Slices of the batches with each document's word count and matches, a
    shard of documents at a time."""
    held: list[pa.RecordBatch] = []
    words: list[np.ndarray] = []
    size = 0

    def flush() -> Iterator[tuple[pa.RecordBatch, list, list]]:
        matches = shard_matches(words, block)
        row = 0
        for b in held:
            yield b, [len(w) for w in words[row:row + b.num_rows]], matches[row:row + b.num_rows]
            row += b.num_rows

    release_kept()
    for b in pieces(batches, text_col):
        words.extend(word_ids(words_of(t), block) for t in text_bytes(b, text_col))
        held.append(b)
        size += b.nbytes
        if size > SHARD_BYTES:
            yield from flush()
            held, words, size = [], [], 0
    if held:
        yield from flush()


def _block_matches(block: Broadcast, text_col: str):
    """The rows with matches in a block, by row number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, new in _scanned(batches, text_col, block.value):
            hit = [i for i, m in enumerate(new) if m]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(hit, pa.int64())), _listed([new[i] for i in hit])], ["row_", "matches"])
    return run


def find_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with n_words, n_hit and matches (item, offsets and length in
    words of every longest verbatim match of ``window`` words or more)."""
    docs = rename_clashes(docs, ["n_words", "n_hit", "matches"])
    schema = extended(docs, f"n_words long, n_hit long, matches array<{MATCH}>")
    rows, names = numbered(docs)
    n, text = len(docs.columns), names[text_col]
    blocks = benchmark_blocks(benchmark, item_id_col, item_text_col, window, block_words)
    block, path = next(blocks), None
    for following in blocks:
        if path is None:                                         # row numbers hold for written rows only
            rows = staged(rows.withColumn("row_", F.monotonically_increasing_id()), "decontaminate-rows")
            path = scratch_path(docs.sparkSession, "decontaminate-matches")
        held = docs.sparkSession.sparkContext.broadcast(block)
        found = rows.select("row_", text).mapInArrow(_block_matches(held, text), f"row_ long, matches array<{MATCH}>")
        found.write.mode("append").parquet(path)
        held.destroy()
        block = following
    if path is not None:
        found = docs.sparkSession.read.schema(f"row_ long, matches array<{MATCH}>").parquet(path)
        found = found.groupBy("row_").agg(F.flatten(F.collect_list("matches")).alias("matches"))
        rows = rows.join(found, "row_", "left").drop("row_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, counts, new in _scanned(batches, text, block):
            if b.num_columns > n:                                # matches of earlier blocks
                new = [longest([tuple(m.values()) for m in o or []] + x) for o, x in zip(b.column(n).to_pylist(), new)]
            hits = pa.array([hit_words(x) for x in new], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(counts, pa.int64()), hits, _listed(new)],
                                             schema.fieldNames())

    return rows.mapInArrow(run, schema)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without any match, with their own columns only."""
    plain, names = numbered(docs)
    found = find_matches(plain, benchmark, names[text_col], **options)
    return found.filter("n_hit = 0").select(*plain.columns).toDF(*docs.columns)
