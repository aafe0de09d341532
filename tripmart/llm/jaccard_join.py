"""Jaccard self-join on word n-grams with a count-vector R-tree.

A document's set is its distinct word shingles. Two documents link when
``100 * intersection >= percent * union``; links make components.

The join, exact at every size:

1. Shingles are hashed to 64 bits and each set's shingles are counted in
   hash groups, up to two for each shingle: the set's *count vector*. The overlap of two sets is at most
   the sum over the groups of the smaller count. Longer sets have more
   groups; a vector folds to fewer groups by adding its halves.
2. Equal sets collapse into one node. Sets that can link share one of their
   first ``n - ceil(percent * n / 100) + 1`` shingles in hash order, so each
   node goes to the blocks of those shingles; that spreads the join.
   In that order shingles common to many documents come last, so that shared
   lines and passages make few large blocks.
   The list goes on for ``MORE`` hundredths of the set beyond that prefix: two
   sets that link share as many hundredths of the smaller one within their
   lists, so a node with fewer shingles there that any other document holds
   links with nothing and goes to no block.
3. Pre-linking: every node is verified against the smallest node that shares
   one of its ``CENTRES`` least shingles (a row per node and shingle, never
   all pairs). This merges large groups of near copies at linear cost.
   Blocks of one node, and nodes that no other one of their block can link
   with by its size and the shingle's place, drop out early.
4. Blocks whose nodes are still in several components build an R-tree over
   the nodes' count vectors of ``GROUPS`` groups (sort-tile-recursive over the
   coordinates of the largest spread, the set size among them; a node's bound
   is the vector of its maxima). The join descends pairs of subtrees from the
   root; a pair is skipped when the summed coordinate minima, the sizes or a
   common component rule it out, pairs of points by the same bound at their
   full number of groups. Pairs
   already connected need no verification: the first round takes only a
   forest of each block's candidate pairs, the likeliest first, and only
   blocks where pairs were left out go on; the last round takes every pair
   that is still between two components.
5. Candidates are verified on their whole shingle sets. Pairs are grouped by
   one of their two nodes (groups of more than ``PARTNERS`` pairs are split),
   one text of each node concerned is sent to its groups, and sets are
   recomputed there; the other texts never leave their place.
6. Components by repeated contraction to the smallest neighbour, each round
   written to the shared folder.

Defined cases: null, empty and blank texts have an empty set and link with
nothing; a text of fewer words than a shingle is one shingle; rows of equal
sets are one component; a component's id is its smallest document id (null
ids are ignored unless all are null); an empty table gives an empty result;
input columns named like a result column are replaced.

Fingerprints have 64 bits: among n distinct sets about n*n / 2**65 pairs
collide (one in 30 at a billion documents).

Scale: what shuffles is a few numbers for each prefix shingle (a fifth of
the shingles). A block of more than ``TILE`` nodes is split into tiles, and
each pair of tiles is its own unit of work. Only a bit map of bounded size
(32 MB) is broadcast; beyond it a join by key takes its place. Tables that a
later step no longer needs are removed.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LEAN_BYTES, discard, extended, numbered, pieces, release_kept, rename_clashes, staged, text_bytes

WORDS = 5
PERCENT = 80
GROUPS = 64           # hash groups of the R-tree's vectors, the fewest of any
MOST_GROUPS = 4096    # bound of a vector's size
ROUNDS = 2            # rounds of the R-tree join at most; the last one is complete
MORE = 10             # hundredths of a set by which its list of shingles is longer than the prefix
CENTRES = 4           # least shingles by which a node is pre-linked
COMMON = 6            # documents of a slice of text that make a shingle common
KEYS = 1 << 21        # keys that a task counts at once
TILE = 4096           # nodes of a block that one task compares
LEAF = 32             # points of an R-tree leaf
FANOUT = 8            # children of an R-tree node above the leaves
PARTNERS = 256        # pairs of one group that are verified together
BITMAP_WORDS = 1 << 22
BROADCAST_KEYS = 1 << 20      # row addresses broadcast as they are (8 MB)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_CODE = np.random.RandomState(20240229).randint(1, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)                       # odd: has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SPAN = 1 << 16       # bytes hashed at once


def _powers(base: np.uint64) -> np.ndarray:
    """base**0 .. base**(_SPAN - 1) modulo 2**64."""
    out = np.full(_SPAN, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_BASE), _powers(_BASE_INVERSE)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX1
    h = (h ^ (h >> np.uint64(33))) * _MIX2
    return h ^ (h >> np.uint64(33))


def byte_run_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs [start, end), given in order: prefix sums
    of byte codes times powers of the base, shifted back to each run's start.
    Bytes are taken ``_SPAN`` at a time; longer runs are hashed one by one."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = int(start[at])
        stop = max(at + 1, int(np.searchsorted(end, base + _SPAN, side="right")))
        s, e = start[at:stop] - base, end[at:stop] - base
        if e[-1] <= _SPAN:
            size = int(e[-1])
            total = np.zeros(size + 1, np.uint64)
            np.cumsum(_BYTE_CODE[raw[base:base + size]] * _UP[:size], out=total[1:])
            out[at:stop] = mix((total[e] - total[s]) * _DOWN[s] + (e - s).astype(np.uint64))
        at = stop
    for k in np.flatnonzero(end - start > _SPAN // 2).tolist():      # these never depend on where a span began
        out[k] = xxhash.xxh3_64_intdigest(raw[start[k]:end[k]].tobytes())
    return out


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    buf = b"\n".join(t or b"" for t in texts)
    none = np.empty(0, np.uint64)
    if not buf:
        return [none for _ in texts]
    raw = np.frombuffer(buf, np.uint8)
    solid = ~_BLANK[raw]
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    word = byte_run_hashes(_LOWER[raw], start, end)
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    cut = np.searchsorted(start, ends)          # words before the end of each text
    n = len(word)
    gram = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        gram = gram * _BASE + word[k:k + len(gram)]
    gram = mix(gram)
    out, first = [], 0
    for last in cut.tolist():
        if last - first >= words:
            out.append(np.unique(gram[first:last - words + 1]))
        elif last > first:
            h = np.zeros(1, np.uint64)
            for k in range(first, last):
                h = h * _BASE + word[k]
            out.append(mix(h + np.uint64(last - first)))
        else:
            out.append(none)
        first = last
    return out


def node_of(shingles: np.ndarray) -> int:
    """64-bit fingerprint of a set (signed)."""
    h = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return h - (1 << 64) if h >= 1 << 63 else h


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n) // 100 + 1


def listed_length(n: int, percent: int = PERCENT) -> int:
    """Shingles of a set's list: the prefix and ``MORE`` hundredths of the set."""
    left = max(0, percent - MORE) * n // 100
    return max(prefix_length(n, percent), n - left)


def least_shared(n: int, percent: int = PERCENT) -> int:
    """Shingles of its list that a set of ``n`` shares with the list of any set
    it links with. Say x's list ends first in the order: of the overlap (at
    least ``percent`` hundredths of the larger set) only what x's list leaves
    out (at most ``percent - MORE`` hundredths of x) is outside both lists."""
    return max(1, -(-min(MORE, percent) * n // 100))


def groups_for(n: int) -> int:
    """Groups of a set of ``n`` shingles: up to twice as many, a power of two, so
    that shingles two sets don't share seldom meet in a group and the bound
    comes close to the overlap (a quarter as many let through every pair of
    large groups of documents that are just too different to link). Halves of
    a vector add up to the vector of half as many groups (:func:`fold`)."""
    return min(MOST_GROUPS, max(GROUPS, 1 << n.bit_length()))


def count_vector(shingles: np.ndarray) -> np.ndarray:
    groups = groups_for(len(shingles))
    return np.bincount((shingles >> np.uint64(32)).astype(np.int64) & (groups - 1), minlength=groups).astype("<u4")


def fold(vector: np.ndarray, groups: int) -> np.ndarray:
    """The count vector of fewer groups."""
    return vector.reshape(-1, groups).sum(axis=0, dtype=np.int64)


_QUARTERS = (np.arange(256, dtype=np.uint8)[:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3


def pack_vector(vector: np.ndarray) -> bytes:
    """Two bits a count, after a byte for the number of groups (a power of two)
    and one for the width of what follows: the counts of three and more, in
    order, as 1, 2 or 4 bytes each."""
    low = np.minimum(vector, 3).astype(np.uint8)
    width = 1 if vector.max() < 1 << 8 else 2 if vector.max() < 1 << 16 else 4
    return (bytes([len(vector).bit_length() - 1, width]) + (low[::4] | low[1::4] << 2 | low[2::4] << 4 | low[3::4] << 6).tobytes()
            + vector[low == 3].astype(f"<u{width}").tobytes())


def unpack_vector(data: bytes) -> np.ndarray:
    size, width = (1 << data[0]) // 4, data[1]
    out = _QUARTERS[np.frombuffer(data, np.uint8, size, 2)].ravel()
    more = np.frombuffer(data, f"<u{width}", offset=2 + size)
    if len(more):
        high = out == 3
        out = out.astype(more.dtype)
        out[high] = more
    return out


def in_bits(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the 64-bit hashes the bit map holds."""
    signed = hashes.view(np.int64)
    return (bits[(signed >> 6) % len(bits)] >> (signed & 63)) & 1 == 1


def common_shingles(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """Shingles that several documents of one slice of text share. They come
    last in the order of shingles, so that few blocks hold many documents;
    any order gives the same links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for b in pieces(batches, "text"):
            sets = {s.tobytes(): s for s in shingle_sets(text_bytes(b, "text"), words)}
            seen, n = np.unique(np.concatenate(list(sets.values())), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen[n >= COMMON].view(np.int64))], ["shingle"])

    return docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "shingle long").distinct()


def addressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, and a hash of both by which a row is found again (rows that
    repeat both share it)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.withColumn("at", F.xxhash64("id", "text"))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """id, its row's address, the hash of its text, n_shingles, node, the list of its first shingles
    (common ones last), the first shingles in plain hash order, and the count vector of every row."""
    common = _bitmap(staged(common_shingles(docs, text_col, words), "jaccard-common"))

    def prefix(s: np.ndarray) -> np.ndarray:
        last = in_bits(s, common)
        return np.concatenate([s[~last], s[last]])[:listed_length(len(s), percent)].view(np.int64)

    rows = addressed(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for b in pieces(batches, "text", LEAN_BYTES):
            sets = shingle_sets(text_bytes(b, "text"), words)
            yield pa.RecordBatch.from_arrays([
                b.column(b.schema.get_field_index("id")),
                b.column(b.schema.get_field_index("at")),
                b.column(b.schema.get_field_index("hash")),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([prefix(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.array([s[:CENTRES].view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.array([pack_vector(count_vector(s)) if len(s) else None for s in sets], pa.binary()),
            ], ["id", "at", "hash", "n_shingles", "node", "prefix", "least", "vector"])

    return rows.mapInArrow(run, f"id {id_type}, at long, hash long, n_shingles long, node long, prefix array<long>, "
                                "least array<long>, vector binary")


# --- verification ----------------------------------------------------------------

def _bits(keys: DataFrame, most: int = BITMAP_WORDS) -> tuple[DataFrame, int]:
    """Bit map (w, b) of a column of 64-bit hashes, and its number of words,
    at most ``most``: false hits only cost work."""
    key = keys.columns[0]
    words = min(most, 1 << max(4, (max(1, keys.count()) // 4).bit_length()))
    rows = keys.select(F.pmod(F.shiftright(key, 6), F.lit(words)).alias("w"),
                       F.expr(f"shiftleft(1L, CAST({key} & 63 AS INT))").alias("b"))
    return rows.groupBy("w").agg(F.bit_or("b").alias("b")), words


def _bitmap(keys: DataFrame) -> np.ndarray:
    """The bit map as an array, for tasks (at most 32 MB)."""
    rows, words = _bits(keys)
    out = np.zeros(words, np.int64)
    # sixteen bytes a word, in Arrow batches of many words
    got = rows.toArrow()
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out


def _fits(keys: DataFrame) -> bool:
    """Whether a bit map of the keys stays sparse enough to tell rows apart."""
    return keys.count() <= BITMAP_WORDS * 8


def _with_key(rows: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """The rows whose key is in ``keys`` (one column of that name): rows that
    a bit map rules out do not shuffle."""
    if not _fits(keys):
        return rows
    bits, words = _bits(keys, 1 << 20)                           # at most 16 MB of pairs
    bits = F.broadcast(staged(bits, "jaccard-bits"))
    hit = F.expr(f"shiftrightunsigned(b, CAST({col} & 63 AS INT)) & 1") == 1
    return (rows.withColumn("w", F.pmod(F.shiftright(col, 6), F.lit(words))).join(bits, "w")
            .filter(hit).select(*rows.columns))


def _split_by_key(rows: DataFrame, col: str, keys: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose key is not in ``keys`` (written, distinct, one column of
    that name) and those whose key is; no second part if there is no key. Up
    to ``BROADCAST_KEYS`` keys are broadcast; beyond, rows that a bit map
    rules out pass straight through and only the others shuffle."""
    n = keys.count()
    if not n:
        return rows, None
    if n <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
        return rows.join(keys, col, "left_anti").select(*rows.columns), rows.join(keys, col, "left_semi").select(*rows.columns)
    bits, words = _bits(keys, 1 << 20)
    bits = F.broadcast(staged(bits, "jaccard-bits"))
    seen = rows.withColumn("w", F.pmod(F.shiftright(col, 6), F.lit(words))).join(bits, "w", "left")
    hit = F.coalesce(F.expr(f"shiftrightunsigned(b, CAST({col} & 63 AS INT)) & 1") == 1, F.lit(False))
    maybe = seen.filter(hit).select(*rows.columns)
    out = seen.filter(~hit).select(*rows.columns).unionByName(maybe.join(keys, col, "left_anti").select(*rows.columns))
    return out, maybe.join(keys, col, "left_semi").select(*rows.columns)


def _agree(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of groups of texts sorted by (a, part, side): the group's
    own text first, then those to compare with it."""
    release_kept()
    held: tuple | None = None                   # group and set of its own text
    for batch in pieces(batches, "text"):
        a, part, side, node = (batch.column(i).to_pylist() for i in range(4))
        found: list[tuple[int, int]] = []
        for i, s in enumerate(shingle_sets(text_bytes(batch, "text"), words)):
            if not len(s) or node_of(s) != node[i]:               # another row with the same address
                continue
            if side[i] == 0:
                held = (a[i], part[i], s)
            elif held is not None and held[:2] == (a[i], part[i]):
                common = len(np.intersect1d(held[2], s, assume_unique=True))
                if 100 * common >= percent * (len(held[2]) + len(s) - common):
                    found.append((a[i], node[i]))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                          pa.array([y for _, y in found], pa.int64())], ["a", "b"])


def verified(pairs: DataFrame, prints: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int,
             percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = staged(pairs.select("a", "b"), "jaccard-wanted")
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    dealt = pairs.join(groups, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    sent = (dealt.select("a", "part", F.lit(1).alias("side"), F.col("b").alias("node"))
            .unionByName(groups.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                       F.lit(0).alias("side"), F.col("a").alias("node"))))
    nodes = sent.select("node").distinct()
    rows = prints.select("node", "at").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("at").alias("at"))
    sent = staged(sent.join(rows, "node"), "jaccard-sent")
    texts = _with_key(addressed(docs, id_col, text_col).select("at", "text"), "at", sent.select("at").distinct())
    order = ["a", "part", "side"]
    met = (texts.join(sent, "at").select(*order, "node", "text")
           .repartition(parts, "a", "part").sortWithinPartitions(*order))
    links = staged(met.mapInArrow(lambda b: _agree(b, words, percent), "a long, b long"), "jaccard-links")
    discard(pairs, sent)
    return links


# --- components --------------------------------------------------------------------

def _jump(up: DataFrame, times: int = 3) -> DataFrame:
    """Follow the links (node, root) to their roots' roots, ``times`` times;
    ``moved`` tells whether the last step still changed anything."""
    now = up
    for _ in range(times):
        high = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
        now = now.join(high, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved"))
        up = now.select("node", "root")
    return now


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge; equal roots: connected.

    Each round sends every node to its smallest neighbour, follows those
    links to their ends by pointer jumping, and contracts the edges.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "edges")
    label: DataFrame | None = None
    while not edges.isEmpty():
        up = (edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
              .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")))
              .groupBy("node").agg(F.min("root").alias("root")))
        while True:
            up = staged(_jump(staged(up, "parents")), "parents")
            moved = not up.filter("moved").isEmpty()
            up = up.select("node", "root")
            if not moved:
                break
        if label is None:
            label = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            label = staged(label.join(step, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "labels")
        ends = [up.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab"]
        edges = staged(edges.join(ends[0], "a").join(ends[1], "b").filter("ra <> rb")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    return label if label is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def star_labels(links: DataFrame) -> DataFrame:
    """(node, root) from links (centre a, node b) in one step: nodes with the
    same root are connected, though not every connection shows yet."""
    return staged(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "jaccard-stars")


# --- the R-tree ---------------------------------------------------------------------

def least_overlap(sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Overlap that two sets of these summed sizes need in order to link."""
    return -((-percent * sizes) // (100 + percent))


class CountTree:
    """R-tree over count vectors, bulk-loaded sort-tile-recursive: points are
    cut into slabs along the coordinate of the largest spread and each slab
    into leaves of ``LEAF`` points along the next (the set size counts as a
    coordinate); ``FANOUT`` neighbouring nodes make one of the level above. A
    node keeps its points' largest counts, smallest and largest size, and its
    components' range."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        self.order = self._tiles(np.column_stack([sizes, vectors]).astype(float))
        self.vectors = vectors[self.order]
        self.sizes, self.comps = sizes[self.order], comps[self.order]
        n = len(sizes)
        self.levels: list[dict] = []                 # from the leaves up; "at": first point of each node
        step = LEAF
        while True:
            at = np.arange(0, n, step)
            self.levels.append({"at": at, "most": np.maximum.reduceat(self.vectors, at, axis=0),
                                "small": np.minimum.reduceat(self.sizes, at), "large": np.maximum.reduceat(self.sizes, at)})
            if len(at) <= FANOUT:
                break
            step *= FANOUT
        self._find_components()
        self.starts, self.ends = self.levels[0]["at"], np.append(self.levels[0]["at"][1:], n)

    @staticmethod
    def _tiles(points: np.ndarray) -> np.ndarray:
        first, second = np.argsort(-points.var(axis=0), kind="stable")[:2]
        leaves = -(-len(points) // LEAF)
        slab = LEAF * -(-leaves // max(1, round(leaves ** 0.5)))
        by = np.argsort(points[:, first], kind="stable")
        return np.concatenate([p[np.argsort(points[p, second], kind="stable")]
                               for p in (by[i:i + slab] for i in range(0, len(by), slab))])

    def _find_components(self) -> None:
        for v in self.levels:
            v["low"] = np.minimum.reduceat(self.comps, v["at"])
            v["high"] = np.maximum.reduceat(self.comps, v["at"])

    def merge(self, old: int, new: int) -> None:
        """Make two components one."""
        moved = self.comps == old
        if moved.any():
            self.comps[moved] = new
            self._find_components()

    def _apart(self, other: "CountTree", level: int, i, j):
        """Whether two nodes hold points of different components."""
        v, w = self.levels[level], other.levels[level]
        return (v["low"][i] != v["high"][i]) | (w["low"][j] != w["high"][j]) | (v["low"][i] != w["low"][j])

    def _leaf_pairs(self, other: "CountTree", percent: int) -> Iterator[tuple[int, int]]:
        """Pairs of leaves that may hold a link, by descent from the top."""
        level = min(len(self.levels), len(other.levels)) - 1
        i, j = (x.ravel() for x in np.indices((len(self.levels[level]["at"]), len(other.levels[level]["at"]))))
        while True:
            v, w = self.levels[level], other.levels[level]
            ok = (100 * w["large"][j] >= percent * v["small"][i]) & (100 * v["large"][i] >= percent * w["small"][j])
            ok &= self._apart(other, level, i, j)
            if self is other:
                ok &= i <= j
            i, j = i[ok], j[ok]
            near = np.zeros(len(i), bool)
            for s in range(0, len(i), 4096):
                x, y = i[s:s + 4096], j[s:s + 4096]
                bound = np.minimum(v["most"][x], w["most"][y]).sum(axis=1)
                near[s:s + 4096] = bound >= least_overlap(v["small"][x] + w["small"][y], percent)
            i, j = i[near], j[near]
            if level == 0:
                break
            level -= 1
            step = np.arange(FANOUT)
            i = np.repeat(i[:, None] * FANOUT + step, FANOUT, axis=1).ravel()
            j = np.tile(j[:, None] * FANOUT + step, FANOUT).ravel()
            real = (i < len(self.levels[level]["at"])) & (j < len(other.levels[level]["at"]))
            i, j = i[real], j[real]
        # leaves most alike in their mean counts first: a forest then takes the likeliest pairs
        f, g, like = self._means(), other._means(), np.zeros(len(i))
        for s in range(0, len(i), 4096):
            x, y = f[i[s:s + 4096]], g[j[s:s + 4096]]
            like[s:s + 4096] = np.minimum(x, y).sum(axis=1) / np.maximum(x.sum(axis=1) + y.sum(axis=1), 1)
        by = np.argsort(-like, kind="stable")
        for x, y in zip(i[by].tolist(), j[by].tolist()):
            if self._apart(other, 0, x, y):              # components may have merged since
                yield x, y

    def _means(self) -> np.ndarray:
        return np.add.reduceat(self.vectors, self.starts, axis=0) / (self.ends - self.starts)[:, None]

    def pairs(self, other: "CountTree", percent: int = PERCENT) -> Iterator[tuple[list[int], list[int]]]:
        """Positions (in the given order of each tree) of pairs that may link,
        leaf by leaf, the likeliest first. The components are read anew for
        each pair of leaves, so the caller may merge them meanwhile."""
        for i, j in self._leaf_pairs(other, percent):
            p, q = slice(self.starts[i], self.ends[i]), slice(other.starts[j], other.ends[j])
            a, b = self.sizes[p][:, None], other.sizes[q][None, :]
            ok = (self.comps[p][:, None] != other.comps[q][None, :])
            ok &= (100 * b >= percent * a) & (100 * a >= percent * b)
            if self is other and i == j:
                ok = np.triu(ok, 1)
            x, y = np.nonzero(ok)
            if len(x):
                x, y = x + p.start, y + q.start
                need = least_overlap(self.sizes[x] + other.sizes[y], percent)
                bound = np.minimum(self.vectors[x], other.vectors[y]).sum(axis=1)
                hit = np.flatnonzero(bound >= need)
                hit = hit[np.argsort(-bound[hit] / need[hit], kind="stable")]
                yield self.order[x[hit]].tolist(), other.order[y[hit]].tolist()


class _Points:
    """A task's view of the nodes it has met: unpacked vectors and the bounds
    of pairs, kept within bounded memory."""

    def __init__(self, percent: int):
        self.percent = percent
        self.vectors: dict[int, np.ndarray] = {}
        self.bounds: dict[tuple[int, int], float] = {}
        self.left_out = False

    def vector(self, row: tuple) -> np.ndarray:
        node = row[0]
        if node not in self.vectors:
            if len(self.vectors) > 5_000:
                self.vectors.clear()
            self.vectors[node] = unpack_vector(row[4])
        return self.vectors[node]

    def bound(self, x: tuple, y: tuple) -> float:
        """Overlap bound of two rows against the overlap they need."""
        key = (x[0], y[0]) if x[0] < y[0] else (y[0], x[0])
        got = self.bounds.get(key)
        if got is None:
            if len(self.bounds) > 100_000:
                self.bounds.clear()
            f, g = self.vector(x), self.vector(y)
            if len(f) != len(g):
                n = min(len(f), len(g))
                f, g = fold(f, n), fold(g, n)
            need = -((-self.percent * (x[1] + y[1])) // (100 + self.percent))
            got = self.bounds[key] = int(np.minimum(f, g).sum()) / need
        return got

    def pairs(self, rows: list[tuple], every: bool) -> Iterator[tuple[int, int]]:
        """Positions of pairs of a cell's rows that may link. Unless ``every``
        pair is wanted, each pair found merges its components for the rest of
        the cell, so the pairs are a forest; ``left_out`` then says whether
        pairs were passed over for that."""
        tiles = sorted({r[3] for r in rows})
        parts = [[i for i, r in enumerate(rows) if r[3] == t] for t in tiles] if len(tiles) > 1 else [range(len(rows))]
        comp = [r[2] for r in rows]
        trees: list[CountTree] = []
        # a cell of two tiles compares across them; each tile meets itself in its own cell
        if len(rows) <= LEAF and len(parts) == 1:
            near = self._leaf(rows)
        else:
            trees = [CountTree(np.stack([fold(self.vector(rows[i]), GROUPS) for i in p]),
                               np.array([rows[i][1] for i in p]), np.array([rows[i][2] for i in p])) for p in parts]
            second = 1 if len(parts) == 2 else 0
            near = (([parts[0][i] for i in x], [parts[second][j] for j in y])
                    for x, y in trees[0].pairs(trees[second], self.percent))
        found = passed = False
        for x, y in near:
            for i, j in zip(x, y):
                if comp[i] == comp[j]:
                    passed = True
                elif self.bound(rows[i], rows[j]) >= 1:
                    found = True
                    yield i, j
                    if not every:
                        old, new = comp[j], comp[i]
                        comp = [new if c == old else c for c in comp]
                        for t in trees:
                            t.merge(old, new)
        # a leaf whose pairs all became connected meanwhile was passed over too
        self.left_out = not every and (passed or (len(rows) > LEAF and found))

    def _leaf(self, rows: list[tuple]) -> Iterator[tuple[list[int], list[int]]]:
        """Pairs of a block that is a single leaf, by size and component."""
        for i, x in enumerate(rows):
            for j in range(i + 1, len(rows)):
                y = rows[j]
                if x[2] != y[2] and 100 * x[1] >= self.percent * y[1] and 100 * y[1] >= self.percent * x[1]:
                    yield [i], [j]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(block, rows) of each (block, cell); a row is (node, n_shingles, comp,
    tile, vector). Rows come sorted by block and cell."""
    key, held = None, []
    for b in batches:
        if not b.num_rows:
            continue
        block, cell = b.column(0).to_numpy(), b.column(1).to_numpy()
        rows = list(zip(*(b.column(b.schema.get_field_index(c)).to_pylist()
                          for c in ("node", "n_shingles", "comp", "tile", "vector"))))
        change = (np.flatnonzero((np.diff(block) != 0) | (np.diff(cell) != 0)) + 1).tolist()
        for s, e in zip([0, *change], [*change, len(rows)]):
            if key is not None and key != (block[s], cell[s]):
                yield int(key[0]), held
                held = []
            key = (block[s], cell[s])
            held = rows[s:e] if not held else held + rows[s:e]
    if held:
        yield int(key[0]), held


def _cell_pairs(batches: Iterator[pa.RecordBatch], percent: int, last_round: bool) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b) of all cells. Before the last round only a
    forest of each cell's pairs is given, and the block where some were left out."""
    release_kept()
    points = _Points(percent)
    sent: set[tuple[int, int]] = set()
    out: list[tuple[int | None, int | None, int | None]] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["a", "b", "block"])

    for block, rows in _cells(batches):
        if len(rows) < 2:
            continue
        for x, y in points.pairs(rows, last_round):
            pair = min(rows[x][0], rows[y][0]), max(rows[x][0], rows[y][0])
            if pair[0] != pair[1] and pair not in sent:
                if len(sent) > 100_000:                 # only to send fewer repeats
                    sent.clear()
                sent.add(pair)
                out.append((*pair, None))
                if len(out) > 10_000:
                    yield batch()
                    out = []
        if points.left_out:
            out.append((None, None, block))
    if out:
        yield batch()


def repeated_keys(lists: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Which of the ``total`` hashes in a column of lists come more than once:
    their low bits (six more than their number needs), written, and the mask.

    What shuffles is three bytes a hash: keys go by their high bits to buckets
    of about 2**18, sorted, and only their low bits (24 at most) are sent."""
    size = int(total).bit_length()
    bits = max(10, size - 18)                                  # of the bucket
    low = max(0, size + 6 - bits)
    mask, rest = np.int64((1 << (bits + low)) - 1), np.int64((1 << low) - 1)
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(held))
        keys = keys[np.concatenate([[True] * len(keys[:2]), keys[2:] != keys[:-2]])]     # twice says as much as often
        at, end = _spans(keys >> low)
        raw = (keys & rest).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
        data = pa.Array.from_buffers(pa.binary(), len(at), [
            None, pa.py_buffer(np.append(at, len(keys)).astype(np.int32) * np.int32(3)), pa.py_buffer(raw.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(keys[at] >> low), data], ["bucket", "low"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        held, n = [], 0
        for b in batches:
            held.append(b.column(0).flatten().to_numpy() & mask)
            n += len(held[-1])
            if n >= KEYS:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def often(bucket: int, data: list[bytes]) -> pa.RecordBatch:
            raw = np.frombuffer(b"".join(data), np.uint8).reshape(-1, 3).astype(np.int64)
            keys = np.sort(raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16)
            again = np.unique(keys[1:][keys[1:] == keys[:-1]])
            return pa.RecordBatch.from_arrays([pa.array(again | np.int64(bucket) << np.int64(low))], ["key"])

        own, data = None, []
        for b in batches:
            for bucket, low_bits in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if bucket != own and data:
                    yield often(own, data)
                    data = []
                own = bucket
                data.append(low_bits)
        if data:
            yield often(own, data)

    dealt = lists.mapInArrow(deal, "bucket long, low binary").repartition(parts, "bucket").sortWithinPartitions("bucket")
    return staged(dealt.mapInArrow(count, "key long"), "jaccard-often"), int(mask)


def shared_blocks(prints: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (block, node, n_shingles, pos) of the blocks of more than one row,
    and a few more; ``pos`` is the shingle's place in its set's order.

    The shingles of all lists are counted by some bits of their hash; those on
    their own drop out before the rows shuffle, by a bit map while that stays
    sparse, else by a join with the counted keys, and so do nodes with fewer
    others than :func:`least_shared`. Only the prefix makes blocks.
    """
    total = prints.agg(F.sum(F.size("prefix"))).first()[0] or 0
    often, mask = repeated_keys(prints.select("prefix"), total)
    if _fits(often):
        bits, low = _bitmap(often), np.int64(mask)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lists = b.column(2)
                block = lists.flatten().to_numpy()
                sizes = lists.value_lengths().to_numpy()
                n = b.column(1).to_numpy()
                own = np.repeat(np.arange(len(sizes)), sizes)
                pos = np.arange(len(block)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                hit = in_bits((block & low).view(np.uint64), bits)
                enough = np.bincount(own[hit], minlength=len(sizes)) >= [least_shared(k, percent) for k in n.tolist()]
                first = pos < np.repeat([prefix_length(k, percent) for k in n.tolist()], sizes)
                hit = np.flatnonzero(hit & first & enough[own])
                at = pa.array(own[hit])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(pos[hit].astype(np.int32)), pa.array(block[hit])],
                    ["node", "n_shingles", "pos", "block"])

        rows = prints.select("node", "n_shingles", "prefix").mapInArrow(run, "node long, n_shingles long, pos int, block long")
        return rows.distinct()                                           # equal sets: one row
    rows = prints.select("node", "n_shingles", F.posexplode("prefix").alias("pos", "block"))
    rows = rows.withColumn("key", F.col("block").bitwiseAND(F.lit(mask).cast("long")))
    rows = staged(rows.join(often, "key", "left_semi").drop("key").distinct(), "jaccard-hits")
    need = F.greatest(F.lit(1), F.expr(f"({min(MORE, percent)} * n_shingles + 99) div 100"))
    enough = rows.groupBy("node", "n_shingles").agg(F.count("*").alias("hits")).filter(F.col("hits") >= need).select("node")
    first = F.col("n_shingles") - F.expr(f"({percent} * n_shingles + 99) div 100") + 1
    return rows.filter(F.col("pos") < first).join(enough, "node", "left_semi")


def _compatible(n: np.ndarray, pos: np.ndarray, comp: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of a block (sorted by set size) have a partner in another
    component whose size and place of the shingle allow a link. Both sets
    share the shingle; of the others before it at most the smaller number is
    shared, and so behind it."""
    keep = np.zeros(len(n), bool)
    last = np.searchsorted(n, (100 * n) // percent, side="right")     # partners up to this row
    for i in range(len(n) - 1):
        j = slice(i + 1, int(last[i]))
        if j.stop <= j.start:
            continue
        most = np.minimum(pos[i], pos[j]) + 1 + np.minimum(n[i] - pos[i], n[j] - pos[j]) - 1
        ok = (comp[j] != comp[i]) & (most >= least_overlap(n[i] + n[j], percent))
        if ok.any():
            keep[i] = True
            keep[j] |= ok
    return keep


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table]]:
    """Rows sorted by their first column, the block, as tables of whole blocks
    (True), and as parts of one block that is too large to look at whole (False)."""
    held: list[pa.RecordBatch] = []
    passing: int | None = None
    for b in batches:
        if not b.num_rows:
            continue
        block = b.column(0).to_numpy()
        if passing is not None:
            own = int(np.searchsorted(block != passing, True))
            yield False, pa.Table.from_batches([b.slice(0, own)])
            b, block = b.slice(own), block[own:]
            if not b.num_rows:
                continue
            passing = None
        if held and held[0].column(0)[0].as_py() != block[0]:
            yield True, pa.Table.from_batches(held)
            held = []
        cut = int(np.searchsorted(block, block[-1], side="left"))     # the last block may go on
        if cut:
            yield True, pa.Table.from_batches([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
        if sum(x.num_rows for x in held) > TILE:
            yield False, pa.Table.from_batches(held)
            held, passing = [], int(block[-1])
    if held:
        yield True, pa.Table.from_batches(held)


def _spans(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row of each block, and the row after its last."""
    change = np.flatnonzero(np.diff(block)) + 1
    return np.concatenate([[0], change]), np.concatenate([change, [len(block)]])


def _compatible_rows(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (block, n_shingles, node, comp, pos), sorted by block and size,
    that have a compatible partner; all rows of a block too large to look at whole."""
    for whole, t in _by_block(batches):
        if whole:
            block, n, pos, comp = (t[c].to_numpy() for c in ("block", "n_shingles", "pos", "comp"))
            keep = np.zeros(len(block), bool)
            for a, b in zip(*(x.tolist() for x in _spans(block))):
                if b - a > 1:
                    keep[a:b] = _compatible(n[a:b], pos[a:b], comp[a:b], percent)
            t = t.filter(pa.array(keep))
        yield from t.combine_chunks().to_batches()


def _sized_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by block, with their block's number of rows ``k`` and a
    hash of its set of nodes; null for a block too large to look at whole."""
    for whole, t in _by_block(batches):
        k = nodes = pa.nulls(t.num_rows, pa.int64())
        if whole and t.num_rows:
            a, b = _spans(t["block"].to_numpy())
            k = pa.array(np.repeat(b - a, b - a))
            total = np.add.reduceat(mix(t["node"].to_numpy().view(np.uint64) + _BASE), a)     # in any order
            nodes = pa.array(np.repeat(total.view(np.int64), b - a))
        yield from t.append_column("k", k).append_column("nodes", nodes).combine_chunks().to_batches()


def crossing(rows: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Rows of blocks that hold several components and can hold a link, with
    comp and the block's number of rows. Near copies meet in a block for each
    shingle they share; of blocks of the same nodes only one goes on."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = rows.join(label, "node", "left").select("block", "n_shingles", "node", F.coalesce("root", "node").alias("comp"), "pos")
    known = known.repartition(parts, "block").sortWithinPartitions("block", "n_shingles")
    out = staged(known.mapInArrow(lambda b: _sized_rows(_compatible_rows(b, percent)), extended(known, "k long, nodes long")),
                 "jaccard-cross")
    seen = out.filter("k IS NOT NULL")
    once = staged(seen.groupBy("nodes").agg(F.min("block").alias("block")).select("block"), "jaccard-once")
    seen = _with_key(seen, "block", once).drop("nodes")
    # the few blocks that no task saw whole are counted here
    large = out.filter("k IS NULL").drop("k", "nodes")
    sizes = staged(large.groupBy("block").agg(F.count("*").alias("k")), "jaccard-sizes")
    return seen if sizes.isEmpty() else seen.unionByName(large.join(sizes, "block"))


def candidates(rows: DataFrame, points: DataFrame, percent: int, tile: int, last_round: bool) -> DataFrame:
    """(a, b, block): pairs of nodes in different components that may link,
    and blocks where pairs were left out (see :func:`_cell_pairs`)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # cell (i, j), i <= j: tiles i and j of a block; a node goes to the cells of its tile
    rows = (rows.withColumn("tiles", F.ceil(F.col("k") / tile).cast("int"))
            .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .withColumn("cell", F.least("tile", "other").cast("long") * F.col("tiles") + F.greatest("tile", "other")))
    rows = (rows.join(points, "node")
            .select("block", "cell", "tile", "node", "comp", "n_shingles", "vector")
            .repartition(parts, "block", "cell").sortWithinPartitions("block", "cell"))
    return rows.mapInArrow(lambda b: _cell_pairs(b, percent, last_round), "a long, b long, block long").distinct()


def centre_pairs(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, na, nb): each node and the smallest node among those that share
    one of its least shingles, with their sizes, where these allow a link."""
    rows = nodes.select(F.explode("least").alias("block"), "node", "n_shingles")
    # written first, so that the join with it can split a block that many nodes share
    first = staged(rows.groupBy("block").agg(F.min(F.struct("node", "n_shingles")).alias("c"), F.count("*").alias("k"))
                   .filter("k > 1").select("block", F.col("c.node").alias("centre"), F.col("c.n_shingles").alias("m")),
                   "jaccard-first")
    pairs = rows.join(first, "block").filter("node <> centre")
    pairs = pairs.filter((100 * F.col("m") >= percent * F.col("n_shingles"))
                         & (100 * F.col("n_shingles") >= percent * F.col("m")))
    return pairs.select(F.col("centre").alias("a"), F.col("node").alias("b"), F.col("m").alias("na"),
                        F.col("n_shingles").alias("nb")).distinct()


def vectors_of(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, vector) of the given nodes (written, distinct). Vectors of others
    do not shuffle: a semi-join would be pushed below the bit map."""
    return _with_key(prints.select("node", "vector"), "node", nodes).join(nodes, "node").dropDuplicates(["node"])


def likely(pairs: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose count vectors allow a link, written."""
    pairs = staged(pairs, "jaccard-pairs")
    ends = staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "jaccard-ends")
    v = staged(vectors_of(prints, ends), "jaccard-vectors")
    both = (pairs.join(v.select(F.col("node").alias("a"), F.col("vector").alias("va")), "a")
            .join(v.select(F.col("node").alias("b"), F.col("vector").alias("vb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = _Points(percent)
        for x in batches:
            col = {n: x.column(i).to_pylist() for i, n in enumerate(x.schema.names)}
            rows = zip(col["a"], col["na"], col["va"], col["b"], col["nb"], col["vb"])
            ok = [points.bound((a, na, 0, 0, va), (b, nb, 0, 0, vb)) >= 1 for a, na, va, b, nb, vb in rows]
            hit = x.filter(pa.array(ok, pa.bool_()))
            yield hit.select(["a", "b"])

    out = staged(both.select("a", "b", "na", "nb", "va", "vb").mapInArrow(run, "a long, b long"), "jaccard-centres")
    discard(pairs, ends, v)
    return out


def _linked(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, percent: int = PERCENT,
            tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """The :func:`fingerprints` of every row, written, and (node, root) of the
    nodes on a link: equal roots are one component."""
    prints = staged(fingerprints(docs, id_col, text_col, words, percent), "jaccard-prints")
    sets = prints.filter("node IS NOT NULL")
    check = lambda pairs: verified(pairs, sets, docs, id_col, text_col, words, percent)
    near = likely(centre_pairs(sets, percent), sets, percent)
    links = check(near)
    label = star_labels(links)
    rows = staged(shared_blocks(sets, percent), "jaccard-shared")
    for n in range(ROUNDS):
        cross = crossing(rows, label, percent)
        discard(rows)
        nodes = staged(cross.select("node").distinct(), "jaccard-nodes")
        points = staged(vectors_of(sets, nodes), "jaccard-points")
        found = staged(candidates(cross, points, percent, tile, n == ROUNDS - 1), "jaccard-candidates")
        discard(nodes, points)
        pairs = found.filter("a IS NOT NULL").select("a", "b")
        if not pairs.isEmpty():
            links = links.unionByName(check(pairs))
        label = components(links)
        left = found.filter("block IS NOT NULL").select("block").distinct()
        if left.isEmpty():
            break
        rows = staged(cross.drop("comp", "k").join(left, "block", "left_semi"), "jaccard-left")
        discard(cross)
    discard(cross)
    return prints, label


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: its id, n_shingles and component_id.
    ``options``: the ``words`` of a shingle, the ``percent`` of a link and the
    nodes of a ``tile``."""
    prints, label = _linked(docs, id_col, text_col, **options)
    # three numbers a row; the lists and vectors are no longer needed
    out = staged(_named(prints, label), "jaccard-components")
    discard(prints)
    return out.withColumnRenamed("id", id_col)


def _named(prints: DataFrame, label: DataFrame) -> DataFrame:
    """id, n_shingles and component_id (the smallest id of the component)."""
    own = prints.select("id", "n_shingles", "node").join(label, "node", "left")
    own = own.withColumn("group", F.coalesce("root", "node"))
    # only groups of several rows need the join back
    first = staged(own.filter("group IS NOT NULL").groupBy("group")
                   .agg(F.min("id").alias("component_id"), F.count("*").alias("k")).filter("k > 1").drop("k"),
                   "jaccard-names")
    return (own.join(first, "group", "left")
            .select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: a row with its smallest
    id, and of several such rows the one whose text hashes least. Whether a
    row stays hangs on the row, not on its id alone: rows that share an id
    but not a component are told apart by their set. Rows without shingles
    all stay; rows without an id stay only where no row of the component has one.

    ``docs`` is read several times and should come from files; no copy of it
    is written. Rows are told apart by their address; of rows that repeat id
    and text, which share it, the first stays."""
    plain, names = numbered(docs)
    key, text = names[id_col], names[text_col]
    prints, label = _linked(plain.select(key, text), key, text, **options)
    own = (prints.filter("node IS NOT NULL").select("id", "at", "hash", "node").join(label, "node", "left")
           .withColumn("group", F.coalesce("root", "node")))
    order = F.struct(F.col("id").isNull().alias("n"), F.col("id"), F.col("hash"), F.col("at"))
    groups = own.groupBy("group").agg(F.min(order).alias("k"), F.count("*").alias("n")).filter("n > 1")
    stays = staged(groups.select("group", F.col("k.at").alias("stays")), "jaccard-stays")
    members = staged(own.join(stays, "group").groupBy("at").agg(F.first(F.col("at") == F.col("stays")).alias("stays"),
                                                               F.count("*").alias("n")), "jaccard-members")
    discard(prints, stays)
    gone = staged(members.filter("NOT stays").select(F.col("at").alias("_at")), "jaccard-gone")
    twice = staged(members.filter("stays AND n > 1").select(F.col("at").alias("_at")), "jaccard-twice")
    rows = plain.withColumn("_at", F.xxhash64(key, text)).withColumn("_nth", F.monotonically_increasing_id())
    out, _ = _split_by_key(rows, "_at", gone)
    out, again = _split_by_key(out, "_at", twice)
    if again is not None:
        first = again.groupBy("_at").agg(F.min_by(F.struct(*plain.columns), "_nth").alias("row"))
        out = out.select(*plain.columns).unionByName(first.select("row.*"))
    return out.select(*plain.columns).toDF(*docs.columns)


def with_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with n_shingles and component_id (joined by the id, a key)."""
    docs = rename_clashes(docs, ["n_shingles", "component_id"])
    return docs.join(similar_components(docs, id_col, text_col, **options), id_col, "left")
