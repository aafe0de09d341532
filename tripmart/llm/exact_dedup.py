"""Exact de-duplication with a two-pass Bloom filter (DataFrame functions only).

Pass 1 hashes every text and sets two bits per text in a blocked Bloom
filter (both bits in one 64-bit word); a bit that two rows or more set is
kept. The hash rows (id and hash, no texts) whose two bits are both shared
*may* be repeated and are grouped exactly by SHA-256; every other row is
certainly unique. Pass 2 probes the rows themselves: those of groups found
repeated meet their decision, all others pass straight through, without a
shuffle. Rows that carry more than id and text are probed with a second,
smaller filter of the hashes found repeated.

Texts are equal when identical after lower-casing A-Z only; a null text
counts as empty. Of equal texts the row with the largest id stays.

Defined cases: null ids lose against any id (a group of only null ids keeps
them); rows that repeat both id and text share one decision, and
:func:`drop_exact_copies` leaves exactly one of them; an empty table gives
an empty result; input columns named like a result column are replaced.

Scale: the hash rows shuffle as 8-byte bit positions, combined before the
shuffle. A filter is broadcast as blocks of ``BLOCK`` words found by block
number, about 9 bytes a word: ``broadcast_words`` (2**24, 67 million rows,
150 MB by default) bounds what an executor holds. A larger filter is
cut into segments of that size and each takes a pass of its own, whose rows
are written to the shared folder; still nothing but possibly repeated rows
shuffles. The passes over whole rows follow the number of repeated hashes
only. A cluster with more memory an executor takes a larger
``broadcast_words`` and so fewer passes.

A group of copies holding a third of all rows is one row per task in both
aggregates. Decisions of groups of more than rows / partitions rows (fewer
groups than shuffle partitions) are broadcast, so their rows do not shuffle;
only the rows of smaller groups meet their decision in a shuffled join.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ASCII_LOWER, ASCII_UPPER, numbered, rename_clashes, staged

BITS_PER_ROW = 16
BLOCK = 64                     # words a row of a broadcast filter holds
BROADCAST_WORDS = 1 << 24      # words of one segment of a filter
RESULT = ["keep_id", "group_size", "kept", "text_sha256"]


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only. An all-ASCII text (as many bytes as characters)
    takes the fast built-in, any other the character map."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, ASCII_UPPER, ASCII_LOWER))


def text_hash(text_col: str) -> Column:
    """SHA-256 (lowercase hex) of the normalised text in UTF-8."""
    return F.sha2(lower_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("binary"), 256)


def _with_bits(hashed: DataFrame, words: int) -> DataFrame:
    """Word number and the two bits of each row's hash."""
    h = F.xxhash64("text_sha256")
    return (hashed.withColumn("_h", h)
            .withColumn("_word", F.pmod(F.col("_h"), F.lit(words)))
            .withColumn("_b1", F.shiftrightunsigned("_h", 52).bitwiseAND(63).cast("int"))
            .withColumn("_b2", F.shiftrightunsigned("_h", 58).cast("int"))
            .drop("_h"))


def filter_words(rows: int, bits_per_row: int = BITS_PER_ROW) -> int:
    """Words of a filter of ``rows`` hashes (a power of two)."""
    return 1 << max(4, (max(1, rows) * bits_per_row // 64).bit_length())


def bloom_filter(hashed: DataFrame, words: int, setters: int) -> DataFrame:
    """The bits that ``setters`` rows or more set, as dense blocks of words:
    (_block, _words). Blocks without a bit are left out."""
    bits = (_with_bits(hashed, words)
            .select(F.explode(F.array(F.col("_word") * 64 + F.col("_b1"), F.col("_word") * 64 + F.col("_b2")))
                    .alias("_pos")))
    held = bits.groupBy("_pos").agg(F.count("*").alias("_n")).filter(F.col("_n") >= setters)
    found = (held.groupBy(F.shiftright("_pos", 6).alias("_fword"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_pos & 63 AS INT))")).alias("_bits")))
    block, place = F.expr(f"_fword div {BLOCK}"), F.expr(f"CAST(_fword % {BLOCK} AS INT)")
    blocks = found.groupBy(block.alias("_block")).agg(F.collect_list(F.struct(place.alias("at"), "_bits")).alias("_set"))
    # every place of the block once, with its bits or none; then in order
    holes = F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)),
                        lambda at: F.struct(at.alias("at"), F.lit(0).cast("bigint").alias("_bits")))
    free = F.filter(holes, lambda x: ~F.array_contains(F.transform("_set", lambda y: y["at"]), x["at"]))
    return blocks.select("_block", F.transform(F.array_sort(F.concat("_set", free)), lambda x: x["_bits"]).alias("_words"))


def probe(rows: DataFrame, blocks: DataFrame, words: int, segment: int, segment_words: int) -> DataFrame:
    """The rows of one segment of a filter, with ``_maybe``: both bits are set.
    The segment (at most ``segment_words`` words) is broadcast."""
    first, last = segment * segment_words, min(words, (segment + 1) * segment_words) - 1
    mine = _with_bits(rows, words)
    if segment_words < words:
        mine = mine.filter(F.col("_word").between(first, last))
        blocks = blocks.filter(F.col("_block").between(first // BLOCK, last // BLOCK))
    both = F.expr("shiftleft(1L, _b1) | shiftleft(1L, _b2)")
    word = F.expr(f"get(_words, CAST(_word % {BLOCK} AS INT))")
    return (mine.withColumn("_at", F.expr(f"_word div {BLOCK}"))
            .join(F.broadcast(blocks), F.col("_at") == F.col("_block"), "left")
            .withColumn("_maybe", F.coalesce(word.bitwiseAND(both) == both, F.lit(False)))
            .drop("_word", "_at", "_block", "_words", "_b1", "_b2"))


def _passes(words: int, segment_words: int, one: Callable[[int], DataFrame], name: str) -> DataFrame:
    """``one(segment)`` of every segment; more than one segment are run in
    turn and written, so that an executor holds one of them at a time."""
    count = -(-words // segment_words)
    if count == 1:
        return one(0)
    first = one(0)
    path = scratch_path(first.sparkSession, name)
    first.write.parquet(path)
    for segment in range(1, count):
        one(segment).write.mode("append").parquet(path)
    return first.sparkSession.read.schema(first.schema).parquet(path)


def exact_groups(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 bits_per_row: int = BITS_PER_ROW, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """``rows`` with keep_id, group_size, kept and text_sha256 on every row.

    Texts are read once to fingerprint them (id and hash, staged in the
    shared folder) and once more a segment of the filter of repeated hashes
    if ``rows`` carries other columns than id and text.
    """
    rows = rename_clashes(rows, RESULT)
    key = F.col(f"`{id_col}`")
    hashed = staged(rows.select(key.alias("_id"), text_hash(text_col).alias("text_sha256")), "exact-hash")
    total = hashed.count()
    words = filter_words(total, bits_per_row)
    shared = staged(bloom_filter(hashed, words, 2), "exact-bloom")
    probed = _passes(words, broadcast_words, lambda s: probe(hashed, shared, words, s, broadcast_words), "exact-probed")
    groups = staged(probed.filter("_maybe").groupBy(F.col("text_sha256").alias("_sha"))
                    .agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size"))
                    .filter("group_size > 1"), "exact-groups")
    share = total // int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = F.broadcast(groups.filter(F.col("group_size") > share)       # fewer groups than partitions
                        .toDF("_large", "_keep", "_size"))
    small = groups.filter(F.col("group_size") <= share)

    def decided(flagged: DataFrame) -> DataFrame:
        keep = [F.col(f"`{c}`") for c in flagged.columns if c != "_maybe"]
        known = flagged.join(large, F.col("_maybe") & (F.col("text_sha256") == F.col("_large")), "left")
        straight = (known.filter("NOT _maybe OR _large IS NOT NULL")         # unique, or of a large group
                    .withColumn("keep_id", F.when(F.col("_large").isNull(), key).otherwise(F.col("_keep")))
                    .withColumn("group_size", F.coalesce("_size", F.lit(1).cast("bigint")))
                    .select(*keep, "keep_id", "group_size"))
        multi = known.filter("_maybe AND _large IS NULL").select(*keep)
        multi = (multi.join(small.toDF("_sha", "_keep", "_size"), F.col("text_sha256") == F.col("_sha"), "left")
                 .withColumn("keep_id", F.when(F.col("_sha").isNull(), key).otherwise(F.col("_keep")))
                 .withColumn("group_size", F.coalesce("_size", F.lit(1).cast("bigint")))
                 .select(*keep, "keep_id", "group_size"))
        return straight.unionByName(multi).withColumn("kept", key.eqNullSafe(F.col("keep_id")))

    if set(rows.columns) <= {id_col, text_col}:    # decisions only: the hashes suffice
        return decided(probed.withColumnRenamed("_id", id_col))
    again = groups.select(F.col("_sha").alias("text_sha256"))
    words2 = filter_words(again.count(), bits_per_row)
    known = staged(bloom_filter(again, words2, 1), "exact-bloom-known")
    full = rows.withColumn("text_sha256", text_hash(text_col))
    return _passes(words2, broadcast_words,
                   lambda s: decided(probe(full, known, words2, s, broadcast_words)), "exact-decided")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns only.

    Unique rows pass straight through; only rows that may be repeated
    shuffle. Rows repeating id and text are reduced to one of them.
    """
    plain, names = numbered(docs)
    # a constant column makes the call carry every column of the rows
    out = exact_groups(plain.withColumn("_row", F.lit(1)), names[id_col], names[text_col]).filter("kept")
    alone = out.filter("group_size = 1")
    again = out.filter("group_size > 1").dropDuplicates([names[id_col], "text_sha256"])
    return alone.unionByName(again).select(*plain.columns).toDF(*docs.columns)
