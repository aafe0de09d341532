"""Registered queries of this package: ``opN_<name>`` and their DuckDB twins.

Each applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (chat, decontaminate, exact_dedup, infill, jaccard_join, language_id, packing, piecewise, quality, sharding, token_store,
               whitening, wordpiece)
from .common import ASCII_LOWER, ASCII_UPPER, id_remainder, staged, table, tokenizer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


@register(f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document (two-pass Bloom filter)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def learn_languages(docs: DataFrame) -> dict[str, list[int]]:
    """Profiles from the rows outside the held-out third."""
    return language_id.learn_profiles(docs.filter(id_remainder("doc_id", 3) != 1))


@register()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by rank-order profiles."""
    docs = table(spark, sf_dir, "documents")
    profiles = learn_languages(docs.select("doc_id", "text", "lang"))
    found = language_id.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


_OP9_WORDS = "regexp_extract_all(translate(text, '{u}', '{l}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(
    u=ASCII_UPPER, l=ASCII_LOWER)


@register(f"""
WITH d AS (SELECT doc_id, coalesce({_OP9_WORDS}, []) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id, {_OP9_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[j:j + n - 1], ' ') AS k FROM (
  SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM (
    SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0))),
hits AS (SELECT p.doc_id, p.p, s.n, s.item_id FROM win s JOIN (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS k FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)) p
  ON p.k = s.k AND p.n = s.n),
hw AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
  SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN hi ON hi.doc_id = d.doc_id""")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, sf_dir, "benchmark")).drop("text")
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select("doc_id", "n_words", "n_hit", F.size(items).cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@register(f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id""")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.8."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.similar_components(docs).select("doc_id", "n_shingles", "component_id")


@register()
def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to a store and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = token_store.store(docs, scratch_path(spark, "token-store"), tokenizer("word_bpe_49k.json"), 1, spaced=False)
    return packing.with_crc(back.withColumnRenamed("id", "doc_id"), "n_tokens")


def packed_digest(docs: DataFrame) -> DataFrame:
    """Pieces of ``docs`` with their places; the ids as a checksum."""
    made = staged(packing.token_pieces(docs.select("doc_id", "text"), tokenizer("byte_bpe_50k.json"), 0), "pack-pieces")
    return packing.place(made, digest=True)


@register()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document packed into sequences of 1024 ids."""
    return packed_digest(table(spark, sf_dir, "documents"))


@register()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document (hashed n-grams, FTRL)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 5) != 0)
    scored = quality.score(docs, quality.train(docs, labels)).drop("text")
    return scored.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


SHARDS = [f"shard-{i:03d}" for i in range(32)]
_SHARD_SLOTS = sharding.next_prime(sharding.SLOTS_PER_SHARD * len(SHARDS))


def _hex60(text: str, at: int) -> str:
    return f"CAST(('0x' || substr(md5({text}), {at}, 15)) AS BIGINT)"


# the table filled one claim at a time: t holds the owners, p the next place of each shard's order
@register(f"""
WITH RECURSIVE s AS MATERIALIZED (SELECT list(o ORDER BY i) AS o, list(k ORDER BY i) AS k FROM (
  SELECT i, {_hex60("n", 1)} % {_SHARD_SLOTS} AS o, {_hex60("n", 17)} % {_SHARD_SLOTS - 1} + 1 AS k
  FROM (SELECT i, printf('shard-%03d', i) AS n FROM range({len(SHARDS)}) r(i)))),
f AS (
  SELECT 0 AS turn, list_transform(range({_SHARD_SLOTS}), lambda x: -1) AS t, list_transform(range({len(SHARDS)}), lambda x: 0) AS p
  UNION ALL
  SELECT turn + 1, list_concat(list_concat(t[1:slot], [who]), t[slot + 2:]), list_concat(list_concat(p[1:who], [j + 1]), p[who + 2:])
  FROM (SELECT *, (o[who + 1] + j * k[who + 1]) % {_SHARD_SLOTS} AS slot FROM (
    SELECT turn, t, p, o, k, turn % {len(SHARDS)} AS who,
      list_min(list_filter(range(p[turn % {len(SHARDS)} + 1], {_SHARD_SLOTS}),
        lambda x: t[(o[turn % {len(SHARDS)} + 1] + x * k[turn % {len(SHARDS)} + 1]) % {_SHARD_SLOTS} + 1] < 0)) AS j
    FROM f, s WHERE turn < {_SHARD_SLOTS}))),
w AS (SELECT t FROM f WHERE turn = {_SHARD_SLOTS}),
d AS (SELECT doc_id, {_hex60("coalesce(CAST(doc_id AS VARCHAR), 'null')", 1)} % {_SHARD_SLOTS} AS slot FROM documents)
SELECT doc_id, slot, printf('shard-%03d', t[slot + 1]) AS shard FROM d, w""")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.assign(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


@register()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece tokens of every document, without building pieces."""
    initial, continuing = wordpiece.sentencepiece_vocabulary(tokenizer("piece_bpe_32k.model"))
    return wordpiece.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), initial, continuing).drop("text")


@register("""
WITH RECURSIVE u AS (SELECT conv_id, turn + 1 AS turn, min(text) AS asked FROM conversations WHERE role = 'user' GROUP BY 1, 2),
said AS (SELECT c.conv_id, c.turn, u.asked, length(u.asked) AS n, coalesce(length(u.asked) < 60, false) AS short
  FROM conversations c LEFT JOIN u ON u.conv_id = c.conv_id AND u.turn = c.turn WHERE c.role = 'assistant'),
calls AS MATERIALIZED (SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, CASE WHEN short THEN 'lookup' ELSE 'search' END AS name,
  asked, n, CASE WHEN short THEN turn + 2 END AS needs_turn FROM said),
results AS (SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, text AS content FROM conversations
  WHERE role = 'system' OR (role = 'assistant' AND length(text) >= 40)),
chain AS (SELECT conv_id, turn, turn AS pos, 0 AS s FROM calls
  UNION ALL SELECT h.conv_id, h.turn, c.needs_turn, h.s + 1 FROM chain h
  JOIN calls c ON c.conv_id = h.conv_id AND c.turn = h.pos JOIN calls o ON o.conv_id = c.conv_id AND o.turn = c.needs_turn
  WHERE c.needs_turn > c.turn AND h.pos = h.turn + 2 * h.s),
k AS (SELECT conv_id, turn, max(pos) AS order_turn, CAST(max(s) AS INT) AS order_step FROM chain GROUP BY 1, 2)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, coalesce(c.turn, r.turn) AS turn,
  coalesce(k.order_turn, r.turn) AS order_turn, coalesce(k.order_step, 0) AS order_step,
  CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'missing' ELSE 'linked' END AS status,
  CASE WHEN c.call_id IS NULL THEN '' WHEN c.asked IS NULL THEN
    CASE WHEN c.name = 'search' THEN 'missing:limit,missing:text' ELSE 'missing:text' END
  ELSE concat_ws(',', CASE WHEN n % 7 = 0 THEN 'type:limit' END, CASE WHEN n % 5 = 0 THEN 'unexpected:extra' END) END AS errors,
  '{"arguments":' || CASE WHEN c.call_id IS NULL THEN 'null' WHEN c.asked IS NULL THEN '{}' ELSE
    '{' || CASE WHEN n % 5 = 0 THEN '"extra":true,' ELSE '' END || '"limit":' ||
    CASE WHEN n % 7 = 0 THEN '"' || n || '"' ELSE CAST(n AS VARCHAR) END || ',"text":' || CAST(to_json(c.asked) AS VARCHAR) || '}' END
  || ',"id":' || to_json(coalesce(c.call_id, r.call_id)) || ',"name":' || coalesce(CAST(to_json(c.name) AS VARCHAR), 'null')
  || ',"result":' || coalesce(CAST(to_json(r.content) AS VARCHAR), 'null') || '}' AS json
FROM calls c FULL OUTER JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
LEFT JOIN k ON k.conv_id = c.conv_id AND k.turn = c.turn""")
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls of every conversation, linked, ordered, checked, as canonical JSON."""
    calls, results = chat.derive_tool_turns(table(spark, sf_dir, "conversations"))
    return chat.format_calls(calls, results, chat.SCHEMAS)


@register()
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document (seekable compressed frames)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = staged(infill.frame_store(docs), "infill-frames")
    return infill.digests(infill.transform(store)).withColumnRenamed("id", "doc_id")


@register()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened values of every embedding (pivoted Cholesky, one-sided Jacobi)."""
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@register()
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piecewise fingerprints of every document, its edited text and the next document."""
    return piecewise.compare_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
