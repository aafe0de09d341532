"""Chat formatting: link tool calls to results, order them, check their
arguments, and write canonical JSON (DataFrame functions only).

``calls``: conv_id, turn, call_id, name, arguments (JSON text) and needs (the
id of a call of the same conversation whose result it uses, or null).
``results``: conv_id, turn, call_id, content.

* Linking is a hash join on (conv_id, call_id). A call without a result is
  ``missing``, a result without a call ``orphan``. Of calls or results with
  the same id the first (by turn, then content) counts, the others are
  ``repeated``.
* Order is topological: a call sorts by (order_turn, order_step), its own
  turn and 0, or, where it needs a later call, that call's key one step on;
  so it always follows what it needs, and calls that need nothing late keep
  their turn. Keys settle in as many rounds as the longest chain of
  references to later turns. A call that waits for itself through others is
  in a cycle: it keeps its own key and gets the error ``cycle``.
* Arguments are held against the tool's schema: known tool, JSON object,
  required fields present, declared types, no other fields.
* JSON is canonical: keys sorted, no blanks, texts unescaped but for what
  JSON requires.

Defined cases: null conv_id or call_id rows are kept and link with nothing;
null or broken arguments give the error ``not an object`` and JSON null; a
null name is an ``unknown tool``; a call without a turn links as any other and
takes its result's turn, or comes first where that is null too;
empty tables give an empty result; other input columns are not read. One
conversation may hold any share of the rows: nothing gathers a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, staged

#: JSON types of a declared field, as Spark's variant functions name them.
TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE"], "boolean": ["BOOLEAN"]}


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls with their results: conv_id, turn, call_id, name, arguments,
    needs, content, status (linked, missing, orphan or repeated), is_call."""
    key = ["conv_id", "call_id"]

    def first(df: DataFrame, *order: str) -> DataFrame:
        """Number the rows of an id; a window over (conversation, id), so its
        groups are the repeats of one id. Null ids are never numbered."""
        w = Window.partitionBy(*key, F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(),
                                            F.monotonically_increasing_id())).orderBy(*order)
        return df.withColumn("_n", F.row_number().over(w))

    # which side a row is from is a flag: turn, name and content may be null on either
    c = first(calls.select(*key, "turn", "name", "arguments", "needs", F.lit(True).alias("is_call")),
              "turn", "arguments", "name", "needs")
    r = first(results.select(*key, "turn", "content", F.lit(True).alias("is_result")), "turn", "content")
    both = (c.filter("_n = 1").drop("_n").alias("c")
            .join(r.filter("_n = 1").drop("_n").alias("r"), key, "full_outer"))
    linked = both.select(
        *key, F.coalesce("c.turn", "r.turn").alias("turn"), "name", "arguments", "needs", "content",
        F.when(F.col("is_call").isNull(), "orphan").when(F.col("is_result").isNull(), "missing")
        .otherwise("linked").alias("status"), F.coalesce("is_call", F.lit(False)).alias("is_call"))
    again = c.filter("_n > 1").select(*key, "turn", "name", "arguments", "needs", F.lit(None).cast("string").alias("content"),
                                      F.lit("repeated").alias("status"), F.lit(True).alias("is_call"))
    extra = r.filter("_n > 1").select(*key, "turn", *[F.lit(None).cast("string").alias(x) for x in ("name", "arguments", "needs")],
                                      "content", F.lit("repeated").alias("status"), F.lit(False).alias("is_call"))
    return linked.unionByName(again).unionByName(extra)


def _follow(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Keys of the calls of ``edges`` (conv_id, call_id, own, needs, first) by
    pointer doubling: conv_id, call_id, k, and the rows whose chain never ends
    (they lead into a cycle; None if there are none), with the call a power of
    two of steps on (``next``, on the cycle).

    After r rounds a row holds the largest key of its next 2**r calls and
    points 2**r calls on, to null once its chain has ended.
    """
    step = lambda k, n: F.struct(k["t"].alias("t"), (k["s"] + n).alias("s"), k["a"].alias("a"))
    rows = staged(edges.select("conv_id", "call_id", F.greatest("own", step(F.col("first"), 1)).alias("k"),
                               F.col("needs").alias("next")), "chat-keys")
    longest = None
    reach = 1
    while not rows.filter("next IS NOT NULL").isEmpty():
        if longest is None:             # no chain without a cycle is longer than its conversation
            longest = rows.groupBy("conv_id").count().agg(F.max("count")).first()[0]
        if reach > longest:
            return rows.filter("next IS NULL"), rows.filter("next IS NOT NULL")
        ahead = rows.select("conv_id", F.col("call_id").alias("next"), F.col("k").alias("nk"), F.col("next").alias("after"))
        moved = (rows.filter("next IS NOT NULL").join(ahead, ["conv_id", "next"], "left")
                 .select("conv_id", "call_id", F.greatest("k", F.when(F.col("nk").isNotNull(), step(F.col("nk"), reach))).alias("k"),
                         F.col("after").alias("next")))
        now = staged(rows.filter("next IS NULL").unionByName(moved), "chat-keys")
        discard(rows)
        rows, reach = now, 2 * reach
    return rows, None


def order(linked: DataFrame) -> DataFrame:
    """``linked`` with order_turn, order_step and cyclic.

    A key is (turn, step, call it goes back to); a call takes the largest of
    its own key and the keys of the calls along its chain of needs, one step
    on for each. A cycle is cut at its latest call, which keeps its own key;
    the calls that lead there are then followed once more.
    """
    own = linked.filter("status IN ('linked', 'missing')")
    key = F.struct(F.col("turn").alias("t"), F.lit(0).cast("bigint").alias("s"), F.col("call_id").alias("a"))
    ids = own.select("conv_id", "call_id", "needs", key.alias("own"))
    target = ids.select("conv_id", F.col("call_id").alias("needs"), F.col("own").alias("first"))
    edges = staged(ids.join(target, ["conv_id", "needs"]), "chat-needs")
    keys, looped = _follow(edges)
    keys = keys.select("conv_id", "call_id", F.col("k").alias("late"), F.lit(False).alias("cyclic"))
    if looped is not None:
        # each call of a cycle is some call's ``next``, and its key holds the cycle's latest turn
        ring = looped.select("conv_id", F.col("next").alias("call_id")).distinct()
        ring = looped.join(ring, ["conv_id", "call_id"]).select(
            "conv_id", "call_id", F.col("k.t").alias("latest"), F.lit(True).alias("in_ring"))
        open_ = edges.join(looped.select("conv_id", "call_id"), ["conv_id", "call_id"]).join(ring, ["conv_id", "call_id"], "left")
        cut = F.coalesce("in_ring", F.lit(False)) & F.col("own.t").eqNullSafe(F.col("latest"))
        parted = staged(open_.withColumn("cut", cut).drop("latest", "in_ring"), "chat-cycles")
        rest, endless = _follow(parted.filter("NOT cut").drop("cut"))
        assert endless is None                  # every cycle is cut
        keys = (keys.unionByName(rest.select("conv_id", "call_id", F.col("k").alias("late"), F.lit(False).alias("cyclic")))
                .unionByName(parted.filter("cut").select("conv_id", "call_id", F.col("own").alias("late"),
                                                         F.lit(True).alias("cyclic"))))
    out = linked.join(keys, ["conv_id", "call_id"], "left")
    ordered = F.col("status").isin("linked", "missing") & F.col("late").isNotNull()
    return (out.withColumn("order_turn", F.when(ordered, F.col("late.t")).otherwise(F.col("turn")))
            .withColumn("order_step", F.when(ordered, F.col("late.s")).otherwise(0).cast("int"))
            .withColumn("cyclic", F.coalesce("cyclic", F.lit(False)) & ordered)
            .drop("late"))


def argument_errors(schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """Errors of name / arguments against ``{tool: {field: (type, required)}}``."""
    parsed = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    checks = F.when(~F.col("name").isin(list(schemas)) | F.col("name").isNull(), F.array(F.lit("unknown tool")))
    for tool, fields in schemas.items():
        found = []
        for field, (kind, required) in sorted(fields.items()):
            value = F.try_variant_get(parsed, f"$['{field}']" if "'" not in field else f'$["{field}"]', "variant")
            there = value.isNotNull() & ~F.is_variant_null(value)
            kind_ok = F.regexp_replace(F.schema_of_variant(value), r"\(.*", "").isin(
                TYPES[kind] + (["DECIMAL"] if kind == "number" else []))
            found.append(F.when(there & ~kind_ok, F.lit(f"type:{field}"))
                         .when(~there & F.lit(required), F.lit(f"missing:{field}")))
        known = F.array(*[F.lit(f) for f in sorted(fields)])
        others = F.transform(F.array_sort(F.array_except(F.json_object_keys("arguments"), known)),
                             lambda k: F.concat(F.lit("unexpected:"), k))
        checks = checks.when(F.col("name") == tool, F.concat(F.array_compact(F.array(*found)), others))
    return F.when(is_object, checks).otherwise(F.array(F.lit("not an object")))


def canonical(arguments: str) -> Column:
    """Canonical JSON of a JSON text (objects sort their keys), null if broken."""
    return F.to_json(F.try_parse_json(arguments))


def format_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row per call or orphaned result, in order within a conversation by
    (order_turn, order_step, call_id): conv_id, call_id, turn, order_turn,
    order_step, status, errors, json."""
    done = order(staged(link(calls, results), "chat-linked"))
    errors = F.when(F.col("is_call"), argument_errors(schemas)).otherwise(F.array().cast("array<string>"))
    errors = F.concat(errors, F.when(F.col("cyclic"), F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>")))
    text = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(
        F.regexp_extract(F.to_json(F.struct(F.col(c).alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1))
    json = F.concat(F.lit('{"arguments":'), F.coalesce(canonical("arguments"), F.lit("null")), F.lit(',"id":'), text("call_id"),
                    F.lit(',"name":'), text("name"), F.lit(',"result":'), text("content"), F.lit("}"))
    return done.select("conv_id", "call_id", "turn", "order_turn", "order_step", "status",
                       F.array_join(errors, ",").alias("errors"), json.alias("json"))


def derive_tool_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results read out of plain conversations.

    Every assistant turn answers through a tool: the user turn before it is
    the call's text, the assistant's text its result. A long user text asks
    for ``search``, a short one (under 60 characters) for ``lookup``, which
    uses the conversation's next assistant turn. An assistant text under 40 characters leaves no result; a system
    turn is a result that nothing called for.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    user = (rows.filter("role = 'user'").groupBy("conv_id", (F.col("turn") + 1).alias("turn"))
            .agg(F.min("text").alias("asked")))
    said = rows.filter("role = 'assistant'").join(user, ["conv_id", "turn"], "left")
    call_id = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    short = F.coalesce(F.char_length("asked") < 60, F.lit(False))
    other = F.when(short, F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") + 2).cast("string")))
    n = F.char_length("asked")
    asked = F.regexp_extract(F.to_json(F.struct(F.col("asked").alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)
    limit = F.when(n % 7 == 0, F.concat(F.lit('"'), n.cast("string"), F.lit('"'))).otherwise(n.cast("string"))
    more = F.when(n % 5 == 0, F.lit('"extra" : true, ')).otherwise(F.lit(""))
    arguments = F.when(F.col("asked").isNull(), F.lit("{}")).otherwise(
        F.concat(F.lit("{ "), more, F.lit('"text": '), asked, F.lit(', "limit": '), limit, F.lit(" }")))
    calls = said.select("conv_id", "turn", call_id.alias("call_id"), F.when(short, "lookup").otherwise("search").alias("name"),
                        arguments.alias("arguments"), other.alias("needs"))
    results = (rows.filter("role = 'system' OR (role = 'assistant' AND char_length(text) >= 40)")
               .select("conv_id", "turn", call_id.alias("call_id"), F.col("text").alias("content")))
    return calls, results


#: Tools of the derived calls: field -> (type, required).
SCHEMAS = {"search": {"text": ("string", True), "limit": ("integer", True)},
           "lookup": {"text": ("string", True), "limit": ("integer", False)}}
