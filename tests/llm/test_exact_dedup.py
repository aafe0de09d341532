"""op3 against a plain grouping."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ID_TEXT, edge_rows, frame, words
from tripmart.llm import exact_dedup as E
from tripmart.plans.inspect import python_nodes


def lower_az(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower_az(t), []).append(i)
    out = []
    for i, t in rows:
        g = groups[lower_az(t)]
        ids = [x for x in g if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(g), i == keep, hashlib.sha256(lower_az(t).encode()).hexdigest()))
    return out


def got(df):
    return [tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_edges_and_random_rows(spark):
    rng = random.Random(1)
    rows = edge_rows() + [(100 + i, " ".join(words(rng, rng.choice([1, 1, 2, 5])))) for i in range(1500)]
    rows += [(5000 + i, "É" + "A" * (i % 2)) for i in range(300)]          # two hot texts
    df = E.exact_groups(frame(spark, rows))
    assert order(got(df)) == order(brute(rows))
    assert not python_nodes(df)


def moved_columns(df):
    """Column names of what the plan's hash and range exchanges move."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.initialPlan())
            continue
        if node.nodeName() == "Exchange":
            out = node.output()
            found.append({out.apply(i).name() for i in range(out.size())})
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


@pytest.mark.parametrize("segment", [256, 512, 1 << 24])
def test_filter_in_segments(spark, segment):
    """Beyond the broadcast bound each segment takes a pass; results stay."""
    rows = edge_rows() + [(100 + i, f"t{i % 2100}") for i in range(3000)]      # 1024 words, up to 4 segments
    assert E.filter_words(len(rows)) == 1024
    assert order(got(E.exact_groups(frame(spark, rows), broadcast_words=segment))) == order(brute(rows))
    wide = frame(spark, rows).withColumn("x", F.lit(1))
    assert order(got(E.exact_groups(wide, broadcast_words=segment))) == order(brute(rows))


def test_unique_rows_pass_without_an_exchange(spark, tmp_path):
    """Only the branch of rows flagged as repeated moves texts, and it holds
    the filter's flag; the rows' own hashes are probed by broadcast."""
    rows = [(i, f"t{i % 900}") for i in range(1000)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.exact_groups(frame(spark, rows).withColumn("x", F.lit(1)))
        moved = [m for m in moved_columns(df) if "text" in m]
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(moved) == 1 and "strategy=broadcast" in plan
        assert order(got(df)) == order(brute(rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_crowded_filter_loses_nothing(spark):
    rows = [(i, f"t{i % 900}") for i in range(1000)]
    assert order(got(E.exact_groups(frame(spark, rows), bits_per_row=1))) == order(brute(rows))


def test_empty_table_and_clashing_columns(spark):
    assert E.exact_groups(frame(spark, [])).count() == 0
    df = frame(spark, [(1, "a"), (2, "A")]).withColumn("kept", F.lit("x")).withColumn("group_size", F.lit(7))
    assert order(got(E.exact_groups(df))) == order(brute([(1, "a"), (2, "A")]))
    kept = E.drop_exact_copies(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [2]


def test_drop_copies_keeps_one_of_rows_that_repeat_id_and_text(spark):
    kept = E.drop_exact_copies(frame(spark, edge_rows()))
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    # 1 and 2 are equal (null counts as empty), 6 and 7, and 9, 9 and 10
    assert ids == [2, 3, 4, 5, 7, 8, 10]
    assert E.drop_exact_copies(frame(spark, [(9, "x"), (9, "x"), (9, "X")], ID_TEXT)).count() == 1


def test_rows_of_a_large_group_stay_spread(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"text {i // 2}") for i in range(1200)] + [(None, "copy"), (None, "alone")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = E.exact_groups(frame(spark, rows).withColumn("x", F.lit(1)).repartition(8)).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ids = {}
    for i, t in rows:
        ids.setdefault(t, []).append(i)
    best = {t: max((i for i in v if i is not None), default=None) for t, v in ids.items()}
    assert sorted(((r.doc_id, r.text, r.keep_id, r.group_size, r.kept) for r in out), key=str) == sorted(
        ((i, t, best[t], len(ids[t]), i == best[t]) for i, t in rows), key=str)
    parts = Counter(r.part for r in out if r.text == "copy")
    assert len(parts) >= 4 and max(parts.values()) < 200          # 401 copies
