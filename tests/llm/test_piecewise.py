"""op13 against plain versions: fingerprints byte by byte, distances, neighbours."""

import hashlib
import random

import numpy as np

from tests.llm.helpers import edge_rows, frame, words
from tripmart.llm import piecewise as P
from tripmart.llm import queries

M32 = 0xFFFFFFFF


def mix(h):
    h = ((h ^ (h >> 16)) * 0x85EBCA6B) & M32
    h = ((h ^ (h >> 13)) * 0xC2B2AE35) & M32
    return h ^ (h >> 16)


def plain_fingerprint(text):
    hashes = []
    for i in range(len(text)):
        h = 0
        for b in text[max(0, i - 6):i + 1]:
            h = (h * 0x01000193 + int(P._CODE[b])) & M32
        hashes.append(mix(h))

    def signature(level):
        out, now, any_ = "", 0, False
        for h in hashes:
            now, any_ = now + (((h * 0x9E3779B1) & M32) >> 8), True
            if h % (1 << level) == 0 and len(out) < 63:
                out, now, any_ = out + chr(P._LETTERS[mix(now & M32) >> 26]), 0, False
        return out + (chr(P._LETTERS[mix(now & M32) >> 26]) if any_ else "")

    level = 0
    while 64 * 2**level < len(text):
        level += 1
    while level and sum(h % (1 << level) == 0 for h in hashes) < 32:
        level -= 1
    return ":".join([str(1 << level)] + [signature(level + k) for k in range(3)])


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def plain_likeness(f, g):
    if f == g:
        return 1.0
    best = 0.0
    for i, s in enumerate(f.split(":")[1:]):
        for j, t in enumerate(g.split(":")[1:]):
            k = min(7, (min(len(s), len(t)) + 1) // 2)
            if int(f.split(":")[0]) << i == int(g.split(":")[0]) << j and k and any(
                    s[x:x + k] in t for x in range(len(s) - k + 1)):
                best = max(best, 1 - plain_distance(s, t) / max(len(s), len(t)))
    return best


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(rows):
        u = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        e = t[:len(t) - q] + u[:q]
        f, g, h = (plain_fingerprint(x.encode()) for x in (t, e, u))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, plain_likeness(f, g), plain_likeness(f, h)))
    return out


def same(got, want):
    got, want = sorted(map(str, map(tuple, got))), sorted(map(str, want))
    assert got == want


def test_given_documents(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_fingerprints(spark, sf_small)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = got.collect()
    same(got, brute(rows))
    changed = [r.near_edited for r in got if r.n_chars > 40]
    assert np.mean(np.array(changed) > 0.5) > 0.97
    assert np.mean([r.near_next for r in got]) < 0.2


def test_edges_repeats_and_ranges(spark):
    rows = [r for r in edge_rows() if r[0] not in (6, 7)] + [(6, " ".join(words(random.Random(5), 2000))), (None, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, fingerprint string")
    got = P.compare_next(docs.repartition(5)).collect()
    assert len(got) == len(rows)
    singles = {i for i, _ in rows if [r[0] for r in rows].count(i) == 1}
    want = {r[0]: r for r in brute(rows) if r[0] in singles}
    for r in got:
        if r.doc_id in singles and r.doc_id not in (8, 10):          # their next has a repeated id
            assert tuple(r) == want[r.doc_id]
    one = P.compare_next(frame(spark, [(5, "abcdefgh")])).collect()
    same(one, brute([(5, "abcdefgh")]))
    assert one[0].near_next == 1.0 and P.compare_next(frame(spark, [])).collect() == []
    prints = P.fingerprints(docs).collect()
    assert len(prints) == len(rows) and {r.fingerprint for r in prints if r.doc_id == 1} == {"1:::"}


def test_blocks_do_not_show(monkeypatch):
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abcd \n") for _ in range(n)) for n in (0, 1, 6, 63, 64, 65, 500, 5000)]
    texts += [b"a" * 3000, b"one line of text\n" * 300]
    want = [plain_fingerprint(t) for t in texts]
    assert [P.fingerprint(t) for t in texts] == want
    for size in (1, 5, 64, 1000):
        monkeypatch.setattr(P, "BLOCK", size)
        use = range(len(texts)) if size > 1 else range(7)
        assert [P.fingerprint(texts[i]) for i in use] == [want[i] for i in use]


def test_distances():
    rng = random.Random(4)
    pick = lambda: "".join(rng.choice("ABCx+") for _ in range(rng.choice([0, 1, 2, 5, 30, 63, 64])))
    pairs = [(pick(), pick()) for _ in range(400)]
    got = P.distances([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [plain_distance(a, b) for a, b in pairs]


def test_repeated_lines_stay_alike():
    line, other = b"the same line again and again\n" * 400, b"quite another text without repeats 0123456789 " * 30
    assert P.likeness([P.fingerprint(line)], [P.fingerprint(line[:-3000] + other[:3000])])[0] > 0.5
    assert P.likeness([P.fingerprint(b"")], [P.fingerprint(b"x")])[0] == 0
