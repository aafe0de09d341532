"""op11 against a plain version, round trips and edges."""

import hashlib
import random
import re

import pytest

from tests.llm.helpers import edge_rows, frame
from tripmart.llm import infill as I
from tripmart.llm import queries
from tripmart.llm.common import staged

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    key = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def key(row):
    return tuple((x is not None, x) for x in row)


def test_given_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    want = [brute(*r) for r in docs.collect()]
    got = queries.op11_fill_in_middle(spark, sf_small)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in want), key=key)
    assert {w[2] for w in want} == {"plain", "spm", "psm"}


@pytest.mark.parametrize("size", [8, 64, I.FRAME_BYTES])
def test_edges_and_tiny_frames(spark, size):
    rng = random.Random(size)
    alphabet = "abZ <PSM>.é日\U0001F600\0\n1"
    rows = edge_rows() + [(20, "x" * 3000), (21, "<P"), (22, "a<M>b"), (23, "é" * 50), (24, "<S<S<P<M"), (24, ">>P>S>M>")]
    rows += [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120)))) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, form string, n int")
    store = staged(I.frame_store(docs, size=size), "test-frames")
    got = I.texts(I.transform(store, size=size)).collect()
    assert sorted(map(tuple, got), key=key) == sorted((brute(*r) for r in rows), key=key)


def test_only_cut_frames_are_decompressed(monkeypatch):
    text = I.to_frames(b"word " * 100_000)
    read = []
    plain = I.Frames.read
    monkeypatch.setattr(I.Frames, "read", lambda self, i: read.append(i) or plain(self, i))
    assert len(text) > 7
    I.infill(text, 30_000, 150_000, "psm")
    assert len(set(read)) == 2


def test_an_empty_table(spark):
    store = I.frame_store(frame(spark, []))
    assert I.digests(I.transform(store)).count() == 0
