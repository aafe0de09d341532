"""op4 and op6 against plain encoding: round trips, places, edges."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import edge_rows, frame
from tripmart.llm import packing as K
from tripmart.llm import queries
from tripmart.llm import token_store as S


def encode(name, texts, end):
    t = Tokenizer.from_file(P.path(name))
    return [e.ids + [end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_store_of_the_given_documents(spark, sf_small):
    docs = sorted(spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect())
    ids = encode("word_bpe_49k.json", [r.text for r in docs], 1)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op4_token_store(spark, sf_small).collect()}
    start = 0
    for r, x in zip(docs, ids):
        assert got[r.doc_id] == (start, len(x), crc(x))
        start += len(x)


def test_store_edges_and_single_documents(spark, tmp_path):
    rows = edge_rows()
    back = S.store(frame(spark, rows), str(tmp_path / "s"), P.path("word_bpe_49k.json"), 1, False)
    got = back.orderBy("start").collect()
    want = encode("word_bpe_49k.json", [t for _, t in rows], 1)
    ids = [np.frombuffer(r.ids, "<u2").tolist() for r in got]
    assert sorted(map(str, ids)) == sorted(map(str, want))
    assert [r.id for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i))
    assert [r.start for r in got] == np.cumsum([0] + [len(x) for x in ids])[:-1].tolist()
    for i in (1, 4, 6, 8):
        assert S.read_document(spark, str(tmp_path / "s"), i).tolist() == want[[r[0] for r in rows].index(i)]
    assert S.read_document(spark, str(tmp_path / "s"), 777) is None
    empty = S.store(frame(spark, []), str(tmp_path / "e"), P.path("word_bpe_49k.json"), 1, False)
    assert empty.count() == 0


def test_payload_round_trip_and_wrong_dictionary():
    samples = [np.arange(k, k + 300, dtype="<u2").tobytes() for k in range(200)]
    data = S.train(samples, 4096)
    assert data and S.train(samples[:1]) == b"" and S.train([]) == b""
    import hashlib
    import zstandard
    packer = zstandard.ZstdCompressor(dict_data=S._dictionary(data))
    frames = [packer.compress(x) for x in samples[:3]]
    payload = S.write_payload([5, None, 9], frames, [300] * 3, 2, hashlib.sha256(data).digest())
    block = S.Payload(payload, data)
    assert block.ids == [5, None, 9] and [block.read(i) for i in range(3)] == samples[:3]
    with pytest.raises(ValueError):
        S.Payload(payload, b"other")


@pytest.mark.parametrize("histogram", [{}, {1: 5}, {1024: 3, 1: 2}, {600: 4, 400: 9, 24: 4, 30: 50},
                                       {k: (k * 37) % 11 for k in range(1, 1025)}])
def test_every_piece_has_one_place(histogram):
    histogram = {k: n for k, n in histogram.items() if n}
    patterns = K.shortest_pack_first(histogram)
    used = {}
    for p in patterns:
        assert sum(p.lengths) <= 1024 and p.count > 0
        for x in p.lengths:
            used[x] = used.get(x, 0) + p.count
    assert used == histogram
    found = K.places(patterns)
    spans = {}
    for x, n in histogram.items():
        s, o = found.find(np.full(n, x), np.arange(n))
        for a, b in zip(s.tolist(), o.tolist()):
            spans.setdefault(a, []).append((b, x))
    for parts in spans.values():
        end = 0
        for b, x in sorted(parts):
            assert b == end
            end += x
        assert end <= 1024
    total = sum(k * n for k, n in histogram.items())
    if len(histogram) > 100:
        assert total / 1024 / len(spans) > 0.97


def check_pieces(rows, want):
    by, seq = {}, {}
    for r in rows:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start:r.start + r.length])
        by.setdefault(r.doc_id, []).append((r.start, r.length))
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for groups, end in ((by, {d: len(x) for d, x in want.items()}), (seq, None)):
        for k, parts in groups.items():
            at = 0
            for s, n in sorted(parts):
                assert s == at
                at += n
            assert at <= 1024 if end is None else at == end[k]
    assert set(by) == set(want)


def test_packing_of_the_given_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], encode("byte_bpe_50k.json", [r.text for r in docs], 0)))
    check_pieces(queries.op6_packing(spark, sf_small).collect(), want)


def test_packing_edges_and_sequences(spark):
    rows = [(i, t) for i, t in dict((r[0], r) for r in edge_rows()).values()]
    packed = K.pack(frame(spark, rows).withColumn("offset", F.lit(1)), P.path("byte_bpe_50k.json"), 0)
    want = dict(zip([i for i, _ in rows], encode("byte_bpe_50k.json", [t for _, t in rows], 0)))
    check_pieces(K.with_crc(packed).collect(), want)
    seqs = K.sequences(packed).collect()
    assert sum(r.n_tokens for r in seqs) == sum(map(len, want.values()))
    assert all(len(r.ids) == 2 * r.n_tokens for r in seqs)
    assert K.pack(frame(spark, []), P.path("byte_bpe_50k.json"), 0).count() == 0
