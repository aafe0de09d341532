"""Whole-text encoding by units equals the library's encoding of whole texts."""

import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import edge_rows
from tripmart.llm import tokens as T

KINDS = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
_REF: dict = {}


def reference(name, texts):
    if name not in _REF:
        _REF[name] = Tokenizer.from_file(P.path(name))
    return [e.ids for e in _REF[name].encode_batch(texts, add_special_tokens=False)]


def mine(name, spaced, texts):
    e = T.encoder(P.path(name), spaced)
    return [np.frombuffer(b, e.dtype).tolist() for b in e.encode_all(texts)]


TEXTS = [t or "" for _, t in edge_rows()] + [
    "", " ", "\n", "a", " a", "a ", "a\nb", "a \n b", "a\n\nb", "A.b,c", "..", "a..b", "a .b", "it's we'll 's", "don't.",
    "THE!! É,ê", "x\ty\rz", "a b", "1,000.50", "a1b2", "é ́a", "İstanbul Σσς", "​z",
    "<|endoftext|> a<|startoftext|>", " <|endoftext|>", "a<|ENDOFTEXT|> b", "<|endoftext", "one <|endoftext|><|endoftext|>two", "<| x",
    "tab\there", "日本語テキスト。x", "\U0001F600\U0001F601 !", "###*** &&& ---", "a\x00b \x1c c",
    "ß ẞ ŒŸ", "x" * 5000, "word " * 3000, "ªº µ ²³ ¼", "а б в Г", "-a -b", "(a) [b]{c}", "­ soft"]


@pytest.mark.parametrize("name,spaced", KINDS)
def test_equals_whole_text_encoding(name, spaced):
    assert mine(name, spaced, TEXTS) == reference(name, TEXTS)
    assert T.encoder(P.path(name), spaced).encode_all([None, ""]) == [b"", b""]


@pytest.mark.parametrize("name,spaced", KINDS)
def test_given_documents(name, spaced, spark, sf_small):
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    assert mine(name, spaced, texts) == reference(name, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab zÉé .,'!#\n\t ́Σ19İ-"), max_size=40), max_size=4))
def test_random_texts(texts):
    for name, spaced in KINDS:
        assert mine(name, spaced, texts) == reference(name, texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", " ", "a", "Word", "É", ".", "\n"]),
                         max_size=12).map("".join), max_size=4))
def test_texts_with_special_strings(texts):
    for name, spaced in KINDS:
        assert mine(name, spaced, texts) == reference(name, texts)


def test_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(T, "MEMO_UNITS", 20)
    rng = random.Random(0)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(30)) for _ in range(20)]
    e = T.Encoder(P.path("byte_bpe_50k.json"), True)
    got = [np.frombuffer(x, e.dtype).tolist() for t in texts for x in e.encode_all([t])]
    assert got == reference("byte_bpe_50k.json", texts)


def test_other_operators_release_the_vocabulary():
    from tripmart.llm.common import release_kept
    first = T.encoder(P.path("byte_bpe_50k.json"), True)
    assert T.encoder(P.path("byte_bpe_50k.json"), True) is first
    release_kept()
    assert T.encoder(P.path("byte_bpe_50k.json"), True) is not first


@pytest.mark.parametrize("name,spaced", KINDS)
def test_only_distinct_units_become_strings(name, spaced, monkeypatch):
    e = T.Encoder(P.path(name), spaced)
    seen, ids_of = [], e._ids_of
    monkeypatch.setattr(e, "_ids_of", lambda units: seen.append(units) or ids_of(units))
    texts = ["one two one two. " * 500 + "end", None, "a\0b two", "", "two one"]
    got = [np.frombuffer(b, e.dtype).tolist() for b in e.encode_all(texts)]
    assert got == reference(name, [t or "" for t in texts])
    assert len(seen) == 1 and len(set(seen[0])) == len(seen[0]) < 12


def test_an_encoder_takes_the_place_of_what_others_kept(monkeypatch):
    from tripmart.llm import common
    common.release_kept()
    kept = ["an index of an earlier stage"]
    monkeypatch.setattr(common, "KEPT", [*common.KEPT, kept.clear])
    first = T.encoder(P.path("byte_bpe_50k.json"), True)
    assert not kept
    kept.append("of the same stage")
    assert T.encoder(P.path("byte_bpe_50k.json"), True) is first and kept
