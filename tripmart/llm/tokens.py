"""Whole-text tokenization inside Spark tasks with the ``tokenizers`` library.

BPE works on one pre-token at a time, so a text is cut only where the
tokenizer itself always cuts (:func:`cut_spaced`, :func:`cut_dropped`), each
distinct unit is encoded once per Python worker by the library, and a
document's ids are the joined ids of its units. Units are cut, told apart and
joined as Arrow columns; only the distinct ones of a few MB of text become
Python strings. That equals encoding the
whole text (``tests/llm/test_tokens.py`` checks it) and saves most of the
merge work. The memo is a cache of at most ``MEMO_UNITS`` units; it is
emptied when full, so its memory is bounded and results never depend on it.

A text that may hold the string of a special token goes to the library whole
and gets that token's id, as the library does; so does a text with a NUL,
which marks the cuts.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import KEPT, release_kept

CUT = "\0"           # between the units of a cut text
MEMO_UNITS = 600_000
TEXT_BYTES = 2 << 20  # text to encode at once
WORDS_AT_ONCE = 200  # new words of one call to the library
LONG_UNIT = 64       # longer units are encoded each time, not kept

_CAREFUL_CUT = re.compile(r"(?<=[0-9A-Za-z])(?= [0-9A-Za-z])")

# Classes of Latin-1 characters: letter or digit, blank or line feed, stop,
# other printable, anything else (other white space, controls).
WORD, SPACE, STOP, MARK, ODD = 0, 1, 2, 3, 4


def _classes() -> np.ndarray:
    out = np.full(256, ODD, np.uint8)
    for b in range(256):
        c = chr(b)
        if c in " \n":
            out[b] = SPACE
        elif c in ".,":
            out[b] = STOP
        elif c.isalpha() or "0" <= c <= "9":
            out[b] = WORD
        elif c.isprintable():
            out[b] = MARK
    return out


_CLASS = _classes()


def _kinds(text: str) -> np.ndarray | None:
    """The class of each character; None for a text beyond Latin-1 or with
    odd characters (those take the careful cut)."""
    try:
        kinds = _CLASS[np.frombuffer(text.encode("latin-1"), np.uint8)]
    except UnicodeEncodeError:
        return None
    return None if (kinds == ODD).any() else kinds


def _stops_follow_words(kinds: np.ndarray) -> bool:
    at = np.flatnonzero(kinds == STOP)
    return not len(at) or bool(at[0] > 0 and (kinds[at - 1] == WORD).all())


def cut_spaced(text: str) -> str:
    """Cuts (marked by ``CUT``) for a byte-level pattern in which a blank belongs to the word after it.

    A single blank or line feed between two non-space characters starts a
    pre-token, and so does a stop right after a letter or digit. Other texts
    are cut only between ASCII words.
    """
    kinds = _kinds(text)
    if kinds is None:
        return _CAREFUL_CUT.sub(CUT, text)
    space = kinds == SPACE
    if space[0] or space[-1] or (space[1:] & space[:-1]).any() or not _stops_follow_words(kinds):
        return _CAREFUL_CUT.sub(CUT, text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").replace(".", "\0.").replace(",", "\0,")


def cut_dropped(text: str) -> str:
    """Cuts (marked by ``CUT``) for a lower-casing pattern that drops white space: no pre-token
    spans a blank, and a stop right after a letter or digit starts one."""
    kinds = _kinds(text)
    if kinds is None:
        return text.replace(" ", CUT)
    text = text.lower().replace("\n", " ")      # Latin-1: lower case is one to one
    if _stops_follow_words(kinds):
        text = text.replace(".", " .").replace(",", " ,")
    return text.replace(" ", CUT)


def _byte_letters() -> dict[int, str]:
    """Byte -> letter of the byte-level alphabet (the public rule: printable
    Latin-1 bytes stand for themselves, the others are numbered from 256)."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(others)) for b in range(256)}


class Encoder:
    """Whole-text encoder over one vocabulary file of the ``tokenizers`` library.

    ``spaced``: the vocabulary keeps blanks (byte-level pattern); otherwise
    it lower-cases and drops white space. Ids come as little-endian bytes of
    ``width`` bytes each (2 where the vocabulary fits).
    """

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab_size(with_added_tokens=True)
        self.width = 2 if vocab <= 65_536 else 4
        self.dtype = np.dtype("<u2" if self.width == 2 else "<u4")
        self.spaced = spaced
        self.cut = cut_spaced if spaced else cut_dropped
        # beginnings of special tokens, and the mark of a cut: texts that hold one are not cut
        self.special = {CUT, *(t.content[:2] for t in self.tok.get_added_tokens_decoder().values())}
        self.letters = _byte_letters()
        # the same model (in memory once) over words that are already pre-tokens, one per line;
        # the id of a line feed, which no word holds, ends each
        self.words = Tokenizer(self.tok.model)
        line = self.letters[ord("\n")]
        self.words.pre_tokenizer = pre_tokenizers.Split(line, "isolated")
        if spaced and self.tok.normalizer is not None:
            self.words.normalizer = self.tok.normalizer
        self.line, = self.words.encode(line, add_special_tokens=False).ids
        # units that are one pre-token of Latin-1 letters (as lower case as the vocabulary wants them)
        word = " ?[A-Za-zÀ-ÖØ-öø-ÿ]{1,200}" if spaced else "[a-zß-öø-ÿ]{1,200}"
        self.plain = re.compile(f"^{word}$", re.M)
        # such a word with marks behind it: the marks start a pre-token
        self.marked = re.compile(f"^({word})([!#$%&*+/:;=?@~-]+)$", re.M)
        self.memo: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _learn(self, units: set[str], memo: dict[str, bytes]) -> None:
        """Encode the units with the library and put their ids into ``memo``."""
        lines = "\n".join(units)
        plain, marked = self.plain.findall(lines), self.marked.findall(lines)
        units = units.difference(plain)
        if marked:
            units.difference_update([w + m for w, m in marked])
            units.update({m for _, m in marked if m not in memo})
            plain += {w for w, _ in marked}.difference(plain, memo)
        for i in range(0, len(plain), WORDS_AT_ONCE):
            some = plain[i:i + WORDS_AT_ONCE]
            text = "\n".join([*some, ""]).encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ends = (np.flatnonzero(ids == self.line) * self.width).tolist()
            flat = ids.tobytes()
            memo.update(zip(some, [flat[s:e] for s, e in zip([0, *(e + self.width for e in ends)], ends)]))
        odd = list(units)
        for u, enc in zip(odd, self.tok.encode_batch(odd, add_special_tokens=False)):
            memo[u] = np.array(enc.ids, self.dtype).tobytes()
        memo.update([(w + m, memo[w] + memo[m]) for w, m in marked])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _ids_of(self, units: list[str]) -> list[bytes]:
        """The ids of distinct units, learned where the memo lacks them."""
        if len(self.memo) > MEMO_UNITS // 2:
            self.memo, self.old = {"": b""}, self.memo
        memo, old, once = self.memo, self.old, {}
        ids = list(map(memo.get, units))
        lack = [i for i, x in enumerate(ids) if x is None]
        new = [units[i] for i in lack]
        memo.update([(u, old[u]) for u in new if u in old])
        new = {u for u in new if u not in memo}
        brief = {u for u in new if len(u) <= LONG_UNIT}
        self._learn(brief, memo)
        if len(brief) < len(new):
            self._learn(new - brief, once)
        for i in lack:
            u = units[i]
            ids[i] = memo[u] if u in memo else once[u]
        return ids

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each whole text (null: none); pass a few MB at a time."""
        whole = {i: self._whole(t) for i, t in enumerate(texts) if t and any(m in t for m in self.special)}
        cut = pc.split_pattern(pa.array([self.cut(t) if t and i not in whole else "" for i, t in enumerate(texts)],
                                        pa.large_string()), CUT)
        units = cut.flatten().dictionary_encode()
        ids = pa.array(self._ids_of(units.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(units.indices)
        ends = np.zeros(len(ids) + 1, np.int64)          # bytes of ids up to each unit
        np.cumsum(pc.binary_length(ids).to_numpy(), out=ends[1:])
        ends = ends[cut.offsets.to_numpy()].tolist()
        flat = memoryview(ids.buffers()[2] or b"")
        out = [bytes(flat[s:e]) for s, e in zip(ends, ends[1:])]
        for i, x in whole.items():
            out[i] = x
        return out


_ENCODERS: dict[tuple, Encoder] = {}
KEPT.append(_ENCODERS.clear)


def encoder(path: str, spaced: bool) -> Encoder:
    """The worker's encoder for one vocabulary file (kept for its next task);
    it takes the place of what earlier stages kept in the worker."""
    key = (path, spaced)
    if key not in _ENCODERS:
        release_kept()
        _ENCODERS[key] = Encoder(path, spaced)
    return _ENCODERS[key]
