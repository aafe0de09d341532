"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie over characters with two roots, one for pieces that
start a word and one for pieces that continue it. Every node has a failure
link and the number of tokens that greedy longest-match has settled when the
link is taken (*popped* tokens), both precomputed. A word is then counted in
one pass over its characters: follow the edge; where there is none, add the
node's popped count and follow its link. No piece is ever built. A word that
gets stuck is one unknown token.

Distinct words of a few MB of text are counted together, character position
by character position; every text is read whole.

Words are separated by ASCII white space. Defined cases: null, empty and
blank texts have no words and no tokens; repeated rows count alike; very
long words are walked on their own; columns named like a result are replaced.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import extended, pieces, rename_clashes

LONG_WORD = 200
_CHAR = 21               # bits of a code point


@dataclass
class Automaton:
    """Edges as sorted keys (node << 21 | code point); node 0 starts words,
    node 1 continues them; a failure link of -1: stuck."""
    keys: np.ndarray
    child: np.ndarray
    link: np.ndarray
    popped: np.ndarray

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Child of each node along each character, -1 where there is none."""
        want = (node << _CHAR) | char
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.child[at], -1) if len(self.keys) else np.full(len(node), -1)


def build(initial: list[str], continuing: list[str]) -> Automaton:
    """The automaton of pieces that start a word and pieces that continue one."""
    edges: list[dict[int, int]] = [{}, {}]
    piece = [False, False]
    for root, texts in ((0, initial), (1, continuing)):
        for text in texts:
            node = root
            for c in map(ord, text):
                if c not in edges[node]:
                    edges[node][c] = len(edges)
                    edges.append({})
                    piece.append(False)
                node = edges[node][c]
            piece[node] = piece[node] or node > 1
    link, popped = [-1] * len(edges), [0] * len(edges)
    todo = deque([0, 1])
    while todo:
        u = todo.popleft()
        for c, v in edges[u].items():
            if piece[v]:
                link[v], popped[v] = 1, 1           # settle this piece, go on from the continuing root
            else:
                z, n = link[u], popped[u]
                while z >= 0 and c not in edges[z]:
                    n += popped[z]
                    z = link[z]
                if z >= 0:
                    link[v], popped[v] = edges[z][c], n
            todo.append(v)
    flat = sorted(((u << _CHAR) | c, v) for u, e in enumerate(edges) for c, v in e.items())
    both = np.array(flat, np.int64).reshape(-1, 2)
    return Automaton(both[:, 0].copy(), both[:, 1].copy(), np.array(link, np.int64), np.array(popped, np.int64))


def count_words(words: list[str], machine: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each word, and whether it is unknown (then one token)."""
    size = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-size, kind="stable")
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    begin = (np.cumsum(size) - size)[order]
    size = size[order]
    node = np.zeros(len(words), np.int64)
    tokens = np.zeros(len(words), np.int64)
    stuck = np.zeros(len(words), bool)

    def fall(at: np.ndarray, here: np.ndarray) -> None:
        """Take the failure link of the words at ``at``."""
        tokens[at] += machine.popped[here]
        node[at] = machine.link[here]
        stuck[at] |= node[at] < 0

    for i in range(int(size.max()) if len(size) else 0):
        live = int(np.searchsorted(-size, -i, side="left"))        # words longer than i
        at = np.flatnonzero(~stuck[:live])
        while len(at):
            here = node[at]
            to = machine.step(here, chars[begin[at] + i])
            found = to >= 0
            node[at[found]] = to[found]
            at, here = at[~found], here[~found]
            fall(at, here)
            at = at[node[at] >= 0]
    at = np.flatnonzero(~stuck & (node > 1))
    while len(at):                                                 # settle what is left of each word
        fall(at, node[at])
        at = at[node[at] > 1]
    out, odd = np.empty(len(words), np.int64), np.empty(len(words), bool)
    out[order] = np.where(stuck, 1, tokens)
    odd[order] = stuck
    return out, odd


def count_tokens(docs: DataFrame, initial: list[str], continuing: list[str], text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_tokens and n_unknown."""
    docs = rename_clashes(docs, ["n_words", "n_tokens", "n_unknown"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = build(initial, continuing)
        for b in pieces(batches, text_col):
            text = pc.fill_null(b.column(b.schema.get_field_index(text_col)), "")
            split = pc.ascii_split_whitespace(text)
            ends = split.offsets.to_numpy()
            words = split.flatten().dictionary_encode()
            distinct = words.dictionary.to_pylist()
            n, odd = count_words([w if len(w) <= LONG_WORD else "" for w in distinct], machine)
            for k, w in enumerate(distinct):
                if len(w) > LONG_WORD:
                    n[k], odd[k] = (x[0] for x in count_words([w], machine))
            real = np.array([w != "" for w in distinct], np.int64)
            index = words.indices.to_numpy()
            sums = [np.concatenate([[0], np.cumsum((x * real)[index])])[ends] for x in (np.ones_like(n), n, odd.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(np.diff(s)) for s in sums)],
                                             [*b.schema.names, "n_words", "n_tokens", "n_unknown"])

    return docs.mapInArrow(run, extended(docs, "n_words long, n_tokens long, n_unknown long"))


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces of a sentencepiece model that start a word (there marked by a
    lower one-eighth block) and that continue one; control and byte pieces are left out."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [t[1:] for t in texts if t[:1] == "▁" and t[1:] and "▁" not in t[1:]], [t for t in texts if "▁" not in t]
