"""Operator 8: BPE encoding and decoding by a walk over a trie of distinct words.

The state of a prefix is the last token of its encoding: a token that ends the prefix and stays apart
from the last token of what stands before it. Exactly one token does, so the state of a node follows
from those of its ancestors, and what words share at their beginning is encoded once. A word's tokens
are read backwards along the states of its path.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, map_texts, uncollected
from .word_bpe import Vocabulary, vocabulary

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
# Bytes of encodings remembered between a task's batches, of pieces and of their words; they change no result.
REMEMBERED = 192 << 20
PAIRS = 1_000_000
NEVER = 1 << 60


class Ending:
    """The longest end of a prefix that begins a token: the tokens that end there, longest first, and what comes next."""

    __slots__ = ("after", "text", "tokens")

    def __init__(self, text: str, tokens: list[tuple[int, int, dict[int, bool]]]):
        self.text, self.tokens = text, tokens
        self.after: dict[str, Ending] = {}


class TrieEncoder:
    def __init__(self, vocab: Vocabulary, remembered: int = REMEMBERED):
        self.vocab = vocab
        self.known, self.pieces = Remembered(remembered // 2), Remembered(remembered // 2)
        self.tokens = self._tokens()
        self.beginnings = {symbols[:n] for symbols in self.tokens for n in range(len(symbols) + 1)}
        # For each token the tokens before it, and whether they stay apart.
        self.borders: dict[int, dict[int, bool]] = {t: {} for t in self.tokens.values()}
        self.borders_held = 0
        self.endings: dict[str, Ending] = {}

    def apart(self, a: int, b: int, until: int = NEVER) -> bool:
        """Whether no merge of a rank below ``until`` crosses the border of two tokens while they are being built.

        The tokens are taken apart again, last merge first. ``x`` and ``y`` are the parts at the border and
        ``dx``, ``dy`` the ranks at which they went into a larger part; of equal merges the left one is done first.
        """
        merges, built, parts = self.vocab.merges, self.vocab.built, self.vocab.parts
        x, y, dx, dy = a, b, until, until
        while True:
            merge = merges.get((x, y))
            if merge is not None and merge[0] < dx and (merge[0] < dy or merge[0] == dy < until):
                return False
            bx, by = built[x], built[y]
            if bx < 0 and by < 0:
                return True
            if bx > by:
                x, dx = parts[x][1], bx
            else:
                y, dy = parts[y][0], by

    def _tokens(self) -> dict[str, int]:
        """The tokens whose own symbols are encoded as the token: only these come up, by symbols."""
        v, whole = self.vocab, set()
        for t in sorted(v.built, key=v.built.__getitem__):
            if v.built[t] < 0 or (v.parts[t][0] in whole and v.parts[t][1] in whole and self.apart(*v.parts[t], v.built[t])):
                whole.add(t)
        return {v.symbols_of[t]: t for t in whole}

    def ending(self, before: Ending | None, c: str) -> Ending:
        """What ``before`` becomes with one more symbol. There are as many as beginnings of tokens, whatever the input."""
        text = before.text + c if before else c
        while text not in self.beginnings:
            text = text[1:]
        found = self.endings.get(text)
        if found is None:
            ends = [(t, n, self.borders[t]) for n in range(len(text), 0, -1) if (t := self.tokens.get(text[-n:])) is not None]
            found = self.endings[text] = Ending(text, ends)
        if before:
            before.after[c] = found
        return found

    def learn(self, words: Iterable[str]) -> None:
        """Encode words through one trie and remember them."""
        v = self.vocab
        if self.borders_held > PAIRS:
            for held in self.borders.values():
                held.clear()
            self.borders_held = 0
        root: dict = {}
        depth_most = 0
        for word in words:
            path = v.symbols(word)
            depth_most = max(depth_most, len(path))
            node = root
            for c in path[:-1]:
                node = node.setdefault(c, {})
            node[path[-1]] = word
        token, size = [0] * (depth_most + 1), [0] * (depth_most + 1)
        stack = [(1, self.ending(None, c), below) for c, below in root.items()]
        while stack:
            depth, end, node = stack.pop()
            while True:
                for t, n, held in end.tokens:
                    if n < depth:
                        last = token[depth - n]
                        free = held.get(last)
                        if free is None:
                            free = held[last] = self.apart(last, t)
                            self.borders_held += 1
                        if not free:
                            continue
                    token[depth], size[depth] = t, n
                    break
                if node.__class__ is str:
                    found = []
                    while depth:
                        found.append(token[depth])
                        depth -= size[depth]
                    found.reverse()
                    self.known.put(node, tuple(found), 8 * len(found))
                    break
                depth += 1
                after = end.after
                if len(node) > 1:
                    stack += [(depth, after.get(c) or self.ending(end, c), below) for c, below in node.items()]
                    break
                ((c, node),) = node.items()
                end = after.get(c) or self.ending(end, c)

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        lists = [self.vocab.pieces(t) for t in texts]
        words = {p: self.vocab.words(p) for p in self.pieces.missing(set().union(*lists))}
        special = self.vocab.special
        self.learn(self.known.missing(set().union(*words.values()) - special.keys()))
        known = self.known.young
        for p, ws in words.items():
            ids = tuple(chain.from_iterable(known[w] if w in known else (special[w],) for w in ws))
            self.pieces.put(p, ids, 8 * len(ids))
        pieces = self.pieces.young
        return [list(chain.from_iterable(map(pieces.__getitem__, cut))) for cut in lists]

    def forget(self) -> None:
        self.known.clear()
        self.pieces.clear()

    def decode(self, ids: Sequence[int]) -> str:
        """The tokens' texts joined by spaces: the vocabulary file names no decoder."""
        return " ".join(map(self.vocab.texts.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int = REMEMBERED) -> TrieEncoder:
    return TrieEncoder(vocabulary(path), remembered)


def encode(
    df: DataFrame, column: str = "text", path: str = VOCABULARY, keep: Sequence[str] | None = None, remembered: int = REMEMBERED
) -> DataFrame:
    """``df`` with ``ids`` (array of int) and ``decoded`` (text), the round trip of each text in ``column``.

    Null and empty texts give no ids and the empty text. Repeated rows are encoded alike. Columns named
    ids or decoded are replaced. ``remembered`` bounds the bytes of a task's memory of encodings and changes no result.
    """

    def make():
        coder = encoder(path, remembered)

        def work(texts: pa.Array):
            with uncollected():
                lists = coder.encode(texts.to_pylist())
            offsets = np.zeros(len(lists) + 1, np.int32)
            np.cumsum([len(x) for x in lists], out=offsets[1:])
            flat = np.fromiter(chain.from_iterable(lists), np.int32, int(offsets[-1]))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            return [ids, pa.array([coder.decode(x) for x in lists], pa.string())]

        work.close = coder.forget
        return work

    return map_texts(df, column, "ids array<int>, decoded string", make, keep)


def digests(df: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of documents."""
    coded = encode(df.select("doc_id", "text"), path=path, keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
