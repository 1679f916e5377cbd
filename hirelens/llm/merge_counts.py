"""Operator 10: token counts by rank-synchronous merging of ragged arrays.

The distinct words of a batch lie one after another in one array of symbols. In every round each word
applies its own lowest-ranked pair wherever it occurs, all words at once, until no pair is left.
What survives is counted.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, map_texts
from .trie_bpe import VOCABULARY
from .word_bpe import Vocabulary, vocabulary

# Bytes of counts remembered between a task's batches, of pieces and of their words; they change no result.
REMEMBERED = 192 << 20
SYMBOLS_AT_ONCE = 2_000_000
NONE = np.iinfo(np.int64).max


class MergeCounter:
    def __init__(self, vocab: Vocabulary, remembered: int = REMEMBERED):
        self.vocab = vocab
        self.known, self.pieces = Remembered(remembered // 2), Remembered(remembered // 2)
        pairs = np.array([(a << 32 | b, r, t) for (a, b), (r, t) in vocab.merges.items()], np.int64)
        pairs = pairs[np.argsort(pairs[:, 0])]
        self.keys, self.ranks, self.made = pairs.T.copy()
        self.base = np.array([vocab.by_symbols[chr(c)] for c in range(512)], np.int64)

    def survivors(self, words: Sequence[str]) -> np.ndarray:
        """The number of symbols of each word after all merges."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        codes = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        codes[np.cumsum(sizes) - 1] += 256
        symbols, owner = self.base[codes], np.repeat(np.arange(len(raw)), sizes)
        counts = sizes.copy()
        while len(symbols) > 1:
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.ranks[at], NONE)
            rank, at = np.append(rank, NONE), np.append(at, 0)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lengths = np.diff(np.append(first, len(owner)))
            least = np.minimum.reduceat(rank, first)
            chosen = (rank == np.repeat(least, lengths)) & (rank != NONE)
            # Of pairs that overlap, as in a run of one symbol, every second one from the left is applied.
            places = np.flatnonzero(chosen)
            starts = np.append(True, np.diff(places) != 1)
            run = np.flatnonzero(starts)[np.cumsum(starts) - 1]
            places = places[(np.arange(len(places)) - run) % 2 == 0]
            symbols = symbols.copy()
            symbols[places] = self.made[at[places]]
            alive = np.repeat(least != NONE, lengths)  # words without a pair are done
            np.subtract.at(counts, owner[places], 1)
            alive[places + 1] = False
            symbols, owner = symbols[alive], owner[alive]
        return counts

    def learn(self, words: Iterable[str]) -> None:
        part: list[str] = []
        held = 0
        for word in words:
            part.append(word)
            held += len(word)
            if held > SYMBOLS_AT_ONCE:
                self._count(part)
                part, held = [], 0
        if part:
            self._count(part)

    def _count(self, words: list[str]) -> None:
        for word, n in zip(words, self.survivors(words).tolist()):
            self.known.put(word, n)

    def count(self, texts: Sequence[str]) -> list[int]:
        lists = [self.vocab.pieces(t) for t in texts]
        words = {p: self.vocab.words(p) for p in self.pieces.missing(set().union(*lists))}
        self.learn(self.known.missing(set().union(*words.values()) - self.vocab.special.keys()))
        known = self.known.young
        for p, ws in words.items():
            self.pieces.put(p, sum(known.get(w, 1) for w in ws))  # a special token is one
        look_up = self.pieces.young.__getitem__
        return [sum(map(look_up, cut)) for cut in lists]

    def forget(self) -> None:
        self.known.clear()
        self.pieces.clear()


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    return MergeCounter(vocabulary(path))


def count_tokens(
    df: DataFrame, column: str = "text", path: str = VOCABULARY, limit: int = 2048, keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` of each text in ``column``.

    Null and empty texts have no bytes and no tokens. Columns with the results' names are replaced.
    """

    def make():
        tokens = counter(path)

        def work(texts: pa.Array):
            return [
                pc.cast(pc.binary_length(texts), pa.int64()),
                pa.array(tokens.count(texts.to_pylist()), pa.int64()),
            ]

        work.close = tokens.forget
        return work

    counted = map_texts(df, column, "n_bytes long, n_tokens long", make, keep)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
