"""Operator 11: alignment of two tokenizers' tokens, each distinct text once.

Texts are brought together by a shuffle on the whole text; each distinct one is encoded by both tokenizers and
its tokens are aligned by their bytes. A pair of ids counts with the number of documents that have one of the
texts in which it is linked. Measures go back to the documents by a digest of the text.

Neither tokenizer has a token across the border from a character to white space behind it, or from a letter to most
marks, so texts are cut there and what comes up again in a Python worker is aligned once, as far as its memory goes.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Remembered, map_texts, prepare, uncollected, written
from .sentence_pieces import _BLANKS, LETTERS, MODEL, SPACE, encoder, free_marks
from .word_bpe import byte_characters

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
WHITE = _BLANKS.replace(SPACE, "")
REMEMBERED = 256 << 20
# Id pairs of texts that are measured together in one task.
BLOCK_PAIRS = 1 << 20
FEW_LINKS = 64
JOINED = 500

FIELDS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<int>"
MEASURES = "text_key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Aligner:
    """Tokens of text behind a blank by a byte-level tokenizer (A) and a piece model (B), in groups of equal bytes."""

    def __init__(self, path_a: str, path_b: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte_of = {c: b for b, c in byte_characters().items()}
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for t, i in vocabulary.items():
            if all(c in byte_of for c in t):
                self.bytes_a[i] = bytes(byte_of[c] for c in t)
        self.b = encoder(path_b)
        self.bytes_b = self.b.model.bytes
        self.sizes_a, self.sizes_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.sizes_in_a = np.array(self.sizes_a)
        self.names_a, self.names_b = list(map(str, range(len(self.bytes_a)))), list(map(str, range(len(self.bytes_b))))
        self.known = Remembered(remembered)
        # White space that a piece may have behind a character does not begin a part.
        inside = "".join(c for c in WHITE if any(c in t[1:] and re.search(f"[^{_BLANKS}]{c}", t) for t in self.b.model.ids))
        more = f"(?:[{inside}][{WHITE}]*[^{WHITE}]*)*" if inside else ""
        marks = free_marks(self.b.model)
        before_mark = f"[{WHITE}]*+[^{WHITE}{marks}]++(?<=[{LETTERS}])(?=[{marks}])"
        self.parts = re.compile(f"{before_mark}|[{WHITE}]*[^{WHITE}]+{more}|[{WHITE}]+")

    def align(self, part: str, a: Sequence[int], b: Sequence[int]):
        """(tokens of A, of B, groups, links, the groups as text, id pairs, their links); none if the bytes differ.

        Pairs and links are 64-bit numbers in bytes; links are None where each pair is linked once.
        """
        whole = part.encode("utf-8")
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return None
        size_a, size_b, name_a, name_b = self.sizes_a, self.sizes_b, self.names_a, self.names_b
        shown, pairs, repeated = [], [], None
        i = j = n_links = 0
        while i < len(a):
            x, y = a[i], b[j]
            i += 1
            j += 1
            if size_a[x] == size_b[y]:
                shown.append(f"{name_a[x]}|{name_b[y]}")
                pairs.append(x << 32 | y)
                n_links += 1
                continue
            from_a, from_b, ahead = i - 1, j - 1, size_a[x] - size_b[y]
            while ahead:
                if ahead < 0:
                    ahead += size_a[a[i]]
                    i += 1
                else:
                    ahead -= size_b[b[j]]
                    j += 1
            group_a, group_b = a[from_a:i], b[from_b:j]
            shown.append(f"{','.join([name_a[x] for x in group_a])}|{','.join([name_b[y] for y in group_b])}")
            links = len(group_a) * len(group_b)
            n_links += links
            if links <= FEW_LINKS:
                pairs += [x << 32 | y for x in group_a for y in group_b]
                continue
            # Equal ids of a long group count once on each side.
            repeated = Counter() if repeated is None else repeated
            times_b = Counter(group_b).items()
            for x, m in Counter(group_a).items():
                for y, n in times_b:
                    repeated[x << 32 | y] += m * n
        links = None
        if repeated is not None or len(set(pairs)) < len(pairs):
            counted = Counter(pairs)
            counted.update(repeated or {})
            pairs, links = list(counted), np.fromiter(counted.values(), np.int64, len(counted)).tobytes()
        return len(a), len(b), len(shown), n_links, ";".join(shown), array("q", pairs).tobytes(), links

    def encode_a(self, parts: list[str]) -> Iterator[tuple[str, Sequence[int]]]:
        """Each part with A's ids. Parts that may stand behind each other without changing are encoded in one text."""
        alone = [p for p in parts if p[0] not in WHITE or p[-1] in WHITE]
        yield from zip(alone, (e.ids for e in self.a.encode_batch_fast(alone, add_special_tokens=False)))
        joined = [p for p in parts if p[0] in WHITE and p[-1] not in WHITE]
        runs = [joined[k : k + JOINED] for k in range(0, len(joined), JOINED)]
        for run, found in zip(runs, self.a.encode_batch_fast(["".join(run) for run in runs], add_special_tokens=False)):
            ids = found.ids
            reached = np.cumsum(self.sizes_in_a[ids])
            ends = np.cumsum([len(p.encode("utf-8")) for p in run])
            to = np.searchsorted(reached, ends)
            if to[-1] >= len(reached) or (reached[to] != ends).any():
                yield from zip(run, (e.ids for e in self.a.encode_batch_fast(run, add_special_tokens=False)))
                continue
            begin = 0
            for part, end in zip(run, (to + 1).tolist()):
                yield part, ids[begin:end]
                begin = end

    def learn(self, parts: list[str]) -> None:
        for part, a in self.encode_a(parts):
            found = self.align(part, a, self.b.encode_part(part.replace(" ", SPACE)))
            self.known.put(part, found, len(found[4]) + 2 * len(found[5]) + 150 if found else 0)

    def work(self, texts: pa.Array) -> list[pa.Array]:
        """The arrays of ``FIELDS`` for texts. One whose bytes differ from either side's tokens has no tokens."""
        with uncollected():
            return self._work(texts.to_pylist())

    def _work(self, texts: list[str]) -> list[pa.Array]:
        lists = [self.parts.findall(" " + t) if t and SPACE not in t else [] for t in texts]
        self.learn(self.known.missing(set().union(*lists)))
        entry = self.known.young.__getitem__
        counts, digests, pairs, links, sizes = [], [], [], [], []
        for cut in lists:
            found = list(map(entry, cut))
            if not found or None in found:
                counts.append((0, 0, 0, 0))
                digests.append("")
                sizes.append(0)
                continue
            n_a, n_b, groups, n_links, shown, ids, times = zip(*found)
            counts.append((sum(n_a), sum(n_b), sum(groups), sum(n_links)))
            digests.append(hashlib.sha256(";".join(shown).encode()).hexdigest())
            sizes.append(sum(map(len, ids)) // 8)
            pairs += ids
            links += times
        key = np.frombuffer(b"".join(pairs), np.int64)
        times = np.ones(len(key), np.int64)
        ends = np.cumsum(np.fromiter(map(len, pairs), np.int64, len(pairs))) // 8
        for k, several in enumerate(links):
            if several is not None:
                times[ends[k] - len(several) // 8 : ends[k]] = np.frombuffer(several, np.int64)
        total = len(key)
        text = np.repeat(np.arange(len(texts)), sizes)
        order = np.lexsort((key, text))
        key, times, text = key[order], times[order], text[order]
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))[:total])
        offsets = np.searchsorted(text[first], np.arange(len(texts) + 1)).astype(np.int32)
        summed = np.add.reduceat(times, first) if total else times
        return [
            *(pa.array(column, pa.int64()) for column in zip(*counts)),
            pa.array(digests, pa.string()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(key[first], pa.int64())),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(summed.astype(np.int32), pa.int32())),
        ]


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def aligned_texts(df: DataFrame, column: str = "text", path_a: str = BYTE_LEVEL, path_b: str = MODEL) -> DataFrame:
    """One row for each distinct text: text_key (its SHA-256), n (its rows), ``FIELDS``; written to the shared folder.

    ``pairs`` are the distinct linked id pairs, A's id in the upper 32 bits, and ``links`` their linked occurrences.
    Null counts as the empty text, which has no tokens.
    """
    prepare(df.sparkSession)
    distinct = df.select(F.coalesce(F.col(column), F.lit("")).alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("n"))

    def make():
        return aligner(path_a, path_b).work  # its memory has a bound and outlives the task

    keyed = distinct.select("text", "n", _key("text").alias("text_key"))
    return written(map_texts(keyed, "text", FIELDS, make, keep=["text_key", "n"]), "aligned")


def _key(column: str):
    return F.unhex(F.sha2(F.coalesce(F.col(column), F.lit("")), 256))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents an id pair is linked, and whether no pair of its A id is in more."""
    pairs = aligned.select("n", F.explode("pairs").alias("pair"))
    return _with_best(pairs.groupBy("pair").agg(F.sum("n").alias("count")))


def _with_best(counts: DataFrame) -> DataFrame:
    # An A id has no more pairs than B has ids.
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def text_measures(aligned: DataFrame) -> DataFrame:
    """``MEASURES`` of each distinct text of :func:`aligned_texts`.

    Texts are dealt into blocks by their key, with about ``BLOCK_PAIRS`` pairs each. A block gets the count of each of its
    pairs once, so a pair that all texts have is sent as often as there are blocks.
    """
    total = aligned.agg(F.sum(F.size("pairs").cast("long"))).first()[0] or 0
    block = F.pmod(F.xxhash64("text_key"), F.lit(total // BLOCK_PAIRS + 1)).alias("block")
    pairs = aligned.select(block, "n", F.explode("pairs").alias("pair"))
    held = written(pairs.groupBy("block", "pair").agg(F.sum("n").alias("count")), "block_pairs")
    counts = _with_best(held.groupBy("pair").agg(F.sum("count").alias("count")))
    known = held.select("block", "pair").join(counts, "pair")
    texts = aligned.drop("n").select(block, "*")
    fields = T.StructType.fromDDL(MEASURES)
    names = fields.names

    def measure(texts: pa.Table, known: pa.Table) -> pa.Table:
        texts, known = texts.combine_chunks(), known.combine_chunks()
        pair, count, best = (known.column(c).to_numpy() for c in ("pair", "count", "best"))
        order = np.argsort(pair)
        lists = texts.column("pairs").combine_chunks()
        times = texts.column("links").combine_chunks().flatten().to_numpy().astype(np.int64)
        sizes = lists.value_lengths().to_numpy()
        at = order[np.searchsorted(pair, lists.flatten().to_numpy(), sorter=order)] if len(times) else np.zeros(0, np.int64)
        ends = np.append(0, np.cumsum(sizes))

        def summed(values: np.ndarray) -> pa.Array:
            sums = np.append(0, np.cumsum(values))
            return pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())

        made = {"n_best": summed(times * best[at]), "count_sum": summed(times * count[at])}
        return pa.table([made.get(n, texts.column(n) if n not in made else None) for n in names], names=names)

    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(measure, fields)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of each document, one row for each row of ``docs``.

    A text that is null, empty, or whose bytes differ from those of either side's tokens has zeros and an empty
    ``groups_sha256``. Copies and repeated ids count as documents each. Long texts are taken whole, an empty
    table gives an empty table; other columns are not read.
    """
    measures = text_measures(aligned_texts(docs))
    ids = docs.select("doc_id", _key("text").alias("text_key"))
    return ids.join(measures, "text_key").drop("text_key")
