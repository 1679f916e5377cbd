"""Operator 13: exact encoding by backtracking over a piece vocabulary with merges by score.

An encoding is the result of merging only if each two neighbours stay apart when they are merged anew
by themselves, and each text has just one such encoding. So the longest piece is tried at each place
(found for all places by one Aho-Corasick pass over the reversed text), then its shorter prefixes; a place from
which no way leads on is marked as failed and never tried again, since what stands before a place is always
encoded alike.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Iterable, Sequence
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, map_texts, uncollected

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
# Letters in every tokenizer's eyes, for a class of characters.
LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
# Bytes of remembered encodings and number of remembered pairs; neither changes a result.
REMEMBERED = 128 << 20
PAIRS = 1_000_000
# Kinds of pieces in a model file, and the kind of model that merges by score.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def wire_fields(data: bytes) -> Iterable[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 2: 0, 5: 4}[key & 7] or number()
        yield key >> 3, data[at : at + size]
        at += size


class PieceModel:
    """The pieces of a model file: texts (blanks as U+2581), scores and kinds by id, and what its settings say."""

    def __init__(self, path: str):
        self.texts: list[str] = []
        self.kinds: list[int] = []
        self.scores: list[float] = []
        trainer: dict = {}
        normalizer: dict = {}
        with open(path, "rb") as file:
            data = file.read()
        for number, value in wire_fields(data):
            if number == 1:
                piece = dict(wire_fields(value))
                self.texts.append(piece[1].decode("utf-8"))
                self.scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(wire_fields(value))
            elif number == 3:
                normalizer = dict(wire_fields(value))
        if trainer.get(3) != BPE or not trainer.get(35) or normalizer.get(2) or USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("only models that merge by score, fall back to bytes and leave texts as they are can be read")
        if not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models that put a blank in front and keep all others can be read")
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == NORMAL}
        self.byte_ids = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == BYTE}
        self.bytes = [
            bytes([int(t[3:5], 16)]) if k == BYTE else t.replace(SPACE, " ").encode("utf-8") if k == NORMAL else b""
            for t, k in zip(self.texts, self.kinds)
        ]
        self.letters = set().union(*self.ids)

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """The pieces of a short text by merging, best score first and then from the left.

        Also for each merge its score and the texts that stand at the left and the right end after it.
        """
        parts, steps = list(text), []
        ids, scores = self.ids, self.scores
        while True:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):
                t = ids.get(parts[k] + parts[k + 1])
                if t is not None and scores[t] > best:
                    best, at = scores[t], k
            if at < 0:
                return parts, steps
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: the blank in front goes, bytes that are no UTF-8 become U+FFFD each."""
        data = b"".join(map(self.bytes.__getitem__, ids))
        if ids and data[:1] == b" " and self.kinds[ids[0]] != BYTE:
            data = data[1:]
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_odd(ids)

    def _decode_odd(self, ids: Sequence[int]) -> str:
        out, run = [], b""
        for k, i in enumerate([*ids, None]):
            if i is not None and self.kinds[i] == BYTE:
                run += self.bytes[i]
                continue
            while run:
                size = next((n for n in range(1, 5) if _is_character(run[:n])), 0)
                out.append(run[:size].decode("utf-8") if size else "�")
                run = run[size or 1 :]
            if i is not None:
                text = self.bytes[i].decode("utf-8")
                out.append(text[1:] if k == 0 and text[:1] == " " else text)
        return "".join(out)


def _is_character(data: bytes) -> bool:
    try:
        return len(data.decode("utf-8")) == 1
    except UnicodeDecodeError:
        return False


def free_marks(model: PieceModel) -> str:
    """For a class of characters: the ASCII marks that no piece has behind one of ``LETTERS``."""
    letter = re.compile(f"[{LETTERS}]")
    bound = {t[k] for t in model.ids for k in range(1, len(t)) if letter.match(t[k - 1])}
    return re.escape("".join(c for c in string.punctuation if c not in bound)) or "\0"


class BacktrackEncoder:
    def __init__(self, model: PieceModel):
        self.model = model
        self.sizes = [len(t) for t in model.texts]
        self.ends: dict[int, tuple[list, list, list]] = {}
        # For each piece the pieces behind it, and whether they stay apart.
        self.pairs: list[dict[int, bool]] = [{} for _ in self.sizes]
        self.held = 0
        # Pieces whose own text is merged to them: no other ever comes up.
        self.whole = {t: i for t, i in model.ids.items() if len(t) == 1 or len(model.merges(t)[0]) == 1}
        # The longest piece that each begins with, beside itself; -1 if there is none.
        self.shorter = [-1] * len(self.sizes)
        self.longest = ahocorasick.Automaton()
        for text, i in self.whole.items():
            self.longest.add_word(text[::-1], i)
            self.shorter[i] = next((self.whole[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.whole), -1)
        self.longest.make_automaton()
        # White space that no piece has behind another character begins a part that is encoded by itself, and so does a
        # mark that none has behind a letter.
        inside = {t[k] for t in model.ids for k in range(1, len(t)) if t[k - 1] not in _BLANKS}
        free = "".join(c for c in _BLANKS if c not in inside)
        marks = free_marks(model)
        self.parts = re.compile(f"(?:[{free}]++[^{free}{marks}]*+|[^{free}{marks}]++)(?<=[{LETTERS}])(?=[{marks}])|[{free}]+[^{free}]*|[^{free}]+")

    def building(self, piece: int) -> tuple[list[float], list[str], list[str]]:
        """The scores of the merges that make the piece, and what stands at its left and right end before each and at last."""
        found = self.ends.get(piece)
        if found is None:
            text = self.model.texts[piece]
            _, steps = self.model.merges(text)
            found = ([s for s, _, _ in steps] + [-np.inf], [text[0]] + [x for _, x, _ in steps], [text[-1]] + [y for _, _, y in steps])
            self.ends[piece] = found
        return found

    def apart(self, a: int, b: int) -> bool:
        """Whether two pieces are the result of merging their joined text anew.

        The merges inside the two are done again in their common order until one across the border would come first.
        """
        ids, scores = self.model.ids, self.model.scores
        left, _, at_right = self.building(a)
        right, at_left, _ = self.building(b)
        i = j = 0
        x, y = at_right[0], at_left[0]
        both = ids.get(x + y)
        while True:
            mine, other = left[i], right[j]
            if both is not None and scores[both] > mine and scores[both] >= other:
                return False
            if mine >= other:
                if mine == -np.inf:
                    return True
                i += 1
                if at_right[i] is x:
                    continue
                x = at_right[i]
            else:
                j += 1
                if at_left[j] is y:
                    continue
                y = at_left[j]
            both = ids.get(x + y)

    def encode_part(self, text: str) -> tuple[int, ...]:
        """The ids of a text whose blanks are U+2581, without the blank in front of all."""
        only = self.whole.get(text)
        if only is not None:
            return (only,)
        sizes, shorter, pairs, n = self.sizes, self.shorter, self.pairs, len(text)
        if self.held > PAIRS:
            for row in pairs:
                row.clear()
            self.held = 0
        longest, seen = array("i", [-1]) * (n + 1), n
        for end, piece in self.longest.iter(text[::-1]):
            if end != seen:  # the first at each place is the longest
                seen = end
                longest[n - 1 - end] = piece
        failed = None
        path: list[int] = []
        at, last, piece, odd = 0, -1, longest[0], False
        while at < n:
            if longest[at] < 0:  # a character without a piece stands apart from all
                last, odd = -1 - ord(text[at]), True
                path.append(last)
                at += 1
                piece = longest[at]
                continue
            row = pairs[last] if last >= 0 else None
            while piece >= 0:
                end = at + sizes[piece]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if row is None:
                        break
                    free = row.get(piece)
                    if free is None:
                        free = row[piece] = self.apart(last, piece)
                        self.held += 1
                    if free:
                        break
                piece = shorter[piece]
            if piece >= 0:
                path.append(piece)
                last, at, piece = piece, end, longest[end]
                continue
            if failed is None:
                failed = bytearray(n // 8 + 1)
            failed[at >> 3] |= 1 << (at & 7)
            while path[-1] < 0:  # the way to a character without a piece has no other
                path.pop()
                at -= 1
                failed[at >> 3] |= 1 << (at & 7)
            piece = path.pop()
            at -= sizes[piece]
            last, piece = path[-1] if path else -1, shorter[piece]
        if not odd:
            return tuple(path)
        bytes_of = self.model.byte_ids
        spelt = ([p] if p >= 0 else [bytes_of[b] for b in chr(-1 - p).encode("utf-8", "surrogatepass")] for p in path)
        return tuple(chain.from_iterable(spelt))

    def cut(self, text: str) -> list[str]:
        """The parts of a text with a blank in front that are encoded by themselves."""
        return self.parts.findall(SPACE + text.replace(" ", SPACE)) if text else []


# Fixed value: the characters that are white space, and the sign for a blank.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0                　" + SPACE


@lru_cache(maxsize=1)
def memory(path: str) -> Remembered:
    """A Python worker's encodings of parts; it has a bound and outlives the task."""
    return Remembered(REMEMBERED)


@lru_cache(maxsize=2)
def encoder(path: str) -> BacktrackEncoder:
    return BacktrackEncoder(PieceModel(path))


def encode(df: DataFrame, column: str = "text", path: str = MODEL, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with ``ids`` (array of int) and ``decoded`` (text), the round trip of each text in ``column``.

    Null and empty texts give no ids and the empty text; an empty table gives an empty table. Repeated rows are
    encoded alike, long texts whole. Columns named ids or decoded, in any case of letters, are replaced.
    """

    def make():
        coder = encoder(path)
        known = memory(path)

        def work(texts: pa.Array):
            with uncollected():
                lists = [coder.cut(t) for t in texts.to_pylist()]
                for part in known.missing(set().union(*lists)):
                    ids = coder.encode_part(part)
                    spelt = b"".join(map(coder.model.bytes.__getitem__, ids))
                    known.put(part, (array("i", ids).tobytes(), spelt), 4 * len(ids) + len(spelt) + 150)
                found = known.young.__getitem__
                coded = [list(zip(*map(found, cut))) or ((), ()) for cut in lists]
                ids = [b"".join(c[0]) for c in coded]
                # What the ids spell, without the blank in front.
                decoded = [b"".join(c[1])[1:] for c in coded]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
            flat = np.frombuffer(b"".join(ids), np.int32)
            made = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            return [made, pa.array(decoded, pa.binary()).cast(pa.string())]

        return work

    return map_texts(df, column, "ids array<int>, decoded string", make, keep)


def digests(df: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of documents, one row for each row of ``df``."""
    coded = encode(df.select("doc_id", "text"), path=path, keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
