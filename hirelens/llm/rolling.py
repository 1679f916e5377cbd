"""Hashes of words and of word or byte windows of many texts at once, in numpy.

A text column is one array of bytes. The hash of a stretch is a difference of prefix sums, with weights
of an odd base so that they can be divided out modulo 2^64, mixed at the end. Windows have a few words each; long stretches
of bytes are hashed otherwise.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93
M64 = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
CONTINUES = (np.arange(256) & 0xC0) == 0x80
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32


# The powers of each base so far, up to so many; more are made anew for a longer text.
HELD = 1 << 20
_held: dict[int, np.ndarray] = {}
# Stretches of so many bytes and more are hashed one by one: sums modulo 2^64 are equal for some long unlike stretches.
LONG = 256


def powers(base: int, size: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64. One array for each base is kept, and no more than ``HELD`` numbers of it."""
    base &= M64
    found = _held.get(base)
    if found is None or len(found) < size:
        found = np.full(max(size, 1 << 12), base, np.uint64)
        found[0] = 1
        np.multiply.accumulate(found, out=found)
        if size <= HELD:
            _held[base] = found
    return found[:size]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of a public generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of values[start:end], from :func:`prefix_sums` of the values."""
    return mix((sums[ends] - sums[starts]) * powers(inverse(base), len(sums))[starts])


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``data[start:end]``; a long stretch's is XXH3's."""
    sums = prefix_sums(data.astype(np.uint64) + np.uint64(1), BASE)
    hashes = stretch_hashes(sums, starts, ends, BASE)
    for k in np.flatnonzero(ends - starts >= LONG):
        hashes[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    return hashes


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the offsets of each text in them (one more than there are texts)."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches where ``mask`` holds; stretches end where a text ends."""
    n = len(mask)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = mask
    starts = mask & (~before[:-1] | edge[:-1])
    after = np.zeros(n, bool)
    after[:-1] = mask[1:]
    ends = mask & (~after | edge[1:])
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


class Words(NamedTuple):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column: byte places, text numbers, hashes, and the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = runs(~SPACE[data], offsets)
    text = np.searchsorted(offsets, starts, "right") - 1
    hashes = byte_hashes(data, starts, ends)
    return Words(starts, ends, text, hashes, np.searchsorted(text, np.arange(len(offsets))))


def windows(words: Words, size: int, sums: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the windows of ``size`` words that lie inside one text."""
    at = np.arange(max(0, len(words.starts) - size + 1))
    at = at[words.text[at] == words.text[at + size - 1]] if len(at) else at
    if sums is None:
        sums = prefix_sums(words.hashes, STEP)
    return at, stretch_hashes(sums, at, at + size, STEP)


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    if len(keys):
        same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    later, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order], twice[order] = same[:-1], same[:-1] | same[1:]
    return twice, later


def covered(at: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` places lie in a window of ``size`` that starts at one of ``at``."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    return np.cumsum(change[:-1]) > 0


def per_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, values, n).astype(np.int64)
