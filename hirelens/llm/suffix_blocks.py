"""Operator 5: removal of repeated byte strings by suffix buckets with a difference cover.

Only suffixes that can matter are sorted. Every window of ``LENGTH`` bytes has an anchor, its 20-byte string of least
hash, chosen by content alone, so equal windows have equal anchors at equal places. Hashes of anchors that
occur in one document only are set aside first. What is left goes, with the bytes around it, to buckets by
the anchor's hash, and one bucket is sorted at a time: suffixes at the columns of a difference cover modulo 13 are
ranked first, with the lengths of their common prefixes, and any other suffix is ordered by the few bytes up to
the next column of the cover and the rank there. Ties of any length are thus settled by ranks, and memory
is bounded by a bucket. In each class of equal windows all but those of the smallest document are marked.

Texts are dealt into groups by their id; a group's own repeats are settled before anything is sent, so that a
passage that is everywhere is sent once for each group.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .common import prepare, texts_of

LENGTH, GRAM = 50, 20
BEFORE = LENGTH - GRAM  # an anchor lies at most so far behind the start of its window
WIDE = BEFORE + LENGTH  # bytes around an anchor that its windows can cover
COVER, PERIOD = (0, 1, 3, 9), 13  # every difference modulo 13 is one of two members
COLUMNS = [c for c in range(BEFORE + PERIOD) if c % PERIOD in COVER]
NEXT = [next(c for c in COLUMNS if c >= s) for s in range(BEFORE + 1)]
PIECE = 1 << 18
PLACE_BITS = 24
STORED = 5  # bytes of a hash that are sent; the bucket says the rest, and chance equals are told apart by the sort
GROUPS_PER_PARTITION = 2


class Anchors(NamedTuple):
    """Anchors of the windows of some texts: text, byte place, hash, and how far before it its windows start."""

    text: np.ndarray
    place: np.ndarray
    hash: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _pieces(offsets: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Batches of (text, start, end) of about ``PIECE`` bytes; long texts are cut so that every window lies in one piece."""
    batch, held = [], 0
    for k in range(len(offsets) - 1):
        start, end = int(offsets[k]), int(offsets[k + 1])
        while end - start >= LENGTH:
            stop = min(end, start + PIECE)
            batch.append((k, start, stop))
            held += stop - start
            start = stop - LENGTH + 1 if stop < end else end
            if held >= PIECE:
                yield batch
                batch, held = [], 0
    if batch:
        yield batch


def anchors(data: np.ndarray, offsets: np.ndarray) -> Anchors:
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    for batch in _pieces(offsets):
        text, start, end = (np.array(x, np.int64) for x in zip(*batch))
        size = end - start
        edge = np.append(0, np.cumsum(size))
        part = np.concatenate([data[a:b] for _, a, b in batch])
        sums = rolling.prefix_sums(part.astype(np.uint64) + np.uint64(1), rolling.BASE)
        n = len(part) - GRAM + 1
        at = np.arange(n)
        hashes = rolling.mix((sums[GRAM:] - sums[:n]) * rolling.powers(rolling.inverse(rolling.BASE), len(sums))[:n])
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = (hashes & ~low) | at.astype(np.uint64)
        for step in (1, 2, 4, 8):
            least = np.minimum(least[:-step], least[step:])
        last = BEFORE + 1 - 16
        least = np.minimum(least[: len(least) - last], least[last:])
        # ``least[i]`` is the anchor of the window at i.
        windows = np.arange(len(least))
        owner = np.repeat(np.arange(len(size)), size)[: len(least)]
        real = windows + LENGTH <= edge[1:][owner]
        windows, owner, chosen = windows[real], owner[real], (least[real] & low).astype(np.int64)
        new = np.append(True, (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1]))
        first = np.flatnonzero(new)
        final = np.append(first[1:], len(windows)) - 1
        a, o = chosen[first], owner[first]
        base = start[o] - edge[:-1][o] - offsets[text[o]]
        for values, x in zip(out, (text[o], a + base, hashes[a], a - windows[final], a - windows[first])):
            values.append(x)
    kinds = (np.int64, np.int64, np.uint64, np.int64, np.int64)
    return Anchors(*(np.concatenate(v) if v else np.zeros(0, k) for v, k in zip(out, kinds)))


def contexts(data: np.ndarray, offsets: np.ndarray, found: Anchors) -> np.ndarray:
    """The bytes from ``BEFORE`` before each anchor on, zero outside the anchor's windows."""
    out = np.zeros((len(found.place), WIDE), np.uint8)
    column = np.arange(WIDE)[None, :]
    for k in range(0, len(out), 1 << 16):
        rows = slice(k, k + (1 << 16))
        at = (offsets[found.text[rows]] + found.place[rows])[:, None] + np.arange(-BEFORE, LENGTH)[None, :]
        part = data[np.clip(at, 0, max(0, len(data) - 1))]
        part[(column < BEFORE - found.high[rows, None]) | (column >= WIDE - found.low[rows, None])] = 0
        out[rows] = part
    return out


def resolve(key: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, around: np.ndarray) -> np.ndarray:
    """[row, d]: whether the window that starts d bytes before the anchor also starts in a smaller document.

    Rows with one key have one anchor. This is the sort of one bucket.
    """
    marked = np.zeros((len(key), BEFORE + 1), bool)
    for c in COLUMNS:
        starts = [s for s in range(BEFORE + 1) if NEXT[s] == c]
        if not starts:
            continue
        rows = np.flatnonzero((BEFORE - high <= starts[-1]) & (BEFORE - low >= starts[0]))
        if len(rows) < 2:
            continue
        # Ranks of the cover's suffixes in this column, and common prefixes of neighbours in rank.
        suffix = np.zeros((len(rows), 56), np.uint8)
        suffix[:, : min(LENGTH, WIDE - c)] = around[rows, c : c + LENGTH]
        packed = suffix.view(">u8").astype(np.uint64)
        order = np.lexsort((*packed.T[::-1], key[rows]))
        rows, suffix = rows[order], suffix[order]
        differ = suffix[1:] != suffix[:-1]
        common = np.where(differ.any(1), differ.argmax(1), LENGTH)
        common[key[rows][1:] != key[rows][:-1]] = -1
        for s in starts:
            # Classes of what follows the cover's column, then the bytes before it.
            kind = np.append(0, np.cumsum(common < LENGTH - (c - s)))
            here = np.flatnonzero((BEFORE - high[rows] <= s) & (s <= BEFORE - low[rows]))
            if len(here) < 2:
                continue
            before = np.zeros(len(here), np.int64)
            for k in range(s, c):
                before = before << 8 | around[rows[here], k]
            kind, own = kind[here], doc[rows[here]]
            order = np.lexsort((own, before, kind))
            kind, before, own = kind[order], before[order], own[order]
            new = np.append(True, (kind[1:] != kind[:-1]) | (before[1:] != before[:-1]))
            least = own[np.flatnonzero(new)][np.cumsum(new) - 1]
            marked[rows[here[order]], BEFORE - s] = own > least
    return marked


def stretches(marked: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the bytes that marked windows cover."""
    flags = np.zeros((len(marked), marked.shape[1] + 2), np.int8)
    flags[:, 1:-1] = marked
    change = np.diff(flags, axis=1)
    row, near = np.nonzero(change == 1)
    _, far = np.nonzero(change == -1)  # windows start between near and far - 1 bytes before the anchor
    return row, place[row] - (far - 1), place[row] - near + LENGTH


# --- groups of texts ------------------------------------------------------------------------


class Group(NamedTuple):
    """The texts of a group in the order of (id, text), which does not depend on how rows arrive."""

    ids: pa.Array
    order: np.ndarray  # ids as numbers; null counts as the largest
    texts: pa.Array
    data: np.ndarray
    offsets: np.ndarray


def _group(table: pa.Table) -> Group:
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    ids = table.column("doc_id").combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    texts = texts_of(table.column("text"))
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    data, offsets = rolling.bytes_of(texts)
    return Group(ids, ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False), texts, data, offsets)


def _dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and stored number of each hash; the number's lowest bit is free."""
    return (hashes % np.uint64(buckets)).astype(np.int64), ((hashes // np.uint64(buckets)) & np.uint64((1 << 39) - 1)) << np.uint64(1)


def _pack(numbers: np.ndarray) -> bytes:
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :STORED].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // STORED, 8), np.uint8)
    out[:, :STORED] = np.frombuffer(data, np.uint8).reshape(-1, STORED)
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.append(bucket[order][1:] != bucket[order][:-1], len(order) > 0))
    start = 0
    for end in ends + 1:
        yield int(bucket[order[start]]), order[start:end]
        start = end




def _records(number, doc, row, place, low, high, around) -> bytes:
    """Columns one after another, which compress better than rows; of the bytes around only those in use."""
    used = np.arange(WIDE)[None, :]
    used = (used >= BEFORE - high[:, None]) & (used < WIDE - low[:, None])
    parts = [np.array([len(number)], "<i8"), doc.astype("<i8"), row.astype("<i4"), place.astype("<i4"), low.astype("u1"), high.astype("u1")]
    return b"".join([*(p.tobytes() for p in parts), _pack(number), around[used].tobytes()])


def _read_records(data: bytes) -> tuple:
    n, at = int(np.frombuffer(data, "<i8", 1)[0]), 8
    out = []
    for kind, width in (("<i8", 8), ("<i4", 4), ("<i4", 4), ("u1", 1), ("u1", 1)):
        out.append(np.frombuffer(data, kind, n, at).astype(np.int64))
        at += n * width
    number = _unpack(data[at : at + n * STORED])
    doc, row, place, low, high = out
    around = np.zeros((n, WIDE), np.uint8)
    used = np.arange(WIDE)[None, :]
    around[(used >= BEFORE - high[:, None]) & (used < WIDE - low[:, None])] = np.frombuffer(data, np.uint8, -1, at + n * STORED)
    return number, doc, row, place, low, high, around


def _spans(row, start, end) -> bytes:
    return np.stack([row, start, end], 1).astype("<i8").tobytes()


def removed_spans(rows: DataFrame, groups: int) -> DataFrame:
    """(part, spans) for ``rows`` (part, doc_id, text) dealt into parts: packed (row, start, end) of the bytes to remove."""

    def offer(key: tuple, table: pa.Table) -> pa.Table:
        group = _group(table)
        found = anchors(group.data, group.offsets)
        order = np.lexsort((group.order[found.text], found.hash))
        h, doc = found.hash[order], group.order[found.text][order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(h)) - 1 if len(h) else first
        bucket, number = _dealt(h[first], groups)
        number |= (doc[first] != doc[last]).astype(np.uint64)  # several documents of the group have it
        made = [(b, _pack(np.sort(number[at]))) for b, at in _by_bucket(bucket)]
        return pa.table({
            "bucket": pa.array([b for b, _ in made], pa.int32()), "part": pa.array([key[0].as_py()] * len(made), pa.int32()),
            "numbers": pa.array([x for _, x in made], pa.binary()),
        })

    def shared(key: tuple, table: pa.Table) -> pa.Table:
        parts = table.column("part").to_pylist()
        lists = [_unpack(x) for x in table.column("numbers").to_pylist()]
        numbers = np.concatenate(lists)
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        plain = numbers >> np.uint64(1)
        order = np.argsort(plain, kind="stable")
        sorted_ = plain[order]
        twice = np.zeros(len(sorted_) + 1, bool)
        twice[1:-1] = sorted_[1:] == sorted_[:-1]
        common = np.zeros(len(plain), bool)
        common[order] = twice[:-1] | twice[1:]
        common |= (numbers & np.uint64(1)) == 1
        made = [(parts[k], _pack(plain[at] << np.uint64(1))) for k, at in _by_bucket(np.where(common, owner, -1)) if k >= 0]
        return pa.table({
            "part": pa.array([p for p, _ in made], pa.int32()), "bucket": pa.array([key[0].as_py()] * len(made), pa.int32()),
            "numbers": pa.array([x for _, x in made], pa.binary()),
        })

    def send(key: tuple, table: pa.Table, wanted: pa.Table) -> pa.Table:
        empty = pa.table({"target": pa.array([], pa.int32()), "part": pa.array([], pa.int32()), "data": pa.array([], pa.binary())})
        if not table.num_rows or not wanted.num_rows:
            return empty
        group = _group(table)
        found = anchors(group.data, group.offsets)
        bucket, number = _dealt(found.hash, groups)
        keep = np.zeros(len(number), bool)
        lists = dict(zip(wanted.column("bucket").to_pylist(), wanted.column("numbers").to_pylist()))
        for b, at in _by_bucket(bucket):
            if b in lists:
                common = np.sort(_unpack(lists[b]))
                place = np.minimum(np.searchsorted(common, number[at]), len(common) - 1)
                keep[at] = common[place] == number[at]
        found = Anchors(*(x[keep] for x in found))
        bucket, number, doc = bucket[keep], number[keep], group.order[found.text]
        low, high = found.low.copy(), found.high.copy()
        around = contexts(group.data, group.offsets, found)
        out: list[tuple[int, bytes]] = []
        # The group's own repeats.
        _, where, times = np.unique(found.hash, return_inverse=True, return_counts=True)
        own = np.flatnonzero(times[where] > 1)
        alive = np.ones(len(doc), bool)
        if len(own):
            marked = resolve(found.hash[own], doc[own], low[own], high[own], around[own])
            r, s, e = stretches(marked, found.place[own])
            if len(r):
                out.append((groups + key[0].as_py(), _spans(found.text[own][r], s, e)))
            d = np.arange(BEFORE + 1)[None, :]
            left = ~marked & (d >= low[own, None]) & (d <= high[own, None])
            alive[own] = left.any(1)
            low[own] = np.where(left.any(1), left.argmax(1), low[own])
            high[own] = np.where(left.any(1), BEFORE - left[:, ::-1].argmax(1), high[own])
        live = np.flatnonzero(alive)
        for b, at in _by_bucket(bucket[live]):
            at = live[at]
            out.append((b, _records(number[at], doc[at], found.text[at], found.place[at], low[at], high[at], around[at])))
        return pa.table({
            "target": pa.array([t for t, _ in out], pa.int32()), "part": pa.array([key[0].as_py()] * len(out), pa.int32()),
            "data": pa.array([x for _, x in out], pa.binary()),
        })

    def settle(key: tuple, table: pa.Table) -> pa.Table:
        parts, blobs = np.array(table.column("part").to_pylist()), table.column("data").to_pylist()
        if key[0].as_py() >= groups:  # a group's own repeats, on their way back
            return pa.table({"part": pa.array(parts, pa.int32()), "spans": pa.array(blobs, pa.binary())})
        read = [_read_records(x) for x in blobs]
        number, doc, row, place, low, high, around = (np.concatenate(x) for x in zip(*read))
        part = np.repeat(parts, [len(x[0]) for x in read])
        r, s, e = stretches(resolve(number, doc, low, high, around), place)
        made = [(p, _spans(row[r][at], s[at], e[at])) for p, at in _by_bucket(part[r])]
        return pa.table({"part": pa.array([p for p, _ in made], pa.int32()), "spans": pa.array([x for _, x in made], pa.binary())})

    offered = rows.groupBy("part").applyInArrow(offer, "bucket int, part int, numbers binary")
    common = offered.groupBy("bucket").applyInArrow(shared, "part int, bucket int, numbers binary")
    sent = rows.groupBy("part").cogroup(common.groupBy("part")).applyInArrow(send, "target int, part int, data binary")
    return sent.groupBy("target").applyInArrow(settle, "part int, spans binary")


def kept_bytes(df: DataFrame, id_column: str = "doc_id", column: str = "text", groups: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the removed stretches as (start, end) in bytes, and the bytes that stay.

    A byte goes if a string of 50 bytes over it also starts in a document with a smaller id. Null counts as the
    empty text, which stays empty, and a null id as larger than all others. Rows with one id are one document: they
    never remove from each other.
    """
    spark = prepare(df.sparkSession)
    groups = groups or GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(column), F.lit("")).alias("text"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(groups)).cast("int"))
    spans = removed_spans(rows, groups)
    schema = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(key: tuple, table: pa.Table, marks: pa.Table) -> pa.Table:
        group = _group(table) if table.num_rows else None
        if group is None:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()), "spans": pa.array([], span_type), "kept": pa.array([], pa.binary())})
        change = np.zeros(len(group.data) + 1, np.int64)
        for blob in marks.column("spans").to_pylist():
            row, start, end = np.frombuffer(blob, "<i8").reshape(-1, 3).T
            np.add.at(change, group.offsets[row] + start, 1)
            np.add.at(change, group.offsets[row] + end, -1)
        gone = np.cumsum(change[:-1]) > 0
        starts, ends = rolling.runs(gone, group.offsets)
        owner = np.searchsorted(group.offsets, starts, "right") - 1
        per = np.append(0, np.cumsum(np.bincount(owner, minlength=len(group.ids)))).astype(np.int32)
        pair = pa.StructArray.from_arrays(
            [pa.array(starts - group.offsets[owner]), pa.array(ends - group.offsets[owner])], names=["start", "end"]
        )
        stays = group.data[~gone]
        ends_at = np.append(0, np.cumsum(~gone))[group.offsets].astype(np.int32)
        kept = pa.Array.from_buffers(pa.binary(), len(group.ids), [None, pa.py_buffer(ends_at.tobytes()), pa.py_buffer(stays.tobytes())])
        return pa.table({
            "doc_id": group.ids, "n_bytes": pa.array(np.diff(group.offsets), pa.int64()),
            "spans": pa.ListArray.from_arrays(pa.array(per), pair).cast(span_type), "kept": kept,
        })

    return rows.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(cut, schema)


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of documents."""
    found = kept_bytes(df.select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
