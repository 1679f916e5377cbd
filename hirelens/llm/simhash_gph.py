"""Operator 4: SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are dealt into parts, bits that go together into the same part. For every fingerprint the
parts get thresholds t_1..t_m that add up to tau - m + 1 (-1: the part is not probed). Any fingerprint
within tau differs from it by at most t_i bits in some part i, since otherwise the differences would
add up to more than tau. The thresholds are those of least estimated cost, by dynamic programming.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, prepare, written
from .components import components

BITS = 64
SEED = 42
# Rows of a bucket that are compared in one piece; larger buckets are compared piece by piece.
PIECE = 4096
# Buckets up to this size give all their links, larger ones a spanning tree of each cluster.
SMALL = 8
# What a row that is sent costs, in comparisons.
ROW_COST = 64.0


# --- fingerprints ---------------------------------------------------------------------------


def fingerprint(text: bytes, size: int = 3, seed: int = SEED) -> int:
    """Majority bits of the XXH64 of all shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed) for s in shingles], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, column: str = "text", size: int = 3, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the fingerprint ``fp`` (long) of each text; null and empty texts have fingerprint 0."""

    def work(texts: pa.Array):
        found = [fingerprint(t, size) for t in texts.cast(pa.binary()).to_pylist()]
        return [pa.array(np.array(found, np.uint64).view(np.int64))]

    return map_texts(df, column, "fp long", lambda: work, keep)


# --- parts and thresholds -------------------------------------------------------------------


def _fp_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def bit_table(fps: DataFrame) -> np.ndarray:
    """How often bits i and j are set together: 64 x 64 counts over all fingerprints."""

    def partial(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for fp in _fp_arrays(batches):
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        cell = np.arange(BITS * BITS)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.reshape(-1))], ["cell", "n"])

    rows = fps.select("fp").mapInArrow(partial, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(BITS * BITS, np.int64)
    for cell, n in rows.collect():  # at most 4096 rows
        out[cell] = n
    return out.reshape(BITS, BITS)


def group_bits(together: np.ndarray, count: int, parts: int) -> list[list[int]]:
    """Deal the bits into parts of equal size, each time adding the bit most correlated with the part."""
    share = np.diag(together) / max(1, count)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    corr = np.abs((together / max(1, count) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, out = set(range(BITS)), []
    sizes = [BITS // parts + (k < BITS % parts) for k in range(parts)]
    for size in sizes:
        part = [max(free, key=lambda b: (corr[b, list(free)].sum(), -b))]
        free.discard(part[0])
        while len(part) < size:
            best = max(free, key=lambda b: (corr[b, part].sum(), -b))
            part.append(best)
            free.discard(best)
        out.append(sorted(part))
    return out


def values_of(fp: np.ndarray, bits: Sequence[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def blocks_of(parts: Sequence[Sequence[int]], width: int = 8) -> list[tuple[int, list[int]]]:
    """(part, bits) of the blocks of at most ``width`` bits for which values are counted."""
    return [(i, list(bits[k : k + width])) for i, bits in enumerate(parts) for k in range(0, len(bits), width)]


def block_counts(fps: DataFrame, parts: Sequence[Sequence[int]]) -> list[np.ndarray]:
    """How often each value of each block occurs: 256 counts for every 8 bits, whatever the input's size."""
    blocks = blocks_of(parts)

    def partial(batches):
        total = np.zeros((len(blocks), 256), np.int64)
        for fp in _fp_arrays(batches):
            for k, (_, bits) in enumerate(blocks):
                total[k] += np.bincount(values_of(fp, bits).astype(np.int64), minlength=256)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.reshape(-1))], ["cell", "n"]
        )

    rows = fps.select("fp").mapInArrow(partial, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(len(blocks) * 256, np.int64)
    for cell, n in rows.collect():  # 256 rows for each block of 8 bits
        out[cell] = n
    return list(out.reshape(len(blocks), 256))


def estimates(fp: np.ndarray, parts, counts: Sequence[np.ndarray], count: int, most: int) -> np.ndarray:
    """Estimated fingerprints within 0..most bits of each given one, in each part: [part, distance, row].

    Within a block the counts are exact; blocks of a part are taken as independent.
    """
    flips = [[np.uint64(sum(1 << b for b in c)) for c in combinations(range(8), d)] for d in range(most + 1)]
    out = np.zeros((len(parts), most + 1, len(fp)))
    shares: dict[int, np.ndarray] = {}
    for (i, bits), table in zip(blocks_of(parts), counts):
        value, within = values_of(fp, bits), np.zeros((most + 1, len(fp)))
        for d in range(most + 1):
            for mask in flips[d]:
                if int(mask) < 1 << len(bits):
                    within[d] += table[(value ^ mask).astype(np.int64)]
        within /= max(1, count)
        if i in shares:
            within = np.stack([sum(shares[i][e] * within[d - e] for e in range(d + 1)) for d in range(most + 1)])
        shares[i] = within
    for i, share in shares.items():
        out[i] = np.cumsum(share, 0) * count
    return out


def allocate(cost: np.ndarray, total: int) -> np.ndarray:
    """Thresholds of least cost that add up to ``total``: [part, row], by dynamic programming over the parts.

    ``cost[i, t + 1, row]`` is what threshold t (-1 and up) costs in part i.
    """
    m, levels, rows = cost.shape
    span = total + m + 1  # sums of thresholds plus their number run from 0
    best = np.full((span, rows), np.inf)
    best[0] = 0
    came = np.zeros((m, span, rows), np.int8)
    for i in range(m):
        new = np.full((span, rows), np.inf)
        for t in range(min(levels, span)):
            tried = np.full((span, rows), np.inf)
            tried[t:] = best[: span - t] + cost[i, t]
            better = tried < new
            new[better] = tried[better]
            came[i][better] = t
        best = new
    left, out = np.full(rows, total + m), np.zeros((m, rows), np.int64)
    for i in range(m - 1, -1, -1):
        out[i] = came[i, left, np.arange(rows)]
        left = left - out[i]
    return out - 1


def parts_for(count: int, tau: int) -> int:
    """The number of parts of least cost for evenly spread fingerprints: rows sent and pairs compared."""

    def cost(m: int) -> float:
        slack, width = tau - m + 1, BITS / m
        probes = sum(sum(_choose(width, d) for d in range((slack + k) // m + 1)) for k in range(m) if slack + k >= 0)
        return count * (ROW_COST * (probes + m) + probes * count / 2**width)

    count = max(1, count)  # an empty table takes the parts of least probes
    return min(range(1, tau + 2), key=cost)


def _choose(n: float, k: int) -> float:
    out = 1.0
    for i in range(k):
        out *= (n - i) / (i + 1)
    return out


# --- probing and verifying ------------------------------------------------------------------


def probes(fps: DataFrame, parts: Sequence[Sequence[int]], counts, count: int, tau: int) -> DataFrame:
    """(part, value, fp): the buckets in which each fingerprint lies and those it has to look into."""
    m, total = len(parts), tau - len(parts) + 1
    most = max(0, min(total + m - 1, -(-total // m) + 1))  # the least cost never needs one part to bear much more than its share
    masks = [
        [np.array([sum(1 << b for b in c) for c in combinations(range(len(bits)), d)], np.uint64) for d in range(most + 1)]
        for bits in parts
    ]

    def emit(batches):
        for fp in _fp_arrays(batches):
            if not len(fp):
                continue
            number = np.array([[sum(len(masks[i][e]) for e in range(d + 1)) for d in range(most + 1)] for i in range(m)])
            near = estimates(fp, parts, counts, count, most) + ROW_COST * number[:, :, None]
            cost = np.concatenate([np.zeros((m, 1, len(fp))), near], 1)
            levels = allocate(cost, total)
            for i, bits in enumerate(parts):
                value = values_of(fp, bits)
                for d in range(most + 1):
                    asked = np.flatnonzero(levels[i] >= d) if d else np.arange(len(fp))
                    mask = masks[i][d]
                    if not len(asked):
                        continue
                    for k in range(0, len(asked), max(1, 100_000 // len(mask))):
                        rows = asked[k : k + max(1, 100_000 // len(mask))]
                        keys = (value[rows][:, None] ^ mask[None, :]).reshape(-1)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(keys), i, np.int32)),
                                pa.array(keys.view(np.int64)),
                                pa.array(np.repeat(fp[rows], len(mask)).view(np.int64)),
                            ],
                            ["part", "value", "fp"],
                        )

    return fps.select("fp").mapInArrow(emit, "part int, value long, fp long")


def cut_large(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """Add (one, two): the pair of pieces in which rows are compared. Buckets up to ``piece`` rows are one piece.

    A bucket of k pieces is compared as k (k + 1) / 2 pairs of pieces, each of which fits one task.
    """
    large = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > piece)
    marked = rows.join(large, ["part", "value"], "left")
    pieces = F.ceil(F.col("n") / piece).cast("int")
    own = F.pmod(F.xxhash64("fp"), pieces).cast("int")
    other = F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), pieces - 1)))
    out = marked.withColumn("own", F.when(F.col("n").isNull(), 0).otherwise(own)).withColumn("other", other)
    return out.select("part", "value", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "fp")


def links_in_bucket(fp: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning tree of each cluster of one bucket, where linked fingerprints are at most ``tau`` bits apart."""
    n = len(fp)
    label = np.arange(n)
    step = max(1, 4_000_000 // n)
    while True:
        new = label.copy()
        for k in range(0, n, step):
            near = np.bitwise_count(fp[k : k + step, None] ^ fp[None, :]) <= tau
            new[k : k + step] = np.where(near, label[None, :], n).min(1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = np.flatnonzero(label != np.arange(n))
    return fp[rest], fp[label[rest]]


def links(rows: DataFrame, tau: int, partitions: int | None = None) -> DataFrame:
    """(a, b): fingerprints joined within buckets. Clusters come whole, not necessarily all their pairs."""
    keys = ["part", "value", "one", "two"]
    count = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut_large(rows).repartition(count, *keys).sortWithinPartitions(*keys, "fp")

    def found(key: np.ndarray, fp: np.ndarray):
        a, b = [], []
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
        size = np.diff(np.append(first, len(fp)))
        for start, n in zip(first[size > SMALL], size[size > SMALL]):
            u, v = links_in_bucket(np.unique(fp[start : start + n]), tau)
            a.append(u)
            b.append(v)
        left = np.repeat(np.where(size <= SMALL, first + size, 0), size)  # where the bucket ends, for small ones
        at = np.arange(len(fp))
        for shift in range(1, SMALL):
            at = at[at + shift < left[at]]
            near = at[np.bitwise_count(fp[at] ^ fp[at + shift]) <= tau]
            near = near[fp[near] != fp[near + shift]]
            a.append(fp[near])
            b.append(fp[near + shift])
        return np.concatenate([np.zeros(0, np.uint64), *a]), np.concatenate([np.zeros(0, np.uint64), *b])

    def run(batches):
        held_key, held_fp = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], 1)
            fp = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
            key, fp = np.concatenate([held_key, key]), np.concatenate([held_fp, fp])
            if not len(fp):
                continue
            changes = np.flatnonzero((key[1:] != key[:-1]).any(1))
            cut = changes[-1] + 1 if len(changes) else 0  # the last bucket may go on in the next batch
            held_key, held_fp = key[cut:], fp[cut:]
            if cut:
                yield _pairs(*found(key[:cut], fp[:cut]))
        if len(held_fp):
            yield _pairs(*found(held_key, held_fp))

    return ordered.mapInArrow(run, "a long, b long")


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def linked(fps: DataFrame, tau: int = 3, parts: int | None = None) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fps``, written to the shared folder."""
    count = fps.count()
    dealt = group_bits(bit_table(fps), count, parts or parts_for(count, tau))
    rows = probes(fps, dealt, block_counts(fps, dealt), count, tau)
    return written(links(rows, tau), "fp_links")


def rooted(rows: DataFrame, size: int = 3, tau: int = 3, parts: int | None = None) -> DataFrame:
    """``rows`` (id, text, and further columns to keep) with fp, root and component_id in place of the text.

    ``root`` is the smallest fingerprint that can be reached and names the component, ``component_id`` its smallest id.
    """
    prepare(rows.sparkSession)
    marked = written(fingerprints(rows, "text", size, keep=[c for c in rows.columns if c != "text"]), "fingerprints")
    named = written(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct_fps")
    found = linked(named.select("fp"), tau, parts)
    reached = named.join(components(found).select(F.col("node").alias("fp"), "root"), "fp", "left")
    reached = reached.withColumn("root", F.coalesce("root", "fp"))
    least = reached.groupBy("root").agg(F.min("least").alias("component_id"))
    grouped = written(reached.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "fp_components")
    return marked.join(grouped, "fp")


def near_duplicates(
    df: DataFrame, id_column: str = "doc_id", column: str = "text", size: int = 3, tau: int = 3, parts: int | None = None
) -> DataFrame:
    """(id, fp, component_id) of every row; component_id is the smallest id that can be reached.

    Texts with equal fingerprints are one node. Null ids keep their row and count only where a component has no
    other id. Null and empty texts have fingerprint 0 and are linked like any other, long texts are taken whole. Repeated
    rows stay. An empty table gives an empty table; other columns are not read.
    """
    rows = df.select(F.col(id_column).alias("id"), F.col(column).alias("text"))
    found = rooted(rows, size, tau, parts)
    return found.select(F.col("id").alias(id_column), "fp", "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", column: str = "text", **options) -> DataFrame:
    """One row of each component of ``docs``, with its columns: the one of the smallest id, null ids last.

    Of rows with that id the one with the least digest of its text stays, of equal texts the one with the least hash of all
    columns. Rows of one id in different components are different documents: each component keeps its own.
    """
    digest = F.md5(F.coalesce(F.col(column), F.lit("")))
    rows = docs.select(F.col(id_column).alias("id"), F.col(column).alias("text"), digest.alias("digest"))
    found = rooted(rows, **options)
    first = F.struct(F.col("id").isNull(), "id", "digest").alias("key")
    counted = found.groupBy("root", first).agg(F.count(F.lit(1)).alias("n"))
    chosen = counted.groupBy("root").agg(F.min(F.struct("key", "n")).alias("least"))
    chosen = written(chosen.select(F.col("least.key.id").alias("__id"), F.col("least.key.digest").alias("__digest"), F.col("least.n").alias("__n")), "chosen")

    def of(keys: DataFrame) -> DataFrame:
        same = docs[id_column].eqNullSafe(F.col("__id")) & (digest == F.col("__digest"))
        return docs.join(keys, same, "left_semi")

    several = of(chosen.where("__n > 1")).select(F.struct("*").alias("__row"), F.col(id_column).alias("__id"), digest.alias("__digest"))
    # Equal texts have equal fingerprints, so an id and a text belong to one component.
    several = several.groupBy("__id", "__digest").agg(F.min_by("__row", F.xxhash64("__row")).alias("__row")).select("__row.*")
    return of(chosen.where("__n = 1")).unionAll(several)


def fingerprint_rows(df: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, and component_id of documents."""
    found = near_duplicates(df.select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
