"""Operator 12: how the sources of a language differ in the terms that they use.

Every shard sorts pointers to the beginnings of its terms, in the bytes as they lie in Arrow's buffers, by multikey
quicksort with eight bytes as one key. A run of equal terms gives the documents and the occurrences of the term
in each source. These rows are summed over all shards.

Divergences of two sources are sums over all kept terms, of which most do not occur in either. With p and q the
smoothed shares and p0, q0 those of a term without occurrences, the sum of f(p, q) is

    V f(p0, q0) + sum over p's terms of (f(p, q0) - f(p0, q0)) + sum over q's terms of (f(p0, q) - f(p0, q0))
    + sum over the common terms of (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))

so that only terms that occur are looked at, exactly, whatever the floors. In the first two sums terms of equal counts are
taken together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, slices, texts_of, written
from .rolling import bytes_of, runs

SHARD_BYTES = 8 << 20
LEAST_DOCUMENTS = 10
TOP_TERMS = 10

IN_TERM = np.zeros(256, bool)
IN_TERM[65:91] = IN_TERM[97:123] = IN_TERM[128:] = True
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32

COUNTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("lang", "source", "term")] + [T.StructField(c, T.LongType()) for c in ("n", "documents")]
)
# Slices of at most so many pointers are sorted at once, larger ones are split by a pivot.
SMALL_SLICE = 1 << 15
LAST_BYTE = np.uint64(255)
# The first 0 to 8 bytes of a number.
FIRST_BYTES = np.array([(1 << 64) - (1 << 8 * (8 - k)) for k in range(9)], np.uint64)


def eights(data: np.ndarray) -> np.ndarray:
    """For each place the eight bytes from there on as one number; zeros follow the end."""
    padded = np.append(data, np.zeros(8, np.uint8))
    return np.ndarray((len(data) + 1,), ">u8", padded, 0, (1,))


def term_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each term from ``8 * depth`` on as one number; zeros follow a term's end."""
    at = starts + 8 * depth
    left = np.clip(ends - at, 0, 8)
    return words[np.minimum(at, len(words) - 1)].astype(np.uint64) & FIRST_BYTES[left]


def sort_pointers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the terms ``data[start:end]``, equal ones as they stand, and the places in it where runs of equals begin.

    Multikey quicksort: a slice is split into smaller, equal and larger keys at its pivot; the equal ones
    go on with their next eight bytes, unless they have ended. A small slice is sorted by its keys at once.
    """
    words = eights(data)
    order = np.arange(len(starts))
    begins = np.zeros(len(starts), bool)
    stack: list[tuple[int, int, int, np.ndarray | None]] = [(0, len(starts), 0, None)]
    while stack:
        low, high, depth, key = stack.pop()
        if high == low:
            continue
        part = order[low:high]
        if key is None:
            key = term_keys(words, starts[part], ends[part], depth)
        if high - low <= SMALL_SLICE:
            order[low:high], begins[low:high] = _sort_slice(words, starts, ends, part, key, depth)
            continue
        sample = np.sort(key[:: max(1, len(key) // 9)])
        pivot = sample[len(sample) // 2]
        less, more = key < pivot, key > pivot
        same = ~(less | more)
        cut, end = low + int(np.count_nonzero(less)), high - int(np.count_nonzero(more))
        order[low:high] = np.concatenate([part[less], part[same], part[more]])
        stack.append((low, cut, depth, key[less]))
        stack.append((end, high, depth, key[more]))
        begins[cut] = True
        if pivot & LAST_BYTE:  # else the equal terms end here
            stack.append((cut, end, depth + 1, None))
    return order, np.flatnonzero(begins)


def _sort_slice(words, starts, ends, part: np.ndarray, key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The pointers of a slice in order, and where runs of equal terms begin; ties are resolved eight bytes further on."""
    by = np.argsort(key, kind="stable")
    part, key = part[by], key[by]
    begins = np.append(True, key[1:] != key[:-1])
    at = np.arange(len(part))
    while True:
        # Runs of equal keys that have not ended, all of them at once.
        first = begins[at]
        alone = first & np.append(first[1:], True)
        at = at[~alone & ((key & LAST_BYTE) != 0)]
        if not len(at):
            return part, begins
        depth += 1
        run = np.cumsum(begins[at])
        key = term_keys(words, starts[part[at]], ends[part[at]], depth)
        by = np.lexsort((key, run))
        part[at], key = part[at][by], key[by]
        begins[at[1:]] |= key[1:] != key[:-1]


def shard_counts(texts: pa.Array, group: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(term, group, occurrences, documents) of the terms of texts, each in a group given by its number."""
    data, offsets = bytes_of(texts)
    data = SMALL[data]
    starts, ends = runs(IN_TERM[data], offsets)
    order, begins = sort_pointers(data, starts, ends)
    text = np.searchsorted(offsets, starts, "right") - 1
    run = np.zeros(len(order), np.int64)
    run[begins[1:]] = 1
    run = np.cumsum(run)
    sorted_text = text[order]
    # Equal terms stand in the order of their texts, so each text begins once in a run.
    new = np.ones(len(order), bool)
    new[1:] = (run[1:] != run[:-1]) | (sorted_text[1:] != sorted_text[:-1])
    groups = int(group.max(initial=0)) + 1
    cell = run * groups + group[sorted_text]
    cells, place = np.unique(cell, return_inverse=True)
    n = np.bincount(place, minlength=len(cells))
    documents = np.bincount(place[new], minlength=len(cells))
    of, rows = order[begins][cells // groups], data.tobytes()
    terms = [rows[a:b] for a, b in zip(starts[of].tolist(), ends[of].tolist())]
    return terms, cells % groups, n, documents


def term_counts(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents) of the texts in ``df``; null lang, source or text counts as ''."""
    prepare(df.sparkSession)

    def count(held: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        lang, source, text = (texts_of(whole.column(c)) for c in ("lang", "source", "text"))
        pairs = list(zip(lang.to_pylist(), source.to_pylist()))
        number = {p: k for k, p in enumerate(dict.fromkeys(pairs))}
        names = list(number)
        terms, group, n, documents = shard_counts(text, np.fromiter(map(number.__getitem__, pairs), np.int64, len(pairs)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[g][0] for g in group], pa.string()),
                pa.array([names[g][1] for g in group], pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(n, pa.int64()),
                pa.array(documents, pa.int64()),
            ],
            names=COUNTS.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                held.append(part)
                size += part.column("text").nbytes
                if size >= SHARD_BYTES:
                    yield count(held)
                    held, size = [], 0
        if held:
            yield count(held)

    texts = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return texts.mapInArrow(run, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def share(count: Column | str, total: Column | str, kept: Column | str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)) in whole numbers, by long division in three steps.

    Right while total + 2 kept is below 9 * 10^15.
    """
    x, whole = F.col(count) + 2 if isinstance(count, str) else count + 2, F.col(total) + 2 * F.col(kept)
    digits = F.lit(0).cast("long")
    for _ in range(3):
        digits = digits * 1000 + _div(x * 1000, whole)
        x = F.pmod(x * 1000, whole)
    return digits + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def far(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q))."""
    p, q = F.col(p), F.col(q)
    return _div((p - q) * (p - q), p + q)


def divergences(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every occurring pair of lang and source, as the rows of ``docs`` have them.

    Part ``pair`` has the other sources of the language, part ``term`` the ``top`` terms that are more frequent in
    the source than in the language. Kept are terms in ``least`` documents of a language (rows of ``docs``; copies and
    repeated ids count each). Null lang, source and text count as ''. An empty table gives no rows; long texts are
    taken whole; other columns are not read.
    """
    counts = written(term_counts(docs), "terms")
    by_term = Window.partitionBy("lang", "term")
    frequent = counts.groupBy("lang", "term").agg(F.sum("documents").alias("documents")).where(F.col("documents") >= least)
    kept = written(counts.join(frequent.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n"), "kept_terms")
    sizes = kept.groupBy("lang").agg(F.count_distinct("term").alias("v"), F.sum("n").alias("in_lang"))
    groups = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("in_source"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["v", "in_lang", "in_source"])
    # Without kept terms there is nothing to divide by; the share is then of no use.
    nothing = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), "in_source", "v")).otherwise(1)
    groups = written(groups.withColumn("p0", nothing), "sources")

    smooth = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", share("n", "in_source", "v").alias("p"), "p0", "v", "in_lang")
    smooth = written(smooth.withColumn("l", F.sum("n").over(by_term)), "shares")
    terms = smooth.select("lang", "source", F.col("term").alias("item"), "p", share("l", "in_lang", "v").alias("q"))
    terms = terms.where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", far("p", "q").alias("value"))

    a, b = groups.select("lang", "source", "p0", "v"), groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = a.join(b, "lang").where("source <> item")
    # Terms of one source beside a source without them, those of equal counts together.
    levels = smooth.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("m"))
    alone = levels.join(b, "lang").where("source <> item")
    alone = alone.select("lang", "source", "item", (F.col("m") * (far("p", "q0") - far("p0", "q0"))).alias("value"))
    other_side = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    # Terms that two sources have.
    left = smooth.select("lang", "term", "source", "p", "p0")
    right = smooth.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    common = left.join(right, ["lang", "term"]).where("source < item")
    common = common.select("lang", "source", "item", (far("p", "q") - far("p", "q0") - far("p0", "q") + far("p0", "q0")).alias("value"))
    common = common.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    swapped = common.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    base = pairs.select("lang", "source", "item", (F.col("v") * far("p0", "q0")).alias("value"))
    every = base.unionByName(alone).unionByName(other_side).unionByName(common).unionByName(swapped)
    summed = every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    summed = summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    place = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(place).alias("rank")
    return summed.select("*", rank).unionByName(terms.select("*", rank).where(F.col("rank") <= top))


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k ON k.lang = g.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
    FROM cells JOIN sizes USING (lang)),
whole AS (SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) JOIN sizes USING (lang)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
every AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
    FROM groups g JOIN groups h ON h.lang = g.lang AND h.source <> g.source
    LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
    UNION ALL
    SELECT s.lang, s.source, 'term', s.term, ((p - q) * (p - q)) // (p + q)
    FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE s.n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
