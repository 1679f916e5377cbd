"""Operator 3: benchmark decontamination by spaced seeds.

Words are runs of letters and digits in small ASCII letters. A mask lays a pattern over a window of words and leaves
some positions out, so that a window still matches after a substitution there. Test windows and training
windows meet in an equi-join on (mask, hash); a filter of fixed size, made of the test hashes, keeps
training windows without partner from being shuffled. Around what joins, the words are compared along the
diagonals: of a short item the matching words count, of a longer one those of each maximal stretch (a match counts
1, a substitution -2).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .common import map_texts, prepare, texts_of, slices, written

MASKS = ("1110110101", "1101011101", "1011101011")
SPAN = len(MASKS[0])
# For items of few words: any fifth of up to 16 words may be substituted and one of these still matches somewhere.
SHORT_MASKS = ("1111", "11011")
SHORT, MIDDLE, WHOLE = 24, 16, 8
LEAST_WORDS = 13
FILTER_BITS = 1 << 24  # 2 MB, whatever the benchmark's size; a fuller filter only lets more windows through
BUCKET_BITS = 32768  # Spark's bitmaps

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin (one more than there are texts)."""
    data, offsets = rolling.bytes_of(texts)
    small = rolling.SMALL[data]
    starts, ends = rolling.runs(WORD_BYTE[small], offsets)
    hashes = rolling.byte_hashes(small, starts, ends)
    return hashes, np.searchsorted(starts, offsets)


def seeds(hashes: np.ndarray, first: np.ndarray, shape: str | int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows that lie inside one text. ``shape``: a mask, or a number of words that all count."""
    kept = [k for k, c in enumerate(shape) if c == "1"] if isinstance(shape, str) else list(range(shape))
    span = len(shape) if isinstance(shape, str) else shape
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(hash_of_shape(shape)))
    weights = rolling.powers(rolling.STEP, span)
    for k in kept:
        total += hashes[k : k + n] * weights[k]
    room = np.zeros(len(hashes) + 1, np.int64)  # words from here to the text's end
    ends = np.repeat(first[1:], np.diff(first))
    room = ends - np.arange(len(hashes))
    at = np.flatnonzero(room[:n] >= span)
    return at, rolling.mix(total[at])


def hash_of_shape(shape: str | int) -> int:
    return (int(shape, 2) << 32 if isinstance(shape, str) else shape) * 0x2545F4914F6CDD1D & rolling.M64


def shape_number(shape: str | int) -> int:
    return int(shape, 2) if isinstance(shape, str) else -shape


def filter_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes & np.uint64(FILTER_BITS - 1), (hashes >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def test_items(benchmark: DataFrame, item_id: str = "item_id", column: str = "text") -> DataFrame:
    """(item, words): the word hashes of every benchmark item that has a word."""

    def make():
        def work(texts: pa.Array):
            hashes, first = words_of(texts)
            return [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), _signed(hashes))]

        return work

    rows = benchmark.select(F.col(item_id).alias("item"), F.col(column).alias("text"))
    return map_texts(rows, "text", "words array<long>", make, ["item"]).where(F.size("words") > 0)


def shapes_of(n: int, masks: Sequence[str] = MASKS) -> list[str | int]:
    """The windows of an item of ``n`` words: all of them at once below ``WHOLE`` words, else masks that fit it."""
    if n < WHOLE:
        return [n]
    return [*(SHORT_MASKS if n < SHORT else ()), *(m for m in masks if len(m) <= n)]


def test_seeds(items: DataFrame, masks: Sequence[str] = MASKS) -> DataFrame:
    """(item, place, shape, seed, bit1, bit2) of every item."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            ids = batch.column(0)
            for k in range(len(batch)):
                words = lists[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                for shape in shapes_of(len(words), masks):
                    at, seed = seeds(words, np.array([0, len(words)]), shape)
                    one, two = filter_places(seed)
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(np.full(n, k))), pa.array(at.astype(np.int32)),
                         pa.array(np.full(n, shape_number(shape), np.int32)), _signed(seed), _signed(one), _signed(two)],
                        ["item", "place", "shape", "seed", "bit1", "bit2"],
                    )

    kind = items.schema["item"].dataType.simpleString()
    return items.select("item", "words").mapInArrow(
        run, f"item {kind}, place int, shape int, seed long, bit1 long, bit2 long"
    )


def filter_of(found: DataFrame) -> np.ndarray:
    """The filter's bits: at most FILTER_BITS / 32768 rows of 4 KB come to the driver."""
    bits = found.select(F.explode(F.array("bit1", "bit2")).alias("bit"))
    parts = bits.groupBy(F.expr(f"bit div {BUCKET_BITS}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("bit") % BUCKET_BITS).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, data in parts.collect():
        at = bucket * BUCKET_BITS // 8
        out[at : at + len(data)] = np.frombuffer(bytes(data), np.uint8)
    return out


def train_segments(
    docs: DataFrame, bits: np.ndarray, reach: int, shapes: Sequence[str | int], doc_id: str, column: str
) -> DataFrame:
    """(doc, start, words, hits): stretches of a text around windows that pass the filter, ``reach`` words to either side."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(bits)
    hit = pa.struct([("place", pa.int32()), ("shape", pa.int32()), ("seed", pa.int64())])

    def run(batches):
        table = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, first = words_of(texts_of(part.column(1)))
                place, shape, seed = [], [], []
                for s in shapes:
                    at, h = seeds(hashes, first, s)
                    ok = np.ones(len(h), bool)
                    for where in filter_places(h):
                        index = where[ok].astype(np.int64)
                        ok[ok] = (table[index >> 3] >> (index & 7).astype(np.uint8)) & 1 == 1
                    place.append(at[ok])
                    seed.append(h[ok])
                    shape.append(np.full(int(ok.sum()), shape_number(s), np.int32))
                place, seed, shape = map(np.concatenate, (place, seed, shape))
                if not len(place):
                    continue
                order = np.argsort(place, kind="stable")
                place, seed, shape = place[order], seed[order], shape[order]
                doc = np.searchsorted(first, place, "right") - 1
                new = np.append(True, (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > 2 * reach))
                begin = np.flatnonzero(new)
                last = np.append(begin[1:], len(place)) - 1
                left = np.maximum(place[begin] - reach, first[doc[begin]])
                right = np.minimum(place[last] + reach, first[doc[begin] + 1])
                size = right - left
                take = np.repeat(left - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
                ends = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
                owner = np.cumsum(new) - 1
                hits = pa.StructArray.from_arrays(
                    [pa.array((place - left[owner]).astype(np.int32)), pa.array(shape), _signed(seed)], fields=list(hit)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(doc[begin])),
                        pa.array((left - first[doc[begin]]).astype(np.int32)),
                        pa.ListArray.from_arrays(ends, _signed(hashes[take])),
                        pa.ListArray.from_arrays(pa.array(np.append(begin, len(place)).astype(np.int32)), hits),
                    ],
                    ["doc", "start", "words", "hits"],
                )

    rows = docs.select(F.col(doc_id).alias("doc"), F.col(column).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, start int, words array<long>, hits array<struct<place: int, shape: int, seed: long>>"
    return rows.mapInArrow(run, schema)


def stretches(same: np.ndarray) -> list[tuple[int, int, int]]:
    """(matches, start, end) of all maximal stretches of a diagonal: those whose sum no longer or shorter one around them
    betters, with 1 for a match and -2 for a substitution."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    sums = np.append(0, np.cumsum(np.where(same, 1, -2)))
    found: list[tuple[int, int, int, int]] = []
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        low, high = int(sums[start]), int(sums[end])
        while True:
            k = next((k for k in range(len(found) - 1, -1, -1) if found[k][0] < low), -1)
            if k < 0 or found[k][1] >= high:
                found.append((low, high, start, end))
                break
            low, start = found[k][0], found[k][2]
            del found[k:]
    return [(int(same[start:end].sum()), start, end) for _, _, start, end in found]


def best_match(same: np.ndarray, n: int, least: int = LEAST_WORDS) -> tuple[int, int, int] | None:
    """(matches, start, end) on a diagonal of an item of ``n`` words, if they are enough: most matches, then the first."""
    if n <= MIDDLE:
        at = np.flatnonzero(same)
        tried = [(len(at), int(at[0]), int(at[-1]) + 1)] if len(at) else []
    else:
        tried = stretches(same)
    best = max(tried, key=lambda t: (t[0], -t[1]), default=None)
    return best if best and best[0] >= needed(n, least) else None


def needed(n: int, least: int = LEAST_WORDS) -> int:
    """The matching words that an item of ``n`` words needs: all of a very short one, four fifths, at most ``least``."""
    return n if n < WHOLE else min(least, -(-4 * n // 5))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
    column: str = "text", item_column: str = "text", least: int = LEAST_WORDS,
) -> DataFrame:
    """(doc, item, matched, start, n): for each pair that overlaps, the words that match, and where the stretch lies.

    An overlap has ``least`` matching words, or four fifths of a shorter item's, or all words of an item below ``WHOLE``
    words; all at their places in the item, and in items above ``MIDDLE`` words within one maximal stretch (see
    ``stretches``). Of several the one with most matches counts, then the first. Null and empty texts and items
    without a word overlap with nothing; repeated rows give one pair; long texts are searched whole. An empty table of either
    kind gives an empty table. Other columns are not read.
    """
    items = written(test_items(benchmark, item_id, item_column).distinct(), "items")
    found = written(test_seeds(items), "seeds")
    facts = items.agg(F.max(F.size("words"))).first()[0] or 0
    sizes = [r[0] for r in items.select(F.least(F.size("words"), F.lit(SHORT))).distinct().collect()]  # up to SHORT rows
    shapes = sorted({s for n in sizes for s in shapes_of(n)}, key=str) or list(MASKS)
    segments = train_segments(docs, filter_of(found), facts, shapes, doc_id, column)
    segments = written(segments.withColumn("segment", F.xxhash64("doc", "start", "words")), "segments")
    hits = segments.select("doc", "start", "segment", F.inline("hits"))
    wanted = found.select("item", F.col("place").alias("at"), "shape", "seed")
    met = hits.join(wanted, ["shape", "seed"]).select("doc", "start", "segment", "item", (F.col("place") - F.col("at")).alias("diagonal"))
    # All diagonals of a stretch of text and an item at once, so that the words travel once.
    pairs = met.groupBy("doc", "start", "segment", "item").agg(F.collect_set("diagonal").alias("diagonals"))
    texts = segments.select("doc", "start", "segment", "words").distinct()
    both = pairs.join(texts, ["doc", "start", "segment"]).join(items.withColumnRenamed("words", "test"), "item")

    def verify(batches):
        for batch in batches:
            keep, matched, start, n = [], [], [], []
            column_of = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            for k in range(len(batch)):
                text = column_of["words"][k].values.to_numpy(zero_copy_only=False)
                test = column_of["test"][k].values.to_numpy(zero_copy_only=False)
                best = None
                for shift in sorted(column_of["diagonals"][k].as_py()):
                    a, b = max(0, -shift), min(len(test), len(text) - shift)
                    tried = best_match(test[a:b] == text[a + shift : b + shift], len(test), least) if b > a else None
                    if tried and (best is None or tried[0] > best[0]):
                        best = tried[0], a + shift + tried[1], tried[2] - tried[1]
                if best:
                    keep.append(k)
                    matched.append(best[0])
                    start.append(column_of["start"][k].as_py() + best[1])
                    n.append(best[2])
            yield pa.RecordBatch.from_arrays(
                [column_of["doc"].take(pa.array(keep, pa.int64())), column_of["item"].take(pa.array(keep, pa.int64())),
                 pa.array(matched, pa.int32()), pa.array(start, pa.int32()), pa.array(n, pa.int32())],
                ["doc", "item", "matched", "start", "n"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in both.schema}
    checked = both.select("doc", "item", "start", "diagonals", "words", "test").mapInArrow(
        verify, f"doc {kinds['doc']}, item {kinds['item']}, matched int, start int, n int"
    )
    best = F.max(F.struct("matched", (-F.col("start")).alias("order"), "n"))
    return checked.groupBy("doc", "item").agg(best.alias("b")).select(
        "doc", "item", F.col("b.matched").alias("matched"), (-F.col("b.order")).alias("start"), F.col("b.n").alias("n")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text overlaps with no benchmark item, with their columns as they were.

    A row is judged by its text alone, whatever its id: copies go together, rows without an id or with that of
    another row are judged like any other. Null and empty texts stay, as do all rows if the benchmark is empty.
    """
    digest = F.md5(F.coalesce(F.col(column), F.lit("")))
    texts = docs.select(digest.alias("digest"), F.col(column).alias("text"))
    hit = overlaps(texts, benchmark, "digest").select(F.col("doc").alias("__digest")).distinct()
    return docs.join(written(hit, "contaminated"), digest == F.col("__digest"), "left_anti")


def pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, the matching words, and the stretch's first word and length."""
    found = overlaps(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    return found.select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("matched").cast("long").alias("n_matched"),
        F.col("start").cast("long").alias("start_word"), F.col("n").cast("long").alias("n_words"),
    )
