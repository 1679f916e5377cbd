"""Operator 9: quality rules on repetition.

Rolling hashes of several n-gram lengths find the words and lines that a text repeats; the rules look at
the share of characters that lie in repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .common import map_texts

LENGTHS = (5, 7, 10)
# Largest shares of the characters in words that may lie in n-grams or lines seen before in the text.
MOST_IN_NGRAMS = {5: 0.15, 7: 0.13, 10: 0.10}
MOST_IN_LINES = 0.30

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_chars long, dup_ngram_chars array<long>"
)
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def measure_texts(texts: pa.Array, lengths: Sequence[int] = LENGTHS) -> list[pa.Array]:
    """The measures in ``FIELDS`` of each text."""
    n = len(texts)
    data, offsets = rolling.bytes_of(texts)
    words = rolling.words_of(data, offsets)
    begins = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~rolling.CONTINUES[data], out=begins[1:])
    chars = begins[words.ends] - begins[words.starts]
    n_words = np.diff(words.first)
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOL[data], out=symbols[1:])
    n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]

    # Lines that have a word, equal to an earlier line of the text.
    line_starts, line_ends = rolling.runs(data != 10, offsets)
    line_text = np.searchsorted(offsets, line_starts, "right") - 1
    first = np.searchsorted(words.starts, line_starts)
    last = np.searchsorted(words.starts, line_ends)
    real = last > first
    line_text = line_text[real]
    later = _seen_before(data.tobytes(), line_starts[real], line_ends[real], line_text)
    sum_chars = np.append(0, np.cumsum(chars))
    line_chars = (sum_chars[last] - sum_chars[first])[real]
    n_dup_lines = rolling.per_text(later.astype(float), line_text, n)
    dup_line_chars = rolling.per_text(line_chars * later, line_text, n)

    word_sums = rolling.prefix_sums(words.hashes, rolling.STEP)

    def in_repeats(size: int) -> tuple[np.ndarray, np.ndarray]:
        """Words in windows that occur twice, and words in windows that occurred before."""
        at, keys = rolling.windows(words, size, word_sums)
        twice, later = rolling.repeats(keys ^ rolling.mix(words.text[at].astype(np.uint64)))
        total = len(words.starts)
        return rolling.covered(at[twice], size, total), rolling.covered(at[later], size, total)

    n_repeat_words = rolling.per_text(in_repeats(5)[0].astype(float), words.text, n)
    shares = [rolling.per_text(chars * in_repeats(size)[1], words.text, n) for size in lengths]
    flat = np.stack(shares, 1).reshape(-1) if n else np.zeros(0, np.int64)
    per = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(lengths)), pa.array(flat, pa.int64()))
    word_chars = rolling.per_text(chars, words.text, n)
    whole = [n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars]
    return [*(pa.array(x, pa.int64()) for x in whole), per]


def _seen_before(data: bytes, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each line whether its bytes stood in its text before."""
    later = np.zeros(len(starts), bool)
    seen: set[bytes] = set()
    of = -1
    for k, (a, b, t) in enumerate(zip(starts.tolist(), ends.tolist(), text.tolist())):
        if t != of:
            seen.clear()
            of = t
        line = data[a:b]
        if line in seen:
            later[k] = True
        else:
            seen.add(line)
    return later


def measure(df: DataFrame, column: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the measures in ``FIELDS``. Null and empty texts measure zero. Same-named columns are replaced."""
    return map_texts(df, column, FIELDS, lambda: measure_texts, keep)


def judge(measured: DataFrame) -> DataFrame:
    """Add base_failed and kept to measured texts.

    ``kept`` needs that the base rules hold and that no share of characters in n-grams or lines seen
    before is above its bound; equality with a bound is kept.
    """
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    repeated = F.col("dup_line_chars") > MOST_IN_LINES * F.col("word_chars")
    for k, size in enumerate(LENGTHS):
        repeated = repeated | (F.col("dup_ngram_chars")[k] > MOST_IN_NGRAMS[size] * F.col("word_chars"))
    return measured.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & ~repeated)


def apply_rules(docs: DataFrame, column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, with their columns as they were."""
    marked = map_texts(docs, column, "__measures struct<%s>" % FIELDS, lambda: _as_struct)
    names = [f.split()[0] for f in FIELDS.split(", ")]
    scratch = marked.select(F.struct(*docs.columns).alias("__row"), *[F.col(f"__measures.{c}").alias(c) for c in names])
    return judge(scratch).where("kept").select("__row.*")


def _as_struct(texts: pa.Array) -> list[pa.Array]:
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return [pa.StructArray.from_arrays(measure_texts(texts), names)]


def verdicts(df: DataFrame) -> DataFrame:
    """doc_id with the base measures, base_failed and kept."""
    judged = judge(measure(df.select("doc_id", "text"), keep=["doc_id"]))
    return judged.drop("dup_line_chars", "dup_ngram_chars")
