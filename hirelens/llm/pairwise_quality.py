"""Operator 1: a quality classifier by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. Pairs of a better and a worse labelled document
give differences of features, and the weights are those of least logistic loss on the differences. The
threshold is a quantile of the training scores: the one that parts the labels best.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rolling
from .common import map_texts

# The weights are fitted on at most so many labelled rows, those of smallest hash of the id.
TRAINING_ROWS = 20_000
PAIRS = 200_000
RIDGE = 1e-3
QUANTILES = 1001
THRESHOLD = 0.3

NAMES = (
    "log_words", "word_length", "long_words", "short_words", "upper", "digits", "non_ascii", "symbols", "exclaims",
    "pipes", "punctuation", "stops", "other_marks", "lines", "word_variety", "repeated_5", "repeated_2", "repeated_lines",
    "upper_words", "marked_words",
)


def _set(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


BYTES = {
    "upper": _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digits": _set("0123456789"),
    "non_ascii": np.arange(256) >= 0xC2,
    "symbols": _set("#*$%&<>"),
    "exclaims": _set("!"),
    "pipes": _set("|"),
    "punctuation": _set(",;:'\"()-"),
    "stops": _set(".?"),
    "other_marks": _set("@[]{}\\/_=+~^`"),
    "lines": _set("\n"),
}


def features(texts: pa.Array) -> np.ndarray:
    """One row of features for each text; an empty text has zeros."""
    n = len(texts)
    data, offsets = rolling.bytes_of(texts)
    words = rolling.words_of(data, offsets)
    per = np.maximum(np.diff(words.first), 1)
    size = np.maximum(np.diff(offsets), 1)
    length = (words.ends - words.starts).astype(float)

    def share(values: np.ndarray) -> np.ndarray:
        return np.bincount(words.text, values, n) / per

    def total(table: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(table[data]))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    def repeated(width: int) -> np.ndarray:
        at, keys = rolling.windows(words, width)
        _, later = rolling.repeats(keys ^ rolling.mix(words.text[at].astype(np.uint64)))
        return share(rolling.covered(at[later], width, len(words.starts)).astype(float))

    ends_in = data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    starts_in = data[words.starts] if len(words.starts) else np.zeros(0, np.uint8)
    _, later = rolling.repeats(words.hashes ^ rolling.mix(words.text.astype(np.uint64)))
    line_starts, line_ends = rolling.runs(data != 10, offsets)
    line_text = np.searchsorted(offsets, line_starts, "right") - 1
    keys = rolling.byte_hashes(data, line_starts, line_ends)
    _, again = rolling.repeats(keys ^ rolling.mix(line_text.astype(np.uint64)))
    columns = {name: total(table) / size for name, table in BYTES.items()}
    columns |= {
        "log_words": np.log1p(np.diff(words.first)),
        "word_length": share(length),
        "long_words": share((length > 12).astype(float)),
        "short_words": share((length < 4).astype(float)),
        "word_variety": share((~later).astype(float)),
        "repeated_5": repeated(5),
        "repeated_2": repeated(2),
        "repeated_lines": np.bincount(line_text, again, n) / np.maximum(np.bincount(line_text, minlength=n), 1),
        "upper_words": share(BYTES["upper"][starts_in].astype(float)),
        "marked_words": share((BYTES["symbols"] | BYTES["exclaims"])[ends_in].astype(float)),
    }
    return np.stack([columns[name] for name in NAMES], 1).astype(float)


class Model(NamedTuple):
    """Strength is ``(features - mean) / spread @ weights``; ``knots`` are quantiles of the training strengths, ``cut`` the
    quantile at which documents count as good."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """The quantile of the strength, stretched so that the cut lies at the threshold: 0 to 1."""
        s = self.strength(x)
        rank = np.linspace(0, 1, len(self.knots))
        low, high = np.searchsorted(self.knots, s, "left"), np.searchsorted(self.knots, s, "right")
        inside = np.interp(s, self.knots, rank)
        tied = (rank[np.minimum(low, len(rank) - 1)] + rank[np.maximum(high - 1, 0)]) / 2
        q = np.where(high - low > 1, tied, inside)
        below = THRESHOLD * q / max(self.cut, 1e-9)
        above = THRESHOLD + (1 - THRESHOLD) * (q - self.cut) / max(1 - self.cut, 1e-9)
        return np.clip(np.where(q < self.cut, np.minimum(below, np.nextafter(THRESHOLD, 0)), above), 0, 1)


def fit(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE) -> Model:
    """The model of labelled rows. Without rows of both labels every strength is 0 and every score 0.5 or above."""
    mean = x.mean(0) if len(x) else np.zeros(len(NAMES))
    spread = np.maximum(x.std(0), 1e-6) if len(x) else np.ones(len(NAMES))
    weights = np.zeros(len(NAMES))
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Model(mean, spread, weights, np.zeros(2), 0.0)
    z = np.clip((x - mean) / spread, -8, 8)
    # Pairs in a fixed order: every worse row meets better rows in turn.
    rng = np.random.default_rng(0)
    k = np.arange(min(pairs, len(good) * len(bad)))
    better, worse = rng.permutation(good)[k % len(good)], rng.permutation(bad)[(k // len(good) + k) % len(bad)]
    diff = z[better] - z[worse]
    for _ in range(25):  # Newton steps on the mean logistic loss with a ridge
        p = 1 / (1 + np.exp(np.clip(diff @ weights, -30, 30)))
        slope = diff.T @ p / len(diff) - ridge * weights
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ weights
    order = np.argsort(s, kind="stable")
    knots = np.quantile(s, np.linspace(0, 1, QUANTILES))
    # Errors if the first k rows in order count as bad; the middle of the best places is taken.
    errors = np.append(0, np.cumsum(label[order] == 1)) + (label == 0).sum() - np.append(0, np.cumsum(label[order] == 0))
    best = np.flatnonzero(errors == errors.min())
    run = best[: int(np.argmax(np.append(np.diff(best) != 1, True))) + 1]
    return Model(mean, spread, weights, knots, float(np.mean(run)) / len(s))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rows`` labelled documents that are not held out.

    Ids whose labels contradict each other are left out. Of more documents, as where ids repeat, those of the
    least hashes of id and text are taken, so that the sample is the same each time.
    """
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).groupBy("doc_id")
    agreed = usable.agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most")
    place = F.xxhash64("doc_id").alias("place")
    chosen = agreed.orderBy(place, "doc_id").limit(rows)
    joined = docs.select("doc_id", "text", F.md5("text").alias("digest")).join(F.broadcast(chosen), "doc_id")  # ``rows`` rows of two numbers
    measured = with_features(joined, ["doc_id", "digest", "quality"]).orderBy(place, "doc_id", "digest").limit(rows)
    found = measured.select("features", "quality").toPandas()
    x = np.array(found["features"].tolist(), float).reshape(-1, len(NAMES))
    y = found["quality"].to_numpy()
    order = np.lexsort((y, *x.T))  # the same order whatever the partitions
    return x[order], y[order]


def with_features(df: DataFrame, keep: Sequence[str] | None = None, column: str = "text") -> DataFrame:
    def work(texts: pa.Array):
        x = features(texts)
        ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES))
        return [pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1)))]

    return map_texts(df, column, "features array<double>", lambda: work, keep)


def score(df: DataFrame, model: Model, column: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with ``score`` of each text, 0 to 1. Null and empty texts are scored by their features, which are zeros;
    equal texts get equal scores. A column called score is replaced."""

    def work(texts: pa.Array):
        return [pa.array(model.score(features(texts)), pa.float64())]

    return map_texts(df, column, "score double", lambda: work, keep)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, one row for each row of ``docs``; the labels of held-out rows are not used.

    Null and empty texts are scored as texts without words, long ones whole; repeated ids and texts are scored each. Without
    labels of both kinds all scores are above the threshold. Empty tables give no rows; other columns are not read.
    """
    scored = score(docs.select("doc_id", "text"), fit(*training_sample(docs, labels)), keep=["doc_id"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
