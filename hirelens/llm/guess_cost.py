"""Operator 6: secret scans, with the guess cost of values that stand where credentials stand.

Three fixed patterns give the base spans. Beside them, the value behind a credential's name is kept if
guessing it is costly: the cost is that of the cheapest way to cut the value into common words, dates,
repeats, keyboard walks, references and spans that must be tried out, found by dynamic programming. Words are ranked
by the number of the corpus's documents that have them, behind a short list of what is common in passwords.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import lru_cache
from math import log10
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, written

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # as AKIA[A-Z0-9]+ with 18 characters or more: a run is matched whole
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12
KINDS = ("assign", "access", "hex", "guess")

# Where a credential may stand, beyond the base pattern: how its name begins, and how it goes on.
_KEY = "[ _-]?(?:key|secret|id)"
NAMES = {
    "pass": "(?:word|wd|phrase|code)?", "pwd": "", "secret": f"(?:{_KEY})?", "token": "", "credential": "s?", "auth": "", "login": "",
    "api": _KEY, "access": _KEY, "private": _KEY, "client": _KEY,
}
HINTS = tuple(NAMES)
# A value in quotes ends with the quote, any other with white space.
CONTEXT = re.compile(
    "(?:" + "|".join(n + more for n, more in NAMES.items()) + ")"
    r"""["']?[ \t]*+(?:[:=]|=>|->)[ \t]*+"""
    r"""(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`|["'`]?(\S++))""",
    re.I | re.A,
)
LEAST_LENGTH = 6
CLOSING = ".,;:!?\"'`)]}>"  # what is no part of a value without quotes where it ends it
LEAST_COST = 10.0  # log10 of guesses

# Common words of passwords and placeholders, most common first: a parameter, not a claim about any corpus.
COMMON = (
    "password pass admin user root test guest login welcome changeme secret default example sample dummy token key "
    "your my the api none null true false letmein qwerty dragon monkey master shadow sunshine princess football "
    "baseball iloveyou hello love summer winter spring autumn monday friday january june july august october "
    "december server database mysql postgres oracle local host prod stage dev demo temp public private access "
    "client name value here insert replace string text foo bar baz company super power magic star blue red green "
    "black white orange apple banana cookie pepper ginger tiger lion bear eagle falcon batman superman pokemon "
    "matrix ninja hunter ranger soccer hockey tennis golf money cash gold silver diamond freedom liberty london "
    "paris berlin boston texas michael jennifer jordan michelle daniel thomas robert andrew charlie jessica "
    "ashley amanda nicole david james john william joseph george mother father baby angel heaven computer "
    "internet google system network security manager service account office home family school student teacher"
).split()
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
# What points to a value and is none: variables, and paths and addresses of plain lower-case names.
_NAME = r"[a-z]{1,20}(?:[._-][a-z]{1,20})*[0-9]{0,4}"
_VARIABLE = r"(?:[a-z]{1,20}(?:[._-][a-z]{1,20})*|[A-Z]{1,20}(?:[_-][A-Z]{1,20})*)[0-9]{0,2}(?!\w)"
REFERENCE = re.compile(
    rf"\${_VARIABLE}|\$?\{{\{{?\x20*{_VARIABLE}\x20*\}}?\}}?|%{_VARIABLE}%|<{_VARIABLE}>?"
    rf"|(?:~|\.\.?)?(?:/{_NAME})+/?(?![\w+=])|[a-z]{{2,8}}://{_NAME}(?::[0-9]{{1,5}})?(?:/{_NAME})*/?(?![\w+=@:])",
    re.A,
)
REFERENCE_COST = 3.0
# Words of the corpus: whole words of letters, not counted behind a colon, an equals sign or an arrow, where values stand.
WORD = r"(?<![\p{L}\p{N}])(\p{L}{4,24})(?![\p{L}\p{N}])"
VALUE_PLACES = r"[:=>][ \t\"'`]*\S+"
CORPUS_WORDS = 20_000
UNITS = (1, 2, 3, 4)  # lengths of what is repeated
DAYS, YEARS = 365.0, 120.0


@lru_cache(maxsize=1)
def _neighbours() -> frozenset[tuple[str, str]]:
    """Keys that lie beside each other in a row, or below each other in the staggered rows."""
    out = set()
    for r, row in enumerate(ROWS):
        for k, c in enumerate(row):
            near = [row[k + 1 : k + 2]]
            if r + 1 < len(ROWS):
                below = k if r else k - 1
                near += [ROWS[r + 1][j : j + 1] for j in (below - 1, below) if j >= 0]
            out |= {(c, d) for d in near if d} | {(d, c) for d in near if d}
    return frozenset(out)


def _alone(c: str) -> float:
    """log10 of the characters one has to try for this one."""
    if c.isdigit():
        return 1.0
    return log10(26) if c.isascii() and c.isalpha() else log10(33)


class Ranking(NamedTuple):
    """Words with their ranks, and the length of the longest."""

    ranks: dict[str, int]
    longest: int


def ranking(words: Sequence[str]) -> Ranking:
    return Ranking({w: k + 1 for k, w in reversed(list(enumerate(words)))}, max(map(len, words), default=0))


def corpus_words(df: DataFrame, column: str = "text", size: int = CORPUS_WORDS) -> list[str]:
    """Up to ``size`` words that most documents of ``df`` have, most frequent first, of equal ones the first by name.

    All documents and whole texts are counted; only the list, whose size is this parameter, comes to the driver. Words of
    one count are in the list together or not at all, so that no ties are cut. Behind rank 20,000 a word is hardly
    cheaper to guess than its letters. Null, empty and repeated texts are documents, too.
    """
    plain = F.regexp_replace(F.lower(column), VALUE_PLACES, " ")
    words = df.select(F.explode(F.array_distinct(F.regexp_extract_all(plain, F.lit(WORD)))).alias("word"))
    counts = written(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word_counts")
    # There are few different counts: their squares add up to no more than twice the words counted.
    levels = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    ranked = levels.select("n", F.sum("words").over(Window.orderBy(F.desc("n"))).alias("total"))
    least = ranked.where(F.col("total") <= size).agg(F.min("n")).first()[0]
    if least is None:
        return []
    rows = counts.where(F.col("n") >= least).collect()
    return [r.word for r in sorted(rows, key=lambda r: (-r.n, r.word))]


def known_words(df: DataFrame, column: str = "text") -> tuple[str, ...]:
    """The fixed list, then the corpus's words."""
    return tuple(dict.fromkeys([*COMMON, *corpus_words(df, column)]))


def guess_cost(value: str, words: Sequence[str] | Ranking = tuple(COMMON)) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` needs. The empty value costs 0.

    A segment costs: words their rank (twice that with capitals), dates the days or years, repeats the unit
    and the number of times, keyboard walks and runs of code points the start and the length, references a fixed
    cost, and characters by themselves their class. Every segment but the first doubles the guesses, since its place is unknown.
    """
    ranks, longest = words if isinstance(words, Ranking) else _ranks(tuple(words))
    small, n = value.lower(), len(value)
    if len(small) != n:
        small = value
    dates: dict[int, list[int]] = {}
    for start in range(n):
        found = DATE.match(value, start) if value[start].isdigit() else None
        if found:
            dates.setdefault(start, []).append(found.end())
            dates[start].append(start + 4) if value[start : start + 2] in ("19", "20") else None
    walks, near = np.zeros(n + 1, int), _neighbours()
    runs = np.zeros(n + 1, int)
    for k in range(n - 2, -1, -1):
        walks[k] = walks[k + 1] + 1 if (small[k], small[k + 1]) in near else 0
        step = ord(small[k + 1]) - ord(small[k])
        same = k + 2 < n and ord(small[k + 2]) - ord(small[k + 1]) == step and runs[k + 1]
        runs[k] = (runs[k + 1] + 1 if same else 1) if abs(step) == 1 else 0
    again = {unit: np.zeros(n + 1, int) for unit in UNITS}  # how long the text goes on as it was ``unit`` characters before
    for unit in UNITS:
        for k in range(n - unit - 1, -1, -1):
            again[unit][k] = again[unit][k + 1] + 1 if value[k] == value[k + unit] else 0
    best = [0.0] + [float("inf")] * n
    open_cost = [float("inf")] * (n + 1)  # the last segment is tried out and may go on
    for k in range(n):
        before = best[k] + (log10(2) if k else 0.0)

        def reach(end: int, cost: float) -> None:
            if before + cost < best[end]:
                best[end] = before + cost

        alone = min(before, open_cost[k]) + _alone(value[k])
        open_cost[k + 1] = alone
        best[k + 1] = min(best[k + 1], alone)
        for end in range(k + 2, min(n, k + longest) + 1):
            rank = ranks.get(small[k:end])
            if rank is not None:
                reach(end, log10(rank) + (0.0 if value[k:end] == small[k:end] else log10(2)))
        refers = REFERENCE.match(value, k) if not k or not value[k - 1].isalnum() else None
        if refers:
            reach(refers.end(), REFERENCE_COST)
        for end in dates.get(k, ()):
            reach(end, log10(YEARS) if end - k == 4 else log10(DAYS * YEARS))
        for length, kinds in ((walks[k], 47 * 3), (runs[k], 36)):
            if length >= 2:
                reach(k + length + 1, log10(kinds) + log10(length + 1))
        for unit in UNITS:
            times = 1 + again[unit][k] // unit
            if times * unit >= 3 and times > 1:
                reach(k + times * unit, sum(_alone(c) for c in value[k : k + unit]) + log10(times))
    return best[n]


@lru_cache(maxsize=4)
def _ranks(words: tuple[str, ...]) -> Ranking:
    return ranking(words)


def base_spans(text: str, small: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns; ``small`` is the text in small letters."""
    out = []
    if "passw" in small or "secret" in small or "token" in small or "api" in small:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def scan_text(text: str, least: float = LEAST_COST, words: Sequence[str] | Ranking = tuple(COMMON)) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind, end) in order, ``kind`` being a place in ``KINDS``."""
    small = text.lower()
    out = base_spans(text, small)
    if any(h in small for h in HINTS):
        for m in CONTEXT.finditer(text):
            start, end = m.span(m.lastindex)
            while m.lastindex == 4 and end > start and text[end - 1] in CLOSING:
                end -= 1
            if end - start >= LEAST_LENGTH and guess_cost(text[start:end], words) >= least:
                out.append((start, 3, end))
    return sorted(out)


SPANS = "spans array<struct<kind: string, start: int, end: int>>"


def _span_array(lists: list[list[tuple[int, int, int]]]) -> pa.Array:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    made = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for spans in lists]
    return pa.array(made, pa.list_(kind))


def scan(
    df: DataFrame, column: str = "text", least: float = LEAST_COST, words: Sequence[str] = tuple(COMMON),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with ``spans`` (kind, start, end in code points) of each text, in order of start, then of ``KINDS``.

    Null and empty texts have no spans; repeated rows have the same ones. A column called spans is replaced.
    """

    def make() -> Callable:
        known = ranking(words)
        return lambda texts: [_span_array([scan_text(t, least, known) for t in texts.to_pylist()])]

    return map_texts(df, column, SPANS, make, keep)


def redact_text(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(df: DataFrame, column: str = "text", mark: str = "[SECRET]", least: float = LEAST_COST) -> DataFrame:
    """``df`` with every span of ``column`` replaced by ``mark``; overlapping spans become one mark. Null stays null.

    Words are those of the column's own texts.
    """
    words = known_words(df, column)

    def make() -> Callable:
        known = ranking(words)

        def work(texts: pa.Array):
            lists = texts.to_pylist()
            return [pa.array([redact_text(t, s, mark) if (s := scan_text(t, least, known)) else t for t in lists], pa.string())]

        return work

    name = next(c for c in df.columns if c.lower() == column.lower())
    raw = df.withColumn("__raw", F.col(name)).withColumn("__null", F.col(name).isNull())
    clean = map_texts(raw, "__raw", f"`{name}` string", make, [*df.columns, "__null"])
    return clean.withColumn(name, F.when(~F.col("__null"), F.col(name))).select(df.columns)


def digests(df: DataFrame) -> DataFrame:
    """doc_id, the numbers of base spans by kind, base_sha256 and spans of documents."""
    found = scan(df.select("doc_id", "text"), words=known_words(df), keep=["doc_id"])

    def joined(spans):
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(each, ",")

    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    kinds = F.transform("spans", lambda s: s["kind"])
    numbers = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *numbers, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
