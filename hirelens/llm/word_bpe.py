"""The word-level BPE vocabulary of a tokenizers file: words of a text, symbols, merges.

The file's rules: the special tokens' texts are cut out of the raw text; the rest is put into NFC,
white space becomes one space, letters become small one by one; words are the matches of ``WORDS``;
a word's UTF-8 bytes are its symbols, the last of them marked as the word's end.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

import regex

# Fixed value: the rule for words in the tokenizer file.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
SPACE = regex.compile(r"\p{White_Space}+")
# str.split() cuts at these, the file's rules do not.
ODD = re.compile("[\x1c-\x1f]")
END = "</w>"


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in names:
            names[b] = chr(256 + len(names) - len(plain))
    return names


class Vocabulary:
    """Symbols are single characters: chr(byte) inside a word, chr(256 + byte) at its end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        byte_of = {c: b for b, c in byte_characters().items()}
        self.texts: dict[int, str] = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.texts.update({i: t for t, i in self.special.items()})

        def symbols(token: str) -> str:
            inner, end = (token[: -len(END)], 256) if token.endswith(END) and len(token) > len(END) else (token, 0)
            codes = [byte_of[c] for c in inner]
            return "".join(map(chr, codes[:-1])) + chr(codes[-1] + end)

        self.symbols_of = {i: symbols(t) for t, i in model["vocab"].items()}
        self.by_symbols = {s: i for i, s in self.symbols_of.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.built = dict.fromkeys(self.symbols_of, -1)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, both = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.merges[left, right] = rank, both
            if self.built[both] < 0:
                self.parts[both], self.built[both] = (left, right), rank
        self.longest = max(map(len, self.by_symbols))
        self._mark = os.path.commonprefix(list(self.special))
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def words(self, text: str) -> list[str]:
        """The words of a text in order; a special token's text stands for itself."""
        if self._mark in text and any(s in text for s in self.special):
            found: list[str] = []
            for k, part in enumerate(self._cut.split(text)):
                found += [part] if k % 2 else self._plain(part)
            return found
        return self._plain(text)

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text cut at white space. No word crosses a cut, so pieces can be looked up one by one."""
        return SPACE.split(text) if ODD.search(text) else text.split()

    @staticmethod
    def _plain(text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return WORDS.findall(text.lower())

    @staticmethod
    def symbols(word: str) -> str:
        data = word.encode("utf-8", "surrogatepass").decode("latin-1")
        return data[:-1] + chr(ord(data[-1]) + 256)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
