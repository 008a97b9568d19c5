"""Splitting texts into the words that byte-pair merging works on."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import regex

#: The split patterns of the two vocabularies.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Every code point below is known to all tables.
BEYOND_LATIN = re.compile("[\u0378-\U0010ffff]")


def lower_each(text: str) -> str:
    """Lower case letter by letter: a capital sigma has no form of its own at the end of a word."""
    return text.replace("Σ", "σ").lower()


@lru_cache(maxsize=1)
def newer_letters() -> re.Pattern:
    """Code points that Python's tables don't know; newer tables may call them letters or digits."""
    ranges, start = [], None
    for c in range(sys.maxunicode + 2):
        unknown = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if unknown and start is None:
            start = c
        elif not unknown and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile("[" + "".join(ranges) + "]")


BEYOND_PLANE = re.compile("[\U00010000-\U0010ffff]")


@lru_cache(maxsize=1)
def plane_spaced() -> re.Pattern:
    """SPACED_PATTERN for texts without code points beyond the first plane, with the same letters, digits and spaces.

    They are spelled out as ranges, which ``re`` looks up in a bit map: about half the time of ``regex``.
    """
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF)
    runs = lambda p: "".join(f"\\u{ord(m[0]):04x}-\\u{ord(m[-1]):04x}" for m in regex.findall(p + "+", every))
    letter, digit, space = runs(r"\p{L}"), runs(r"\p{N}"), runs(r"\s")
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


class Splitter:
    """Words of a text.  Special strings stand for themselves and are found before anything else.

    ``source`` is the tokenizer's file content.  It is only used for texts with code
    points that Python's own Unicode tables lack: those are split with the tables the
    file was made for.
    """

    def __init__(self, pattern: str, specials: list[str], normalise: bool, source: str) -> None:
        self.words = self.plain_words = regex.compile(pattern).findall
        if pattern == SPACED_PATTERN and not normalise:
            self.plain_words = plane_spaced().findall
        self.source, self.exact = source, None
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)))
        self.marks = specials
        self.normalise = normalise

    def _newer(self, text: str) -> list[str]:
        from strataforge.llm.bpe import byte_symbols

        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact, self.symbols = Tokenizer.from_str(self.source), byte_symbols()
        if self.exact.normalizer is not None:
            text = self.exact.normalizer.normalize_str(text)
        words = [w for w, _ in self.exact.pre_tokenizer.pre_tokenize_str(text)]
        return [bytes(map(self.symbols.__getitem__, w)).decode("utf-8") for w in words]

    def _plain(self, text: str) -> list[str]:
        beyond = not text.isascii() and BEYOND_LATIN.search(text)
        if beyond and newer_letters().search(text):
            return self._newer(text)
        if self.normalise:
            text = lower_each(unicodedata.normalize("NFC", text))
        return self.words(text) if beyond and BEYOND_PLANE.search(text) else self.plain_words(text)

    def split(self, text: str) -> list[str]:
        if not any(m in text for m in self.marks):
            return self._plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._plain(text[at:])
