"""Measures of a text's form, and the votes of heuristic labellers on them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from strataforge.llm.bytewords import ALNUM, NOT_SPACE, byte_class, text_bytes, word_hashes

#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that for it was on with as be by this are or from at an not "
    "der die und das den von zu mit ein ist des im auf für eine nicht dem sich als auch "
    "le la les des et un une du que qui dans pour par sur est pas au avec en de "
    "el los las del y se una con por para al lo su es como más o no ja"
).split()

CLEAN, JUNK, ABSTAIN = 0, 1, 2

#: Labeller, measure, clean from, clean to, junk below, junk above; between them it abstains.
LABELLERS = [
    ("stutter", "repeated", 0.0, 0.04, -1.0, 0.12),
    ("shouting", "capitals", 0.0, 0.12, -1.0, 0.35),
    ("symbols", "symbols", 0.0, 0.07, -1.0, 0.11),
    ("menus", "separators", 0.0, 0.02, -1.0, 0.15),
    ("poor", "variety", 0.35, 1.0, 0.15, 2.0),
    ("prose", "function_words", 0.12, 0.7, 0.04, 2.0),
    ("echo", "repeated_lines", 0.0, 0.3, -1.0, 0.55),
    ("word_length", "word_length", 4.0, 6.2, 3.0, 7.5),
    ("sentences", "sentence_ends", 0.02, 0.4, 0.004, 0.75),
]

_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_CAPITAL = np.array([ord("A") <= b <= ord("Z") for b in range(256)])
_SYMBOL = np.array([0x21 <= b < 0x7F and not chr(b).isalnum() for b in range(256)])
_LINE = byte_class(b"\n")
_END = np.isin(np.arange(256), list(b".!?"))


def hashes_of(words: list[str]) -> np.ndarray:
    return np.unique(word_hashes(*text_bytes(pa.array([" ".join(words)])), NOT_SPACE)[0])


def _sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def _distinct(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(firsts) - 1, dtype=np.int64)
    for i, (lo, hi) in enumerate(zip(firsts[:-1], firsts[1:])):
        if hi > lo:
            s = np.sort(hashes[lo:hi])
            out[i] = 1 + np.count_nonzero(s[1:] != s[:-1])
    return out


def measures(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Measures per text; hashes of all its words of letters and digits, and where each text's begin."""
    data, offsets = text_bytes(texts)
    words, firsts = word_hashes(data, offsets, NOT_SPACE)
    plain, plain_firsts = word_hashes(data, offsets, ALNUM)
    lines, line_firsts = word_hashes(data, offsets, _LINE)
    n = np.diff(firsts)
    per_word = np.maximum(n, 1)
    text = np.repeat(np.arange(len(n)), n)
    same = np.zeros(len(words), dtype=bool)
    if len(words):
        same[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    letters = _sums(_LETTER[data], offsets)
    space = ~NOT_SPACE[data]
    filled = np.diff(offsets) - _sums(space, offsets)
    last = np.zeros(len(data), dtype=bool)
    if len(data):
        last[:-1] = _END[data[:-1]] & space[1:]
        last[-1] = _END[data[-1]]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        last[inner - 1] |= _END[data[inner - 1]]
    line_count = np.maximum(np.diff(line_firsts), 1)
    plain_n = np.diff(plain_firsts)
    known = np.isin(plain, hashes_of(FUNCTION_WORDS))
    out = {
        "words": n,
        "repeated": _sums(same, firsts) / per_word,
        "capitals": _sums(_CAPITAL[data], offsets) / np.maximum(letters, 1),
        "symbols": _sums(_SYMBOL[data], offsets) / np.maximum(filled, 1),
        "separators": _sums(np.isin(words, hashes_of(["|", "-", "*", ">", "»", "·"])), firsts) / per_word,
        # A long text repeats words anyway; 400 words are expected to be new for it.
        "variety": _distinct(plain, plain_firsts) / np.maximum(np.minimum(plain_n, 400), 1),
        "function_words": _sums(known, plain_firsts) / np.maximum(plain_n, 1),
        "repeated_lines": 1 - _distinct(lines, line_firsts) / line_count,
        "word_length": filled / per_word,
        "sentence_ends": _sums(last, offsets) / per_word,
    }
    out["variety"] = np.minimum(out["variety"], 1.0)
    out["repeated_lines"] = np.where(np.diff(line_firsts) > 2, out["repeated_lines"], 0.0)
    return out, plain, plain_firsts


def votes(found: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, labellers): clean, junk or no vote.  Texts of under 5 words get none."""
    out = np.full((len(found["words"]), len(LABELLERS)), ABSTAIN, dtype=np.int8)
    for k, (_, measure, lo, hi, below, above) in enumerate(LABELLERS):
        x = found[measure]
        out[(x >= lo) & (x <= hi), k] = CLEAN
        out[(x < below) | (x > above), k] = JUNK
    out[found["words"] < 5] = ABSTAIN
    return out
