"""Words of many texts at once, as 64-bit hashes, from the bytes of an Arrow batch.

A word is a maximal run of word bytes inside one text; which bytes those are is a
table of 256 flags, so any word class that treats all non-ASCII bytes alike can be
used.  Hashes are those of the words with A-Z lower-cased.  They depend on the
word's bytes only: the same word has the same hash in every batch and task.

Memory is bounded by ``SEGMENT`` bytes of text at a time (a longer single word
extends it), whatever the lengths of the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_class(separators: bytes) -> np.ndarray:
    """256 flags: True for bytes that belong to words."""
    flags = np.ones(256, dtype=bool)
    flags[list(separators)] = False
    return flags


SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: Everything but white space of ASCII.
NOT_SPACE = byte_class(SPACE)
#: ASCII letters and digits and everything that is not ASCII.
ALNUM = byte_class(bytes(b for b in range(0x80) if not chr(b).isalnum()))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        _TABLES.extend((powers(_BASE, SEGMENT + 1), powers(_BASE_INVERSE, SEGMENT + 1)))
    if n <= SEGMENT:
        return _TABLES[0][:n], _TABLES[1][: n + 1]
    return powers(_BASE, n), powers(_BASE_INVERSE, n + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts (one more than texts); null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Ranges of at most SEGMENT bytes that end where no word is cut."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + SEGMENT, n)
        while end < n:
            window = is_word[data[end : end + 4096]]
            stop = end + (int(np.argmin(window)) if not window.all() else len(window))
            k = np.searchsorted(offsets, end)
            text_end = int(offsets[k]) if k < len(offsets) else n
            if text_end <= stop:
                end = text_end
                break
            end = stop
            if not window.all():
                break
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and for each text the index of its first word (one more entry than texts)."""
    hashes, starts_at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in _cuts(data, offsets, is_word):
        piece = data[lo:hi]
        inside = is_word[piece]
        edges = offsets[np.searchsorted(offsets, lo, "left") : np.searchsorted(offsets, hi, "left")] - lo
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        starts[edges] |= inside[edges]
        ends = np.zeros(len(piece) + 1, dtype=bool)
        ends[1:] = inside
        ends[1:-1] &= ~inside[1:]
        later = edges[edges > 0]
        ends[later] |= inside[later - 1]
        first, last = np.flatnonzero(starts), np.flatnonzero(ends)
        power, inverse = _tables(len(piece))
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum((_LOWER[piece].astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * inverse[first]))
        starts_at.append(first + lo)
    positions = np.concatenate(starts_at)
    return np.concatenate(hashes), np.searchsorted(positions, offsets)


def shingle_hashes(hashes: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside one text, and the text of each.

    A text with 1 to k - 1 words has one shingle, all its words.
    """
    n = np.diff(firsts)
    out, owner = [], []
    if len(hashes) >= k:
        size = len(hashes) - k + 1
        s = np.zeros(size, dtype=np.uint64)
        for i in range(k):
            s = mix(s * np.uint64(3) + hashes[i : i + size] + np.uint64(i + 1))
        text = np.repeat(np.arange(len(n)), n)
        whole = text[:size] == text[k - 1 :]
        out.append(s[whole])
        owner.append(text[:size][whole])
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        s = np.zeros(len(short), dtype=np.uint64)
        for i in range(k - 1):
            has = n[short] > i
            at = np.minimum(firsts[short] + i, max(len(hashes) - 1, 0))
            s = np.where(has, mix(s * np.uint64(3) + hashes[at] + np.uint64(i + 1)), s)
        out.append(mix(s + n[short].astype(np.uint64) * np.uint64(_BASE)))
        owner.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out, owner = np.concatenate(out), np.concatenate(owner).astype(np.int64)
    return out, owner
