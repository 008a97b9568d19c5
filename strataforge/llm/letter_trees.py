"""Letter counts of words as bits, and k-d trees over them.

A word's letter counts are written in unary: bit t of a letter says that it occurs more
than t times, for t below 4.  The number of bits in which two words differ is then the L1
distance of their counts, cut at 4, so it is never above the true one.  A box of a k-d tree
is the AND (least counts) and the OR (largest counts) of its words, and the distance of a
word to it is the number of bits that the AND has and the word lacks, or the word has and
the OR lacks.  Splitting at a count of a letter is splitting at a bit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Letter classes: a to z, and all others by their code point modulo 6; thresholds of a class.
CLASSES, STEPS = 32, 4
BITS = CLASSES * STEPS


def codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each: bytes where they fit."""
    text = "".join(words)
    try:
        flat = np.frombuffer(text.encode("latin-1"), dtype=np.uint8)
    except UnicodeEncodeError:
        flat = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return flat.reshape(len(words), length)


def letter_bits(points: np.ndarray) -> np.ndarray:
    """Unary letter counts, one byte a bit."""
    n, length = points.shape
    if n == 0 or length == 0:
        return np.zeros((n, BITS), np.uint8)
    letters = points.astype(np.int32)
    kind = np.where((letters >= 97) & (letters <= 122), letters - 97, 26 + letters % (CLASSES - 26))
    counts = np.bincount((np.arange(n)[:, None] * CLASSES + kind).ravel(), minlength=n * CLASSES).reshape(n, CLASSES)
    return (counts[:, :, None] > np.arange(STEPS)).astype(np.uint8).reshape(n, BITS)


def packed(bits: np.ndarray) -> np.ndarray:
    """Bits as two 64-bit numbers a row."""
    return np.packbits(bits, axis=1).view(np.uint64)


@dataclass
class LetterTree:
    """Nodes by number: the bit that splits a node and its first child (-1: a leaf), its places in ``order``."""

    bit: np.ndarray
    child: np.ndarray
    start: np.ndarray
    end: np.ndarray
    order: np.ndarray
    leaf: np.ndarray  # leaves numbered from the left, -1 elsewhere

    def boxes(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """AND and OR of the words of each node."""
        low, high = np.empty((len(self.bit), 2), np.uint64), np.empty((len(self.bit), 2), np.uint64)
        inside = packed(bits)[self.order]
        for node in range(len(self.bit) - 1, -1, -1):
            c = self.child[node]
            if c < 0:
                part = inside[self.start[node] : self.end[node]]
                low[node], high[node] = np.bitwise_and.reduce(part, axis=0), np.bitwise_or.reduce(part, axis=0)
            else:
                low[node], high[node] = low[c] & low[c + 1], high[c] | high[c + 1]
        return low, high


def grow(bits: np.ndarray, leaf: int) -> LetterTree:
    """A tree whose nodes are split at the bit that halves them best, down to ``leaf`` words or equal counts."""
    n = len(bits)
    order = np.arange(n)
    bit, child, start, end = [-1], [-1], [0], [n]
    level = [0]
    while level:
        wide = [i for i in level if end[i] - start[i] > leaf]
        if not wide:
            break
        inside = np.vstack([bits[order], np.zeros((1, bits.shape[1]), np.uint8)])
        cuts = np.array([[start[i], end[i]] for i in wide]).ravel()
        ones = np.add.reduceat(inside, cuts, axis=0, dtype=np.int64)[::2]
        sizes = np.array([end[i] - start[i] for i in wide])
        even = np.minimum(ones, sizes[:, None] - ones)
        best = even.argmax(axis=1)
        level = []
        for i, b, good in zip(wide, best, even.max(axis=1)):
            if good == 0:
                continue
            span = order[start[i] : end[i]]
            right = bits[span, b] == 1
            order[start[i] : end[i]] = np.concatenate([span[~right], span[right]])
            middle = end[i] - int(right.sum())
            bit[i], child[i] = int(b), len(bit)
            level += [len(bit), len(bit) + 1]
            bit += [-1, -1]
            child += [-1, -1]
            start += [start[i], middle]
            end += [middle, end[i]]
    child_a, start_a = np.array(child), np.array(start)
    number = np.full(len(bit), -1)
    leaves = np.flatnonzero(child_a < 0)
    number[leaves[np.argsort(start_a[leaves], kind="stable")]] = np.arange(len(leaves))
    return LetterTree(np.array(bit), child_a, start_a, np.array(end), order, number)


def single() -> LetterTree:
    return LetterTree(np.array([-1]), np.array([-1]), np.array([0]), np.array([0]), np.zeros(0, np.int64), np.array([0]))


def cells(tree: LetterTree, bits: np.ndarray, more: int, fewer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, moved) of all leaves that may hold a word with up to ``more`` letters more and ``fewer`` less.

    ``more`` and ``fewer`` are 0 or 1.  ``moved`` is false for the leaf that the row itself belongs to.
    """
    rows, nodes = np.arange(len(bits)), np.zeros(len(bits), np.int64)
    up, down = np.full(len(bits), -1), np.full(len(bits), -1)  # the class that was raised or lowered
    out = []
    while len(rows):
        done = tree.child[nodes] < 0
        out.append((rows[done], tree.leaf[nodes[done]], (up[done] >= 0) | (down[done] >= 0)))
        rows, nodes, up, down = rows[~done], nodes[~done], up[~done], down[~done]
        if not len(rows):
            break
        b, first = tree.bit[nodes], tree.child[nodes]
        value, kind, step = bits[rows, b], b // STEPS, b % STEPS
        # One letter more sets this bit if the count stands right below it; one less clears it if right above.
        below = (value == 0) & ((step == 0) | (bits[rows, b - 1] == 1)) & (up < 0) & (down != kind) & (more > 0)
        above = (value == 1) & ((step == STEPS - 1) | (bits[rows, np.minimum(b + 1, BITS - 1)] == 0)) & (down < 0) & (up != kind) & (fewer > 0)
        rows, nodes, up, down = (
            np.concatenate([rows, rows[below], rows[above]]),
            np.concatenate([first + value, first[below] + 1, first[above]]),
            np.concatenate([up, kind[below], up[above]]),
            np.concatenate([down, down[below], kind[above]]),
        )
    row, leaf, moved = (np.concatenate(x) for x in zip(*out))
    return row, leaf, moved


def within(tree: LetterTree, boxes: tuple[np.ndarray, np.ndarray], words: np.ndarray, asked: np.ndarray, reach: int, most: int = 1 << 18):
    """Yield (query, word) places whose bits differ in at most ``reach``: boxes out of reach are pruned."""
    low, high = boxes
    queries, nodes = np.arange(len(asked)), np.zeros(len(asked), np.int64)
    while len(queries):
        q = asked[queries]
        off = np.bitwise_count(low[nodes] & ~q) + np.bitwise_count(q & ~high[nodes])
        near = off[:, 0] + off[:, 1] <= reach
        queries, nodes = queries[near], nodes[near]
        done = tree.child[nodes] < 0
        sizes = tree.end[nodes[done]] - tree.start[nodes[done]]
        who, first = queries[done], tree.start[nodes[done]]
        # Leaves are opened in slices of a bounded number of pairs.
        total = np.cumsum(sizes)
        lo = 0
        while lo < len(who):
            base = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, base + most, "right")))
            s = sizes[lo:hi]
            i = np.repeat(who[lo:hi], s)
            at = np.repeat(first[lo:hi] - (np.cumsum(s) - s), s) + np.arange(s.sum())
            j = tree.order[at]
            d = np.bitwise_count(asked[i] ^ words[j])
            keep = d[:, 0] + d[:, 1] <= reach
            yield i[keep], j[keep]
            lo = hi
        first = tree.child[nodes[~done]]
        queries = np.repeat(queries[~done], 2)
        nodes = (first[:, None] + [0, 1]).ravel()


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of equal length differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a row of ``b``, one longer, is that of ``a`` with one code point put in."""
    n, length = a.shape
    if length == 0:
        return np.ones(n, bool)
    edge = np.ones((n, 1), bool)
    head = np.hstack([a != b[:, :-1], edge]).argmax(axis=1)
    tail = np.hstack([(a != b[:, 1:])[:, ::-1], edge]).argmax(axis=1)
    return head + tail >= length
