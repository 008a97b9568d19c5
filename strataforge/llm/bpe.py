"""Byte-pair merging of words: speculate with longest matches, verify pairs, merge the rest exactly.

A word is a Latin-1 string of its UTF-8 bytes, closed by ``END`` where the vocabulary
marks word ends.  Greedy longest match proposes tokens.  A proposal is the result of
the merges exactly if each two neighbours would stay apart when merged on their own,
so only pairs are tested, all distinct pairs of a batch of words at once.  Words with
a failing pair are merged exactly.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass, field

import numpy as np

END = "Ā"
_NEVER = np.int64(1) << 40


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Tokens and merges of a byte-level BPE file, of a size fixed by the file."""

    tokens: list[str]
    specials: dict[str, int]
    end_of_word: bool
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray
    pair_ids: np.ndarray
    spelled: list[str]
    match: dict[str, int] = field(default_factory=dict, repr=False)
    pairs: dict[tuple[int, int], int] = field(default_factory=dict, repr=False)
    reach: dict[str, int] = field(default_factory=dict, repr=False)

    @classmethod
    def from_json(cls, text: str) -> Vocabulary:
        content = json.loads(text)
        model = content["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        specials = {t["content"]: t["id"] for t in content["added_tokens"]}
        n = max([*vocab.values(), *specials.values()]) + 1
        tokens = [""] * n
        for t, i in [*vocab.items(), *specials.items()]:
            tokens[i] = t
        symbols = byte_symbols()
        spelled = [""] * n
        for symbol, b in symbols.items():
            spelled[vocab[symbol]] = chr(b)
            if suffix:
                spelled[vocab[symbol + suffix]] = chr(b) + END
        rank = np.full(n, -1, dtype=np.int64)
        left, right = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        keys, ids = [], []
        for r, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            rank[k], left[k], right[k] = r, i, j
            spelled[k] = spelled[i] + spelled[j]
            keys.append(i << 32 | j)
            ids.append(k)
        order = np.argsort(np.array(keys, dtype=np.int64))
        out = cls(
            tokens, specials, bool(suffix), rank, left, right,
            np.array(keys, dtype=np.int64)[order], np.array(ids, dtype=np.int64)[order], spelled,
        )
        out._index()
        return out

    def _index(self) -> None:
        self.pairs = {(int(k >> 32), int(k & 0xFFFFFFFF)): int(i) for k, i in zip(self.pair_keys, self.pair_ids)}
        # A token whose own letters would be merged otherwise may not be proposed.
        made = np.flatnonzero(self.rank >= 0)
        sound = np.ones(len(self.tokens), dtype=bool)
        sound[made] = ~self.conflicts(self.left[made], self.right[made], self.rank[made])
        for t in made[np.argsort(self.rank[made])]:
            sound[t] &= sound[self.left[t]] and sound[self.right[t]]
        self.match = {s: i for i, s in enumerate(self.spelled) if s and sound[i]}
        # The longest token behind the first three letters, so that a letter is not tried with tokens it can't start.
        self.reach = {}
        for t in self.match:
            if len(t) >= 3:
                self.reach[t[:3]] = max(self.reach.get(t[:3], 0), len(t))

    def __getstate__(self) -> dict:
        # The lookup dictionaries are made again where the vocabulary is used.
        return self.__dict__ | {"match": {}, "pairs": {}, "reach": {}}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._index()

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or a rank that never comes."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.rank[self.pair_ids[at]], _NEVER)

    def conflicts(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair of tokens: does a merge across their border come first?

        Undoes the merges inside both tokens, the latest first, and at each step
        asks whether the pieces at the border would merge before they are used
        up inside their token.  Of two equal merges the left one comes first.
        ``limit``: only merges before this rank count.
        """
        n = len(a)
        found = np.zeros(n, dtype=bool)
        at, a, b = np.arange(n), a.astype(np.int64), b.astype(np.int64)
        until_a = np.full(n, _NEVER) if limit is None else limit.astype(np.int64)
        until_b = np.full(n, _NEVER - 1) if limit is None else limit.astype(np.int64) - 1
        while len(at):
            m = self._merged(a, b)
            hit = (m < until_a) & (m <= until_b)
            found[at[hit]] = True
            undo_a = self.rank[a] > self.rank[b]
            open_ = ~hit & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            until_a = np.where(undo_a, self.rank[a], until_a)
            until_b = np.where(undo_a, until_b, self.rank[b])
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            at, a, b, until_a, until_b = at[open_], a[open_], b[open_], until_a[open_], until_b[open_]
        return found

    def propose(self, word: str) -> list[int]:
        """Longest match from the left; the end mark belongs to the last letter."""
        out, at, n, match, reach = [], 0, len(word), self.match, self.reach
        marked = self.end_of_word
        while at < n:
            for end in range(min(n, at + reach.get(word[at : at + 3], 2)), at, -1):
                if marked and end == n - 1:
                    continue
                if (t := match.get(word[at:end])) is not None:
                    out.append(t)
                    at = end
                    break
        return out

    def merge(self, word: str) -> list[int]:
        """The merges in order of rank, then place, with a heap: n log n for a word of n bytes."""
        if self.end_of_word:
            symbols = [*word[:-2], word[-2:]]
        else:
            symbols = [*word]
        ids: list[int] = [self.match[s] for s in symbols]
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pairs, rank = self.pairs, self.rank
        heap = [(int(rank[k]), i, k) for i in range(n - 1) if (k := pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, k = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get((ids[i], ids[j])) != k:
                continue
            ids[i], ids[j] = k, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (x := pairs.get((k, ids[after[i]]))) is not None:
                    heapq.heappush(heap, (int(rank[x]), i, x))
            if before[i] >= 0 and (x := pairs.get((ids[before[i]], k))) is not None:
                heapq.heappush(heap, (int(rank[x]), before[i], x))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of words: proposals, one check of all distinct neighbour pairs, exact merging of the rest."""
        proposed = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, proposed), dtype=np.int64, count=len(proposed))
        if not sizes.sum():
            return proposed
        flat = np.fromiter((t for p in proposed for t in p), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        keys, back = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
        bad = self.conflicts(keys >> 32, keys & 0xFFFFFFFF)[back]
        for w in np.unique(owner[inner[bad]]):
            proposed[w] = self.merge(words[w])
        return proposed


class WordCache:
    """Token ids of words seen by this worker, in flat arrays; at most ``limit`` words of ``letters`` letters in all are kept."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 600_000, letters: int = 1 << 24) -> None:
        self.vocabulary, self.limit, self.letters = vocabulary, limit, letters
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.sizes, self.starts = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.int32), 0
        self.held = 0
        for s, i in self.vocabulary.specials.items():
            self._add([s], [[i]])

    def _add(self, words: list[str], ids: list[list[int]]) -> None:
        base = len(self.index)
        self.index.update(zip(words, range(base, base + len(words))))
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        total = int(sizes.sum())
        end, used = base + len(words), self.used + total
        if end > len(self.sizes):
            self.sizes, self.starts = np.resize(self.sizes, 2 * end), np.resize(self.starts, 2 * end)
        if used > len(self.ids):
            self.ids = np.resize(self.ids, 2 * used)
        self.sizes[base:end] = sizes
        self.starts[base:end] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : used] = np.fromiter((t for p in ids for t in p), dtype=np.int32, count=total)
        self.used = used

    def learn(self, words: set[str]) -> None:
        """Make all these words known; older ones may go."""
        new = words - self.index.keys()
        if len(self.index) + len(new) > self.limit or self.held + sum(map(len, new)) > self.letters:
            self.clear()
            new = words - self.index.keys()
        if new:
            self.held += sum(map(len, new))
            new = sorted(new)
            end = END if self.vocabulary.end_of_word else ""
            spelled = [w.encode("utf-8").decode("latin-1") + end for w in new]
            self._add(new, self.vocabulary.encode_words(spelled))

    def expand(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these indexes, one after the other, and how many each has."""
        sizes = self.sizes[at]
        first = np.cumsum(sizes) - sizes
        take = np.arange(int(sizes.sum())) + np.repeat(self.starts[at] - first, sizes)
        return self.ids[take], sizes
