"""Spelling variants: words one edit apart, grouped under their commonest form.

One inserted or deleted code point changes one letter count by one, one replaced code point
two at most, so near words have letter counts within L1 distance 1 (lengths that differ by
one) or 2 (equal lengths).  Per length, a k-d tree over letter counts, grown on a bounded sample of
words, deals all words into cells; a word visits the cells of its own length and of the next that
its range reaches.  Inside a cell a k-d tree over all its words prunes boxes out of range, and the
letters of what is left are compared in order.  A tree decides where words meet, never whether
they are near.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strataforge.functions.lookup import lookup
from strataforge.llm.letter_trees import LetterTree, cells, codes, grow, letter_bits, one_inserted, one_replaced, packed, single, within
from strataforge.llm.workers import trimmed
from strataforge.session import cut
from strataforge.sources.store import materialize

#: Words of a cell as a rule, and at most (in code points too); words of a leaf; queries at a time.
CELL, CELL_MOST, CELL_POINTS, LEAF, QUERIES = 8192, 16_384, 1 << 24, 16, 4096
#: Words that trees are grown on: so many a cell, and at most so many in all.
SAMPLE_A_CELL, SAMPLE = 16, 1 << 18

VISITS = "cell long, block int, kind int, own boolean, length int, word string, n long"


def corpus_words(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 7, min_count: int = 2, slip: int = 31) -> DataFrame:
    """(word, n) of the letter runs of all texts, A to Z lower-cased, with planted slips.

    A run is a maximal ``[A-Za-z\\u00C0-\\u00FF]+``.  Where ``slip`` divides h, the crc32 of
    ``<id>:<run>``, the code point h % length is deleted.  Words have ``min_chars`` code points
    and ``min_count`` occurrences at least.  Null and empty texts have no words; a null id is
    an empty one.
    """
    # Shorter runs can't give a word, with or without a slip.
    runs = docs.select(
        F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit("[A-Za-zÀ-ÿ]{%d,}" % max(1, min_chars)), F.lit(0))).alias("run"),
    )
    lower = runs.select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    hashed = lower.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % slip == 0, slipped).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _trees(words: DataFrame) -> dict[int, LetterTree]:
    """A tree for every length with more words than a cell holds; there are at most words / CELL of them."""
    many = {
        r["length"]: r["n"]
        for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).where(F.col("n") > CELL).collect()
    }
    wanted = {length: SAMPLE_A_CELL * -(-n // CELL) for length, n in many.items()}
    scale = min(1.0, SAMPLE / max(1, sum(wanted.values())))
    parts = 1 << 30
    share = F.lit(None).cast("long")
    for length, n in many.items():
        share = F.when(F.length("word") == length, F.lit(max(1, int(parts * scale * wanted[length] / n)))).otherwise(share)
    if not many:
        return {}
    drawn = words.where(F.pmod(F.xxhash64("word"), F.lit(parts).cast("long")) < share).select("word").collect()
    sampled: dict[int, list[str]] = {length: [] for length in many}
    for r in drawn:
        sampled[len(r["word"])].append(r["word"])
    return {length: grow(letter_bits(codes(sorted(w), length)), SAMPLE_A_CELL) for length, w in sampled.items() if w}


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], np.ndarray]]:
    words = batch.column(0).to_pylist()
    counts = batch.column(1).to_numpy(zero_copy_only=False)
    sizes = np.array([len(w) for w in words])
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        yield int(length), [words[i] for i in at], counts[at]


def _cell_most(length: int) -> int:
    return max(1, min(CELL_MOST, CELL_POINTS // max(1, length)))


def _cell(length: int, leaf: np.ndarray) -> np.ndarray:
    return (np.int64(length) << 32) + leaf


def _large_cells(words: DataFrame, trees: dict[int, LetterTree]) -> dict[int, int]:
    """Cells with more words than one task should hold, and the number of blocks they are cut into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some, _ in _by_length(batch):
                tree = trees.get(length)
                leaf = np.zeros(len(some), np.int64) if tree is None else cells(tree, letter_bits(codes(some, length)), 0, 0)[1]
                where, many = np.unique(_cell(length, leaf), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(many)], names=["cell", "n"])

    most = F.greatest(F.lit(1), F.least(F.lit(CELL_MOST), F.floor(F.lit(CELL_POINTS) / F.greatest(F.lit(1), F.shiftright("cell", 32)))))
    found = words.mapInArrow(trimmed(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    return {r["cell"]: -(-r["n"] // _cell_most(r["cell"] >> 32)) for r in found.collect()}


def _route(trees: dict[int, LetterTree], large: dict[int, int]):
    """Each word once at home (kind 0), and as a query (kind 1) in all cells it has to visit."""
    alone = single()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 8192):
                for length, some, n in _by_length(whole.slice(lo, 8192)):
                    bits = letter_bits(codes(some, length))
                    tree = trees.get(length, alone)
                    row, leaf, moved = cells(tree, bits, 1, 1)
                    home = np.empty(len(some), np.int64)
                    home[row[~moved]] = leaf[~moved]
                    # Of two cells of one length, the words of the first visit the second.
                    ask = leaf >= home[row]
                    next_row, next_leaf, _ = cells(trees.get(length + 1, alone), bits, 1, 0)
                    who = np.concatenate([np.arange(len(some)), row[ask], next_row])
                    where = np.concatenate([_cell(length, home), _cell(length, leaf[ask]), _cell(length + 1, next_leaf)])
                    kind = np.concatenate([np.zeros(len(some), np.int32), np.ones(len(who) - len(some), np.int32)])
                    own = np.concatenate([np.zeros(len(some), bool), ~moved[ask], np.zeros(len(next_row), bool)])
                    block = np.zeros(len(who), np.int32)
                    for i in np.flatnonzero(np.isin(where, list(large))) if large else ():
                        if kind[i] == 0:
                            block[i] = zlib.crc32(some[who[i]].encode()) % large[int(where[i])]
                    more = [(i, b) for i in np.flatnonzero((kind == 1) & np.isin(where, list(large))) for b in range(1, large[int(where[i])])] if large else []
                    if more:
                        extra = np.array([i for i, _ in more])
                        who, where, kind, own = (np.concatenate([x, x[extra]]) for x in (who, where, kind, own))
                        block = np.concatenate([block, np.array([b for _, b in more], np.int32)])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(where),
                            pa.array(block),
                            pa.array(kind),
                            pa.array(own),
                            pa.array(np.full(len(who), length, np.int32)),
                            pa.array(some).take(pa.array(who)),
                            pa.array(n[who]),
                        ],
                        names=["cell", "block", "kind", "own", "length", "word", "n"],
                    )

    return run


class _Cell:
    """The words of a block of a cell, with what near words they have found so far."""

    def __init__(self, length: int, words: list[str], n: np.ndarray) -> None:
        order = sorted(range(len(words)), key=words.__getitem__)
        self.length, self.words, self.n = length, [words[i] for i in order], n[order]
        self.points = codes(self.words, length)
        bits = letter_bits(self.points)
        self.tree, self.packed = grow(bits, LEAF), packed(bits)
        self.boxes = self.tree.boxes(bits)
        self.near = np.zeros(len(words), np.int64)
        self.best: dict[int, tuple[int, str]] = {}

    def ask(self, length: int, words: list[str], n: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[int, str]]]:
        """Numbers of near words of the queries, and (-n, word) of the best."""
        points = codes(words, length)
        near, best = np.zeros(len(words), np.int64), {}
        verify = one_replaced if length == self.length else one_inserted
        step = max(1, (1 << 22) // max(1, length))
        place = {w: i for i, w in enumerate(self.words)} if own.any() else {}
        rank = np.array([place.get(w, -1) if o else -1 for w, o in zip(words, own)])
        for i, j in within(self.tree, self.boxes, self.packed, packed(letter_bits(points)), 2 if length == self.length else 1):
            # In its own cell a word is asked about those behind it only.
            later = ~own[i] | (np.array([words[x] < self.words[y] for x, y in zip(i, j)], bool) if (own & (rank < 0)).any() else j > rank[i])
            i, j = i[later], j[later]
            for lo in range(0, len(i), step):
                a, b = i[lo : lo + step], j[lo : lo + step]
                good = verify(points[a], self.points[b])
                a, b = a[good], b[good]
                near += np.bincount(a, minlength=len(near))
                self.near += np.bincount(b, minlength=len(self.near))
                for x, y in zip(a.tolist(), b.tolist()):
                    found = (-int(self.n[y]), self.words[y])
                    if x not in best or found < best[x]:
                        best[x] = found
                    found = (-int(n[x]), words[x])
                    if y not in self.best or found < self.best[y]:
                        self.best[y] = found
        return near, best


def _rows(words: list[str], near: np.ndarray, best: dict[int, tuple[int, str]]) -> pa.RecordBatch:
    at = sorted(best)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[i] for i in at], pa.string()),
            pa.array([int(near[i]) for i in at], pa.int64()),
            pa.array([best[i][0] for i in at], pa.int64()),
            pa.array([best[i][1] for i in at], pa.string()),
        ],
        names=["word", "n_near", "less", "form"],
    )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a block come first, then its queries; both get what they have found there."""
    key, cell, words, counts = None, None, [], []
    for batch in batches:
        where, block, kind, length = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
        own, n = batch.column(3).to_numpy(zero_copy_only=False), batch.column(6).to_numpy(zero_copy_only=False)
        change = (np.diff(where) != 0) | (np.diff(block) != 0) | (np.diff(kind) != 0) | (np.diff(length) != 0)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            if lo == hi:
                continue
            if (where[lo], block[lo]) != key:
                if cell is not None:
                    yield _rows(cell.words, cell.near, cell.best)
                key, cell, words, counts = (where[lo], block[lo]), None, [], []
            some = batch.column(5)[lo:hi].to_pylist()
            if kind[lo] == 0:
                words += some
                counts.append(n[lo:hi])
                continue
            if cell is None:
                if not words:
                    continue  # no words live here
                cell = _Cell(int(where[lo]) >> 32, words, np.concatenate(counts))
                words, counts = [], []
            for a in range(lo, hi, QUERIES):
                b = min(hi, a + QUERIES)
                asked = some[a - lo : b - lo]
                yield _rows(asked, *cell.ask(int(length[lo]), asked, n[a:b], own[a:b]))
    if cell is not None:
        yield _rows(cell.words, cell.near, cell.best)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near ones; ``words`` is written already."""
    trees = _trees(words)
    large = _large_cells(words, trees)
    routed = words.mapInArrow(trimmed(_route(trees, large)), VISITS)
    dealt = routed.repartition("cell", "block").sortWithinPartitions("cell", "block", "kind", "length")
    found = dealt.mapInArrow(trimmed(_search), "word string, n_near long, less long, form string")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best")
    ).select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.form").alias("best"))


def spelling_forms(words: DataFrame, factor: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table of distinct words and their counts.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point;
    ``n_near`` counts a word's near words.  ``form`` is the near word of largest n (ties: the
    smallest in code-point order), if its n is ``factor`` times the word's at least, else null;
    ``form_n`` is its n.  ``root`` is reached by following forms to the last, and is the word
    itself if it has none.

    Words may hold any characters and be of any length.  Null words and words with a null count are left
    out; rows of the same word are one with their counts added.  An empty table gives an empty
    one.  Other columns don't matter.
    """
    known = words.where("word is not null and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    known = materialize(known, "words")
    found = known.join(near_words(known), "word", "left")
    good = F.col("best_n") >= F.col("n") * factor
    formed = cut(
        found.select(
            "word",
            F.when(good, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("best_n")).alias("form_n"),
        )
    )
    # Counts grow by the factor along forms, so chains are short; each round doubles the steps.
    step = cut(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        ahead = cut(lookup(step, onward, ["root"]))
        moved = ahead.where("beyond is not null").limit(1).count()
        step = ahead.select("word", F.coalesce("beyond", "root").alias("root"))
        if not moved:
            break
    rooted = lookup(formed, step, ["word"])
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
