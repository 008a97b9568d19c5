"""Benchmark decontamination by latent semantic retrieval.

1. Words are weighted by their rarity over all documents.
2. Benchmark items are cut into passages; a distributed randomised SVD of their TF-IDF
   rows gives a latent space per block of passages.
3. Windows of the documents are folded into that space and compared by cosine.  A window
   whose benchmark words hold too little of its weight can't reach the threshold with
   any passage and is left out before.
4. Windows that share a few consecutive words with a passage are candidates whatever
   their cosine, so that no rare word beside a copy hides it.
5. Candidates are verified on words: longest common subsequence, and for paraphrases
   the passage's most informative words (its answer) as well; or a long run of words
   that both have, whatever its share of the passage.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from strataforge.functions.matrices import tree_merge
from strataforge.llm.bytewords import ALNUM, mix, text_bytes, word_hashes
from strataforge.llm.naming import unused
from strataforge.llm.workers import trimmed
from strataforge.session import cut

#: Slots of the table of word weights (1 MB).
SLOT_BITS = 18
#: Words of a passage at most.
PASSAGE = 64
#: Passages of fewer words than the first are sought in short windows; words of short and of long windows, which
#: overlap by half.
SHORT, WINDOWS = 24, (16, 32)
#: Rarity counts with this power, so that a window of common words is far from everything.
POWER = 3
#: Passages of a block (their number varies around it), blocks searched in one pass, latent dimensions at most.
BLOCK, PER_PASS, RANK = 192, 8, 224
#: Consecutive words that make a window a candidate: a copy with at most an eighth of its words changed has so many in a row.
SEED = 4
#: Bits of the table of marks that most other runs of words fail (1 MB).
MARK_BITS = 20
#: Items with fewer words are too common to be told from chance.
SHORTEST = 5
#: Cosine of candidates; share of a passage in the common subsequence; the same with its answer's share, which is below it:
#: a copy with a third of its words changed at random keeps six or seven of ten words of its answer, seldom eight.
COSINE, VERBATIM, PARAPHRASE, ANSWER = 0.35, 0.8, 0.6, 0.5
#: Words in a row that are a quotation.  Passages overlap so far that one of them holds all of any such run.
QUOTED = 13
#: Texts, and windows, worked on at a time.
ROWS, CHUNK = 512, 4096


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*text_bytes(column), ALNUM)


def _slots(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def rarity(docs: DataFrame) -> np.ndarray:
    """Weight of each slot: a power of the log of all words over the slot's, counted over all documents.

    Counts travel compressed: those of a task with few words are mostly zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in batches:
            for part in _parts(batch):
                words, _ = _words(part.column(0))
                counts += np.bincount(_slots(words), minlength=len(counts))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([0], pa.int32()), pa.array([zlib.compress(counts, 1)], pa.binary())],
            names=["part", "g", "m"],
        )

    def merge(parts: list[bytes]) -> bytes:
        return zlib.compress(sum(np.frombuffer(zlib.decompress(p), dtype=np.int64) for p in parts), 1)

    sums = tree_merge(docs.select("text").mapInArrow(trimmed(run), "part int, g int, m binary"), merge)
    counts = np.frombuffer(zlib.decompress(sums[0]), dtype=np.int64) if sums else np.zeros(1 << SLOT_BITS, np.int64)
    return (np.log((counts.sum() + 2.0) / (counts + 1.0)) ** POWER).astype(np.float32)


def passages(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """(item, part, words) of every benchmark passage; ``words`` are packed hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, firsts = _words(batch.column(1))
            items, parts, packed = [], [], []
            for item, lo, hi in zip(batch.column(0).to_pylist(), firsts[:-1], firsts[1:]):
                if hi - lo < SHORTEST:
                    continue
                for k, at in enumerate(range(lo, max(lo + 1, hi - PASSAGE // 2), PASSAGE // 2)):
                    items.append(item)
                    parts.append(k)
                    packed.append(words[at : min(at + PASSAGE, hi)].tobytes())
            columns = [pa.array(items, pa.int64()), pa.array(parts, pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "part", "words"])

    slim = benchmark.select(F.col(f"`{id}`").cast("long").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    return slim.where("item is not null").distinct().mapInArrow(trimmed(run), "item long, part int, words binary")


def _row(words: np.ndarray, vocabulary: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A passage's row of unit length over the block's vocabulary; a word counts once."""
    at = np.unique(np.searchsorted(vocabulary, words))
    value = weight[_slots(vocabulary[at])].astype(np.float64)
    return at, value / max(np.sqrt((value * value).sum()), 1e-12)


def randomised_svd(rows: DataFrame, vocabulary: np.ndarray, weight: np.ndarray, rank: int, rounds: int = 2) -> np.ndarray:
    """Right singular directions (vocabulary x rank) of the passages' TF-IDF matrix.

    A fixed random start is multiplied by A^T A; each task adds up its rows' share and
    shares are merged in rounds, so no task or driver ever holds the matrix.  A share is
    sent as the words it has and their rows, so it is as small as the task's passages are few.
    """
    context = rows.sparkSession.sparkContext
    basis = np.random.default_rng(7).standard_normal((len(vocabulary), rank))
    size = len(vocabulary)

    def packed(at: np.ndarray, total: np.ndarray) -> bytes:
        return np.int64(len(at)).tobytes() + at.astype(np.int64).tobytes() + total[at].tobytes()

    def merge(parts: list[bytes]) -> bytes:
        total, held = np.zeros((size, rank)), np.zeros(size, dtype=bool)
        for p in parts:
            n = int(np.frombuffer(p, np.int64, 1)[0])
            at = np.frombuffer(p, np.int64, n, 8)
            total[at] += np.frombuffer(p, offset=8 * (n + 1)).reshape(n, rank)
            held[at] = True
        return packed(np.flatnonzero(held), total)

    for _ in range(rounds):
        shared = context.broadcast((vocabulary, weight, np.linalg.qr(basis)[0]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabulary, weight, basis = shared.value
            total, held = np.zeros_like(basis), np.zeros(len(basis), dtype=bool)
            for batch in batches:
                for words in batch.column(0).to_pylist():
                    at, value = _row(np.frombuffer(words, dtype=np.uint64), vocabulary, weight)
                    total[at] += np.outer(value, value @ basis[at])
                    held[at] = True
            if held.any():
                part = TaskContext.get().partitionId()
                share = packed(np.flatnonzero(held), total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([0], pa.int32()), pa.array([share], pa.binary())], names=["part", "g", "m"]
                )

        sums = tree_merge(rows.select("words").mapInArrow(trimmed(run), "part int, g int, m binary"), merge)
        n = int(np.frombuffer(sums[0], np.int64, 1)[0])
        basis = np.zeros_like(basis)
        basis[np.frombuffer(sums[0], np.int64, n, 8)] = np.frombuffer(sums[0], offset=8 * (n + 1)).reshape(n, rank)
        shared.unpersist()
    return np.linalg.qr(basis)[0]


def _runs(words: np.ndarray) -> np.ndarray:
    """A hash of the SEED words from each word on."""
    n = max(0, len(words) - SEED + 1)
    out = np.zeros(n, np.uint64)
    for i in range(SEED):
        out = mix(out * np.uint64(3) + words[i : i + n])
    return out


class Block:
    """Some passages of like length: their words, vocabulary, latent word vectors and latent rows."""

    def __init__(
        self, window: int, items: list[int], words: list[np.ndarray], vocabulary: np.ndarray, weight: np.ndarray, turn: np.ndarray
    ) -> None:
        self.window, self.items, self.words, self.vocabulary = window, items, words, vocabulary
        own = weight[_slots(vocabulary)].astype(np.float64)
        # The last row stands for words that no passage has.
        self.square = np.append(own**2, 0.0)
        self.latent = np.vstack([turn * own[:, None], np.zeros(turn.shape[1])]).astype(np.float32)
        rows = [_row(w, vocabulary, weight) for w in words]
        self.rows = np.stack([value @ turn[at] for at, value in rows]).astype(np.float32)

    def answer(self, k: int, weight: np.ndarray) -> np.ndarray:
        """The third of a passage's distinct words that says most."""
        own = np.unique(self.words[k])
        return own[np.argsort(-weight[_slots(own)], kind="stable")[: max(1, len(own) // 3)]]


class Seeds:
    """The runs of SEED words of the passages of some blocks."""

    def __init__(self, blocks: list[Block]) -> None:
        own = [(np.unique(_runs(w)), b, k) for b, block in enumerate(blocks) for k, w in enumerate(block.words)]
        many = [len(runs) for runs, _, _ in own]
        runs = np.concatenate([runs for runs, _, _ in own])
        order = np.argsort(runs, kind="stable")
        self.runs, firsts = np.unique(runs[order], return_index=True)
        self.firsts = np.append(firsts, len(runs))
        self.block = np.repeat([b for _, b, _ in own], many)[order]
        self.passage = np.repeat([k for _, _, k in own], many)[order]
        self.marks = np.zeros(1 << MARK_BITS, dtype=bool)
        self.marks[self._mark(self.runs)] = True

    def _mark(self, runs: np.ndarray) -> np.ndarray:
        return (runs >> np.uint64(64 - MARK_BITS)).astype(np.int64)

    def found(self, words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, block, passage) of the runs of the texts that begin at ``firsts`` that a passage has as well."""
        runs = _runs(words)
        place = np.flatnonzero(self.marks[self._mark(runs)])
        at = np.minimum(np.searchsorted(self.runs, runs[place]), len(self.runs) - 1)
        one_text = np.searchsorted(firsts, place, "right") == np.searchsorted(firsts, place + SEED - 1, "right")
        same = one_text & (self.runs[at] == runs[place])
        place, at = place[same], at[same]
        many = self.firsts[at + 1] - self.firsts[at]
        k = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.firsts[at], many)
        return np.repeat(place, many), self.block[k], self.passage[k]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, one row of the table at a time as bits of an integer."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full, state = (1 << len(a)) - 1, (1 << len(a)) - 1
    for w in b.tolist():
        m = state & masks.get(w, 0)
        state = ((state + m) | (state - m)) & full
    return len(a) - bin(state).count("1")


def quotes(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether both have the same QUOTED words in a row."""
    own, other = ({w[i : i + 8 * QUOTED] for i in range(0, len(w) - 8 * QUOTED + 1, 8)} for w in (a.tobytes(), b.tobytes()))
    return not own.isdisjoint(other)


def _windows(firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of all windows, each beginning in the middle of the one before, of texts that begin at ``firsts``."""
    n, step = np.diff(firsts), size // 2
    many = np.where(n > 0, np.maximum(1, -(-(n - step) // step)), 0)
    text = np.repeat(np.arange(len(n)), many)
    k = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    start = firsts[text] + k * step
    return text, start, np.minimum(start + size, firsts[text + 1])


def _candidates(block: Block, words: np.ndarray, start: np.ndarray, end: np.ndarray, square: np.ndarray, near: np.ndarray):
    """(windows, passages, cosines) at COSINE or more, and of the pairs ``near``: distinct window * passages + passage, sorted.

    By Cauchy and Schwarz a window's cosine with any passage is at most the share
    that the block's words have of its length, so windows below that are left out.
    """
    near_window, near_passage = np.divmod(near, len(block.items))
    none = len(block.vocabulary)
    at = np.searchsorted(block.vocabulary, words)
    at[at == none] = 0
    at = np.where(block.vocabulary[at] == words, at, none).astype(np.int32)
    other = np.concatenate([[0.0], np.cumsum(np.where(at == none, square, 0.0))])
    at = np.append(at, np.int32(none))
    for lo in range(0, len(start), CHUNK):
        first, last = start[lo : lo + CHUNK], end[lo : lo + CHUNK]
        index = first[:, None] + np.arange(block.window)
        own = np.sort(at[np.where(index < last[:, None], index, len(words))], axis=1)
        own[:, 1:][own[:, 1:] == own[:, :-1]] = none
        mass = block.square[own].sum(axis=1)
        length = np.sqrt(mass + other[last] - other[first]) + 1e-12
        own_near = near_window[slice(*np.searchsorted(near_window, (lo, lo + CHUNK)))] - lo
        gate = np.union1d(np.flatnonzero(mass >= (COSINE * length) ** 2), own_near)
        for k in range(0, len(gate), 512):
            w = gate[k : k + 512]
            cosine = block.latent[own[w]].sum(axis=1) @ block.rows.T / length[w, None]
            close = cosine >= COSINE
            seeded = slice(*np.searchsorted(near_window, (lo + w[0], lo + w[-1] + 1)))
            close[np.searchsorted(w, near_window[seeded] - lo), near_passage[seeded]] = True
            i, passage = np.nonzero(close)
            yield lo + w[i], passage, cosine[i, passage]


def _search(docs: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, seeds, weight = shared.value
        answers = [[b.answer(k, weight) for k in range(len(b.items))] for b in blocks]
        for batch in batches:
            for part in _parts(batch):
                words, firsts = _words(part.column(1))
                square = weight[_slots(words)].astype(np.float64) ** 2
                windows = {size: _windows(firsts, size) for size in {b.window for b in blocks}}
                place, in_block, in_passage = seeds.found(words, firsts)
                found: dict[tuple[int, int], tuple] = {}
                for b, block in enumerate(blocks):
                    text, start, end = windows[block.window]
                    own = in_block == b
                    near = np.unique((np.searchsorted(start, place[own], "right") - 1) * len(block.items) + in_passage[own])
                    for window, passage, cosine in _candidates(block, words, start, end, square, near):
                        for w, k, c in zip(window.tolist(), passage.tolist(), cosine.tolist()):
                            t, p = int(text[w]), block.words[k]
                            lo = max(int(firsts[t]), int(start[w]) - len(p))
                            region = words[lo : min(int(firsts[t + 1]), int(end[w]) + len(p))]
                            common = common_subsequence(p, region)
                            share = common / len(p)
                            answer = float(np.isin(answers[b][k], region).mean())
                            told = share >= VERBATIM or share >= PARAPHRASE and answer >= ANSWER
                            if told or common >= QUOTED and quotes(p, region):
                                key = (t, block.items[k])
                                found[key] = max(found.get(key, (0.0, 0.0, 0.0)), (share, answer, min(c, 1.0)))
                if found:
                    rows = [(part.column(0)[t].as_py(), item, *best) for (t, item), best in found.items()]
                    types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "item", "lcs", "answer", "cosine"])

    return docs.select("id", "text").mapInArrow(trimmed(run), "id long, item long, lcs double, answer double, cosine double")


def leaks(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(id, item, lcs, answer, cosine) of every document that holds a benchmark item, a paraphrase or QUOTED words in a row of it.

    Every window of every whole text is searched, against blocks of benchmark passages
    that are broadcast a bounded number at a time.  A passage that stands in a text word
    for word, or with at most an eighth of its words changed, is found whatever its words
    and neighbours are; so is any run of QUOTED words of an item, wherever it begins (then
    ``lcs`` can be below the shares asked of the others).  Null and empty texts hold nothing;
    neither do rows with a null id.  Items with a null id or fewer than SHORTEST words
    are left out.  Rows with the same id are one document, repeated items count once,
    and empty tables give no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    source = source.where("id is not null")
    queried = cut(passages(benchmark, item, item_text))
    found = spark.createDataFrame([], "id long, item long, lcs double, answer double, cosine double")
    is_short = F.octet_length("words") < 8 * SHORT
    counts = {r["short"]: r["count"] for r in queried.groupBy(is_short.alias("short")).count().collect()}
    if not counts:
        return _named(found, id, item)
    weight = rarity(source)
    ready = [
        (WINDOWS[0] if short else WINDOWS[1], queried.where(is_short == short), math.ceil(n / BLOCK), b)
        for short, n in sorted(counts.items())
        for b in range(math.ceil(n / BLOCK))
    ]
    for first in range(0, len(ready), PER_PASS):
        blocks = []
        for window, table, n_blocks, b in ready[first : first + PER_PASS]:
            rows = table.where(F.pmod(F.xxhash64("item", "part"), F.lit(n_blocks)) == b)
            own = sorted((r["item"], r["part"], bytes(r["words"])) for r in rows.collect())
            if own:
                words = [np.frombuffer(w, dtype=np.uint64) for _, _, w in own]
                vocabulary = np.unique(np.concatenate(words))
                turn = randomised_svd(rows, vocabulary, weight, min(RANK, len(own), len(vocabulary)))
                blocks.append(Block(window, [i for i, _, _ in own], words, vocabulary, weight, turn))
        if blocks:
            found = found.unionByName(_search(source, spark.sparkContext.broadcast((blocks, Seeds(blocks), weight))))
    best = found.groupBy("id", "item").agg(F.max(F.struct("lcs", "answer", "cosine")).alias("best"))
    return _named(best.select("id", "item", "best.lcs", "best.answer", "best.cosine"), id, item)


def _named(found: DataFrame, id: str, item: str) -> DataFrame:
    return found.select(F.col("id").alias(id), F.col("item").alias(item), "lcs", "answer", "cosine")


def clean_documents(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", **names) -> DataFrame:
    """The documents that hold no benchmark item and no long quotation of one.  Rows with a null id stay."""
    name = unused(docs.columns, "_dirty")
    dirty = leaks(docs, benchmark, id=id, **names).select(F.col(id).alias(name)).distinct()
    return docs.join(dirty, F.col(f"`{id}`") == F.col(name), "left_anti")
