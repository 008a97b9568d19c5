"""Quality classifier without hand labels: a label model over heuristics, then a hashed linear scorer.

Heuristic labellers vote clean, junk or not at all.  Votes overlap and err, so their
accuracies are estimated by expectation-maximisation on the counts of vote patterns
over all documents.  The posteriors of the patterns are soft labels, on which a linear
scorer over hashed words and votes is trained; it judges all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from strataforge.llm.naming import others
from strataforge.llm.text_signals import ABSTAIN, LABELLERS, measures, votes
from strataforge.llm.workers import trimmed

#: Documents the scorer is fitted on, by the order of a hash of the id.
FIT_ROWS = 4096
SLOT_BITS = 12
SLOTS = 1 << SLOT_BITS
WIDTH = SLOTS + 3 * len(LABELLERS) + 1
#: Texts worked on at a time.
ROWS = 512
_POWERS = 3 ** np.arange(len(LABELLERS))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def pattern_counts(docs: DataFrame) -> list[tuple[int, int]]:
    """(vote pattern, documents) over all documents; at most 3^labellers rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(3 ** len(LABELLERS), dtype=np.int64)
        for batch in batches:
            for part in _parts(batch):
                code = votes(measures(part.column(0))[0]) @ _POWERS
                counts += np.bincount(code, minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["pattern", "n"])

    found = docs.select("text").mapInArrow(trimmed(run), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    return [(r["pattern"], r["n"]) for r in found.collect()]


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of junk for every pattern; P(vote | clean or junk, it votes) per labeller; share of junk.

    Not to vote says nothing, so a pattern without votes has the share as its posterior.

    Each labeller looks for one kind of junk, so the start takes it to miss most junk
    and to raise few false alarms, and 1 document in 10 to be junk.  A few
    pseudo-counts keep a labeller that hardly votes near its start.
    """
    vote = (patterns[:, None] // _POWERS) % 3
    weight = 4.0
    table = np.ones((2, len(LABELLERS), 3))
    table[0], table[1] = (0.98, 0.02, 1.0), (0.67, 0.33, 1.0)
    start, share = table.copy(), 0.1
    each = np.arange(len(LABELLERS))
    for _ in range(rounds):
        log = np.log(table[:, each, vote]).sum(axis=2)
        odds = log[1] - log[0] + np.log(share / (1 - share))
        post = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        for c, p in ((0, 1 - post), (1, post)):
            mass = (p * counts)[:, None, None] * (vote[:, :, None] == np.arange(3))
            table[c] = mass.sum(axis=0) + weight * start[c]
        table /= table[:, :, :ABSTAIN].sum(axis=2, keepdims=True)
        table[:, :, ABSTAIN] = 1.0
        share = float(((post * counts).sum() + 1) / (counts.sum() + 10))
    return post, table, share


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (text, column, value), the vote pattern and the number of words of each text."""
    found, words, firsts = measures(texts)
    vote = votes(found)
    n = len(vote)
    text = np.repeat(np.arange(n), np.diff(firsts))
    slot = (words >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    cell, times = np.unique(text * SLOTS + slot, return_counts=True)
    row, column = cell // SLOTS, cell % SLOTS
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(row, value * value, minlength=n))
    value = value / norm[row]
    own = np.arange(n)
    rows, columns, values = [row], [column], [value]
    for k in range(len(LABELLERS)):
        rows.append(own)
        columns.append(SLOTS + 3 * k + vote[:, k].astype(np.int64))
        values.append(np.ones(n))
    rows.append(own)
    columns.append(np.full(n, WIDTH - 1))
    values.append(np.ones(n))
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values), vote @ _POWERS, found["words"]


def fit_rows(docs: DataFrame, rows: int) -> list:
    """Packed features of the ``rows`` documents with the smallest hashes of their ids, one row per id."""
    chosen = docs.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                row, column, value, code, _ = features(part.column(0))
                order = np.argsort(row, kind="stable")
                ends = np.searchsorted(row[order], np.arange(part.num_rows + 1))
                column, value = column[order].astype(np.uint16), value[order].astype(np.float32)
                cut = list(zip(ends[:-1], ends[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(code, pa.int64()),
                        pa.array([column[a:b].tobytes() for a, b in cut], pa.binary()),
                        pa.array([value[a:b].tobytes() for a, b in cut], pa.binary()),
                    ],
                    names=["pattern", "columns", "values"],
                )

    # One row per chosen id, whatever order tasks end in: the text with the smallest hash.
    few = docs.join(F.broadcast(chosen), "id", "left_semi").groupBy("id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return few.select("text").mapInArrow(trimmed(run), "pattern long, columns binary, values binary").collect()


def train(packed: list, posterior: dict[int, float], rounds: int = 150, decay: float = 1e-3) -> np.ndarray:
    """Logistic regression on soft labels by accelerated gradient steps; deterministic."""
    packed = sorted(packed, key=lambda r: (r["pattern"], bytes(r["columns"]), bytes(r["values"])))
    column = [np.frombuffer(r["columns"], np.uint16) for r in packed]
    sizes = [len(c) for c in column]
    row = np.repeat(np.arange(len(packed)), sizes)
    column = np.concatenate([*column, np.zeros(0, np.uint16)]).astype(np.int64)
    value = np.concatenate([*(np.frombuffer(r["values"], np.float32) for r in packed), np.zeros(0, np.float32)]).astype(np.float64)
    target = np.array([posterior.get(r["pattern"], 0.5) for r in packed])
    weights = np.zeros(WIDTH)
    ahead, n = weights.copy(), max(len(packed), 1)
    step = 4.0 / (len(LABELLERS) + 2)
    for t in range(rounds):
        z = np.bincount(row, value * ahead[column], minlength=len(packed))
        gap = 1 / (1 + np.exp(-z)) - target
        slope = np.bincount(column, value * gap[row], minlength=WIDTH) / n + decay * ahead
        new = ahead - step * slope
        ahead, weights = new + t / (t + 3) * (new - weights), new
    return weights


def quality_scores(docs: DataFrame, id: str = "doc_id", text: str = "text", rows: int = FIT_ROWS, limit: float = 0.5) -> DataFrame:
    """Add ``junk_posterior`` (label model), ``junk_score`` (scorer) and ``kept`` (score below ``limit``).

    Texts without words (null or empty ones too) get score 1 and are not kept.  Very
    short texts get no votes and are judged by their words.  Repeated rows get the same
    scores, other columns stay (columns with the added names are replaced), and an
    empty table stays empty.  Fitted on at most ``rows`` ids; all else covers all rows.
    """
    added = ("junk_posterior", "junk_score", "kept")
    kept = others(docs.columns, added)
    slim = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    found = pattern_counts(slim)
    patterns = np.array([p for p, _ in found] or [int(ABSTAIN * _POWERS.sum())], dtype=np.int64)
    counts = np.array([n for _, n in found] or [0], dtype=np.float64)
    post, _, _ = label_model(patterns, counts)
    posterior = dict(zip(patterns.tolist(), post.tolist()))
    weights = train(fit_rows(slim, rows), posterior)
    shared = docs.sparkSession.sparkContext.broadcast((posterior, weights))
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType(
        [*source.schema.fields, StructField(added[0], DoubleType()), StructField(added[1], DoubleType()), StructField(added[2], BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posterior, weights = shared.value
        for batch in batches:
            for part in _parts(batch):
                row, column, value, code, n = features(part.column(kept.index(text)))
                z = np.bincount(row, value * weights[column], minlength=part.num_rows)
                score = np.where(n > 0, 1 / (1 + np.exp(-z)), 1.0)
                label = np.array([posterior.get(c, 0.5) for c in code.tolist()], dtype=np.float64)
                arrays = [*part.columns, pa.array(label), pa.array(score), pa.array(score < limit)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *added])

    return source.mapInArrow(trimmed(run), schema)
