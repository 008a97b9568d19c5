"""Exact top-k search by inner product, term at a time.

A dimension is a term.  All vectors are dealt evenly into strips and packed there into blocks
of postings: per dimension, the places in the block with a weight other than zero.  Queries are
packed as sparse rows, and each block of queries visits every strip.  For each term of a
query block its weights are scattered over the postings into a dense array of scores
(query x place); a partition picks the best places of a row, a merge over the blocks of a strip
and one over strips give the answer.  Nothing is skipped, so the search is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from strataforge.llm.fixed_point import floors, matrices, pack, sound, unpack, within_long
from strataforge.llm.workers import trimmed
from strataforge.sources.store import materialize

#: Vectors and components of a block, queries of a block, components and (at least) vectors of a strip.
BLOCK_ROWS, BLOCK_CELLS, QUERY_ROWS, STRIP_CELLS, STRIP_ROWS = 4096, 1 << 20, 128, 1 << 23, 1024

PACKED = "strip int, kind int, seq int, ids binary, ends binary, places binary, weights binary, top long"


def _packed(strip: int, kind: int, seq: int, ids: np.ndarray, numbers: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A block: ids, and for term t the places and weights from ends[t] to ends[t + 1]."""
    width = max((m.shape[1] for _, m in numbers), default=0)
    terms, places, weights = [], [], []
    for rows, m in numbers:
        t, r = np.nonzero(m.T)
        terms.append(t)
        places.append(rows[r])
        weights.append(m[r, t])
    term, place = np.concatenate(terms), np.concatenate(places)
    weight = np.concatenate(weights)
    order = np.lexsort((place, term))
    ends = np.searchsorted(term[order], np.arange(width + 1))
    top = max((abs(int(x)) for x in (weight.min(), weight.max())), default=0) if len(weight) else 0
    return pa.RecordBatch.from_arrays(
        [
            pa.array([strip], pa.int32()),
            pa.array([kind], pa.int32()),
            pa.array([seq], pa.int32()),
            pa.array([pack(ids)], pa.binary()),
            pa.array([pack(ends)], pa.binary()),
            pa.array([pack(place[order])], pa.binary()),
            pa.array([pack(weight[order])], pa.binary()),
            pa.array([within_long(top)], pa.int64()),
        ],
        names=["strip", "kind", "seq", "ids", "ends", "places", "weights", "top"],
    )


def _pack_rows(kind: int, most_rows: int, scale: int):
    """Blocks of the (id, vec) rows of a task, ids ascending inside a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            lo = 0
            while lo < batch.num_rows:
                cells = np.cumsum(sizes[lo : lo + most_rows], dtype=np.int64)
                hi = lo + max(1, int(np.searchsorted(cells, BLOCK_CELLS, "right")))
                ids = batch.column(0)[lo:hi].to_numpy(zero_copy_only=False).astype(np.int64)
                order = np.argsort(ids, kind="stable")
                place = np.empty(len(ids), np.int64)
                place[order] = np.arange(len(ids))
                numbers = [(place[rows], floors(m, scale)) for _, rows, m in matrices(batch.column(1)[lo:hi])]
                yield _packed(part, kind, seq, ids[order], numbers)
                lo, seq = hi, seq + 1

    return run


class _Block:
    def __init__(self, row: dict) -> None:
        self.ids, self.ends = unpack(row["ids"]), unpack(row["ends"])
        self.places, self.weights = unpack(row["places"]), unpack(row["weights"])
        self.top, self.n = row["top"], len(self.ids)

    def term(self, t: int) -> slice:
        return slice(self.ends[t], self.ends[t + 1])


def _scores(queries: _Block, block: _Block) -> np.ndarray:
    """The dense (query x place) array of scores."""
    terms = min(len(queries.ends), len(block.ends)) - 1
    most = queries.top * block.top * max(1, terms)
    # Places are ranked by score and place in one number, which has to fit too.
    kind = np.int32 if most < 1 << 31 else np.int64 if most * block.n < 1 << 62 else object
    scores = np.zeros((queries.n, block.n), dtype=kind)
    q_weights, weights = queries.weights.astype(kind), block.weights.astype(kind)
    for t in range(terms):
        q, p = queries.term(t), block.term(t)
        who, where = queries.places[q], block.places[p]
        if not len(who) or not len(where):
            continue
        gain = q_weights[q][:, None] * weights[p][None, :]
        if len(who) == queries.n and len(where) == block.n:
            scores += gain
        elif len(where) == block.n:
            scores[who] += gain
        else:
            scores[who[:, None], where[None, :]] += gain
    return scores


def _best(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k highest scores of each row (ties: the first places), and whether there are so many."""
    n = scores.shape[1]
    k = min(k, n)
    if scores.dtype == object:
        at = np.array([sorted(range(n), key=lambda j: (o[j], -int(r[j]), j))[:k] for r, o in zip(scores, own)], dtype=np.int64)
        at = at.reshape(len(scores), k)
    else:
        key = scores.astype(np.int64) * n + (n - 1 - np.arange(n))
        key[own] = np.iinfo(np.int64).min
        at = np.argpartition(key, n - k, axis=1)[:, n - k :]
    return at, ~np.take_along_axis(own, at, axis=1)


def _search(k: int):
    """Blocks of a strip come first, then blocks of queries; each query gets its best of the strip."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, blocks = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["strip"] != strip:
                    strip, blocks = row["strip"], []
                if row["kind"] == 0:
                    blocks.append(_Block(row))
                    continue
                queries = _Block(row)
                ids, scores, there = [], [], []
                for block in blocks:
                    all_scores = _scores(queries, block)
                    own = np.zeros(all_scores.shape, bool)
                    first, after = np.searchsorted(block.ids, queries.ids), np.searchsorted(block.ids, queries.ids, "right")
                    for q in np.flatnonzero(after > first):
                        own[q, first[q] : after[q]] = True
                    at, ok = _best(all_scores, own, k)
                    ids.append(block.ids[at])
                    picked = np.take_along_axis(all_scores, at, axis=1)
                    if picked.dtype == object:
                        picked = np.array([[within_long(x) for x in r] for r in picked], dtype=np.int64).reshape(at.shape)
                    scores.append(picked.astype(np.int64))
                    there.append(ok)
                if not blocks:
                    continue
                ids, scores, there = np.hstack(ids), np.hstack(scores), np.hstack(there)
                order = np.lexsort((ids, ~scores, ~there), axis=1)[:, :k]  # ~ turns the order of longs around
                take = lambda x: np.take_along_axis(x, order, axis=1)
                ids, scores, there = take(ids), take(scores), take(there)
                who = np.broadcast_to(queries.ids[:, None], ids.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who[there]), pa.array(ids[there]), pa.array(scores[there])], names=["query_id", "id", "score"]
                )

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` vectors with the highest scores for each query.

    Components become ``floor(scale * x)`` (a power of two); the score is the integer inner
    product, ties go to the smaller id, ranks start at 1.  A query gets every row but those
    with its own id, and fewer than ``k`` if there are fewer.

    Rows with a null id, a null vector or a null or non-finite component take no part.  A zero
    or empty vector scores 0 with everything; a shorter vector counts as if zeros followed.
    Of queries with the same id the smallest vector is taken; repeated rows among ``vectors``
    count each.  Scores beyond the range of a long are given, and ranked, as its ends.  Empty
    tables give an empty one.  Other columns don't matter.
    """
    if scale < 1 or scale & (scale - 1):
        raise ValueError("scale must be a power of two")
    spark = vectors.sparkSession
    usable = lambda df: df.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vec")
    ).where(F.col("id").isNotNull() & sound(F.col("vec")))
    rows, asked = usable(vectors), usable(queries).groupBy("id").agg(F.min("vec").alias("vec"))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("vec") + 1), F.lit(0)).alias("cells")).first()
    # A strip is held in a task's memory; small tables are still dealt over the cores.
    cores = spark.sparkContext.defaultParallelism
    strips = max(1, -(-size["cells"] // STRIP_CELLS), min(2 * cores, size["n"] // STRIP_ROWS))
    dealt = rows.repartition(strips).mapInArrow(trimmed(_pack_rows(0, BLOCK_ROWS, scale)), PACKED)
    blocks = materialize(dealt, "postings")
    packed = materialize(asked.mapInArrow(trimmed(_pack_rows(1, QUERY_ROWS, scale)), PACKED), "query-blocks")
    visits = packed.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    together = blocks.unionByName(visits).repartitionById(strips, F.col("strip")).sortWithinPartitions("strip", "kind", "seq")
    found = together.mapInArrow(trimmed(_search(k)), "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias(id), "score")
