"""Vectors as short codes: one codebook per part position, fitted by Lloyd rounds over two trees.

Vectors are packed once into blocks.  A block keeps, for every part position, its parts
in the order of a balanced k-d tree with the box and the sum of each leaf.  A round walks
this tree from the top, all nodes of a level at once, against a tree over the entries of
the codebook: a pair of nodes is given up where the least distance of its boxes is beyond
the largest distance to some other entry node.  A node that is left with one entry is
assigned whole, with its cached sum; parts in leaves with several entries left are compared
in integers.  All bounds are integers too, so pruning never changes an assignment.  What a
round moves is one small matrix of sums a task.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from strataforge.functions.lookup import lookup
from strataforge.functions.matrices import tree_merge
from strataforge.llm.fixed_point import LONG_MAX, floors, limit, matrices, pack, sound, unpack, within_long
from strataforge.llm.workers import trimmed
from strataforge.session import cut
from strataforge.sources.store import materialize

#: Vectors and components of a block at most, parts of a tree leaf at most.
BLOCK_ROWS, BLOCK_CELLS, LEAF = 8192, 1 << 21, 32


def _depth(n: int, leaf: int) -> int:
    """Halvings until no node holds more than ``leaf`` of ``n``."""
    depth = 0
    while -(-n // (1 << depth)) > leaf:
        depth += 1
    return depth


def _starts(n: int, level: int) -> np.ndarray:
    """First places of the nodes of a level; node i covers n*i/2^level to n*(i+1)/2^level."""
    return (n * np.arange(1 << level)) >> level


def _tree_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Places of the points in a balanced k-d tree: nodes are halved along their widest side."""
    n = len(points)
    order = np.arange(n)
    for level in range(_depth(n, leaf)):
        starts = _starts(n, level)
        sizes = np.diff(np.append(starts, n))
        inside = points[order]
        wide = np.argmax(np.maximum.reduceat(inside, starts) - np.minimum.reduceat(inside, starts), axis=1)
        key = inside[np.arange(n), np.repeat(wide, sizes)]
        order = order[np.lexsort((key, np.repeat(np.arange(len(starts)), sizes)))]
    return order


def _halved(leaves: np.ndarray, merge) -> list[np.ndarray]:
    """The levels of a tree from the top, given what its leaves hold."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(merge(levels[-1][0::2], levels[-1][1::2]))
    return levels[::-1]


@dataclass
class Parts:
    """The parts of a block at one position, in tree order, and what the tree's nodes hold."""

    order: np.ndarray
    points: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]

    @classmethod
    def read(cls, row: dict, width: int) -> Parts:
        points, order = unpack(row["points"], width), unpack(row["order"])
        if points.dtype == object:
            return cls(order, points, [], [], [])
        low, high, sums = (unpack(row[k], width) for k in ("low", "high", "sums"))
        return cls(order, points, _halved(low, np.minimum), _halved(high, np.maximum), _halved(sums, np.add))


def _leaf_columns(points: np.ndarray) -> dict[str, bytes]:
    if points.dtype == object:
        return {"order": pack(np.arange(len(points))), "points": pack(points), "low": b"", "high": b"", "sums": b""}
    order = _tree_order(points, LEAF)
    placed = points[order]
    starts = _starts(len(points), _depth(len(points), LEAF))
    return {
        "order": pack(order),
        "points": pack(placed),
        "low": pack(np.minimum.reduceat(placed, starts)),
        "high": pack(np.maximum.reduceat(placed, starts)),
        "sums": pack(np.add.reduceat(placed, starts)),
    }


@dataclass
class Assigned:
    """Entries of a block's parts in tree order, sums and counts by entry, and parts that came in whole nodes."""

    codes: np.ndarray
    sums: np.ndarray
    counts: np.ndarray
    whole: int


def _nearest(points: np.ndarray, book: np.ndarray, may: np.ndarray) -> np.ndarray:
    """The nearest entry among those that a part may have, the lowest index first."""
    far = (book * book).sum(axis=1)[None, :] - 2 * (points @ book.T)
    if far.dtype == object:
        return np.array([min(range(len(book)), key=lambda e: row[e]) for row in far], dtype=np.int64)
    return np.argmin(np.where(may, far, np.iinfo(np.int64).max), axis=1)


def assign(parts: Parts, book: np.ndarray) -> Assigned:
    """The nearest entry of each part, by squared distance and then by index."""
    n, k = len(parts.points), len(book)
    if parts.points.dtype == object or book.dtype == object:
        codes = _nearest(parts.points.astype(object), book.astype(object), np.ones((n, k), bool))
        sums = np.array([parts.points[codes == e].astype(object).sum(axis=0) for e in range(k)], dtype=object)
        return Assigned(codes, sums, np.bincount(codes, minlength=k), 0)
    turn = _tree_order(book, 1)
    entries = book[turn]
    # The entry tree from its root to single entries.
    steps = [_starts(k, level) for level in range(_depth(k, 1))] + [np.arange(k)]
    boxes = [(np.minimum.reduceat(entries, s), np.maximum.reduceat(entries, s), np.diff(np.append(s, k))) for s in steps]

    codes = np.empty(n, np.int64)
    sums, counts, whole = np.zeros_like(book), np.zeros(k, np.int64), 0
    nodes, alive = np.zeros(1, np.int64), np.ones((1, k), bool)
    last = len(parts.low) - 1
    for level in range(last + 1):
        low, high = parts.low[level][nodes][:, None, :], parts.high[level][nodes][:, None, :]
        for s, (e_low, e_high, sizes) in zip(steps, boxes):
            live = np.logical_or.reduceat(alive, s, axis=1)
            gap = np.maximum(np.maximum(e_low - high, low - e_high), 0)
            reach = np.maximum(np.abs(high - e_low), np.abs(e_high - low))
            bound = np.where(live, (reach * reach).sum(axis=2), np.iinfo(np.int64).max).min(axis=1)
            alive &= np.repeat((gap * gap).sum(axis=2) <= bound[:, None], sizes, axis=1)
        one = alive.sum(axis=1) == 1
        for node, e in zip(nodes[one], turn[np.argmax(alive[one], axis=1)]):
            a, b = (n * int(node)) >> level, (n * (int(node) + 1)) >> level
            codes[a:b] = e
            sums[e] += parts.sums[level][node]
            counts[e] += b - a
            whole += b - a
        nodes, alive = nodes[~one], alive[~one]
        if level < last:
            nodes, alive = (2 * nodes[:, None] + [0, 1]).ravel(), np.repeat(alive, 2, axis=0)
    if len(nodes):
        first, after = (n * nodes) >> last, (n * (nodes + 1)) >> last
        sizes = after - first
        rows = np.repeat(first - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
        may = np.empty_like(alive)
        may[:, turn] = alive
        found = _nearest(parts.points[rows], book, np.repeat(may, sizes, axis=0))
        codes[rows] = found
        for e in range(k):
            sums[e] += parts.points[rows[found == e]].sum(axis=0)
        counts += np.bincount(found, minlength=k)
    return Assigned(codes, sums, counts, whole)


def _blocks(rows: DataFrame, parts: int, scale: int) -> DataFrame:
    """One row per block: its ids and labels, and per part position the packed tree."""

    def block(d: int, ids: pa.Array, labels: pa.Array, values: np.ndarray) -> pa.RecordBatch:
        width = max(1, -(-d // parts))
        whole = np.zeros((len(values), width * parts))
        whole[:, :d] = values
        numbers = floors(whole, scale)
        trees = [_leaf_columns(numbers[:, j * width : (j + 1) * width]) for j in range(parts)]
        ends = pa.array([0, len(ids)], pa.int32())
        tree_type = pa.list_(pa.struct([(c, pa.binary()) for c in ("order", "points", "low", "high", "sums")]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d], pa.int32()),
                pa.ListArray.from_arrays(ends, ids),
                pa.ListArray.from_arrays(ends, labels),
                pa.array([trees], tree_type),
            ],
            names=["d", "ids", "labels", "trees"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        cells = 0

        def flush(d: int) -> Iterator[pa.RecordBatch]:
            ids, labels, values = zip(*held.pop(d))
            yield block(d, pa.concat_arrays(ids), pa.concat_arrays(labels), np.concatenate(values))

        for batch in batches:
            for d, at, values in matrices(batch.column(2)):
                most = max(1, min(BLOCK_ROWS, BLOCK_CELLS // max(1, d)))
                pick = pa.array(at)
                ids, labels = batch.column(0).take(pick), batch.column(1).take(pick)
                lo = 0
                while lo < len(at):
                    got = sum(len(x[0]) for x in held.get(d, []))
                    hi = min(len(at), lo + most - got)
                    held.setdefault(d, []).append((ids[lo:hi], labels[lo:hi], values[lo:hi].copy()))
                    cells += (hi - lo) * (d + 1)
                    if got + hi - lo == most:
                        cells -= most * (d + 1)
                        yield from flush(d)
                    lo = hi
            if cells > 2 * BLOCK_CELLS:  # many lengths, none of which fills a block
                for d in list(held):
                    yield from flush(d)
                cells = 0
        for d in list(held):
            yield from flush(d)

    tree = StructType([StructField(c, BinaryType()) for c in ("order", "points", "low", "high", "sums")])
    schema = StructType(
        [
            StructField("d", IntegerType()),
            StructField("ids", ArrayType(LongType())),
            StructField("labels", ArrayType(rows.schema["label"].dataType)),
            StructField("trees", ArrayType(tree)),
        ]
    )
    return materialize(rows.mapInArrow(trimmed(run), schema), "vector-blocks")


def _vectors(trees: list[dict], width: int) -> np.ndarray:
    """The whole vectors of a block, in the order of its ids."""
    out = []
    for row in trees:
        points, order = unpack(row["points"], width), unpack(row["order"])
        back = np.empty_like(points)
        back[order] = points
        out.append(back)
    kind = object if any(x.dtype == object for x in out) else np.int64
    return np.hstack([x.astype(kind) for x in out])


def _merged(blocks: DataFrame, each, merge) -> dict[int, list]:
    """What ``each(d, rows of blocks)`` gives a task for every vector length, merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                got = each(row)
                found[row["d"]] = merge([found[row["d"]], got]) if row["d"] in found else got
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(found), pa.int32()),
                pa.array(list(found), pa.int32()),
                pa.array([json.dumps(x).encode() for x in found.values()], pa.binary()),
            ],
            names=["part", "g", "m"],
        )

    parts = blocks.mapInArrow(trimmed(run), "part int, g int, m binary")
    joined = lambda many: json.dumps(merge([json.loads(m) for m in many])).encode()
    return {d: json.loads(m) for d, m in tree_merge(parts, joined).items()}


def _first_entries(blocks: DataFrame, parts: int, entries: int) -> dict[int, list]:
    """The vectors of the smallest ids (null ids last, equal ids by components), per vector length."""

    def smallest(rows: list) -> list:
        return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]

    def each(row: dict) -> list:
        width = max(1, -(-row["d"] // parts))
        ids = np.array([LONG_MAX if i is None else i for i in row["ids"]], dtype=np.int64)
        bar = np.partition(ids, entries - 1)[entries - 1] if len(ids) > entries else LONG_MAX
        at = np.flatnonzero(ids <= bar)
        vectors = _vectors(row["trees"], width)[at]
        return smallest([(row["ids"][i], [int(x) for x in v]) for i, v in zip(at, vectors)])

    return _merged(blocks.select("d", "ids", "trees"), each, lambda lists: smallest([r for rows in lists for r in rows]))


def _book(entries: list[list[int]], width: int) -> np.ndarray:
    """A codebook as long integers, or as Python's own where these are too large."""
    flat = [x for e in entries for x in e]
    exact = max(map(abs, flat), default=0) < limit(width)
    return np.array(entries, dtype=np.int64 if exact else object).reshape(len(entries), width)


@dataclass
class Codebooks:
    """Per vector length: entries by part position, as lists of integers."""

    parts: int
    books: dict[int, list[list[list[int]]]]

    def arrays(self, d: int) -> list[np.ndarray]:
        width = max(1, -(-d // self.parts))
        return [_book(entries, width) for entries in self.books[d]]

    def digest(self, d: int) -> str:
        numbers = ",".join(str(x) for entries in self.books[d] for e in entries for x in e)
        return hashlib.sha256(numbers.encode()).hexdigest()


def _round(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floor of its parts' mean."""

    def each(row: dict) -> list:
        width = max(1, -(-row["d"] // books.parts))
        out = []
        for tree, book in zip(row["trees"], books.arrays(row["d"])):
            got = assign(Parts.read(tree, width), book)
            out.append([[int(c), *map(int, s)] for c, s in zip(got.counts, got.sums)])
        return out

    def merge(many: list) -> list:
        return [[[sum(x) for x in zip(*entry)] for entry in zip(*part)] for part in zip(*many)]

    sums = _merged(blocks.select("d", "trees"), each, merge)
    new = {
        d: [
            [[s // e[0] for s in e[1:]] if e[0] else old for e, old in zip(part, olds)]
            for part, olds in zip(sums[d], books.books[d])
        ]
        for d in books.books
    }
    return Codebooks(books.parts, new)


def fit(blocks: DataFrame, parts: int, entries: int, rounds: int) -> Codebooks:
    first = _first_entries(blocks, parts, entries)
    start = {}
    for d, rows in first.items():
        width = max(1, -(-d // parts))
        start[d] = [[v[j * width : (j + 1) * width] for _, v in rows] for j in range(parts)]
    books = Codebooks(parts, start)
    for _ in range(rounds):
        books = _round(blocks, books)
    return books


def _encode(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, d, code, error) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                d, n = row.column(0)[0].as_py(), len(row.column(1)[0])
                width = max(1, -(-d // books.parts))
                codes, error = np.empty((n, books.parts), np.uint8), np.zeros(n, np.int64)
                for j, (tree, book) in enumerate(zip(row.column(3)[0].as_py(), books.arrays(d))):
                    parts = Parts.read(tree, width)
                    got = assign(parts, book).codes
                    off = parts.points - book[got]
                    off = (off * off).sum(axis=1)
                    error = error.astype(object) if off.dtype == object else error
                    codes[parts.order, j] = got
                    error[parts.order] += off
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column(1).flatten(),
                        row.column(2).flatten(),
                        pa.array(np.full(n, d, np.int32)),
                        pa.array([text[2 * books.parts * r : 2 * books.parts * (r + 1)] for r in range(n)], pa.string()),
                        pa.array([within_long(x) for x in error.tolist()], pa.int64()),
                    ],
                    names=["id", "label", "d", "code", "error"],
                )

    schema = StructType(
        [
            StructField("id", LongType()),
            StructField("label", blocks.schema["labels"].dataType.elementType),
            StructField("d", IntegerType()),
            StructField("code", StringType()),
            StructField("error", LongType()),
        ]
    )
    return blocks.mapInArrow(trimmed(run), schema)


def vector_codes(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every vector that is there and finite.

    Components become ``floor(scale * x)`` (a power of two), vectors are cut into ``parts``
    equal parts, each position gets a codebook of at most 256 ``entries``: first the parts of
    the smallest ids, then ``rounds`` times the floors of the means of the parts that are nearest
    to them.  An entry without parts stays.  ``code`` has two hex digits a part, ``error`` is
    the squared distance to the code, ``label_error`` its sum over the rows with the same label
    (nulls together) and ``codebooks_sha256`` the digest of all entries.

    Rows with a null vector or a null or non-finite component are left out; a zero vector
    is a vector.  Lengths that ``parts`` doesn't divide are padded with zeros at the end (an empty
    vector to one zero a part), and each vector length has codebooks of its own.  Null ids
    come after all others as first entries, equal ids are ordered by their components.  Repeated
    rows count each.  Numbers of any size are exact; an error beyond the range of a long is
    given as its largest value.  An empty table gives an empty one.  Other columns don't matter.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    if scale < 1 or scale & (scale - 1):
        raise ValueError("scale must be a power of two")
    rows = vectors.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vec")
    )
    blocks = _blocks(rows.where(sound(F.col("vec"))), parts, scale)
    books = fit(blocks, parts, entries, rounds)
    coded = cut(_encode(blocks, books))
    total = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    summed = lookup(coded, total, ["label"], null_safe=["label"])
    digests = F.lit(None).cast("string")
    for d in books.books:
        digests = F.when(F.col("d") == d, F.lit(books.digest(d))).otherwise(digests)
    return summed.select(
        F.col("id").alias(id),
        F.col("label").alias(label),
        "code",
        "error",
        F.least("label_error", F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"),
        digests.alias("codebooks_sha256"),
    )
