"""Near-duplicate vectors by cosine, over PCA-ordered tiles.

Vectors of one length are rotated so that directions with most variance come first, ordered by
the first of them and cut into tiles.  A tile travels as the leading coordinates of its vectors
with the norms of what remains.  Tiles are dealt into strips and strips meet in squares, so a
tile is sent to as many squares as there are strips, not to every other tile.

Two tiles are compared only if their boxes are close enough.  The dot product is then added up over
leading dimensions; what the others can add is at most the product of the norms of both remainders,
so a pair is given up as soon as that can't reach the threshold.  Only vectors that keep some
partner in another tile go on: their whole vectors meet tile by tile and are compared exactly.
Such a meeting returns counts and a spanning set of links, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from strataforge.functions.lookup import Size, lookup
from strataforge.functions.matrices import tree_merge
from strataforge.functions.ordering import positions
from strataforge.llm.components import connected
from strataforge.llm.fixed_point import matrices, sound
from strataforge.llm.workers import trimmed
from strataforge.session import cut
from strataforge.sources.store import materialize

#: Vectors in a tile, rows of a tile compared at a time, leading dimensions after which bounds are tested.
TILE, BAND, STEPS = 4096, 512, (16, 32)
#: Tiles of a strip at most (a task holds the leading coordinates of one), and tasks at most.
STRIP, TASKS = 128, 4096
#: Slack of the bounds, which are computed in single precision, and of double products before the exact test.
SLACK, CLOSE = 1e-4, 1e-9


def _unit(m: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps squares of tiny and huge numbers finite.
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _steps(d: int) -> list[int]:
    return sorted({min(s, d) for s in STEPS})


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per length the directions of the vectors' second moments over all rows, the largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, m in matrices(batch.column(0)):
                u = _unit(m)
                total[d] = total.get(d, 0) + u.T @ u
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(total), pa.int32()),
                pa.array(list(total), pa.int32()),
                pa.array([m.tobytes() for m in total.values()], pa.binary()),
            ],
            names=["part", "g", "m"],
        )

    def merge(parts: list[bytes]) -> bytes:
        return sum(np.frombuffer(p) for p in parts).tobytes()

    out = {}
    for d, sums in tree_merge(vectors.select("vec").mapInArrow(trimmed(run), "part int, g int, m binary"), merge).items():
        values, directions = np.linalg.eigh(np.frombuffer(sums).reshape(d, d))
        out[d] = directions[:, np.argsort(-values)]
    return out


class _Tile:
    """The leading coordinates of a tile's vectors, the norms of what remains, and its box."""

    def __init__(self, row: dict) -> None:
        steps = _steps(row["d"])
        self.number = row["tile"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        n = len(self.ids)
        self.lead = np.frombuffer(row["lead"], dtype=np.float32).reshape(n, steps[-1])
        self.rest = np.frombuffer(row["rest"], dtype=np.float32).reshape(n, len(steps))
        self.low, self.high = self.lead.min(axis=0), self.lead.max(axis=0)

    def far(self, other: _Tile, reach: float) -> bool:
        gap = np.maximum(np.maximum(self.low - other.high, other.low - self.high), 0).astype(np.float64)
        return float(gap @ gap) > reach * reach


def _partners(a: _Tile, b: _Tile, steps: list[int], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of each tile have a row of the other that the bounds can't rule out."""
    m = steps[0]
    has_a, has_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    right = np.hstack([b.lead[:, :m], b.rest[:, :1]])
    for lo in range(0, len(a.ids), BAND):
        left = np.hstack([a.lead[lo : lo + BAND, :m], a.rest[lo : lo + BAND, :1]])
        i, j = np.nonzero(left @ right.T >= threshold - SLACK)
        i += lo
        if a.number == b.number:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 << 17):
            x, y = i[at : at + (1 << 17)], j[at : at + (1 << 17)]
            dots = (a.lead[x, :m] * b.lead[y, :m]).sum(axis=1)
            for k in range(1, len(steps)):
                dots = dots + (a.lead[x, steps[k - 1] : steps[k]] * b.lead[y, steps[k - 1] : steps[k]]).sum(axis=1)
                can = dots + a.rest[x, k] * b.rest[y, k] >= threshold - SLACK
                x, y, dots = x[can], y[can], dots[can]
            has_a[x] = True
            has_b[y] = True
    return has_a, has_b


def _survivors(threshold: float, reach: float):
    """(d, i, j, tile, id) of the vectors with a partner left; tiles of strip a come first, those of b visit them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if (row["d"], row["a"], row["b"]) != key:
                    key, held = (row["d"], row["a"], row["b"]), []
                tile = _Tile(row)
                if row["kind"] == 0:
                    held.append(tile)
                    continue
                for other in held:
                    if other.number > tile.number or other.far(tile, reach):
                        continue
                    mine, its = _partners(other, tile, _steps(row["d"]), threshold)
                    same = other.number == tile.number
                    sides = [(other, mine | its)] if same else [(other, mine), (tile, its)]
                    ids = np.concatenate([t.ids[some] for t, some in sides])
                    if not len(ids):
                        continue
                    where = np.concatenate([np.full(int(some.sum()), t.number) for t, some in sides])
                    full = lambda x, kind: pa.array(np.full(len(ids), x), kind)  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays(
                        [full(row["d"], pa.int32()), full(other.number, pa.int64()), full(tile.number, pa.int64()), pa.array(where, pa.int64()), pa.array(ids)],
                        names=["d", "i", "j", "tile", "id"],
                    )

    return run


def _meet(threshold: float):
    """Counts and a spanning set of links among the vectors that two tiles still have to compare."""

    def side(rows: pa.Table, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = rows.sort_by("id").combine_chunks()
        vectors = rows.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
        return rows.column("id").to_numpy(), rows.column("copies").to_numpy(), _unit(vectors) if len(vectors) else vectors

    def run(group: pa.Table) -> pa.Table:
        d, i, j = (group.column(c)[0].as_py() for c in ("d", "i", "j"))
        tile = group.column("tile").to_numpy()
        own = i == j
        a_ids, a_copies, a = side(group.filter(pa.array(tile == i)), d)
        b_ids, b_copies, b = (a_ids, a_copies, a) if own else side(group.filter(pa.array(tile == j)), d)
        links_a, links_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        ids = a_ids if own else np.concatenate([a_ids, b_ids])
        shift = 0 if own else len(a_ids)
        label = np.arange(len(ids))
        edges: list[tuple[int, int]] = []
        for lo in range(0, len(a_ids), BAND):
            x, y = np.nonzero(a[lo : lo + BAND] @ b.T >= threshold - CLOSE)
            x += lo
            keep = x != y if own else np.ones(len(x), bool)
            x, y = x[keep], y[keep]
            exact = np.concatenate(
                [np.zeros(0, bool)]
                + [np.einsum("ij,ij->i", a[x[k : k + (1 << 17)]], b[y[k : k + (1 << 17)]]) >= threshold for k in range(0, len(x), 1 << 17)]
            )
            x, y = x[exact], y[exact]
            np.add.at(links_a, x, b_copies[y])
            if not own:
                np.add.at(links_b, y, a_copies[x])
            y = y + shift
            for r in np.unique(x):
                near = y[np.searchsorted(x, r) : np.searchsorted(x, r, "right")]
                others, at = np.unique(label[near], return_index=True)
                new = others != label[r]
                edges += [(ids[r], ids[k]) for k in near[at[new]]]
                if new.any():
                    label[np.isin(label, others)] = label[r]
        counts = [(a_ids, links_a)] if own else [(a_ids, links_a), (b_ids, links_b)]
        who = np.concatenate([x[n > 0] for x, n in counts])
        many = np.concatenate([n[n > 0] for _, n in counts])
        e = np.array(edges, dtype=np.int64).reshape(-1, 2)
        return pa.table(
            {
                "kind": pa.array(np.concatenate([np.zeros(len(who)), np.ones(len(e))]), pa.int32()),
                "a": pa.array(np.concatenate([who, e[:, 0]]), pa.int64()),
                "b": pa.array(np.concatenate([many, e[:, 1]]), pa.int64()),
            }
        )

    return run


def tiles(classes: DataFrame) -> DataFrame:
    """One row per length and tile: ids, leading coordinates and norms of remainders."""
    turn = classes.sparkSession.sparkContext.broadcast(rotations(classes))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            along, sizes = np.empty(batch.num_rows), np.empty(batch.num_rows, np.int32)
            for d, rows, m in matrices(batch.column(1)):
                along[rows], sizes[rows] = _unit(m) @ turn.value[d][:, 0], d
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes), pa.array(along)], names=["rep", "vec", "d", "along"])

    placed = classes.select("rep", "vec").mapInArrow(trimmed(first), "rep long, vec array<double>, d int, along double")
    numbered = positions(placed, ["along", "rep"], ["d"]).withColumn("tile", F.floor((F.col("position") - 1) / TILE))

    def pack(group: pa.Table) -> pa.Table:
        d = group.column("d")[0].as_py()
        steps = _steps(d)
        vectors = group.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
        turned = _unit(vectors) @ turn.value[d]
        suffix = np.sqrt(np.maximum(0, np.cumsum((turned * turned)[:, ::-1], axis=1)[:, ::-1]))
        rest = np.stack([suffix[:, s] if s < d else np.zeros(len(turned)) for s in steps], axis=1)
        lead = turned[:, : steps[-1]]
        return pa.table(
            {
                "d": pa.array([d], pa.int32()),
                "tile": pa.array([group.column("tile")[0].as_py()], pa.int64()),
                "ids": pa.array([group.column("rep").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "lead": pa.array([lead.astype(np.float32).tobytes()], pa.binary()),
                "rest": pa.array([rest.astype(np.float32).tobytes()], pa.binary()),
            }
        )

    schema = "d int, tile long, ids binary, lead binary, rest binary"
    return materialize(numbered.select("d", "tile", "rep", "vec").groupBy("d", "tile").applyInArrow(pack, schema), "vector-tiles")


def _by_length(table: dict[int, int]) -> Column:
    found = F.lit(None).cast("long")
    for d, x in table.items():
        found = F.when(F.col("d") == d, F.lit(x).cast("long")).otherwise(found)
    return found


def squares(packed: DataFrame, sizes: dict[int, int]) -> tuple[DataFrame, int]:
    """Tiles dealt to the squares (a, b) of strips with a <= b, and the number of tasks.

    In a square the tiles of strip a are held (kind 0) and those of b visit them (kind 1).
    A strip has at most STRIP tiles; few tiles still make enough squares for the cores.
    """
    cores = packed.sparkSession.sparkContext.defaultParallelism
    width, strips, first, squares_ = {}, {}, {}, 0
    for d, n in sorted(sizes.items()):
        many = -(-n // TILE)
        wanted = max(-(-many // STRIP), min(many, math.isqrt(2 * cores - 1) + 1))
        width[d] = -(-many // wanted)
        strips[d] = -(-many // width[d])
        first[d] = squares_
        squares_ += strips[d] * (strips[d] + 1) // 2
    tasks = min(TASKS, squares_)
    strip = F.floor(F.col("tile") / _by_length(width))
    dealt = packed.withColumn("strip", strip).withColumn("last", _by_length(strips) - 1)
    held = dealt.withColumn("a", F.col("strip")).withColumn("b", F.explode(F.sequence("strip", "last"))).withColumn("kind", F.lit(0))
    visits = dealt.withColumn("b", F.col("strip")).withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), "strip"))).withColumn("kind", F.lit(1))
    both = held.unionByName(visits).drop("strip", "last")
    square = _by_length(first) + F.floor(F.col("b") * (F.col("b") + 1) / 2) + F.col("a")
    return both.withColumn("task", F.pmod(square, F.lit(tasks)).cast("int")), tasks


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Cosine in double precision, links at ``threshold`` or more.  ``n_links`` counts
    the other rows linked directly, ``component_id`` is the smallest id that links
    lead to, and ``kept`` is true for the row with that id.

    Vectors that are null, empty or zero or hold null or non-finite components link
    with nothing and stay by themselves.  Vectors are compared with those of their own length.
    Rows with a null id get no component.  Equal vectors are one class and are compared
    once.  Repeated rows count as copies of each other; an empty table gives an empty one.
    """
    # Adding zero makes -0.0 and 0.0 one key.
    vec = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), vec.alias("vec"))
    fit = F.col("id").isNotNull() & (F.size("vec") > 0) & sound(F.col("vec")) & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    alone = rows.where("not fit").select(
        F.col("id").alias(id), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
    )
    classes = cut(rows.where("fit").groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return alone
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    dealt, tasks = squares(tiles(classes), sizes)
    dealt = dealt.repartitionById(tasks, F.col("task")).drop("task").sortWithinPartitions("d", "a", "b", "kind", "tile")
    left = cut(dealt.mapInArrow(trimmed(_survivors(threshold, reach)), "d int, i long, j long, tile long, id long"))
    members = left.join(classes.withColumnRenamed("rep", "id"), "id")
    found = cut(members.groupBy("d", "i", "j").applyInArrow(_meet(threshold), "kind int, a long, b long"))
    counts = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
    component = connected(found.where("kind = 1").select("a", "b")).withColumnRenamed("id", "rep")
    table = classes.join(counts, "rep", "left").join(component, "rep", "left")
    table = table.select(
        "vec", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    size = Size(sum(sizes.values()), sum(n * (8 * d + 48) for d, n in sizes.items()))
    linked = lookup(rows.where("fit").select("id", "vec"), table, ["vec"], size=size)
    return linked.select(
        F.col("id").alias(id),
        F.col("n_links").cast("long").alias("n_links"),
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    ).unionByName(alone)
