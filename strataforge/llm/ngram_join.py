"""Jaccard self-join of documents on word n-grams, by prefix trees.

1. Every document becomes a set of 64-bit shingle hashes.  Equal sets are one class.
2. All shingles have one global order: those in crowded cells of a fixed-size count
   table come last, otherwise by hash.  Two sets can only reach the threshold if they
   share a shingle in their prefixes, the first 1 - t of each set.
3. Shingles found in two or more prefixes are buckets.  Buckets with the same members,
   or all of whose members meet in one larger bucket, are left out.
4. The prefixes of a bucket's members are stored in a trie.  A traversal adds up, for
   all of them at once, how much they share with the path so far; members that can't
   reach the threshold with what remains of the subtree and of the sets are dropped.
   Most chance meetings end here, before whole sets are moved.  Large buckets are
   split into blocks, and each pair of blocks is a group of its own.
5. The whole sets of those that are left go through the same trie, where sets already
   connected with all of a subtree are dropped as well.  Links found there are exact
   and become components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strataforge.functions.lookup import lookup, measure
from strataforge.llm.bytewords import NOT_SPACE, mix, shingle_hashes, text_bytes, word_hashes
from strataforge.llm.components import connected
from strataforge.llm.workers import trimmed
from strataforge.session import cut
from strataforge.sources.store import materialize

#: Cells of the count table (fixed size: 16 MB when broadcast), how many crowded ones count at most, and how many
#: cells a task may report by chance.
CELL_BITS, CROWDED, CHANCE = 24, 1 << 20, 1 << 15
#: Sets and shingles in one block of a bucket.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 20
#: Rows worked on at a time.
ROWS = 512


def document_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(texts)
    hashes, firsts = word_hashes(data, offsets, NOT_SPACE)
    shingles, owner = shingle_hashes(hashes, firsts, k)
    if len(owner) > 1 and (owner[1:] < owner[:-1]).any():
        order = np.argsort(owner, kind="stable")
        shingles, owner = shingles[order], owner[order]
    at = np.searchsorted(owner, np.arange(len(texts) + 1))
    for lo, hi in zip(at[:-1], at[1:]):
        s = np.sort(shingles[lo:hi])
        if len(s) > 1:
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        yield s


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def crowded_cells(docs: DataFrame, k: int) -> np.ndarray:
    """Order of magnitude of the counts of crowded cells of shingles, over all documents; 0 for the others.

    Every task counts its shingles in a table of 2^CELL_BITS cells and reports the
    cells that stand out.  This only decides in which order shingles are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, dtype=np.int32)
        for batch in batches:
            for part in _parts(batch):
                data, offsets = text_bytes(part.column(0))
                shingles, _ = shingle_hashes(*word_hashes(data, offsets, NOT_SPACE), k)
                np.add.at(cells, (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
        # The smallest count that chance alone gives to few cells of this load.
        load, bar = cells.sum() / len(cells), 2
        while len(cells) * (1 - sum(math.exp(-load) * load**k / math.factorial(k) for k in range(bar))) > CHANCE:
            bar += 1
        found = np.flatnonzero(cells >= bar)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(cells[found], pa.int64())], names=["cell", "n"])

    found = docs.select("text").mapInArrow(trimmed(run), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = found.where("n >= 4").orderBy(F.desc("n"), "cell").limit(CROWDED).toArrow()
    levels = np.zeros(1 << CELL_BITS, dtype=np.uint8)
    levels[rows["cell"].to_numpy()] = np.log2(rows["n"].to_numpy()).astype(np.uint8) + 1
    return levels


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def prints(docs: DataFrame, k: int, percent: int, levels) -> DataFrame:
    """(id, n, f1, f2, prefix): size and fingerprint of each set, and its prefix in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            for part in _parts(batch):
                n, f1, f2, prefixes = [], [], [], []
                for s in document_sets(part.column(1), k):
                    n.append(len(s))
                    f1.append(int(mix(s ^ np.uint64(0x51ED)).sum(dtype=np.uint64)) if len(s) else 0)
                    f2.append(int(mix(s * np.uint64(3) + np.uint64(0xA5)).sum(dtype=np.uint64)) if len(s) else 0)
                    short = len(s) - (percent * len(s) + 99) // 100 + 1 if len(s) else 0
                    rank = level[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                    prefixes.append((s[np.argsort(rank, kind="stable")] if rank.any() else s)[:short])
                flat = np.concatenate([*prefixes, np.zeros(0, np.uint64)])
                ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(n, pa.int64()), _signed(np.array(f1, np.uint64)), _signed(np.array(f2, np.uint64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(flat)),
                    ],
                    names=["id", "n", "f1", "f2", "prefix"],
                )

    return docs.select("id", "text").mapInArrow(trimmed(run), "id long, n long, f1 long, f2 long, prefix array<long>")


def _shared(tokens: DataFrame) -> DataFrame:
    """The rows whose token more than one set has.

    Rows are range-partitioned and sorted by token and set, so a token that many sets
    have spans tasks, and neighbours tell which rows are alone.  Where a run may go on
    in the next task, its row is kept to be safe.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row of the batch before waits for the next one.
        waiting, before, first = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
            token = batch.column(0).to_numpy()
            same = token[1:] == token[:-1]
            keep = np.zeros(len(token), dtype=bool)
            keep[1:] = same
            keep[:-1] |= same
            if first:
                keep |= token == token[0]
            elif before is not None:
                keep[0] |= token[0] == before
            first = False
            if len(token) > 1:
                before = token[-2]
                yield batch.slice(0, len(token) - 1).filter(pa.array(keep[:-1]))
            waiting = batch.slice(len(token) - 1)
        if waiting is not None:
            yield waiting

    dealt = tokens.repartitionByRange("token", "rep").sortWithinPartitions("token", "rep")
    return dealt.mapInArrow(trimmed(run), tokens.schema)


def _buckets(reps: DataFrame, percent: int) -> DataFrame:
    """(token, rep, n, blocks): members of the buckets whose pairs no other bucket covers.

    A bucket holds sets of one shared token whose sizes allow a link: size classes are
    as wide as linked sizes may differ, and each set is in its own and the next class.
    The smaller one of two linked sets has their first shared token among its first
    n - 2t/(1+t) n + 1 ones, so a bucket without such a set is left out.
    """
    tokens = reps.select("rep", "n", F.posexplode("prefix").alias("at", "token"))
    early = F.col("at") < F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent) - 1e-9) + 1
    shared = cut(_shared(tokens.select("token", "rep", "n", early.alias("early"))))
    # A little wider than exact, for the rounding of logarithms.
    size_class = F.floor(F.log("n") / F.lit(-math.log(percent / 100) * (1 + 1e-9) if percent < 100 else 1e-9)).cast("long")
    classed = shared.select("*", F.explode(F.array(size_class, size_class + 1)).alias("class"))
    classed = classed.select(F.xxhash64("token", "class").alias("token"), "rep", "n", "early")
    hashed = [F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("y")]
    groups = classed.groupBy("token").agg(F.count("*").alias("c"), F.sum("n").alias("size"), F.max("early").alias("early"), *hashed)
    groups = groups.where("c > 1 and early")
    unique = groups.groupBy("c", "x", "y").agg(F.min("token").alias("token"), F.first("size").alias("size"))
    members = cut(classed.drop("early").join(unique.select("token", "c", "size"), "token"))
    best = members.groupBy("rep").agg(F.max(F.struct("c", "token")).alias("best"))
    own = F.struct("c", "token")
    covered = (
        members.join(best, "rep")
        .groupBy("token")
        .agg(F.min("best").alias("one"), F.max("best").alias("other"), F.first(own).alias("own"))
        .where("one = other and own != one")
    )
    left = members.join(covered.select("token"), "token", "left_anti")
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
    return cut(left.select("token", "rep", "n", blocks.alias("blocks")))


def _block_pairs(members: DataFrame) -> DataFrame:
    """Each member once for every pair of blocks that its block is in; ``side`` 0 and 1 are compared, 2 is both."""
    block = F.pmod(F.xxhash64("rep", "token"), F.col("blocks")).cast("int")
    each = members.select("token", "rep", block.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return each.select("token", "rep", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"))


def _groups(met: DataFrame) -> DataFrame:
    """(token, i, j, side, rep) for the comparison of whole sets: each set once with all it may be linked with.

    ``met`` has, for each group of the prefix comparison, the sets that are left and a
    root each, which may-be links connect it with.  Connected sets form a cell.  The
    sets of a cell that is too large for one group stay in the groups where they met.
    """
    cells = connected(met.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    sizes = met.select("rep", "n").distinct().join(cells, "rep")
    fits = (F.count("*") <= BLOCK_SETS) & (F.sum("n") <= BLOCK_SHINGLES)
    cells = cut(sizes.join(sizes.groupBy("component").agg(fits.alias("fits")), "component").select("rep", "component", "fits"))
    none = F.lit(-1)
    small = cells.where("fits").select(
        F.col("component").alias("token"), none.alias("i"), none.alias("j"), F.lit(2).alias("side"), "rep"
    )
    large = met.join(cells.where("not fits").select("rep"), "rep").select("token", "i", "j", "side", "rep")
    return cut(small.unionByName(large))


class _Links:
    """Labels of sets that are already connected, and the links that connected them."""

    def __init__(self, n: int) -> None:
        self.label, self.links = np.arange(n), []

    def add(self, y: int, xs: np.ndarray) -> None:
        own = self.label[y]
        others, at = np.unique(self.label[xs], return_index=True)
        for o, x in zip(others, xs[at]):
            if o != own:
                self.links.append((y, int(x)))
        self.label[np.isin(self.label, others)] = own


class _Trie:
    """Sorted paths of some stored sets, and which probes hold each token.

    Tokens of one set only can't be shared and are left out; the others are numbered
    from the most frequent on, so that paths are shared as far as can be.
    """

    def __init__(self, sets: list[np.ndarray], probes: np.ndarray, stored: np.ndarray) -> None:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, token, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(counts), dtype=np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
        common = counts[token] > 1
        token, owner = rank[token[common]], owner[common]
        order = np.lexsort((token, owner))
        token, owner = token[order], owner[order]
        at = np.searchsorted(owner, np.arange(len(sets) + 1))
        self.length = np.diff(at)
        probe_of = np.full(len(sets), -1)
        probe_of[probes] = np.arange(len(probes))
        held = probe_of[owner] >= 0
        by_token = np.argsort(token[held], kind="stable")
        self.post, post_token = probe_of[owner[held]][by_token], token[held][by_token]
        self.starts = np.searchsorted(post_token, np.arange((int(token.max()) + 1 if len(token) else 0) + 1))
        self.n_probes = len(probes)
        paths = [token[at[i] : at[i + 1]] for i in stored]
        by_path = sorted(range(len(stored)), key=lambda i: paths[i].tolist())
        self.leaves, self.paths = stored[by_path], [paths[i] for i in by_path]

    def edge(self, lo: int, hi: int, d: int) -> np.ndarray:
        """Tokens after depth ``d`` that all paths lo..hi share."""
        first, last = self.paths[lo], self.paths[hi - 1]
        m = min(len(first), len(last))
        differ = np.flatnonzero(first[d:m] != last[d:m])
        return first[d : d + int(differ[0])] if len(differ) else first[d:m]

    def holders(self, edge: np.ndarray) -> np.ndarray:
        """For each probe, how many of the edge's tokens it holds."""
        sizes = self.starts[edge + 1] - self.starts[edge]
        take = np.arange(int(sizes.sum())) + np.repeat(self.starts[edge] - (np.cumsum(sizes) - sizes), sizes)
        return np.bincount(self.post[take], minlength=self.n_probes)


def _traverse(trie: _Trie, probes: np.ndarray, n: np.ndarray, unseen: np.ndarray, percent: int, done, leaf) -> None:
    """Call ``leaf(set, probes still alive, tokens shared)`` for every stored set that some probe may reach.

    ``n``: sizes of the whole sets; ``unseen``: how many of each set's tokens the trie
    doesn't hold.  ``done(lo, hi, probes)`` marks probes that needn't go on.
    """
    leaves = trie.leaves
    size, depth, hidden = n[leaves], trie.length[leaves], unseen[leaves]
    n_probe, left, behind = n[probes], trie.length[probes], unseen[probes]
    todo = [(0, len(leaves), 0, np.arange(len(probes)), np.zeros(len(probes), dtype=np.int64))]
    while todo:
        lo, hi, d, alive, shared = todo.pop()
        # What the rest of the subtree's paths and the tokens beyond the trie can add at most.
        rest = np.minimum(int(depth[lo:hi].max()) - d, left[alive] - shared)
        rest = rest + np.maximum(int(hidden[lo:hi].max()), behind[alive])
        can = (100 + percent) * (shared + rest) >= percent * (n_probe[alive] + int(size[lo:hi].min()))
        can &= ~done(lo, hi, probes[alive])
        alive, shared = alive[can], shared[can]
        if not len(alive):
            continue
        edge = trie.edge(lo, hi, d)
        if len(edge):
            shared = shared + trie.holders(edge)[alive]
        end = d + len(edge)
        while lo < hi and depth[lo] == end:
            leaf(int(leaves[lo]), probes[alive], shared)
            lo += 1
        while lo < hi:
            step, stop = trie.paths[lo][end], lo + 1
            while stop < hi and trie.paths[stop][end] == step:
                stop += 1
            todo.append((lo, stop, end, alive, shared))
            lo = stop


def trie_links(sets: list[np.ndarray], probes: np.ndarray, stored: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between probes and stored sets, enough to connect all that are linked.

    100 * shared >= percent * union is a link.
    """
    found, trie = _Links(len(sets)), _Trie(sets, probes, stored)
    n = np.array([len(s) for s in sets], dtype=np.int64)

    def done(lo: int, hi: int, xs: np.ndarray) -> np.ndarray:
        labels = found.label[trie.leaves[lo:hi]]
        return (labels == labels[0]).all() & (found.label[xs] == labels[0])

    def leaf(y: int, xs: np.ndarray, shared: np.ndarray) -> None:
        hit = xs[((100 + percent) * shared >= percent * (n[xs] + n[y])) & (xs != y)]
        found.add(y, hit)

    _traverse(trie, probes, n, np.zeros_like(n), percent, done, leaf)
    return found.links


def prefix_survivors(
    prefixes: list[np.ndarray], n: np.ndarray, places: list[np.ndarray], probes: np.ndarray, stored: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the sets that some other one may still be linked with, as far as prefixes can tell, and their roots.

    Sets connected by links that may be have one root.  ``places``: the rising places of each prefix's tokens in the global order.  Up to
    the earlier of two prefixes' ends both sets are known; beyond it neither can add
    more than it has left there.
    """
    trie = _Trie(prefixes, probes, stored)
    size = np.array([len(p) for p in prefixes], dtype=np.int64)
    unseen = n - size
    stays, maybe = np.zeros(len(n), dtype=bool), _Links(len(n))
    last = np.array([p[-1] for p in places], dtype=np.int64)
    width = int(last.max()) + 1
    starts = np.cumsum(size) - size
    flat = np.concatenate([p + i * width for i, p in enumerate(places)])

    def before(xs: np.ndarray, place) -> np.ndarray:
        """How many of each set's prefix tokens stand at ``place`` or earlier."""
        return np.searchsorted(flat, xs * width + place, "right") - starts[xs]

    def leaf(y: int, xs: np.ndarray, shared: np.ndarray) -> None:
        end = np.minimum(last[xs], last[y])
        more = np.minimum(n[xs] - before(xs, end), n[y] - before(np.full(len(xs), y), end))
        hit = ((100 + percent) * (shared + more) >= percent * (n[xs] + n[y])) & (xs != y)
        if hit.any():
            stays[xs[hit]] = True
            stays[y] = True
            maybe.add(y, xs[hit])

    _traverse(trie, probes, n, unseen, percent, lambda lo, hi, xs: np.zeros(len(xs), dtype=bool), leaf)
    return stays, maybe.label


def _distinct(group: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """The group's members, each once, with ids, probes and stored ones."""
    ids, first = np.unique(group.column("rep").to_numpy(), return_index=True)
    group = group.take(pa.array(first))
    side = group.column("side").to_numpy()
    return group, ids, np.flatnonzero(side != 1), np.flatnonzero(side != 0)


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes as the upper halves of their hashes, packed."""
    for batch in batches:
        listed = batch.column(2)
        flat = (listed.values.to_numpy().view(np.uint64) >> np.uint64(32)).astype(np.uint32)
        ends = listed.offsets.to_numpy()
        packed = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["rep", "n", "prefix"])


def _group_survivors(percent: int, levels):
    def run(group: pa.Table) -> pa.Table:
        group, ids, probes, stored = _distinct(group)
        prefixes = [np.frombuffer(b, dtype=np.uint32) for b in group.column("prefix").to_pylist()]
        flat = np.concatenate(prefixes)
        level = levels.value[(flat >> np.uint32(32 - CELL_BITS)).astype(np.int64)]
        order = np.lexsort((flat, level))
        # Equal tokens have one place.
        place = np.empty(len(flat), dtype=np.int64)
        place[order] = np.cumsum(np.concatenate([[False], flat[order][1:] != flat[order][:-1]]))
        places = np.split(place, np.cumsum([len(p) for p in prefixes])[:-1])
        n = group.column("n").to_numpy()
        stays, label = np.zeros(len(ids), dtype=bool), np.arange(len(ids))
        if len(probes) and len(stored):
            stays, label = prefix_survivors(prefixes, n, places, probes, stored, percent)
        out = group.select(["token", "rep", "n", "i", "j", "side"]).append_column("root", pa.array(ids[label], pa.int64()))
        return out.filter(pa.array(stays))

    return run


def _group_links(percent: int):
    def run(group: pa.Table) -> pa.Table:
        group, ids, probes, stored = _distinct(group)
        sets = [np.frombuffer(b, dtype=np.uint64) for b in group.column("set").to_pylist()]
        links = trie_links(sets, probes, stored, percent) if len(probes) and len(stored) else []
        a, b = (ids[[x[i] for x in links]] if links else np.zeros(0, np.int64) for i in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def ngram_components(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``.

    Words are runs of non-blank characters with A-Z in lower case.  A document's set
    are its distinct runs of ``k`` words; with 1 to k - 1 words, all its words as
    one.  Documents whose sets have ``100 * shared >= percent * union`` are linked;
    a component is the smallest id that links lead to.

    Documents without words (null or empty texts) have 0 shingles and are linked with
    nothing.  Rows with the same id are one document.  Rows with a null id belong to
    no component.  Repeated rows repeat; an empty table gives an empty one.  Hashes
    have 64 bits: sets of two documents that are compared differ from the words
    themselves with a chance of about (shingles of both)^2 / 2^64.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    levels = spark.sparkContext.broadcast(crowded_cells(slim, k))
    printed = materialize(prints(slim, k, percent, levels), "ngram-prints")
    known = printed.where("n > 0 and id is not null")
    classes = cut(
        known.groupBy("n", "f1", "f2").agg(
            F.min("id").alias("rep"), F.min_by("prefix", "id").alias("prefix"), F.count("*").alias("copies")
        )
    )
    members = _buckets(classes.select("rep", "n", "prefix"), percent)
    # Half of each hash is enough to tell who can't be linked; more matches than there are only let more sets through.
    halves = classes.select("rep", "n", "prefix").join(members.select("rep").distinct(), "rep", "left_semi")
    halves = halves.mapInArrow(trimmed(_halved), "rep long, n long, prefix binary")
    met = _block_pairs(members).join(halves, "rep").groupBy("token", "i", "j")
    schema = "token long, rep long, n long, i int, j int, side int, root long"
    left = _groups(cut(met.applyInArrow(_group_survivors(percent, levels), schema)))

    wanted = cut(left.select(F.col("rep").alias("id")).distinct())
    side = F.broadcast(wanted) if measure(wanted).fits() else wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                sets = [s.tobytes() for s in document_sets(part.column(1), k)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(len, sets), pa.int64()), pa.array(sets, pa.binary())], names=["rep", "bytes", "set"]
                )

    sets = slim.join(side, "id", "left_semi").select("id", "text").mapInArrow(trimmed(run), "rep long, bytes long, set binary")
    grouped = left.join(sets, "rep").groupBy("token", "i", "j")
    links = grouped.applyInArrow(_group_links(percent), "a long, b long")
    component = connected(links).withColumnRenamed("id", "rep")
    named = classes.select("n", "f1", "f2", "rep", "copies").join(component, "rep", "left")
    table = named.select("n", "f1", "f2", F.coalesce("component", "rep").alias("component"), "copies")
    out = lookup(printed.select("id", "n", "f1", "f2"), table, ["n", "f1", "f2"], weight="copies")
    of_id = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), of_id.alias("component_id"))
