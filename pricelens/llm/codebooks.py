"""Vector code compression: product codes from integer Lloyd rounds over two trees.

Components become integers floor(4096 x); vectors are cut into ``PARTS`` consecutive parts,
each with a codebook of ``ENTRIES`` entries that starts as the parts of the vectors with the
smallest vec_ids. Vectors are dealt into blocks. For each block and part position a balanced
tree halves the block's parts along the widest side of their box, down to leaves of some
``LEAF``; every node keeps its box and the count and component sums of its parts. The trees
don't depend on the codebook: they are written once and read by every round.

A round descends the parts' trees together with a tree over the entries. A pair of nodes is
dropped if the boxes' least distance exceeds the greatest distance to some other node of
entries; down at single entries, one goes if another is nearer (ties: has the lower index)
at every corner of the node's box. Where one entry is left, the node's cached sums are added
to it whole; parts of leaves that stay uncertain are compared with the entries left, in
integers. All bounds are integers, so pruning never changes a result. Tasks send sums per
(part, entry); the driver sees the new codebooks only, whose size doesn't depend on the rows.

Defined results: rows whose vector is null or has a null or non-finite component are left
out; null vec_ids come last in the choice of the first entries, ties of vec_id go by vector.
Vectors of different lengths have codebooks of their own; a length that 8 doesn't divide is
cut at floor(i * length / 8), an empty part has distance 0. Fewer rows than entries make
fewer entries. Components beyond +-2**24 (x beyond +-4096) are taken as that bound, so that
squared distances stay exact longs. Equal labels, nulls together, share their error, over
all lengths. Repeated rows count each. Extra columns are ignored.
"""

from __future__ import annotations

import pickle
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block and, about, parts of a leaf.
BLOCK, LEAF = 4096, 32
BOUND = 1 << 24


def cuts(size: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(size * i // parts, size * (i + 1) // parts) for i in range(parts)]


class Tree:
    """A balanced tree over rows of integers. ``order`` lists the rows so that a node's rows
    stand together; level k has 2**k nodes, ``levels[k]`` their first rows (and the end),
    boxes, counts and sums."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        n, depth = len(x), max(0, int(np.ceil(np.log2(max(1, len(x) / leaf)))))
        order, bounds = np.arange(n), np.array([0, n])
        self.levels = []
        for level in range(depth + 1):
            y = x[order]
            first = bounds[:-1]
            low, high = np.minimum.reduceat(y, first, axis=0), np.maximum.reduceat(y, first, axis=0)
            self.levels.append((bounds, low, high, np.diff(bounds), np.add.reduceat(y, first, axis=0)))
            if level == depth:
                break
            halves = [0]
            order = order.copy()
            for k in range(len(first)):
                a, b = bounds[k], bounds[k + 1]
                middle = (a + b) // 2
                if x.shape[1]:
                    rows = order[a:b]
                    side = int((high[k] - low[k]).argmax())
                    order[a:b] = rows[np.argpartition(x[rows, side], middle - a)]
                halves += [middle, b]
            bounds = np.array(halves)
        self.order, self.x = order, x[order]

    def __getstate__(self):
        return self.__dict__ | {"order": self.order.astype(np.int32), "x": self.x.astype(np.int32)}

    def __setstate__(self, state):
        self.__dict__ = state | {"order": state["order"].astype(np.int64), "x": state["x"].astype(np.int64)}


def entry_levels(entries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The tree over the entries, from one node to single entries: (node of each entry,
    nodes' low and high corners) of each level. Entries are halved along their widest side."""
    groups, out = [np.arange(len(entries))], []
    while True:
        owner = np.empty(len(entries), np.int64)
        for k, g in enumerate(groups):
            owner[g] = k
        out.append((owner, np.stack([entries[g].min(0) for g in groups]), np.stack([entries[g].max(0) for g in groups])))
        if all(len(g) == 1 for g in groups):
            return out
        split = []
        for g in groups:
            if len(g) == 1:
                split.append(g)
                continue
            side = int(np.ptp(entries[g], axis=0).argmax()) if entries.shape[1] else 0
            by = g[np.argsort(entries[g, side], kind="stable")] if entries.shape[1] else g
            split += [by[: len(by) // 2], by[len(by) // 2 :]]
        groups = split


def descend(tree: Tree, entries: np.ndarray):
    """Nodes that one entry owns whole, and rows of leaves with several entries left.

    Yields (level, nodes, entry of each) for the former, (None, nodes, entries allowed: a
    matrix of leaves by entries) for the latter, at the end."""
    levels, k = entry_levels(entries), len(entries)
    allowed, nodes = np.ones((1, k), bool), np.zeros(1, np.int64)
    # c is nearer than e where 2 x (e - c) < |e|^2 - |c|^2; equal counts if c < e
    step = entries[None, :, :] - entries[:, None, :]
    square = (entries * entries).sum(1)
    gap = square[None, :] - square[:, None] + (np.arange(k)[:, None] < np.arange(k)[None, :])
    up, down = np.maximum(step, 0), np.minimum(step, 0)
    depth = at = 0
    deepest, last = len(tree.levels) - 1, len(levels) - 1
    while len(nodes):
        _, low, high, _, _ = tree.levels[depth]
        low, high = low[nodes], high[nodes]
        owner, elow, ehigh = levels[at]
        open_ = np.stack([allowed[:, owner == g].any(1) for g in range(len(elow))], 1)
        near = np.maximum(np.maximum(elow[None] - high[:, None], low[:, None] - ehigh[None]), 0)
        far = np.maximum(np.abs(high[:, None] - elow[None]), np.abs(ehigh[None] - low[:, None]))
        near, far = (near * near).sum(2), (far * far).sum(2)
        limit = np.where(open_, far, np.iinfo(np.int64).max).min(1)
        allowed = allowed & (open_ & (near <= limit[:, None]))[:, owner]
        if at == last:
            # 2 x (e - c) at the corner of a node's box that is worst for c
            worst = 2 * (np.einsum("nd,ced->nce", high, up) + np.einsum("nd,ced->nce", low, down))
            allowed = allowed & ~((worst < gap[None]) & allowed[:, :, None]).any(1)
        single = allowed.sum(1) == 1
        if single.any():
            yield depth, nodes[single], allowed[single].argmax(1)
            nodes, allowed = nodes[~single], allowed[~single]
        if depth == deepest and at == last:
            break
        if depth < deepest:
            nodes, allowed = np.stack((2 * nodes, 2 * nodes + 1), 1).ravel(), np.repeat(allowed, 2, axis=0)
            depth += 1
        at = min(at + 1, last)
    yield None, nodes, allowed


def _uncertain(tree: Tree, nodes: np.ndarray, allowed: np.ndarray, entries: np.ndarray):
    """Rows of some leaves, and the nearest of each leaf's entries left for each."""
    bounds = tree.levels[-1][0]
    size = bounds[nodes + 1] - bounds[nodes]
    rows = np.repeat(bounds[nodes] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    x, at = tree.x[rows], np.repeat(np.arange(len(nodes)), size)
    best, who = np.full(len(rows), np.iinfo(np.int64).max), np.zeros(len(rows), np.int64)
    for e in range(len(entries)):
        some = np.flatnonzero(allowed[at, e])
        apart = x[some] - entries[e]
        apart = (apart * apart).sum(1)
        closer = apart < best[some]
        best[some[closer]], who[some[closer]] = apart[closer], e
    return rows, who


def sums(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and component sums of the rows nearest to each entry."""
    count, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    for level, nodes, who in descend(tree, entries):
        if level is not None:
            np.add.at(count, who, tree.levels[level][3][nodes])
            np.add.at(total, who, tree.levels[level][4][nodes])
        elif len(nodes):
            rows, nearest = _uncertain(tree, nodes, who, entries)
            count += np.bincount(nearest, minlength=len(entries))
            for e in np.unique(nearest):
                total[e] += tree.x[rows[nearest == e]].sum(0)
    return count, total


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row, in the rows' own order, and the squared distance."""
    out = np.empty(len(tree.order), np.int64)
    for level, nodes, who in descend(tree, entries):
        if level is not None:
            bounds = tree.levels[level][0]
            for a, b, e in zip(bounds[nodes], bounds[nodes + 1], who, strict=True):
                out[a:b] = e
        elif len(nodes):
            rows, nearest = _uncertain(tree, nodes, who, entries)
            out[rows] = nearest
    apart = tree.x - entries[out]
    back = np.empty(len(out), np.int64)
    back[tree.order] = np.arange(len(out))
    return out[back], (apart * apart).sum(1)[back]


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label (as text) and the integer components ``x`` of the rows that count."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    limit = F.lit(float(BOUND // SCALE))
    whole = F.transform("embedding", lambda v: F.floor(
        F.greatest(-limit, F.least(limit, v.cast("double"))) * SCALE).cast("int"))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.alias("x"))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """A row a block: its vec_ids, labels and the trees of its parts, pickled arrays."""
    def grow(batches):
        import pyarrow as pa

        for batch in batches:
            for k in range(0, len(batch), BLOCK):
                some = batch.slice(k, BLOCK)
                x = some.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(some), size)
                trees = [Tree(np.ascontiguousarray(x[:, a:b])) for a, b in cuts(size)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([some.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([some.column(1).to_pylist()], pa.list_(pa.string())),
                    pa.array([pickle.dumps(trees, pickle.HIGHEST_PROTOCOL)], pa.binary())], names=["vec_ids", "labels", "trees"])

    return rows.select("vec_id", "label", "x").mapInArrow(grow, "vec_ids array<long>, labels array<string>, trees binary")


def _rounds(blocks: DataFrame, books: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    for _ in range(rounds):
        given = blocks.sparkSession.sparkContext.broadcast(books)  # ENTRIES vectors at most

        def add(batches, given=given):
            import pyarrow as pa

            books = given.value
            count = [np.zeros(len(b), np.int64) for b in books]
            total = [np.zeros(b.shape, np.int64) for b in books]
            for batch in batches:
                for one in batch.column(0):
                    for p, tree in enumerate(pickle.loads(one.as_buffer())):
                        c, t = sums(tree, books[p])
                        count[p] += c
                        total[p] += t
            rows = [(p, e, -1, int(c[e])) for p, c in enumerate(count) for e in np.flatnonzero(c)]
            rows += [(p, e, d, int(total[p][e, d])) for p, e, k, _ in rows for d in range(books[p].shape[1])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
                    names=["part", "entry", "place", "n"])

        found = (blocks.select("trees").mapInArrow(add, "part int, entry int, place int, n long")
                 .groupBy("part", "entry", "place").agg(F.sum("n").alias("n")).collect())
        n = {(r["part"], r["entry"]): r["n"] for r in found if r["place"] < 0}
        books = [b.copy() for b in books]
        for r in found:
            if r["place"] >= 0:
                books[r["part"]][r["entry"], r["place"]] = r["n"] // n[r["part"], r["entry"]]
    return books


def _coded(rows: DataFrame, size: int, rounds: int, entries: int) -> DataFrame:
    chosen = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    first = np.array([r["x"] for r in chosen], np.int64).reshape(len(chosen), size)
    blocks = stored(_blocks(rows, size), "vector_blocks")
    books = _rounds(blocks, [first[:, a:b] for a, b in cuts(size)], rounds)
    text = ",".join(str(v) for b in books for v in b.ravel().tolist())
    given = blocks.sparkSession.sparkContext.broadcast(books)

    def code(batches):
        import pyarrow as pa

        for batch in batches:
            for ids, labels, trees in zip(*(batch.column(k) for k in range(3)), strict=True):
                found = [assign(tree, book) for tree, book in zip(pickle.loads(trees.as_buffer()), given.value, strict=True)]
                digits = np.stack([f[0] for f in found], 1).astype(np.uint8).tobytes().hex()
                codes = [digits[k : k + 2 * PARTS] for k in range(0, len(digits), 2 * PARTS)]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(codes, pa.string()),
                                                  pa.array(sum(f[1] for f in found), pa.int64())],
                                                 names=["vec_id", "label", "code", "error"])

    return (blocks.mapInArrow(code, "vec_id long, label string, code string, error long")
            .withColumn("codebooks_sha256", F.lit(sha256(text.encode()).hexdigest())))


def compress(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of the rows of ``vectors``
    (vec_id, embedding, label) that count; ``entries`` is 256 at most."""
    rows = kept(vectors)
    sizes = sorted(r["size"] for r in rows.select(F.size("x").alias("size")).distinct().collect())
    out = None
    for size in sizes:
        one = _coded(rows.where(F.size("x") == size), size, rounds, entries)
        out = one if out is None else out.unionByName(one)
    if out is None:
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    out = stored(out, "codes")
    # stored, so that Spark can split the shuffle of a label that many rows share
    errors = stored(out.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label_errors")
    return out.join(errors, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")
