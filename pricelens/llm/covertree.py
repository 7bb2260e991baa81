"""Embedding near-duplicates: exact cosine pairs by dual traversal of cover trees.

Equal vectors are one point that counts as many. Unit vectors with a cosine of at least
``threshold`` lie within r = sqrt(2 - 2 threshold) of each other. A bounded sample gives
the upper levels of a cover tree, nested centres with halving radii; every point goes to
its nearest centre of the lowest level with at most ``CELLS`` centres, and pairs of cells
whose covering balls are further apart than r are dropped. Cells are dealt into blocks of
about ``BLOCK`` points by hash. Each block builds its own cover tree, levels of halving
radii down to ``FINEST``, with the covering radius of every node measured. For each pair of
blocks left, both trees are descended together: a pair of nodes further apart than r is
dropped, one whose points are all within r is counted and linked whole, any other is opened;
pairs of points are compared by their cosine in double precision.

Nothing is approximate. Where vectors have no cluster structure the bounds drop node pairs
only at the level of single points, and the work grows with the square of their number.

Defined results: a vector that is null, empty, zero, or has a null or non-finite component
links with nothing; vectors of different lengths don't link. A null vec_id counts as a
vector; a component's id is its smallest non-null vec_id. Rows that repeat are links of each
other. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, stored
from .components import components, local_stars

THRESHOLD = 0.95
#: Sampled points (about), cells (at most) and points of a block (about).
SAMPLE, CELLS, BLOCK = 4096, 256, 8192
COARSEST, FINEST = 1.0, 1 / 32
_EPS, _CHUNK = 1e-9, 1024


def unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


def net(x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres (row numbers) more than ``radius`` apart, and each row's centre within it."""
    centres: list[int] = []
    owner = np.empty(len(x), np.int64)
    for k in range(0, len(x), _CHUNK):
        rows = x[k : k + _CHUNK]
        best, at = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64)
        for c in range(0, len(centres), 4 * _CHUNK):
            some = np.array(centres[c : c + 4 * _CHUNK])
            d = distances(rows, x[some])
            near = d.argmin(1)
            closer = d[np.arange(len(rows)), near] < best
            best = np.where(closer, d[np.arange(len(rows)), near], best)
            at = np.where(closer, some[near], at)
        left = np.flatnonzero(best > radius)
        if len(left):
            d = distances(rows[left], rows[left])
            open_ = np.ones(len(left), bool)
            for i in range(len(left)):
                if open_[i]:
                    centres.append(k + left[i])
                    taken = open_ & (d[i] <= radius)
                    at[left[taken]] = k + left[i]
                    open_ &= ~taken
        owner[k : k + len(rows)] = at
    return np.array(centres, np.int64), owner


def cover(x: np.ndarray, coarsest: float = COARSEST, finest: float = FINEST) -> np.ndarray:
    """For each row of unit vectors the rows of its centres at levels of halving radii, a
    column a level; the rows of a centre at one level share their centre at the level above."""
    parts, radius, paths = [np.arange(len(x))], coarsest, []
    while radius >= finest:
        path, groups = np.empty(len(x), np.int64), []
        for rows in parts:
            if len(rows) == 1:
                path[rows] = rows
                groups.append(rows)
                continue
            _, owner = net(x[rows], radius)
            path[rows] = rows[owner]
            by = np.argsort(owner, kind="stable")
            groups += [rows[g] for g in np.split(by, np.flatnonzero(np.diff(owner[by])) + 1)]
        paths.append(path)
        parts, radius = groups, radius / 2
    return np.stack(paths, axis=1)


class CoverTree:
    """Nested levels over rows of unit vectors. ``levels[k]`` holds a node's centre row, its
    covering radius, its weight, and its children as a range of the next level's nodes; the
    last level's nodes are single points. ``paths`` is what ``cover`` returns."""

    def __init__(self, x: np.ndarray, weights: np.ndarray, paths: np.ndarray | None = None):
        paths = cover(x) if paths is None else paths
        paths = [*paths.T, np.arange(len(x))]
        # rows in an order in which each node's rows stand together at every level
        self.rows = np.lexsort(paths[::-1])
        self.x, self.weights, self.levels = x[self.rows], weights[self.rows], []
        starts = None
        for path in reversed(paths):
            p = path[self.rows]
            first = np.concatenate(([0], np.flatnonzero(np.diff(p)) + 1)) if len(p) else np.empty(0, np.int64)
            last = np.concatenate((first[1:], [len(p)])) if len(p) else first
            centre = x[p[first]]
            gap = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", self.x, np.repeat(centre, last - first, axis=0))))
            level = {"first": first, "last": last, "centre": centre,
                     "radius": np.maximum.reduceat(gap, first) if len(p) else gap,
                     "weight": np.add.reduceat(self.weights, first) if len(p) else self.weights,
                     "child": None if starts is None else np.searchsorted(starts, first),
                     "child_end": None if starts is None else np.searchsorted(starts, last)}
            level["radius"] = np.where(last - first > 1, level["radius"], 0.0)  # a lone row is its centre
            self.levels.insert(0, level)
            starts = first


def traverse(a: CoverTree, b: CoverTree, threshold: float, same: bool):
    """(weights linked to each row of a, to each of b, linked rows of a, of b); the links
    given are enough for the components. ``same``: a is b, and a row isn't its own link."""
    r = math.sqrt(2 - 2 * threshold)
    into_a, into_b = np.zeros(len(a.x)), np.zeros(len(b.x))
    links = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    top_a, top_b = a.levels[0], b.levels[0]
    found = [(np.empty(0, np.int64),) * 2]
    fa, fb = top_a["centre"].astype(np.float32), top_b["centre"].astype(np.float32)
    # single points, narrow and wide balls apart: a wide ball would loosen the bound for all
    kind = np.digitize(top_b["radius"], (1e-12, r))
    for group in (np.flatnonzero(kind == k) for k in range(3)):
        if not len(group):
            continue
        far = np.minimum(2.0, r + top_a["radius"] + top_b["radius"][group].max() + 1e-4)
        least = (1 - far * far / 2 - 1e-5).astype(np.float32)  # of a dot product, with room for single precision
        for k in range(0, len(fa), _CHUNK):
            i, j = np.nonzero(fa[k : k + _CHUNK] @ fb[group].T >= least[k : k + _CHUNK, None])
            i, j = i + k, group[j]
            found.append((i[i <= j], j[i <= j]) if same else (i, j))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    for depth, (la, lb) in enumerate(zip(a.levels, b.levels, strict=True)):
        if depth == len(a.levels) - 1:
            break
        d = np.empty(len(i))
        for k in range(0, len(i), 1 << 16):
            s = slice(k, k + (1 << 16))
            d[s] = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", la["centre"][i[s]], lb["centre"][j[s]])))
        reach = la["radius"][i] + lb["radius"][j]
        whole = d + reach <= r - _EPS
        for p, q in zip(i[whole].tolist(), j[whole].tolist(), strict=True):
            rp, rq = slice(la["first"][p], la["last"][p]), slice(lb["first"][q], lb["last"][q])
            into_a[rp] += lb["weight"][q]
            into_b[rq] += la["weight"][p]
            if same and p == q:
                into_b[rq] -= la["weight"][p]  # once only: every row to all of its node, itself left out below
            links.append((np.arange(rp.start, rp.stop), np.full(rp.stop - rp.start, rq.start)))
            links.append((np.full(rq.stop - rq.start, rp.start), np.arange(rq.start, rq.stop)))
            if same and p == q:
                into_a[rp] -= a.weights[rp]
        open_ = ~whole & (d - reach <= r + _EPS)
        i, j = i[open_], j[open_]
        na, nb = la["child_end"][i] - la["child"][i], lb["child_end"][j] - lb["child"][j]
        total = na * nb
        at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        wide = np.repeat(nb, total)
        i2 = np.repeat(la["child"][i], total) + at // wide
        j2 = np.repeat(lb["child"][j], total) + at % wide
        if same:
            keep = ~((np.repeat(i, total) == np.repeat(j, total)) & (i2 > j2))
            i2, j2 = i2[keep], j2[keep]
        i, j = i2, j2
    if same:
        i, j = i[i != j], j[i != j]
    near = np.zeros(len(i), bool)
    for k in range(0, len(i), 1 << 16):
        s = slice(k, k + (1 << 16))
        near[s] = np.einsum("ij,ij->i", a.x[i[s]], b.x[j[s]]) >= threshold
    i, j = i[near], j[near]
    np.add.at(into_a, i, b.weights[j])
    np.add.at(into_b, j, a.weights[i])
    links.append((i, j))
    return into_a, into_b, *(np.concatenate(x) for x in zip(*links, strict=True))


def _points(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their point or null, points: pid, vec, n, low, size)."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumn("good", good)
    points = rows.where("good").groupBy("embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
    points = stored(points.select(F.monotonically_increasing_id().alias("pid"), F.col("embedding").alias("vec"), "n", "low",
                                  F.size("embedding").alias("size")), "vectors")
    return rows, points


def _cells(points: DataFrame) -> np.ndarray:
    """Centres of the lowest level of a cover tree over a sample that has few enough."""
    x = unit(list(sampled(points, "vec", SAMPLE, points.count()).select("vec").toPandas()["vec"]))
    centres, radius = x[:1], COARSEST
    while radius >= FINEST:
        chosen, _ = net(x, radius)
        if len(chosen) > CELLS:
            break
        centres, radius = x[chosen], radius / 2
    return centres


def _pairs_of_length(points: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): links of points (n null) and weights linked to point a (b null)."""
    context = points.sparkSession.sparkContext
    centres = context.broadcast(_cells(points))  # CELLS vectors at most

    def place(batches):
        for batch in batches:
            if len(batch):
                d = distances(unit(list(batch["vec"])), centres.value)
                at = d.argmin(1)
                yield batch.assign(cell=at.astype(np.int32), away=d[np.arange(len(d)), at])

    placed = stored(points.select("pid", "vec", "n").mapInPandas(
        place, "pid long, vec " + points.schema["vec"].dataType.simpleString() + ", n long, cell int, away double"), "cells")
    seen = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).toPandas()
    cells = len(centres.value)
    count, radius = np.zeros(cells, np.int64), np.zeros(cells)
    count[seen["cell"]], radius[seen["cell"]] = seen["n"], seen["radius"]
    blocks = -(-count // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)))
    apart = distances(centres.value, centres.value) - radius[:, None] - radius[None, :]
    near = apart <= math.sqrt(2 - 2 * threshold) + _EPS
    plan = context.broadcast((blocks, first, near))

    vec = "vec " + points.schema["vec"].dataType.simpleString()

    def number(batches):
        blocks, first, _ = plan.value
        for batch in batches:
            cell = batch["cell"].to_numpy()
            part = batch["hash"].to_numpy().view(np.uint64) % blocks[cell].astype(np.uint64)
            yield batch.drop(columns="hash").assign(block=first[cell] + part.astype(np.int64))

    def grow(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pid", ignore_index=True)
        return block.assign(path=list(cover(unit(list(block["vec"]))).astype(np.int32)))

    numbered = placed.select("pid", "vec", "n", "cell", F.xxhash64("pid", F.lit(1)).alias("hash")).mapInPandas(
        number, f"pid long, {vec}, n long, cell int, block long")
    grown = stored(numbered.groupBy("block").applyInPandas(
        grow, f"pid long, {vec}, n long, cell int, block long, path array<int>"), "cover_trees")

    def deal(batches):
        _, first, near = plan.value
        for batch in batches:
            for c, rows in batch.groupby("cell"):
                mine = rows["block"].to_numpy()
                for other in np.flatnonzero(near[c]):
                    for b in range(first[other], first[other + 1]):
                        yield rows.drop(columns="cell").assign(p=np.minimum(mine, b), q=np.maximum(mine, b))

    dealt = grown.mapInPandas(deal, f"pid long, {vec}, n long, block long, path array<int>, p long, q long")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        p, q = group["p"].iloc[0], group["q"].iloc[0]
        parts = [group[group["block"] == k].sort_values("pid") for k in ((p,) if p == q else (p, q))]
        trees = [CoverTree(unit(list(x["vec"])), x["n"].to_numpy(np.float64), np.stack(list(x["path"]))) for x in parts]
        pids = [x["pid"].to_numpy()[t.rows] for x, t in zip(parts, trees, strict=True)]
        into_a, into_b, i, j = traverse(trees[0], trees[-1], threshold, p == q)
        counts = [(pids[0], into_a)] + ([(pids[0], into_b)] if p == q else [(pids[1], into_b)])
        a, b = local_stars(pids[0][i], pids[-1][j])
        out = [pd.DataFrame({"a": a, "b": b, "n": None})]
        out += [pd.DataFrame({"a": ids[n > 0], "b": None, "n": n[n > 0].astype(np.int64)}) for ids, n in counts]
        return pd.concat(out).astype({"a": "int64", "b": "Int64", "n": "Int64"})

    return dealt.groupBy("p", "q").applyInPandas(compare, "a long, b long, n long")


def link(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links (other rows within the threshold), component_id and kept (the row is
    its component's smallest vec_id) of every row of ``vectors`` (vec_id, embedding)."""
    rows, points = _points(vectors)
    sizes = [r["size"] for r in points.select("size").distinct().collect()]
    found = None
    for size in sorted(sizes):
        some = _pairs_of_length(points.where(F.col("size") == size), threshold)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = points.sparkSession.createDataFrame([], "a long, b long, n long")
    found = stored(found, "links")
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("pid")).agg(F.sum("n").alias("others"))
    parts = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "pid")
    points = (points.join(counts, "pid", "left").join(parts, "pid", "left")
              .select("vec", "low", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                      F.coalesce("component", "pid").alias("component")))
    points = stored(points, "linked_vectors")
    ids = points.groupBy("component").agg(F.min("low").alias("component_id"))
    points = stored(points.join(ids, "component").select("vec", "n_links", "component_id"), "vector_groups")
    linked = rows.where("good").join(points, F.col("embedding") == F.col("vec")).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("good")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
