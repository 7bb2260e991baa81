"""SimHash near-duplicates: exact Hamming pairs through vantage-point trees.

Fingerprints: whole texts, A-Z lower-cased, word shingles, 64 bits. Equal fingerprints
are one point, so copies of a text cost nothing beyond the first. A vantage-point tree
over a bounded sample splits the points into shards: a node sends a point left if its
distance to the vantage point is at most the median, else right. Two points within the
radius differ by at most the radius in that distance, so only left points close to the
boundary go to the right shard too, and every pair within the radius meets in a shard.
A shard of too many points, as a dense cloud makes one that no split thins out, is cut
into blocks by hash whose pairs are compared in separate tasks. Points of a task split
further in the same way before they are compared, and the pairs found are all and only
those within the radius.

Defined results: a null text is an empty text; a text without words has fingerprint
zero and links like any other; a text shorter than a shingle is one shingle. The
component's id is its smallest non-null doc_id, null if it has none. Repeated rows
are rows of one component. Among rows of the smallest doc_id the one whose text has
the smallest hash represents a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from .common import sampled, stored
from .components import components, local_stars

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Points the tree is fitted on, about; aimed points of a shard; points compared with each other.
SAMPLE, SHARD, LEAF = 1 << 15, 1 << 14, 256
#: A split whose sides together hold more than so many times the points isn't made: in a
#: dense cloud they would both hold most of it, again and again.
OVERLAP = 1.4
_BLOCK, _PAIRS, _WIDE = 1 << 15, 1 << 20, 1 << 12


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint as an unsigned 64-bit integer."""
    from xxhash import xxh64_intdigest as xxh64

    words = (text or "").encode().lower().split()  # of bytes: A-Z only, separators 0x20 and 0x09-0x0D
    if not words:
        return 0
    if len(words) < size:
        return xxh64(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - size + 1
    counts = np.zeros(64, np.int64)
    for k in range(0, n, _BLOCK):
        spans = zip(starts[k : min(k + _BLOCK, n)].tolist(), ends[k + size - 1 : k + _BLOCK + size - 1].tolist(),
                    strict=False)
        h = np.array([xxh64(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint as a signed long column (an Arrow-batched function)."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, size) for t in texts], dtype=np.uint64).view(np.int64))

    return of(F.coalesce(text, F.lit("")))


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def halves(points: np.ndarray, v: np.uint64, radius: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The median distance from a vantage point, the points up to it, and those that lie
    beyond it or close enough to it to have a partner there."""
    d = np.bitwise_count(points ^ v).astype(np.int64)
    m = int(np.median(d))
    return m, points[d <= m], points[d > m - radius]


class Tree:
    """The inner nodes of a vantage-point tree: (vantage, bound, left, right); a child
    below zero is the shard of number -1 - child."""

    def __init__(self, sample: np.ndarray, rows: int, radius: int, shard: int = SHARD):
        self.radius, self.nodes, self.shards = radius, [], 0
        self.root = self._split(sample, rows / max(1, len(sample)), shard)

    def _split(self, points: np.ndarray, weight: float, shard: int) -> int:
        if len(points) >= 32 and len(points) * weight > shard:
            for v in points[:8]:
                m, left, right = halves(points, v, self.radius)
                if len(left) + len(right) <= OVERLAP * len(points):
                    at = len(self.nodes)
                    self.nodes.append(None)
                    self.nodes[at] = (v, m, self._split(left, weight, shard), self._split(right, weight, shard))
                    return at
        self.shards += 1
        return -self.shards

    def route(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, positions) of points; those near a boundary go to several shards."""
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                yield -1 - node, at
                continue
            v, m, left, right = self.nodes[node]
            d = np.bitwise_count(points[at] ^ v)
            todo.append((left, at[d <= m]))
            todo.append((right, at[d.astype(np.int64) > m - self.radius]))


def near_pairs(points: np.ndarray, radius: int, leaf: int = LEAF,
               others: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of distinct points within the radius, some of them more than once; with
    ``others`` only pairs of a point and one of the others."""
    todo = [(points, others)]
    while todo:
        p, q = todo.pop()
        both = p if q is None else np.concatenate((p, q))
        if len(both) > leaf:
            v = both[len(both) // 2]
            _, left, right = halves(both, v, radius)
            if max(len(left), len(right)) < 0.9 * len(both) and len(left) + len(right) <= OVERLAP * len(both):
                if q is None:
                    todo += [(left, None), (right, None)]
                    continue
                for side in (left, right):
                    of_q = np.isin(side, q)
                    if of_q.any() and not of_q.all():
                        todo.append((side[~of_q], side[of_q]))
                continue
        for k in range(0, len(p), leaf):
            a = p[k : k + leaf]
            for start in range(k if q is None else 0, len(p if q is None else q), _WIDE):
                b = (p if q is None else q)[start : start + _WIDE]
                i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None]) <= radius)
                if q is None:
                    keep = j + start > i + k
                    i, j = i[keep], j[keep]
                yield a[i], b[j]


def dealt(points: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(shard, p, q, block, fp): what each task compares. A shard of more than ``shard``
    points, as a dense cloud makes one, is cut into blocks of about that many by hash, and
    every pair (p, q) of its blocks is a group of its own; other shards are one block."""
    spark, rows = points.sparkSession, points.count()
    sample = sampled(points.select("fp"), "fp", SAMPLE, rows).toPandas()["fp"].sort_values()
    tree = Tree(np.random.default_rng(SEED).permutation(sample.to_numpy(np.int64).view(np.uint64)), rows, radius, shard)
    tree_b = spark.sparkContext.broadcast(tree)  # two nodes a shard at most, fitted on SAMPLE points

    def route(batches):
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            for number, at in tree_b.value.route(fps.view(np.uint64)):
                yield pd.DataFrame({"shard": np.full(len(at), number, np.int32), "fp": fps[at]})

    shards = stored(points.select("fp").mapInPandas(route, "shard int, fp long"), "shards")
    seen = shards.groupBy("shard").agg(F.count("*").alias("n")).toPandas()  # a row a shard
    blocks = np.ones(tree.shards, np.int64)
    blocks[seen["shard"]] = -(-seen["n"] // shard)
    blocks_b = spark.sparkContext.broadcast(blocks)

    def deal(batches):
        for batch in batches:
            many = blocks_b.value[batch["shard"]]
            mine = (batch["hash"].to_numpy(np.int64).view(np.uint64) % many.astype(np.uint64)).astype(np.int32)
            rows = batch[["shard", "fp"]].assign(block=mine)
            for other in range(int(many.max(initial=0))):
                some, at = rows[many > other], mine[many > other]
                yield some.assign(p=np.minimum(at, np.int32(other)), q=np.maximum(at, np.int32(other)))

    hashed = shards.select("shard", "fp", F.xxhash64("fp", F.lit("block")).alias("hash"))
    return hashed.mapInPandas(deal, "shard int, fp long, block int, p int, q int")


def links(points: DataFrame, radius: int = RADIUS, stars: bool = False, shard: int = SHARD) -> DataFrame:
    """(a, b) of all pairs within the radius among distinct non-null longs ``fp``; with
    ``stars`` a shard's pairs are replaced by fewer ones of the same components."""
    def pairs(group: pd.DataFrame) -> pd.DataFrame:
        a, b, found, n = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def merged():
            x, y = (np.concatenate([old, *new]).astype(np.int64) for old, new in zip((a, b), zip(*found, strict=True), strict=True))
            return local_stars(x, y) if stars else np.unique(np.stack((x, y)), axis=1)

        fps, one = group["fp"].to_numpy(np.int64).view(np.uint64), group["block"].to_numpy() == group["p"].iloc[0]
        others = None if group["p"].iloc[0] == group["q"].iloc[0] else np.sort(fps[~one])
        for x, y in near_pairs(np.sort(fps[one]), radius, others=others):
            found.append((x.view(np.int64), y.view(np.int64)))
            n += len(x)
            if n > _PAIRS:  # of a dense cloud: as few links as say the same, before more come
                (a, b), found, n = merged(), [], 0
        if n:
            a, b = merged()
        return pd.DataFrame({"a": a, "b": b})

    return dealt(points, radius, shard).groupBy("shard", "p", "q").applyInPandas(pairs, "a long, b long")


def groups(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """(rows, fingerprints): rows has doc_id, text_hash and fp of every document;
    fingerprints has fp, component_id and its representative's doc_id and text_hash."""
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                              fingerprint_column(F.col("text"), size).alias("fp")), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    points = stored(rows.groupBy("fp").agg(first), "fingerprints")
    linked = components(links(points, radius, stars=True))
    points = points.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    points = stored(points.withColumn("component", F.coalesce("component", "fp")), "components")
    heads = points.groupBy("component").agg(F.min("first").alias("head"))
    points = points.join(heads, "component").select(
        "fp", F.col("head.doc_id").alias("component_id"), F.col("head.text_hash").alias("head_hash"))
    return rows, stored(points, "groups")


def assign(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id of every document."""
    rows, points = groups(docs, size, radius)
    return rows.join(points, "fp").select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents that represent their group, one row a group, with all their columns."""
    _, points = groups(docs, size, radius)
    heads = points.select(F.col("component_id").alias("id"), F.col("head_hash").alias("hash")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    kept = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
    once = W.partitionBy("doc_id", "text_hash").orderBy("hash")
    return kept.withColumn("nth", F.row_number().over(once)).where("nth = 1").select("row.*")
