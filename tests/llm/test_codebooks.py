import math
import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import codebooks as C

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int"


def plain(rows, rounds=6):
    """The rounds over all pairs, in Python integers."""
    rows = [(i, [math.floor(4096 * float(np.float32(v))) for v in e], label) for i, e, label in rows
            if e is not None and all(v is not None and math.isfinite(v) for v in e)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(rows[0][1]) if rows else 0
    bounds = [(size * k // 8, size * (k + 1) // 8) for k in range(8)]
    books = [[r[1][a:b] for r in rows[:16]] for a, b in bounds]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(bounds):
            groups = {}
            for _, x, _ in rows:
                groups.setdefault(nearest(x[a:b], books[p])[1], []).append(x[a:b])
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else books[p][e]
                        for e in range(len(books[p]))]
    text = ",".join(str(v) for book in books for e in book for v in e)
    out, by = [], {}
    for i, x, label in rows:
        found = [nearest(x[a:b], books[p]) for p, (a, b) in enumerate(bounds)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        by[label] = by.get(label, 0) + out[-1][2]
    return sorted(((i, c, e, by[label], sha256(text.encode()).hexdigest()) for i, c, e, label in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_trees_against_all_pairs():
    r = np.random.default_rng(0)
    for _ in range(80):
        n, d, k = r.integers(1, 500), r.integers(0, 9), r.integers(1, 17)
        x = r.integers(-20, 20, (n, d)) * r.choice([1, 100])
        e = x[r.integers(0, n, k)] + r.integers(-3, 3, (k, d))
        tree = C.Tree(x)
        far = ((x[:, None] - e[None]) ** 2).sum(2)
        who, apart = C.assign(tree, e)
        assert (who == far.argmin(1)).all() and (apart == far.min(1)).all()
        count, total = C.sums(tree, e)
        assert (count == np.bincount(who, minlength=k)).all()
        assert all((total[i] == x[who == i].sum(0)).all() for i in range(k))


def test_whole_nodes_are_assigned():
    r = np.random.default_rng(1)
    x = np.concatenate([r.integers(-9, 9, (1000, 8)) + 4000 * k for k in range(4)])
    entries = np.array([[4000 * k] * 8 for k in range(4)])
    tree, whole, left = C.Tree(x), 0, 0
    for level, nodes, _ in C.descend(tree, entries):
        if level is None:
            left += len(nodes)
        else:
            whole += tree.levels[level][3][nodes].sum()
    assert whole == 4000 and not left


def test_whole_table(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()]
    assert got(C.compress(vectors)) == plain(rows)


def test_ties_nulls_and_repeats(spark, monkeypatch):
    r = random.Random(5)
    rows = [(r.choice([None, *range(60)]), [r.choice([0.0, 0.25, -0.5, 1e-4, -1e-4]) for _ in range(10)], r.choice([None, 1, 2]))
            for _ in range(150)]
    rows += rows[:20] + [(r0, e, None) for r0, e in ((900, None), (901, [math.nan] + [0.0] * 9), (902, [None] * 10),
                                                   (903, [math.inf] * 10))]
    frame = spark.createDataFrame([(*x, "c", 1) for x in rows], SCHEMA)
    want = plain(rows)
    assert got(C.compress(frame)) == want
    monkeypatch.setattr(C, "BLOCK", 7)
    assert got(C.compress(frame.repartition(3))) == want


def test_few_rows_and_odd_lengths(spark):
    rows = [(1, [0.5] * 3, 1), (2, [0.1, 0.2, 0.3], 1)]
    frame = spark.createDataFrame([(*x, "c", 1) for x in rows], SCHEMA)
    assert got(C.compress(frame)) == plain(rows)
    both = frame.unionByName(spark.createDataFrame([(3, [], 2, "c", 1), (4, [1.0] * 9, 2, "c", 1)], SCHEMA))
    out = {r["vec_id"]: r for r in C.compress(both).collect()}
    assert set(out) == {1, 2, 3, 4} and out[3]["error"] == out[4]["error"] == 0 and out[3]["code"] == "00" * 8
    huge = spark.createDataFrame([(1, [3e38] * 8, 1, "c", 1), (2, [-3e38] * 8, None, "c", 1)], SCHEMA)
    assert {r["code"] for r in C.compress(huge).collect()} == {"00" * 8, "01" * 8}
    assert C.compress(frame.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("label", [None, 3])
def test_a_label_of_all_rows(spark, label):
    rows = [(k, [k % 7 / 8.0] * 8, label) for k in range(300)]
    out = C.compress(spark.createDataFrame([(*x, "c", 1) for x in rows], SCHEMA)).collect()
    assert len(out) == 300 and {r["label_error"] for r in out} == {sum(r["error"] for r in out)}
