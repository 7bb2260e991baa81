import math

import numpy as np
import pytest

from pricelens.llm import covertree as C


def some_vectors(seed, n, dim=8):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    ball = x[0] + r.normal(size=(n, dim)) * 0.02
    wide = x[1] + r.normal(size=(n, dim)) * 0.25
    chain = np.outer(np.linspace(0, 1, n), x[2]) + np.outer(np.linspace(1, 0, n), x[3])
    return np.concatenate((x, ball, wide, chain))


@pytest.mark.parametrize("threshold", [0.5, 0.95, 0.999])
def test_traversal_counts_all_pairs(threshold):
    x = C.unit(list(some_vectors(1, 80)))
    w = np.arange(1, len(x) + 1).astype(float)
    half = len(x) // 2
    near = (x @ x.T) >= threshold
    t = C.CoverTree(x, w)
    a, b, i, j = C.traverse(t, t, threshold, True)
    want = (near * w).sum(1) - w
    assert np.allclose((a + b)[np.argsort(t.rows)], want)
    assert near[t.rows[i], t.rows[j]].all()
    ta, tb = C.CoverTree(x[:half], w[:half]), C.CoverTree(x[half:], w[half:])
    a, b, _, _ = C.traverse(ta, tb, threshold, False)
    assert np.allclose(a[np.argsort(ta.rows)], (near[:half, half:] * w[half:]).sum(1))
    assert np.allclose(b[np.argsort(tb.rows)], (near[half:, :half] * w[:half]).sum(1))


def brute(rows, threshold=0.95):
    good = [(k, np.array(v, float)) for k, (_, v) in enumerate(rows)
            if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    links, up = [0] * len(rows), list(range(len(rows)))
    def find(k):
        while up[k] != k:
            k = up[k]
        return k
    for n, (k, v) in enumerate(good):
        for m, u in good[:n]:
            if len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= threshold:
                links[k] += 1
                links[m] += 1
                up[find(k)] = find(m)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(i, ids.get(find(k), i))
    return sorted(((i, links[k], ids.get(find(k)), i is not None and ids.get(find(k)) == i)
                   for k, (i, _) in enumerate(rows)), key=str)


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 40)
    monkeypatch.setattr(C, "SAMPLE", 60)
    monkeypatch.setattr(C, "CELLS", 20)
    x = some_vectors(2, 50).astype(np.float32).tolist()
    odd = [None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1.0, 2.0], [2.0, 4.0], x[5]]
    rows = [*enumerate(x), *enumerate(odd, 900), (None, x[7]), (3, x[3]), (3, x[3])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n_links int")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in C.link(df).collect()), key=str)
    assert got == brute(rows)


def test_empty(spark):
    assert C.link(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    one = C.link(spark.createDataFrame([(4, None)], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in one] == [(4, 0, 4, True)]
