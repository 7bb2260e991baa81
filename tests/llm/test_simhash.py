import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pricelens.llm import simhash as S
from pricelens.llm.components import components, local_stars


def plain_fingerprint(text, size=3):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).translate({c: 32 for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


TEXTS = [None, "", " \t\n", "One", "one", "ONE two", "É one\x0btwo three", "a b c d e " * 50, "no break is one word",
         "x " * 40_000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_hash_is_the_one_of_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("één two")).alias("h")).first()
    assert row["h"] % 2**64 == xxh64_intdigest("één two".encode(), 42)


def some_points(seed, n):
    r = random.Random(seed)
    out = {r.getrandbits(64) for _ in range(n)}
    for p in r.sample(sorted(out), n // 5):
        for _ in range(r.randrange(4)):
            p ^= 1 << r.randrange(64)
            out.add(p)
    centre = r.getrandbits(64)
    out |= {centre ^ 1 << a ^ 1 << b for a, b in combinations(range(20), 2)}
    return np.array(sorted(out), np.uint64)


def all_pairs(points, radius):
    out = set()
    for k in range(len(points)):
        near = np.flatnonzero(np.bitwise_count(points[k + 1 :] ^ points[k]) <= radius)
        out |= {(int(points[k]), int(points[k + 1 + j])) for j in near}
    return out


def test_near_pairs():
    p = some_points(1, 1500)
    got = {tuple(sorted(x)) for a, b in S.near_pairs(p, 2, leaf=16) for x in zip(a.tolist(), b.tolist(), strict=True)}
    assert got == all_pairs(p, 2)


def test_links_over_shards(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLE", 512)
    p = some_points(2, 1500)
    df = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp long")
    got = {tuple(sorted((x["a"] % 2**64, x["b"] % 2**64))) for x in S.links(df, shard=64).collect()}
    assert got == all_pairs(p, 2)


def root_of(edges):
    up = {}
    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(r.randrange(100, 400), r.randrange(100, 400)) for _ in range(150)]
    edges += [(500, 500 + k) for k in range(1, 80)] + [(9, 9), (5, 4)]
    want = {x: y for x, y in root_of(edges).items() if x != y}
    df = spark.createDataFrame([*edges, (None, 3)], "x long, y long")
    assert {x["node"]: x["component"] for x in components(df).collect()} == want
    a, b = local_stars(*np.array(edges).T)
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == want
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []


def test_groups_against_all_pairs(spark):
    r = random.Random(4)
    base = [" ".join(r.choice("abcdefgh") * r.randrange(1, 5) for _ in range(60)) for _ in range(12)]
    texts = TEXTS + base + [b.replace(" ", "  ", 3).upper() for b in base[:5]] + [b + " tail" for b in base]
    rows = [(None if k == 7 else k // 2 if k < 4 else k, t, k) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[-1]], "doc_id long, text string, component_id long")
    fps = [(d, plain_fingerprint(t)) for d, t, _ in [*rows, rows[-1]]]
    points = sorted({f for _, f in fps})
    near = root_of([(a, b) for a, b in combinations(points, 2) if (a ^ b).bit_count() <= 2])
    low = {}
    for d, f in fps:
        if d is not None:
            low[near.get(f, f)] = min(d, low.get(near.get(f, f), d))
    want = sorted(((d, f"{f:016x}", low.get(near.get(f, f))) for d, f in fps), key=str)
    got = S.assign(docs).collect()
    assert sorted(((x["doc_id"], x["fingerprint"], x["component_id"]) for x in got), key=str) == want
    kept = S.deduplicate(docs).collect()
    assert len(kept) == len({near.get(f, f) for f in points})
    assert S.deduplicate(docs).columns == docs.columns


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.assign(docs).collect() == [] and S.deduplicate(docs).collect() == []


def cloud(seed, bits):
    centre, some = random.Random(seed).getrandbits(64), np.arange(1 << bits, dtype=np.uint64)
    return np.sort(np.uint64(centre) ^ some)


def test_pairs_between_two_sets():
    p = np.concatenate((some_points(5, 800), cloud(6, 9)))
    one = np.random.default_rng(7).random(len(p)) < 0.4
    pairs = S.near_pairs(p[one], 2, leaf=16, others=p[~one])
    got = {x for a, b in pairs for x in zip(a.tolist(), b.tolist(), strict=True)}
    want = {x if x[0] in set(p[one].tolist()) else x[::-1] for x in all_pairs(p, 2)}
    first = set(p[one].tolist())
    assert got == {(a, b) for a, b in want if a in first and b not in first}


def test_dense_cloud_takes_bounded_memory():
    import tracemalloc

    p = cloud(8, 14)
    tracemalloc.start()
    found = sum(len(a) for a, _ in S.near_pairs(p, 1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 14 * len(p) // 2 and peak < 24 << 20


def test_dense_cloud_is_dealt_in_blocks(spark):
    p = cloud(9, 10)
    df = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp long")
    tasks = S.dealt(df, 2, shard=64).groupBy("shard", "p", "q").count().collect()
    assert len(tasks) > 16 and max(r["count"] for r in tasks) <= 4 * 64
    got = {tuple(sorted((x["a"] % 2**64, x["b"] % 2**64))) for x in S.links(df, shard=64).collect()}
    assert got == all_pairs(p, 2)
