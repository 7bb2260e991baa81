import random
from collections import defaultdict

import pytest

from pricelens.llm import mixing as M


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    goal, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (goal - sum(2 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        more = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= more


def corpus(seed, n=900):
    r = random.Random(seed)
    names = ["a", "b", "é", "z", "Z", None, "", "long"]
    rows = []
    for k in range(n):
        source = r.choice(names[:3]) if r.random() < 0.6 else r.choice(names)
        words = r.choice([0, 1, 3, 10, 40, 300])
        sep = r.choice([" ", "\n", "\t ", "\x0b"])
        rows.append((k, sep.join("w" * r.randrange(1, 4) for _ in range(words)) + r.choice(["", " "]), source, 1.0))
    return [*rows, (None, None, "a", 2.0), (n, "no break", "b", 3.0), (0, rows[0][1], rows[0][2], 1.0)]


def test_against_plain_version(spark):
    rows = corpus(1)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target double")
    got = M.report(df).collect()
    sizes = defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").encode().split())
    want = plain_targets(sizes)
    taken, rates, largest = defaultdict(int), defaultdict(dict), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"] and abs(r["copies"] - r["rate"]) <= 1.0001 or r["size"] == 0
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        rates[r["source"]][r["size"]] = r["rate"]
    assert len(got) == len(rows) and sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s, goal in want.items():
        assert abs(taken[s] - goal) <= largest[s]
        # the balance: rates times sizes give the target, and log rates go with the size up to the cap
        assert sum(r["rate"] * r["size"] for r in got if r["source"] == s) == pytest.approx(goal, rel=1e-4)
    again = M.report(df.repartition(5)).collect()
    key = lambda r: str((r["doc_id"], r["size"], r["taken"]))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_rates_are_tilted(spark):
    import math

    rows = [(k, "w " * (1 + k % 7), "s") for k in range(70)] + [(k, "w", "t") for k in range(100, 900)]
    got = M.report(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1.0, 4.0)).collect()
    rate = {r["size"]: r["rate"] for r in got if r["source"] == "s"}
    slopes = [math.log(rate[n]) / n for n in rate if 0 < rate[n] < 2]
    assert slopes and max(slopes) == pytest.approx(min(slopes), rel=1e-6)


def test_apply_and_empty(spark):
    schema = "doc_id long, text string, source string, row int, copies string"
    df = spark.createDataFrame([(k, "a b c", "s", k, "x") for k in range(40)] + [(99, "", None, 1, "y")], schema)
    out = M.apply(df)
    assert out.columns == df.columns and out.where("source = 's'").count() == 60
    assert [r["copies"] for r in out.where("source IS NULL").collect()] == ["y"]
    assert M.apply(df.limit(0)).collect() == []


def test_words_next_to_each_separator_and_f(spark):
    texts = [None, "", "f", "fff", "a f", "fff foo", "f\x0cf"]
    texts += [t for s in " \t\n\x0b\x0c\r" for t in (s, s + "one two", "one two" + s, f"f{s}of", f"{s}f one f{s}")]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, __text string")
    got = {r["k"]: r["n"] for r in df.select("k", M.n_words().alias("n")).collect() if r["n"] is not None}
    assert [got.get(k) for k in range(len(texts))] == [len((t or "").encode().split()) for t in texts]
