import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import toxicity as T

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return T.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def plain_segments(s):
    """Maximal segments by their definition: the best one, then the same on both sides of it."""
    if not len(s):
        return []
    c, best = np.concatenate(([0.0], np.cumsum(s))), (0, 0, 0.0)
    for i in range(len(s)):
        for j in range(i + 1, len(s) + 1):
            if c[j] - c[i] > best[2] + 1e-12:
                best = (i, j, c[j] - c[i])
    if best[2] <= 0:
        return []
    i, j, _ = best
    return plain_segments(s[:i]) + [best] + [(a + j, b + j, v) for a, b, v in plain_segments(s[j:])]


def test_all_maximal_segments():
    r = np.random.default_rng(3)
    for _ in range(300):
        s = r.normal(-0.3, 1, r.integers(0, 30))
        got, want = T.segments(s), plain_segments(s)
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in got], [x[2] for x in want])
    assert T.segments(np.array([])) == [] and T.segments(np.array([-1.0, 0.0])) == []


def test_search_is_linear():
    import time

    s = np.tile([1.0, -1.5, 2.0, -1.0], 250_000)
    begin = time.time()
    found = T.segments(s)
    assert time.time() - begin < 20 and sum(b - a for a, b, _ in found) > 500_000


def test_extreme_values_are_recovered():
    r = np.random.default_rng(1)
    n = r.integers(50, 500, 20_000).astype(float)
    best = (np.log(0.2 * n) - np.log(-np.log(r.random(len(n))))) / 1.5
    rate, k = T.extreme_value(best, n)
    assert abs(rate - 1.5) < 0.05 and abs(k - 0.2) < 0.03


def test_evidence_sums_several_segments():
    m = T.Model(np.zeros((T.WORDS, 2)), np.zeros((T.STEMS, 2)), (9, 1))
    assert m.evidence([], 10) == 0 and m.evidence([(0, 1, 1e-9)], 1000) == 0
    one, two = m.evidence([(0, 1, 8.0)], 10), m.evidence([(0, 1, 8.0), (3, 4, 8.0)], 10)
    assert 0 < one < two < 2 * one + 1


def test_held_out(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    out = T.score(docs.select("doc_id", "text"), model).where(T.fold(F.col("doc_id")) == 0).join(labels, "doc_id")
    n = {(r["toxic"], r["said"]): r["count"]
         for r in out.groupBy("toxic", (F.col("score") >= 0.5).alias("said")).count().collect()}
    assert n[1, True] >= 0.85 * (n[1, True] + n.get((1, False), 0))
    assert n.get((0, True), 0) <= 0.01 * n[0, False]


def test_passages_hold_the_words(spark, model):
    text = ("the and of to in that is it " * 60 + "you  stupid\tpathetic, worthless\nmoron scum### " + "the and of to in " * 60)
    row = T.score(spark.createDataFrame([(text,)], "text string"), model).first()
    assert row["score"] >= 0.5 and len(row["passages"]) == 1
    p = row["passages"][0]
    found = text[p["start"] : p["end"]]
    assert found.startswith("stupid") and found.endswith("scum###") and p["expected"] <= T.SIGNIFICANT
    assert T.score(spark.createDataFrame([("the and of to in that is it " * 99,)], "text string"), model).first()["score"] < 0.5


def test_defined_results(spark, model, monkeypatch):
    rows = [(None, None, 1, 2.0, "p"), (1, "", 1, 2.0, "p"), (1, "", 1, 2.0, "p"), (2, " \n\x1c ", 0, 1.0, "q"),
            (3, "123 $$$", 0, 1.0, ""), (4, "x" * 300_000, 0, 1.0, ""), (5, "the moron of " * 40_000, 0, 1.0, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int, fold double, n string")
    out = T.score(frame, model).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[None]["score"] == by[1]["score"] == by[2]["score"] == by[3]["score"] < 0.5
    assert by[5]["score"] >= 0.5 and by[5]["passages"]
    monkeypatch.setattr(T, "PIECE", 100)
    model.cache.clear()
    assert model.judge(rows[-1][1])[0] == by[5]["score"]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(k, "a b c d", 1) for k in range(20)], "doc_id long, text string, toxic int")
    for labels in ([], [(k, 0) for k in range(20)], [(None, 1), (2, None), (77, 1)]):
        model = T.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [r["score"] for r in T.score(docs, model).collect()] == [0.0] * 20
    empty = spark.createDataFrame([], docs.schema)
    assert T.score(empty, T.fit(empty, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0


def test_sample_takes_the_labels_that_it_should(spark):
    docs = spark.createDataFrame([(k, f"t{k}") for k in range(500)] + [(None, "x"), (7, "again")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(500)] + [(None, 1), (3, None), (8, 1)], "doc_id long, toxic int")
    found, rows = T.sample(docs, labels)
    got = [tuple(r) for r in found.collect()]
    held = spark.range(500).where(T.fold(F.col("id")) == 0).count()
    assert len(got) == 500 - held + (1 if spark.range(7, 8).where(T.fold(F.col("id")) != 0).count() else 0)
    assert sum(rows.values()) == 500 - held and all(f for f, _, _ in got)
    few, _ = T.sample(docs, labels, size=20)
    assert 10 < few.count() < 90
