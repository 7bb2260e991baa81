import itertools
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import langid as L

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def field(spark):
    return L.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_marginals_are_those_of_the_whole_chain():
    f = L.Field(["a", "b", "c"], {})
    r = np.random.default_rng(1)
    f.steps = r.normal(size=(3, 3))
    table = np.exp(r.normal(size=(6, 3))).astype(np.float32)
    chains = [np.array(x) for x in ([0], [1, 2], [3, 4, 5, 0, 1], [2] * 7)]
    got = f.marginal_sums(chains, table)
    for ids, sums in zip(chains, got, strict=True):
        want, total = np.zeros(3), 0.0
        for path in itertools.product(range(3), repeat=len(ids)):
            w = np.prod([table[i, y] for i, y in zip(ids, path, strict=True)])
            w *= np.exp(sum(f.steps[x, y] for x, y in itertools.pairwise(path)))
            total += w
            want += w * np.bincount(path, minlength=3)
        assert np.allclose(sums, want / total, rtol=1e-4)


def test_segments_make_no_difference(monkeypatch):
    f = L.Field(["a", "b"], {})
    r = np.random.default_rng(2)
    f.steps, table = r.normal(size=(2, 2)) * 2, np.exp(r.normal(size=(9, 2)) * 3).astype(np.float32)
    chains = [r.integers(0, 9, n) for n in (1, 31, 32, 33, 64, 400, 5)]
    a = f.marginal_sums(chains, table)
    monkeypatch.setattr(L, "SEGMENT", 500)
    assert np.allclose(a, f.marginal_sums(chains, table), rtol=1e-3)


def test_held_out_accuracy(spark, field):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.identify(docs, field).where(L.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    right, n, low = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")),
                            F.count("*"), F.min("score")).first()
    assert n > 200 and right >= 0.98 * n and low >= 0.25


def test_code_switching(spark, field):
    docs = {r["lang"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 2000")
            .groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()}
    de, fr = " ".join(docs["de"].split()[:100]), " ".join(docs["fr"].split()[:40])
    (lang,), (score,) = field.predict([de + " " + fr])
    assert lang == "de" and 0.6 < score < 0.8


def test_defined_results(spark, field):
    texts = [None, "", "  \n", "123 $$$ 4.5", "the", "x" * 100_000, "the and of " * 30_000]
    langs, scores = field.predict(texts)
    assert langs[:4] == ["und"] * 4 and scores[:4].tolist() == [0.0] * 4
    assert langs[4] == langs[6] == "en" and all(0 <= s <= 1 for s in scores)
    schema = "doc_id long, text string, lang string, lang_pred string, row int"
    rows = [(1, "the and of that", None, "p", 3), (1, "the and of that", None, "p", 3), (None, None, "en", "q", 4)]
    df = spark.createDataFrame(rows, schema)
    assert L.fit(df.where("lang IS NULL")).predict(["the"])[0] == ["und"]
    assert L.accept(df).collect() == [] and L.accept(df.limit(0)).collect() == []
    learned = next(k for k in range(9) if crc32(str(k).encode()) % 3 != 1)
    one = spark.createDataFrame([(learned, "ein Wort", "de", "p", 1), (-1, "12", "de", "p", 1)], schema)
    assert [tuple(r) for r in L.accept(one).collect()] == [(learned, "ein Wort", "de", "p", 1)]


def test_nothing_is_learned_from_the_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = {r["text"] for r in docs.where(L.held_out(F.col("doc_id"))).collect()}
    rest = [r["text"] for r in docs.where(~L.held_out(F.col("doc_id"))).collect()]
    for _, piece in L.sample(docs, 50):
        assert any(piece in t for t in rest)
    assert held


def made_up(n_languages, n_pieces, n_words, seed=5):
    r = np.random.default_rng(seed)
    names = [f"l{k:03}" for k in range(n_languages)]
    lexicon = {x: ["".join(r.choice(list("abcdefghijklmnop"), 5)) for _ in range(20)] for x in names}
    return [(x, " ".join(r.choice(lexicon[x], n_words))) for x in names for _ in range(n_pieces)]


def test_batches_give_the_same_field_and_marginals(monkeypatch):
    pieces = made_up(3, 9, 30)
    whole = L.train(pieces, steps=8)
    texts = [" ".join(t for _, t in pieces), "", "abc", *(t for _, t in pieces)]
    langs, scores = whole.predict(texts)
    monkeypatch.setattr(L, "TRAIN_CELLS", 600)
    monkeypatch.setattr(L, "MOVE_CELLS", 20)
    parts = L.train(pieces, steps=8)
    assert np.allclose(parts.weights, whole.weights, atol=1e-6) and np.allclose(parts.steps, whole.steps, atol=1e-6)
    again, close = whole.predict(texts)
    assert again == langs and np.allclose(close, scores, atol=1e-5)


def test_many_languages_take_bounded_memory():
    import tracemalloc

    pieces = made_up(60, 12, 80)
    tracemalloc.start()
    field = L.train(pieces, steps=2)
    field.predict([t for _, t in pieces] * 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
