import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pricelens.llm import bottomk as B


def shingles(text, size=5):
    w = [x for x in text.lower().translate({c: 32 for c in range(9, 14)}).split(" ") if x]
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = ["", "one two", "one two three four five six", " ".join(f"w{i}" for i in range(60)), "é 😀 " * 20, None, "  \n ",
         " ".join(f"w{i % 700}" for i in range(30_000)), "x" * 50_000]


def test_edits_and_likeness(spark):
    r = random.Random(1)
    ids = r.sample(range(-10**12, 10**12), 6) + list(range(40, 49))
    texts = TEXTS + [" ".join(r.choice(["a", "b", "c"]) for _ in range(r.randrange(30))) for _ in range(6)]
    rows = list(zip(ids, texts, strict=True))
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, id string")
    got = {x["doc_id"]: x for x in B.compare_with_edits(df).collect()}
    order = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        x = got[i]
        assert (x["n_chars"], x["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert len(x["fingerprint"]) == 16 * min(B.K, len(shingles(text)))
        if max(len(shingles(t)) for t in (text, edited, after)) < B.K:  # then nothing is estimated
            assert x["near_edited"] == pytest.approx(jaccard(shingles(text), shingles(edited)))
            assert x["near_next"] == pytest.approx(jaccard(shingles(text), shingles(after)))
            assert x["n_shingles"] == len(shingles(text))
        else:
            assert abs(x["near_edited"] - jaccard(shingles(text), shingles(edited))) < 0.15
            assert x["n_shingles"] == pytest.approx(len(shingles(text)), rel=0.3)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "z"), (2, "q r s t"), (None, "k l m n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(x["doc_id"]), x["edited_sha256"]) for x in B.compare_with_edits(df).collect())
    edited = [("1", "a b q r "[:4] + "q r"), ("1", "a b " + "q r"), ("1", "z"), ("2", "q r a b"[:4] + "a b"), ("None", "k l " + "a b")]
    assert got == sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in edited)
    assert B.compare_with_edits(df.limit(0)).collect() == []
    only = B.compare_with_edits(df.where("doc_id IS NULL")).collect()
    assert only[0]["edited_sha256"] == hashlib.sha256(b"k l ").hexdigest()


def test_successors(spark):
    r = random.Random(2)
    ids = sorted({r.randrange(-2**63, 2**63) for _ in range(200)} | set(range(1000, 1300)) | {-2**63, 2**63 - 1})
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {x["id"]: x["next_id"] for x in B.successors(df, group=16).collect()}
    assert got == dict(zip(ids, [*ids[1:], None], strict=True))


def test_merging(spark):
    parts = [(k % 3, " ".join(f"{k % 3}w{(k * 31 + j) % 500}" for j in range(80))) for k in range(60)] + [(7, ""), (None, "a b")]
    df = B.with_sketch(spark.createDataFrame(parts, "g int, text string"), "text", "s", k=32)
    got = {x["g"]: x["s"] for x in B.merge_rows(df, ["g"], "s", k=32, salts=4).collect()}
    for g in (0, 1, 2, 7, None):
        rows = [x["s"] for x in df.where(F.col("g").eqNullSafe(g)).collect()]
        assert got[g] == sorted({h for s in rows for h in s})[:32]
    two = df.where("g = 0").limit(2).collect()
    one = spark.createDataFrame([(two[0]["s"], two[1]["s"])], "a array<long>, b array<long>")
    assert one.select(B.merge(F.col("a"), F.col("b"), 32).alias("m")).first()["m"] == sorted({*two[0]["s"], *two[1]["s"]})[:32]


def test_containment(spark):
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(100))
    df = spark.createDataFrame([(a, b, "")], "a string, b string, c string")
    for c in "abc":
        df = B.with_sketch(df, c, "s" + c)
    got = df.select(*[B.containment(F.col("s" + x), F.col("s" + y)).alias(x + y) for x, y in ("ab", "ba", "ca", "ac")]).first()
    assert (got["ab"], got["ca"], got["ac"]) == (1.0, 1.0, 0.0) and got["ba"] == pytest.approx(36 / 96)
