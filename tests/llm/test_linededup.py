import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from pricelens.llm import linededup as L


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def some_lines(seed, n):
    r = random.Random(seed)
    vocabulary = ["ab", "cd", "Ef", "gh", "é", "x,"]
    lines = [[r.choice(vocabulary) for _ in range(r.choice([1, 3, 4, 5, 9]))] for _ in range(n)]
    for k in range(n):
        w = list(r.choice(lines))
        kind, i = r.randrange(4), r.randrange(len(w))
        if kind == 0:
            w[i] = "new%d" % r.randrange(3)
        elif kind == 1:
            w.insert(i, "new")
        elif kind == 2 and len(w) > 1:
            del w[i]
        lines.append(w)
    return [r.choice([" ", "  ", "\t"]).join(w) for w in lines]


@pytest.mark.parametrize("seed", range(3))
def test_keys_meet_exactly_within_one_edit(seed):
    words = [L.line_words(x) for x in some_lines(seed, 40)]
    for a, b in combinations(words, 2):
        near = levenshtein(a, b) <= 1
        assert L.within_one_edit(a, b) == near
        assert bool({*L.variant_keys(a).tolist()} & {*L.variant_keys(b).tolist()}) == near
        if near and a != b:
            assert {*L.half_keys(a)} & {*L.half_keys(b)}


def brute(rows, min_words):
    """Kept text per row, by comparing each line with all earlier ones."""
    hashes = rows
    order = sorted({(d is None, d or 0, h, t) for d, h, t in hashes}, key=lambda x: x[:3])
    seen, out = [], {}
    for none, d, h, text in order:
        keep = []
        for line in text.split("\n"):
            w = L.line_words(line)
            equal = bool(w) and w in seen
            near = len(w) >= min_words and any(len(s) >= min_words and levenshtein(w, s) <= 1 for s in seen)
            if w:
                seen.append(w)
            if not (equal or near):
                keep.append(line)
        out[None if none else d, h] = "\n".join(keep)
    return out


def test_against_all_pairs(spark):
    r = random.Random(5)
    lines = some_lines(7, 60) + ["", "   "]
    texts = ["\n".join(r.choice(lines) for _ in range(r.randrange(1, 9))) for _ in range(40)]
    rows = [(r.choice([None, *range(30)]), t, "x") for t in texts] + [(3, None, "n"), (4, "", "e"), (4, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __lines string")
    docs = docs.withColumnRenamed("__lines", "near")  # a column name that the operator uses inside
    got = L.deduplicate(docs, min_words=3).select("row.*", "n_equal", "n_near").drop("near").collect()
    hashed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.coalesce("text", F.lit("")).alias("t"))
    want = brute([tuple(x) for x in hashed.collect()], 3)
    expected = sorted(((d, None if t is None else want[d, h]) for d, t, h in
                       [(x["doc_id"], x["text"], x["h"]) for x in docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]),
                      key=str)
    assert sorted(((g["doc_id"], g["text"]) for g in got), key=str) == expected
    assert sum(g["n_near"] for g in got) > 5 and sum(g["n_equal"] for g in got) > 5


def test_empty_table_and_long_line(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    assert L.apply(spark.createDataFrame([], schema)).collect() == []
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long, "en", "a", 1), (2, "first\n" + long.replace("w777 ", "other "), "en", "a", 1), (3, long, None, None, 1)]
    got = {x["doc_id"]: x for x in L.apply(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {1, 2} and got[2]["text"] == "first" and got[2]["n_chars"] == 5
