import itertools
import math
import random
import re

from pyspark.sql import functions as F

from pricelens.llm import filteraudit as A

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, mask int, n string"


def plain_mask(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return ((len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words))
            + 4 * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + 8 * bool(re.search("[#$%&*|]", text)))


def plain(docs, labels):
    """Every order walked over the rows themselves."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    rows = []
    for d, text, lang in docs:
        same = [x for x, t, _ in docs if (t or "") == (text or "") and x is not None]
        late = d is not None and min(same) < d
        rows.append((lang or "", plain_mask(text or "") + 16 * late, d is not None and d in good, d is not None and d in toxic))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                bit = 1 << (ord(f) - 65)
                hit = [r for r in left if r[1] & bit]
                out[part, "".join(order), step] = [
                    len(left) - len(hit), len(hit), sum(bool(r[1] & bit) for r in gone),
                    sum(r[1] == bit for r in left + gone), sum(r[2] for r in hit), sum(r[3] for r in hit)]
                shapley[part, f] = shapley.get((part, f), 0) + len(hit)
                left, gone = [r for r in left if not r[1] & bit], gone + hit
    return {k: tuple(v) + (shapley[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def got(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_lattice_counts_all_paths():
    forward, backward, edges = A.lattice(5)
    for state in range(32):
        k = bin(state).count("1")
        assert forward[state] == math.factorial(k) and backward[state] == math.factorial(5 - k)
    assert sum(w for s, f, w in edges if f == 2) == 120 and len(edges) == 80


def test_every_order_against_rows(spark):
    r = random.Random(4)
    texts = [None, "", " \n\t", "short", "Word " * 250, " ".join(f"w{i}" for i in range(210)), "ABC def", "a #b",
             " ".join(f"x{i}" for i in range(300)) + " $", "é" * 40 + "A", "É" * 10, "\x0bx\x0c" * 300]
    docs = [(r.choice([None, *range(30)]), r.choice(texts), r.choice(["en", "de", None, ""])) for _ in range(80)]
    docs += docs[:7]
    labels = [(d, r.choice([0, 1, None]), r.choice([0, 1, None])) for d in [None, *range(0, 30, 2), 2, 4, 99]]
    frame = spark.createDataFrame([(*d, 1, "n") for d in docs], DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert got(A.audit(frame, marks)) == plain(docs, labels)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = plain([tuple(x) for x in docs.select("doc_id", "text", "lang").collect()],
                 [tuple(x) for x in labels.select("doc_id", "quality", "toxic").collect()])
    assert got(A.audit(docs, labels)) == want


def test_shapley_values_share_all_removals(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = A.audit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    n = docs.groupBy(F.col("lang").alias("part")).agg(F.count("*").alias("n"))
    one = out.where("filter_order = 'ABCDE'").groupBy("part").agg(F.sum("shapley").alias("all"), F.min("kept").alias("kept"))
    rows = one.join(n, "part").collect()
    assert rows and all(r["all"] == 120 * (r["n"] - r["kept"]) for r in rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None, 0, "")], DOCS)
    rows = A.audit(one, labels).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""}


def test_long_texts_in_pieces(monkeypatch):
    text = ("One two #three " * 5000 + "é" * 300 + " four\n").encode()
    whole = A.fails(text)
    monkeypatch.setattr(A, "_PIECE", 50)
    assert A.fails(text) == whole == plain_mask(text.decode())
