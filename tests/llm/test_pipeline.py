import hashlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from pricelens.llm import bpe, langid, linededup, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.toPandas())
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        before = docs.columns
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "bpe":
            assert docs.columns == before
        out.append(docs.toPandas())
    return out


def test_language_stage(stages):
    before, after = stages[0], stages[1]
    assert set(after.doc_id) <= set(before.doc_id) and len(after) >= 0.98 * len(before)
    gone = before[~before.doc_id.isin(after.doc_id)]
    assert all(t is None or len(t.split()) < 5 or not any(c.isalpha() for c in t) for t in gone.text)


def test_line_stage(stages):
    before, after = stages[1].sort_values("doc_id"), stages[2].set_index("doc_id")
    seen, keys = set(), {}
    for doc_id, text in zip(before.doc_id, before.text, strict=True):
        keep = []
        for line in text.split("\n"):
            w = tuple(linededup.line_words(line))
            near = False
            if len(w) >= linededup.MIN_WORDS:
                # an earlier line within one word edit shares one of these with this one
                mine = [("gap", g, w) for g in range(len(w) + 1)] + [("gap", g, w[:g] + w[g + 1 :]) for g in range(len(w))]
                near = any(keys.get(k, w) != w for k in mine)
                for k in mine:
                    keys.setdefault(k, w)
            if not w or not (near or w in seen):
                keep.append(line)
            if w:
                seen.add(w)
        text_now = "\n".join(keep)
        if text_now.strip() or not text.strip():
            assert after.text[doc_id] == text_now and after.n_chars[doc_id] == len(text_now)
        else:
            assert doc_id not in after.index


def test_simhash_stage(stages):
    before, after = stages[2].sort_values("doc_id"), stages[3]
    fps = np.array([simhash.fingerprint(t) for t in before.text], dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    low = np.arange(len(fps))
    while True:
        now = np.array([low[n].min() for n in near])
        if (now == low).all():
            break
        low = now
    assert sorted(after.doc_id) == sorted(before.doc_id.to_numpy()[np.unique(low)])


def test_mixing_stage(stages):
    before, after = stages[3], stages[4]
    copies = Counter(after.doc_id)
    assert set(copies) <= set(before.doc_id) and max(copies.values()) <= 2
    size = {d: len(t.encode().split()) for d, t in zip(before.doc_id, before.text, strict=True)}
    taken = sum(size[d] * n for d, n in copies.items())
    assert abs(taken - 1.5 * sum(size.values())) <= 0.5 * sum(before.groupby("source").doc_id.agg(lambda x: max(map(size.get, x))))


def test_token_stage(stages):
    before, after = stages[4], stages[5]
    assert len(before) == len(after)
    tokens = Tokenizer.from_file(bpe.default_path())
    text = dict(zip(before.doc_id, before.text, strict=True))
    for row in after.itertuples():
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert ids == tokens.encode(text[row.doc_id], add_special_tokens=False).ids and row.n_tokens == len(ids)
        assert row.decoded_sha256 == hashlib.sha256(text[row.doc_id].encode()).hexdigest()


def test_run_is_the_stages(spark, stages):
    got = P.run(spark, SF).toPandas()
    assert sorted(got.ids_sha256) == sorted(stages[5].ids_sha256)


def test_names_and_rejects():
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "mixing", "bpe"]
    assert langid.MIN_SCORE < 0.5
