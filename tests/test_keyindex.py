"""The key index of the ingest: what a batch reads stays flat while the layer grows."""

import functools
import random

from pyspark.sql import functions as F

from pricelens.session import scratch_path
from pricelens.sources import files
from pricelens.streaming import incremental
from pricelens.streaming.keyindex import KeyIndex, bucket_of, key_hash, split_source


def _entries(spark, rows):
    frame = spark.createDataFrame(rows, "k string, ano int, mes int")
    return frame.select(key_hash(["k"]).alias("key_hash"), "ano", "mes")


def _size(spark, path):
    fs, p = files._hadoop(spark, path)
    return fs.getContentSummary(p).getLength()


def _all(index):
    rows = index.spark.read.parquet(index.data).collect()
    assert len({(r["key_hash"], r["ano"], r["mes"]) for r in rows}) == len(rows)
    return {(r["key_hash"], r["ano"], r["mes"]): r["bucket"] for r in rows}


def test_linear_hashing_moves_keys_to_new_buckets_only(spark):
    h = spark.range(-500, 500).select(F.xxhash64("id").alias("h"))
    cols = [bucket_of(F.col("h"), n).alias(f"b{n}") for n in range(1, 20)]
    for r in h.select(*cols).collect():
        for n in range(1, 19):
            assert 0 <= r[f"b{n}"] < n
            if r[f"b{n + 1}"] != r[f"b{n}"]:
                assert r[f"b{n + 1}"] == n and r[f"b{n}"] == split_source(n)


def test_updates_replace_what_is_known_of_a_key(spark):
    index = KeyIndex(spark, scratch_path(spark, "keys"), bucket_keys=20)
    r, want = random.Random(2), {}
    for batch in range(5):
        rows = [(f"k{r.randrange(150)}", 2020 + r.randrange(2), 1 + r.randrange(3)) for _ in range(60)]
        rows = list({k: (k, a, m) for k, a, m in rows}.values())
        state = index.update(_entries(spark, rows), batch)
        want |= {k: (a, m) for k, a, m in rows}
        # a replay changes nothing
        assert index.update(_entries(spark, rows[:1]), batch) == state
    hashes = {r["key_hash"]: r["k"] for r in spark.createDataFrame([(k,) for k in want], "k string")
              .select("k", key_hash(["k"]).alias("key_hash")).collect()}
    got = _all(index)
    assert {(hashes[h], a, m) for h, a, m in got} == {(k, a, m) for k, (a, m) in want.items()}
    assert state["keys"] == len(want) and state["buckets"] == -(-len(want) // 20)
    assert set(got.values()) <= set(range(state["buckets"]))
    held, _ = index.lookup(_entries(spark, [("k1", 1, 1), ("none", 1, 1)]))
    assert {tuple(x) for x in held.collect()} == ({want["k1"]} if "k1" in want else set())


def test_a_key_without_rows_leaves_the_index(spark):
    index = KeyIndex(spark, scratch_path(spark, "keys"), bucket_keys=20)
    one = _entries(spark, [("a", 2020, 1)])
    index.update(one, 0)
    index.update(one.limit(0), 1, replaced=one)
    assert index.lookup(one)[0].count() == 0
    index.update(one, 2)
    assert index.lookup(one)[0].count() == 1


def test_replay_after_a_failure_between_staging_and_buckets(spark, monkeypatch):
    index = KeyIndex(spark, scratch_path(spark, "keys"), bucket_keys=3)
    first = _entries(spark, [(f"a{k}", 2020, 1) for k in range(9)])
    index.update(first, 0)
    more = _entries(spark, [(f"b{k}", 2020, 2) for k in range(9)])
    gone = files.delete_path

    def fail(spark_, path):
        if "/buckets/" in path or "/staged/" in path:
            raise OSError("lost")
        gone(spark_, path)

    monkeypatch.setattr(files, "delete_path", fail)
    try:
        index.update(more, 1)
    except OSError:
        pass
    monkeypatch.setattr(files, "delete_path", gone)
    state = index.update(more, 1)
    assert state["keys"] == 18 and len(_all(index)) == 18


def test_bytes_read_per_batch_stay_flat(spark, monkeypatch):
    """Months come one after the other, each with keys of its own: the buckets that a batch
    looks at, and their bytes, depend on the batch, not on the layer."""
    out, staging = scratch_path(spark, "layer"), scratch_path(spark, "merge")
    schema = "k string, v double, ano int, mes int"
    index = KeyIndex(spark, f"{out}_keys", bucket_keys=200)
    read, months = [], []
    monkeypatch.setattr(incremental, "KeyIndex", functools.partial(KeyIndex, bucket_keys=200))
    for batch in range(8):
        rows = [(f"{batch}-{k}", float(k), 2015 + batch, 1) for k in range(600)]
        stats = incremental.merge_batch(spark.createDataFrame(rows, schema), batch, out, f"{out}_rejects", staging, ["k"], ["v"])
        months.append(stats["partitions"])
    for batch in range(8, 11):   # a few late rows, among ever more months
        rows = [(f"{batch % 3}-{k}", -1.0, 2015 + batch % 3, 1) for k in range(5)]
        frame = spark.createDataFrame(rows, schema)
        _, buckets = index.lookup(frame.select(key_hash(["k"]).alias("key_hash")))
        read.append((len(buckets), sum(_size(spark, f"{index.data}/bucket={b}") for b in buckets)))
        stats = incremental.merge_batch(frame, batch, out, f"{out}_rejects", staging, ["k"], ["v"])
        assert stats["partitions"] == 1 and set(stats["buckets"]) == set(buckets)
    assert max(months) <= 1 and index.state()["buckets"] == 24
    whole = _size(spark, index.data)
    assert all(n <= 5 and size < whole / 3 for n, size in read)
    assert spark.read.parquet(out).where("v = -1.0").count() == 15 and spark.read.parquet(out).count() == 8 * 600


def test_index_of_a_layer_that_was_there_before(spark):
    out, staging = scratch_path(spark, "layer"), scratch_path(spark, "merge")
    schema = "k string, v double, ano int, mes int"
    files.write_layer(spark.createDataFrame([("a", 5.0, 2020, 1), ("b", 5.0, 2020, 2)], schema), out)
    incremental.merge_batch(spark.createDataFrame([("a", 4.0, 2020, 3)], schema), 0, out, f"{out}_rejects", staging, ["k"], ["v"])
    assert sorted(tuple(r) for r in spark.read.parquet(out).select("k", "v", "mes").collect()) == [("a", 4.0, 3), ("b", 5.0, 2)]
