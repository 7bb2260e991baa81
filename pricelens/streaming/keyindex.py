"""Where the written rows of a business key lie: an index key -> (ano, mes).

The index holds a row (bucket, key_hash, ano, mes) for each partition that holds a key, as
Parquet partitioned by ``bucket``, so a batch reads the buckets of its own keys and nothing
else. Buckets follow linear hashing: the number of buckets grows with the keys, one bucket
split at a time, so that a bucket holds about ``BUCKET_KEYS`` keys however large the layer
is. What a batch reads and writes here depends on the keys it brings, not on what was
written before.

Keys are known by 64 bits of their hash. Keys that share a hash make a batch look at a
partition more than it has to, never at one less; rows are compared by their keys.

A batch's changes are staged below the checkpoint folder before a bucket is replaced, so a
batch that is replayed writes the same buckets again. ``state`` files, one a batch, name the
number of buckets; the last complete one counts.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..session import writing
from ..sources import files

PARTS = list(C.PARTITION_COLUMNS)
SCHEMA = "key_hash long, ano int, mes int, bucket int"
#: Keys of a bucket (about): a bucket's file stays below a few megabytes.
BUCKET_KEYS = 100_000
#: The number of the update that indexes a layer that was there before its index.
FIRST = -1


def key_hash(keys: list[str]) -> Column:
    """64 bits of a key, null parts marked; spread once more, as buckets take its low bits."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(f"`{k}`").cast("string")), F.lit("~")) for k in keys]
    return F.xxhash64(*cells)


def bucket_of(h: Column, buckets: int) -> Column:
    """Linear hashing over ``buckets`` buckets: the hash modulo the next power of two, or,
    where that bucket isn't there yet, modulo the one before."""
    level = 1 << max(0, (buckets - 1).bit_length())
    wide = F.pmod(h, F.lit(level))
    return F.when(wide < buckets, wide).otherwise(F.pmod(h, F.lit(max(1, level // 2)))).cast("int")


def split_source(bucket: int) -> int:
    """The bucket whose keys a new bucket takes over in part."""
    return bucket - (1 << (bucket.bit_length() - 1)) if bucket else 0


class KeyIndex:
    """The index of one layer, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, bucket_keys: int = BUCKET_KEYS):
        self.spark, self.root, self.bucket_keys = spark, root.rstrip("/"), bucket_keys

    @property
    def data(self) -> str:
        return f"{self.root}/buckets"

    def state(self) -> dict:
        """{'buckets', 'keys', 'batch'} after the last complete update; empty before the first."""
        path = f"{self.root}/state"
        if not files.path_exists(self.spark, path):
            return {}
        rows = [json.loads(r["value"]) for r in self.spark.read.option("recursiveFileLookup", "true").text(path).collect()]
        return max(rows, key=lambda s: s["batch"], default={})

    def from_layer(self) -> bool:
        """Was the index made from a layer that was there before it?"""
        return files.path_exists(self.spark, f"{self.root}/state/batch={FIRST}")

    def _read(self, buckets: list[int]) -> DataFrame:
        """The rows of some buckets; only their folders are listed."""
        there = [p for b in buckets if files.path_exists(self.spark, p := f"{self.data}/bucket={b}")]
        if not there:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("basePath", self.data).parquet(*there)

    def lookup(self, keys: DataFrame) -> tuple[DataFrame, list[int]]:
        """(partitions that hold one of the hashes ``key_hash`` of ``keys``, buckets looked at)."""
        state = self.state()
        if not state:
            return self.spark.createDataFrame([], "ano int, mes int"), []
        hashes = keys.select("key_hash", bucket_of(F.col("key_hash"), state["buckets"]).alias("bucket"))
        # a number a bucket: at most as many as the batch has keys, and as there are buckets
        buckets = sorted(r["bucket"] for r in hashes.select("bucket").distinct().collect())
        held = self._read(buckets).join(hashes.select("key_hash").distinct(), "key_hash", "left_semi")
        return held.select(*PARTS).distinct(), buckets

    def update(self, entries: DataFrame, batch_id: int, replaced: DataFrame | None = None) -> dict:
        """Put (key_hash, ano, mes) in place of all that is known of the keys ``replaced``
        (by default the keys of ``entries``), and add buckets for the keys that came.

        A replay of the last update changes nothing: it finds its staged buckets."""
        spark, state = self.spark, self.state()
        staged, plan = f"{self.root}/staged/{batch_id}", f"{self.root}/staged/{batch_id}-plan"
        if state.get("batch", FIRST - 1) >= batch_id:
            return state
        if not files.path_exists(spark, f"{plan}/_SUCCESS"):
            old = state.get("buckets", 1)
            hashes = entries.select("key_hash")
            replaced = (hashes if replaced is None else hashes.unionByName(replaced.select("key_hash"))).distinct()
            hashes = replaced.select("key_hash", bucket_of(F.col("key_hash"), old).alias("bucket"))
            touched = {r["bucket"] for r in hashes.select("bucket").distinct().collect()} if state else set()
            before = self._read(sorted(touched))
            known = before.join(replaced, "key_hash", "left_semi").select("key_hash").distinct().count() if touched else 0
            keys = state.get("keys", 0) - known + entries.select("key_hash").distinct().count()
            new = max(old, -(-keys // self.bucket_keys))
            # a new bucket takes keys from an old one, whether the batch has a key there or not
            split = {s for b in range(old, new) if (s := split_source(b)) < old}
            rest = self._read(sorted(split - touched)).unionByName(before).join(replaced, "key_hash", "left_anti")
            rows = (rest.select("key_hash", *PARTS).unionByName(entries.select("key_hash", *PARTS)).distinct()
                    .withColumn("bucket", bucket_of(F.col("key_hash"), new)))
            with writing(spark):
                rows.repartition(F.col("bucket")).write.mode("overwrite").parquet(staged)
            # buckets that are left without a row, if any, are cleared after
            left = {r["bucket"] for r in spark.read.parquet(staged).select("bucket").distinct().collect()}
            empty = sorted((touched | split) - left)
            text = json.dumps({"batch": batch_id, "buckets": new, "keys": keys, "empty": empty,
                               "read": sorted(touched | split)})
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(plan)
        state = json.loads(spark.read.text(plan).first()["value"])
        merged = spark.read.schema(SCHEMA).parquet(staged)
        if not merged.isEmpty():
            # staged rows lie by bucket, so they are written as they come
            (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket").parquet(self.data))
        for b in state["empty"]:
            files.delete_path(spark, f"{self.data}/bucket={b}")
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.root}/state/batch={batch_id}")
        for k in (batch_id - 1, batch_id - 2):
            files.delete_path(spark, f"{self.root}/state/batch={k}") if k >= 0 else None
            files.delete_path(spark, f"{self.root}/staged/{k}")
            files.delete_path(spark, f"{self.root}/staged/{k}-plan")
        return state
