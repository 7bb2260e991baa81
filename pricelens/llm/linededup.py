"""Line dedup across documents: equal lines, and lines one word edit apart.

A line is a sequence of words (A-Z lower-cased, separated by space and the controls
9-13); an edit inserts, removes or replaces a word. Lines come in the order of doc_id,
text hash and position. A line goes if an earlier one is equal or, both having
``min_words`` words or more, within the edit bound of one word; so every line that goes
has an earlier line that justifies it, and the earliest of any group stays.

Deletion neighbourhood: a line emits a hashed key for every way in which a bound of one
word can be spent: itself with each gap between its words, and each of its words left
out with the gap that leaves. Lines share a key exactly if one word put into that gap on
either or both sides makes them equal, so all lines of a key are within the bound of each
other and it is enough to compare each one with the key's earliest, whatever the size of
the group. The words of each such pair are compared at last.

Only lines that may have a partner emit keys: two lines within the bound share their
first or last half, so lines whose halves nobody shares are put aside before. Where the
texts of the others are picked out of the documents, a Bloom filter of fixed size spares
most lines the shuffle; what it lets through in error is removed by an exact join.

Defined results: null texts stay null and have no lines; lines without words always stay;
rows that repeat doc_id and text keep the same lines; null doc_ids come last in order.
Line breaks are ``\\n``; whatever stays is joined again unchanged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, stored

MIN_WORDS = 10
#: Size of the Bloom filter: 2**BLOOM_BITS bits, 4 MB.
BLOOM_BITS = 25
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def line_words(line: str) -> list[bytes]:
    return line.encode().lower().split()


def line_hash(words: list[bytes]) -> tuple[int, int]:
    """128 bits as two signed longs."""
    from xxhash import xxh3_128_digest

    a, b = np.frombuffer(xxh3_128_digest(b" ".join(words)), "<i8").tolist()
    return a, b


def half_keys(words: list[bytes]) -> list[int]:
    """Keys of which two lines within one edit share at least one. With m words in the
    shorter line, a common beginning and a common end have m - 1 words together at least."""
    from xxhash import xxh64_intdigest as xxh64

    n, out = len(words), []
    for c in {n // 2, (n - 1) // 2}:  # ceil((m - 1) / 2) for m = n and m = n - 1
        out += [xxh64(b" ".join(words[:c]), 2 * c), xxh64(b" ".join(words[n - c :]), 2 * c + 1)]
    return [k - (1 << 64) if k >> 63 else k for k in out]


def variant_keys(words: list[bytes]) -> np.ndarray:
    """The keys of a line's deletion neighbourhood: 2 n + 1 for n words, in linear time."""
    from xxhash import xxh64_intdigest as xxh64

    n = len(words)
    h = np.fromiter((xxh64(w) for w in words), np.uint64, n)
    power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, _ODD))))
    # head[i]: polynomial of the first i words; tail[i]: of those from i on
    up = np.cumsum(h * power[:n])
    head = np.concatenate(([np.uint64(0)], up))
    tail = head[n] - head
    size = np.array([n, n - 1], np.uint64) * _MIX
    whole = np.full(n + 1, head[n]) + size[0]
    # without word i the later words move one place down: their polynomial times 1 / odd
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
    less = head[:n] + tail[1:] * inverse + size[1]
    gaps = np.concatenate((np.arange(n + 1), np.arange(n))).astype(np.uint64)
    keys = np.concatenate((whole, less)) ^ ((gaps + np.uint64(1)) * _ODD)
    keys = (keys ^ (keys >> np.uint64(31))) * _MIX
    return (keys ^ (keys >> np.uint64(29))).view(np.int64)


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at = next((i for i, w in enumerate(a) if w != b[i]), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


_ORDER = "none boolean, doc_id long, text_hash long, pos int"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """A row for each line that has words: its place, hash, and half keys if it is long enough."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows = []
            for doc_id, text, text_hash in zip(ids, batch.column(1), hashes, strict=True):
                for pos, line in enumerate((text.as_py() or "").split("\n")):
                    if words := line_words(line):
                        rows.append((doc_id, text_hash, pos, *line_hash(words),
                                     half_keys(words) if len(words) >= min_words else None))
                if len(rows) > 10_000:
                    yield _batch(rows, pa)
                    rows = []
            if rows:
                yield _batch(rows, pa)
        give_back()

    return _keyed(docs).mapInArrow(run, "doc_id long, text_hash long, pos int, h1 long, h2 long, halves array<long>")


def _batch(rows: list[tuple], pa):
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["doc_id", "text_hash", "pos", "h1", "h2", "halves"])


def _bloom_places(h: np.ndarray) -> np.ndarray:
    """Two bit numbers for each hash."""
    u = h.view(np.uint64)
    mask = np.uint64((1 << BLOOM_BITS) - 1)
    return np.stack((u & mask, (u >> np.uint64(32)) & mask))


def _bloom(hashes: DataFrame) -> np.ndarray:
    """The filter as 64-bit words, or-ed together by Spark; at most 2**(BLOOM_BITS - 6) rows come back."""
    mask = (1 << BLOOM_BITS) - 1
    bits = hashes.select(F.explode(F.array(F.col("h1").bitwiseAND(mask),
                                           F.shiftrightunsigned("h1", 32).bitwiseAND(mask))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")).toPandas()
    out = np.zeros(1 << (BLOOM_BITS - 6), np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _suspects(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(h1, h2, line) of the distinct lines that share a half with another line."""
    halves = lines.where("halves IS NOT NULL").select("h1", F.explode("halves").alias("half"))
    shared = stored(halves.groupBy("half").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
                    .where("low <> high").select("half"), "shared_halves")
    wanted = stored(halves.join(shared, "half").select("h1").distinct(), "suspects")
    bloom = docs.sparkSession.sparkContext.broadcast(_bloom(wanted))

    def run(batches):
        import pyarrow as pa

        filter_ = bloom.value
        for batch in batches:
            for text in batch.column(0):
                rows = []
                for line in set((text.as_py() or "").split("\n")):
                    if words := line_words(line):
                        rows.append((*line_hash(words), b" ".join(words).decode()))
                if not rows:
                    continue
                places = _bloom_places(np.array([r[0] for r in rows], np.int64))
                hit = ((filter_[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)).all(0)
                rows = [r for r, ok in zip(rows, hit.tolist(), strict=True) if ok]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()),
                                                        strict=True)], names=["h1", "h2", "line"])
        give_back()

    found = _keyed(docs).select("text").mapInArrow(run, "h1 long, h2 long, line string").distinct()
    return stored(found.join(wanted, "h1", "left_semi"), "suspect_lines")


def _variants(suspects: DataFrame) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            h1, h2 = (batch.column(k).to_numpy() for k in (0, 1))
            keys, begin, size = [], 0, 0
            for k, line in enumerate(batch.column(2)):
                keys.append(variant_keys(line.as_py().encode().split(b" ")))
                size += len(keys[-1])
                if size > 200_000 or k == len(h1) - 1:
                    counts = [len(x) for x in keys]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys)), pa.array(np.repeat(h1[begin : k + 1], counts)),
                         pa.array(np.repeat(h2[begin : k + 1], counts))], names=["variant", "h1", "h2"])
                    keys, begin, size = [], k + 1, 0
        give_back()

    return suspects.select("h1", "h2", "line").mapInArrow(run, "variant long, h1 long, h2 long")


def near_lines(docs: DataFrame, lines: DataFrame, first: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line within the edit bound."""
    suspects = _suspects(docs, lines)
    places = first.join(suspects.select("h1", "h2"), ["h1", "h2"], "left_semi")
    places = stored(places.select("h1", "h2", "place"), "places")
    variants = _variants(suspects)
    shared = stored(variants.groupBy("variant").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
                    .where("low <> high").select("variant"), "shared_variants")
    members = stored(variants.join(shared, "variant"), "members").join(places, ["h1", "h2"])
    members = stored(members, "placed_members")
    heads = members.groupBy("variant").agg(F.min(F.struct("place", "h1", "h2")).alias("head"))
    pairs = (members.join(heads, "variant").where(F.col("place") != F.col("head.place"))
             .select("h1", "h2", F.col("head.h1").alias("e1"), F.col("head.h2").alias("e2")).distinct())
    lines_of = suspects.select("h1", "h2", "line")
    earlier = suspects.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("earlier"))

    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within_one_edit(x.encode().split(b" "), y.encode().split(b" "))
                          for x, y in zip(a, b, strict=True)], dtype=bool)

    both = pairs.join(lines_of, ["h1", "h2"]).join(earlier, ["e1", "e2"])
    return stored(both.where(close("line", "earlier")).select("h1", "h2").distinct(), "near_lines")


def drops(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_hash, and the positions of the lines that go: ``equal``, ``near``."""
    lines = stored(_lines(docs, min_words), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "pos")
    first = stored(lines.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.count("*").alias("n"),
                                                 F.max(F.col("halves").isNotNull()).alias("long")), "first_lines")
    near = near_lines(docs, lines, first.where("long"))
    bad = first.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("n > 1 OR near")
    bad = stored(bad.select("h1", "h2", "place", F.coalesce("near", F.lit(False)).alias("near")), "repeated_lines")
    again = place != F.col("first")
    gone = (lines.drop("halves").join(bad.withColumnRenamed("place", "first"), ["h1", "h2"])
            .where(again | F.col("near")).withColumn("again", again))
    return gone.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.when(F.col("again"), F.col("pos"))).alias("equal"),
        F.collect_set(F.when(~F.col("again"), F.col("pos"))).alias("near"))


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``row``, a struct of all columns of ``docs`` with the lines gone from its text, and
    counts n_lines, n_equal, n_near."""
    gone = stored(drops(docs, min_words), "drops").select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "equal", "near")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    out = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    none = F.expr("array()").cast("array<int>")
    lines = F.split(F.col("row.text"), "\n", -1)
    out = (out.withColumn("gone", F.concat(F.coalesce("equal", none), F.coalesce("near", none)))
           .withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)))
           .withColumn("n_equal", F.coalesce(F.size("equal"), F.lit(0)))
           .withColumn("n_near", F.coalesce(F.size("near"), F.lit(0))))
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.size("gone") > 0, kept).otherwise(F.col("row.text"))
    return out.select(F.col("row").withField("text", text).alias("row"), "n_lines", "n_equal", "n_near")


def apply(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without repeated lines, columns as before (n_chars, if there, brought
    up to date). A document that loses its last line with words goes."""
    out = deduplicate(docs, min_words)
    blank = ~F.col("row.text").rlike(r"[^\x20\x09-\x0D]")
    emptied = (F.col("n_equal") + F.col("n_near") > 0) & F.coalesce(blank, F.lit(False))
    out = out.where(~emptied).select("row.*")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed)
    return out
