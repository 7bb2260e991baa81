"""Document fingerprints: bottom-k sketches of shingle hashes, native columns only.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a
text's word shingles. Two sketches of the same ``k`` merge by keeping the ``k``
smallest of their union, so parts of a text or of a corpus can be sketched apart.
From sketches alone one estimates the number of distinct shingles, resemblance
(Jaccard) and containment. Below ``k`` distinct shingles every figure is exact.

Defined results: a null text is an empty text; a text without words has an empty
sketch; a text of fewer words than a shingle has one shingle, the whole sequence;
two empty sketches resemble each other with 1, an empty and a non-empty one with 0.
A null sketch gives null figures.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

SHINGLE = 5
K = 128
_SPAN = float(2**64)


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Hashes of all shingles of a word array, repeats included."""
    n = F.size(words)
    return (F.when(n >= size, F.transform(F.sequence(F.lit(1), n - (size - 1)),
                                          lambda i: F.xxhash64(F.slice(words, i, size))))
            .when(n > 0, F.array(F.xxhash64(words)))
            .otherwise(F.expr("array()").cast("array<bigint>")))


def sketch(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, size: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of column ``text`` as column ``out``. The word array
    gets a column of its own for a while, so that it is computed once a row."""
    tmp = f"__words_of_{out}"
    return (df.withColumn(tmp, common.words(F.lower(F.col(text))))
            .withColumn(out, sketch(shingle_hashes(F.col(tmp), size), k)).drop(tmp))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches describe."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_rows(df: DataFrame, keys: list[str], col: str, k: int = K, salts: int = 64) -> DataFrame:
    """One sketch per key from many rows. Hashes are ranked within (key, salt)
    first, so a hot key's rows are cut to ``salts * k`` before they meet."""
    salt = F.pmod(F.xxhash64(F.col(col)), F.lit(salts))
    rows = (df.select(*keys, salt.alias("__salt"), F.explode(col).alias("__hash")).distinct())
    part = W.partitionBy(*keys, "__salt").orderBy("__hash")
    rows = rows.withColumn("__rank", F.row_number().over(part)).where(F.col("__rank") <= k)
    some = rows.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_set("__hash")), 1, k).alias(col))
    none = df.where(F.size(col) == 0).select(*keys).distinct()
    same = reduce(lambda x, y: x & y, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys])
    empty = F.expr("array()").cast("array<bigint>").alias(col)
    return some.unionByName(none.alias("l").join(some.alias("r"), same, "left_anti").select(*keys, empty))


def _limit(a: Column, k: int) -> Column:
    """Every hash up to this one is known to the sketch."""
    return F.when(F.size(a) >= k, F.element_at(a, k)).otherwise(F.lit(2**63 - 1))


def _joint(a: Column, b: Column, k: int) -> tuple[Column, Column, Column]:
    """Known hashes of a or b, of both, and of a, up to the limit of both sketches."""
    top = F.least(_limit(a, k), _limit(b, k))
    upto = lambda x: F.filter(x, lambda h: h <= top)
    return F.size(upto(F.array_union(a, b))), F.size(upto(F.array_intersect(a, b))), F.size(upto(a))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of the shingle sets, 0 to 1."""
    either, both, _ = _joint(a, b, k)
    return F.when(either > 0, both / either).when(either == 0, F.lit(1.0))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too (an empty a: 1)."""
    _, both, ours = _joint(a, b, k)
    return F.when(ours > 0, both / ours).when(F.size(a) == 0, F.lit(1.0)).when(ours == 0, F.lit(0.0))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(_SPAN)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def to_string(a: Column) -> Column:
    """A sketch as text: its hashes as 16 hexadecimal digits each, in order."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def successors(ids: DataFrame, rows: int | None = None, group: int = 4096) -> DataFrame:
    """(id, next_id) for a frame of distinct non-null longs ``id``: the next larger
    one, for the largest null. Ids are cut into ranges of about ``group`` ids; the
    last id of a range finds its successor among the first ids of the ranges,
    a table ``group`` times smaller, for which the same is done again."""
    if rows is None:
        rows = ids.count()
    if rows <= group:
        return ids.select("id", F.lead("id").over(W.orderBy("id")).alias("next_id"))
    lo, hi = ids.agg(F.min("id"), F.max("id")).first()
    width = min((hi - lo) // (rows // group) + 1, 2**63 - 1)
    ranged = ids.withColumn("__range", F.expr(f"id div {width}L"))
    w = W.partitionBy("__range")
    inner = common.stored(ranged.select("id", F.min("id").over(w).alias("__first"),
                                        F.lead("id").over(w.orderBy("id")).alias("__next")), "successors")
    firsts = inner.where(F.col("id") == F.col("__first")).select("id")
    later = successors(firsts, group=group).select(F.col("id").alias("__first"),
                                                   F.col("next_id").alias("__later"))
    last = inner.where(F.col("__next").isNull()).join(later, "__first", "left")
    return (inner.where(F.col("__next").isNotNull()).select("id", F.col("__next").alias("next_id"))
            .unionByName(last.select("id", F.col("__later").alias("next_id"))))


def compare_with_edits(docs: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """Fingerprints each text and an edited copy of it, whose last half is replaced
    by the beginning of the next document, and estimates three likenesses.

    Needs columns doc_id and text; others are ignored. Next means next larger doc_id,
    after the largest the smallest; a null doc_id is followed by the smallest. Among
    rows with equal doc_id the smallest text is the one that stands as "next"; each
    such row is fingerprinted. Without any non-null doc_id the next text is empty.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("body"))
    known = base.where("id IS NOT NULL")
    ids = common.stored(known.select("id").distinct(), "doc_ids")
    first = F.lit(ids.agg(F.min("id")).first()[0]).cast("long")
    half = F.floor(F.length("body") / 2).cast("int")
    own = (known.join(successors(ids), "id", "left").withColumn("next_id", F.coalesce("next_id", first))
           .unionByName(base.where("id IS NULL").withColumn("next_id", first))
           .withColumn("n_chars", F.length("body").cast("long")).withColumn("half", half))
    own = with_sketch(own, "body", "own_sketch", k, size)
    own = own.select(F.col("id").alias("doc_id"), "next_id", "n_chars", "half", "own_sketch",
                     F.expr("left(body, CAST(n_chars AS INT) - half)").alias("head"))
    # lag, not a rank: a rank's limit before the shuffle, like a column renamed on one
    # side only, would keep the two uses of ``known`` from sharing one shuffle of texts
    follows = (known.withColumn("__before", F.lag(F.lit(1)).over(W.partitionBy("id").orderBy("body")))
               .where("__before IS NULL").select(F.col("id").alias("next_id"), F.col("body").alias("next_text")))
    both = (own.join(follows, "next_id", "left")
            .withColumn("next_text", F.coalesce("next_text", F.lit("")))
            .withColumn("edited", F.concat("head", F.expr("left(next_text, half)"))))
    both = with_sketch(both, "edited", "edited_sketch", k, size)
    both = with_sketch(both, "next_text", "next_sketch", k, size)
    own_s, edited_s = F.col("own_sketch"), F.col("edited_sketch")
    return both.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        to_string(own_s).alias("fingerprint"), to_string(edited_s).alias("edited_fingerprint"),
        resemblance(own_s, edited_s, k).alias("near_edited"),
        resemblance(own_s, F.col("next_sketch"), k).alias("near_next"),
        containment(edited_s, own_s, k).alias("edited_in_own"),
        distinct_shingles(own_s, k).alias("n_shingles"))
