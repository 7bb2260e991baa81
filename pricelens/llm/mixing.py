"""Mixing sources to target weights by entropy balancing.

Among all mixes in which a source's words come to its target and no document is taken
more than ``CAP`` times, the one closest to the corpus in relative entropy takes a
document of n words exp(theta * n) times, cut at the cap, with one theta per source.
The dual is convex; damped Newton steps, each an aggregation over a table of (source,
size) counts, solve it for all sources at once. Rates are then rounded into copies: a
document's lower copy count is sure, the next one goes to the documents whose fraction
exceeds a hash of the row by most, down to the bound at which the source's words come
closest to its target. That bound is found by digits, 4096 bins of a source at a time.

The driver sees counts and convergence figures only; sources may be any number.

Defined results: a null text is an empty text; documents without words are taken once
and count nothing; a null source is a source, the last in order; rows that repeat
(doc_id and text) share their hash and are taken alike. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import SPACE, stored

WEIGHTS, SHARE, CAP = (3.0, 1.0, 2.0), 1.5, 2.0
TOLERANCE, ROUNDS = 1e-6, 80
_DIGITS, _BITS = 3, 12  # of the rounding bound


def n_words() -> Column:
    """Number of words of the column ``__text``."""
    bare = F.expr("trim(BOTH ' \\t\\n\\u000b\\u000c\\r' FROM __text)")
    return F.when(F.length(bare) > 0, F.size(F.split(bare, SPACE))).otherwise(0).cast("long")


def _sized(docs: DataFrame) -> DataFrame:
    """Rows as a struct ``row`` beside what the mix needs of them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"),
                       F.col("source").cast("string").alias("source"), text.alias("__text"))
    return rows.select("row", "doc_id", "source", F.xxhash64("__text").alias("text"), n_words().alias("__size"))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target, ...) from one row a source. Weights go round the
    sources by code point, null last; a target stops at ``cap`` times its source."""
    spark = totals.sparkSession
    schema = T.StructType([*totals.schema.fields, T.StructField("nth", T.LongType())])
    ordered = totals.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    rows = stored(spark.createDataFrame(ordered, schema).withColumn("weight", weight), "sources")
    goal = share * float(rows.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.lit(level) * F.col("weight") > cap * F.col("source_size")
        n, at_cap, free = rows.agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, cap * F.col("source_size"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if n == capped or not free:
            break
        level, capped = (goal - at_cap) / free, n
    return rows.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap * F.col("source_size"))).drop("nth")


def _tilted(cap: float) -> tuple[Column, Column]:
    """The rate of a size under a source's theta, and whether it is below the cap."""
    power = F.col("theta") * F.col("__size") / F.col("scale")
    below = power < F.log(F.lit(cap))
    return F.when(below, F.exp(power)).otherwise(F.lit(cap)), below


def solve(sizes: DataFrame, rows: DataFrame, cap: float = CAP) -> DataFrame:
    """``rows`` with theta per source, from (source, __size, n) counts. ``scale`` is the
    size of the document that a random word is in, so that thetas are of order one."""
    shape = sizes.where("__size > 0").groupBy("source").agg(
        (F.sum(F.col("n") * F.col("__size").cast("double") * F.col("__size")) / F.sum(F.col("n") * F.col("__size")))
        .alias("scale"), F.min("__size").alias("least"))
    top = F.log(F.lit(cap)) * F.col("scale") / F.col("least")
    state = (rows.alias("r").join(shape.alias("s"), _same("r", "s"), "left")
             .select("r.*", F.coalesce("s.scale", F.lit(1.0)).alias("scale"), F.coalesce("s.least", F.lit(1)).alias("least"))
             .withColumn("hi", top).withColumn("lo", -700.0 * F.col("scale") / F.col("least"))
             .withColumn("theta", F.when(F.col("target") >= cap * F.col("source_size"), F.col("hi")).otherwise(0.0))
             .drop("least", "weight"))
    state = stored(state, "dual")
    rate, below = _tilted(cap)
    words = F.col("n") * F.col("__size")
    for _ in range(ROUNDS):
        sums = (sizes.alias("h").join(state.select("source", "scale", "theta").alias("t"), _same("h", "t"))
                .select("h.*", "t.scale", "t.theta").groupBy("source")
                .agg(F.sum(words * rate).alias("got"),
                     F.sum(F.when(below, words * rate * F.col("__size") / F.col("scale")).otherwise(0.0)).alias("slope")))
        gap = F.col("got") - F.col("target")
        done = F.abs(gap) <= TOLERANCE * F.greatest("target", F.lit(1.0))
        done = done | (F.col("hi") - F.col("lo") <= 1e-12 * F.abs("theta"))
        now = (state.alias("s").join(sums.alias("g"), _same("s", "g"), "left")
               .select("s.*", F.coalesce("g.got", F.lit(0.0)).alias("got"), F.coalesce("g.slope", F.lit(0.0)).alias("slope"))
               .withColumn("done", done)
               .withColumn("lo", F.when(gap < 0, F.col("theta")).otherwise(F.col("lo")))
               .withColumn("hi", F.when(gap > 0, F.col("theta")).otherwise(F.col("hi"))))
        step = F.col("theta") - gap / F.when(F.col("slope") > 0, F.col("slope"))
        inside = (step > F.col("lo")) & (step < F.col("hi"))
        now = now.withColumn("theta", F.when(F.col("done"), F.col("theta")).when(inside, step)
                             .otherwise((F.col("lo") + F.col("hi")) / 2))
        state = stored(now, "dual")
        if not state.where("NOT done").limit(1).count():
            break
        state = state.drop("got", "slope", "done")
    return state.select("source", "source_size", "target", "scale", "theta")


def _lots(sized: DataFrame, state: DataFrame, cap: float, seed: int) -> DataFrame:
    """Rows with their sure copies and, as ``__lot``, how far their fraction exceeds their hash."""
    rate, _ = _tilted(cap)
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(1 << 53)) / float(1 << 53)
    sure = F.least(F.floor("__rate"), F.lit(int(cap) - 1)).cast("long")
    lot = F.floor((F.col("__rate") - F.col("__sure") - F.col("__unit") + 1) * float(1 << (_DIGITS * _BITS - 1)))
    keep = [F.col(f"d.`{c}`") for c in sized.columns]
    return (sized.alias("d").withColumn("__unit", unit).alias("d").join(state.alias("s"), _same("d", "s"))
            .select(*keep, F.col("d.__unit"), *[F.col(f"s.{c}").alias(c if c != "source" else "__source")
                                                for c in state.columns if c != "source"])
            .withColumn("__rate", rate).withColumn("__sure", sure).withColumn("__lot", lot))


def bounds(lots: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` with ``bound``: documents of a lot of at least this get the next copy."""
    sure = lots.groupBy("source").agg(F.sum(F.col("__sure") * F.col("__size")).alias("sure"))
    now = (state.alias("s").join(sure.alias("g"), _same("s", "g"), "left")
           .select("s.*", (F.col("target") - F.coalesce("g.sure", F.lit(0))).alias("need"),
                   F.lit(0).cast("long").alias("bound"), F.lit(0).cast("long").alias("above")))
    now = stored(now, "bounds")
    for digit in range(_DIGITS):
        shift = (_DIGITS - 1 - digit) * _BITS
        prefix = F.shiftright("__lot", shift + _BITS)
        bins = (lots.alias("l").join(now.select("source", "bound").alias("b"), _same("l", "b"))
                .where(prefix == F.col("b.bound")).groupBy("l.source", F.shiftright("__lot", shift).alias("bin"))
                .agg(F.sum("__size").alias("words")))
        w = W.partitionBy("source")
        bins = bins.alias("x").join(now.select("source", "need", "above").alias("b"), _same("x", "b")).select(
            "x.*", "b.need", "b.above")
        bins = bins.withColumn("upto", F.col("above") + F.sum("words").over(w.orderBy(F.col("bin").desc())))
        # the highest bin that reaches the need; the lowest one if none does
        bins = (bins.withColumn("reaches", F.col("upto") >= F.col("need"))
                .groupBy("source").agg(
                    F.max(F.when(F.col("reaches"), F.struct("bin", "upto", "words"))).alias("hit"),
                    F.min(F.struct("bin", "upto", "words")).alias("low")))
        hit = F.coalesce("p.hit", "p.low")
        now = (now.alias("n").join(bins.alias("p"), _same("n", "p"), "left")
               .select(*[f"n.{c}" for c in now.columns if c not in ("bound", "above")],
                       F.coalesce(hit["bin"], F.col("n.bound") * (1 << _BITS)).alias("bound"),
                       F.coalesce(hit["upto"] - hit["words"], F.col("n.above")).alias("above"),
                       F.coalesce(hit["upto"], F.col("n.above")).alias("with_bound")))
        now = stored(now, "bounds")
        if digit < _DIGITS - 1:
            now = now.drop("with_bound")
    over = F.col("with_bound") - F.col("need") > F.col("need") - F.col("above")  # the bound's own rows overshoot by more
    return now.withColumn("bound", F.when(over, F.col("bound") + 1).otherwise(F.col("bound"))).drop(
        "need", "above", "with_bound")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
        seed: int = 7) -> DataFrame:
    """``row``, a struct of all columns of ``docs`` (doc_id, text, source and any others), with
    size, source_size, target, rate and copies. Only the table of sources meets the texts,
    in a join that Spark broadcasts if the table's measured size allows it."""
    sized = stored(_sized(docs.select("doc_id", "source", "text")).drop("row"), "sizes")
    sizes = stored(sized.groupBy("source", "__size").agg(F.count("*").alias("n")), "size_counts")
    totals = sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("__size")).alias("source_size"))
    state = stored(solve(sizes, targets(totals, weights, share, cap), cap), "rates")
    lots = stored(_lots(sized, state, cap, seed).select("source", "__size", "__sure", "__lot"), "lots")
    state = stored(bounds(lots, state), "mix")
    more = (F.col("__lot") >= F.col("bound")).cast("long")
    copies = F.when(F.col("__size") == 0, F.lit(1).cast("long")).otherwise(F.col("__sure") + more)
    return _lots(_sized(docs), state, cap, seed).select(
        "row", F.col("__size").alias("size"), "source_size", "target", F.col("__rate").alias("rate"),
        copies.alias("copies"))


def apply(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, columns as before."""
    return (mix(docs, **how).select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
            .select("row.*"))


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target and the words taken, per document."""
    out = mix(docs.select("doc_id", "text", "source"), **how)
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                      "row.source", "copies", "rate")
