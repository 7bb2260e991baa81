"""Exact grouped quantiles (linear interpolation) for groups of any size.

Medians are taken with the other aggregates, in the same pass and shuffle: a KLL sketch of
size ``SKETCH`` holds every value of a group of that many rows or fewer, so its middle values
are exact, and its state stays below 50 KB whatever the group. The aggregated rows are
checkpointed. Groups with more rows, if there are any, are read a second time: the sketch
bounds their middle on both sides, so values outside these bounds are only counted, and the
few inside are counted by value; where a median isn't inside its bounds after all, the group
is counted whole. The counts go the way of all other quantiles:

Rows become (group, value) counts: a partial aggregate, so a value that a third of the rows
share is one row per map task, and a hot group spreads by its values. Values are cut into
segments with explicit bounds, ``2**LEVELS[0]`` to each doubling, whatever the data. From the
number of rows per segment (a small table) follows which segment holds which rank; only those
segments' values are put in order, each on its own, and the ranks are picked there. Where a
wanted segment holds more than ``BOUND`` values, the wanted segments are cut again by their
own bounds, into 2**16 pieces at most, until none does; a group of no more values than that
isn't cut at all. Pieces are counted where the values lie, and every window is over a bounded
number of pieces or values.

Counts that are read more than once are checkpointed, so that nothing is computed twice to
learn a size. All ways give the same value: the formula is one (``_between``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.clean import write_rows

#: Rows of a group whose median the sketch holds exactly.
SKETCH = 2048
#: Share of a group's rows by which the bounds of its median lie below and above the middle;
#: the sketch misplaces a value by 0.0014 of the rows at most in 99 cases of 100.
MARGIN = 0.01
#: Segments to a doubling of the value, as powers of two: at first, and after each cut. The
#: last ones hold 2**16 doubles at most.
LEVELS = (4, 20, 36)
#: Values of a segment that are put in order in one window.
BOUND = 1 << 16
#: Groups, or wanted segments, that are broadcast; if there are more, rows are shuffled.
BROADCAST_ROWS = 10_000
#: Groups whose bounds are broadcast.
BROADCAST_BOUNDS = 100_000
_EXPONENT = 1250   # above the exponents of doubles, subnormal ones too


def _kept(df: DataFrame) -> DataFrame:
    """``df`` in the shared checkpoint folder: computed once, read by several plans."""
    return write_rows(df)


def _segment(v: Column, bits: int = LEVELS[0]) -> Column:
    """A number that grows with the value, ``2**bits`` of them to a doubling."""
    size = F.abs(v)
    step = F.floor(F.log2(size) * float(1 << bits)) + (_EXPONENT << bits)
    edge = F.when(F.isnan(v), F.lit(3 * _EXPONENT << bits)).when(
        size == float("inf"), F.signum(v).cast("long") * (2 * _EXPONENT << bits))
    return edge.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("long") * step).cast("long")


def _between(lo: Column, hi: Column, part: Column) -> Column:
    """The value ``part`` of the way from lo to hi. A midpoint is (lo + hi) / 2, the correctly
    rounded value; others lo + part * (hi - lo)."""
    return F.when(part == 0.5, (lo + hi) * 0.5).otherwise(lo + part * (hi - lo))


def value_counts(df: DataFrame, keys, measures) -> DataFrame:
    """keys, _m, _v, _c: how often each non-null value of each measure occurs."""
    each = F.array(*[F.struct(F.lit(m).alias("_m"), F.col(m).cast("double").alias("_v")) for m in measures])
    rows = df.select(*keys, F.inline(each)).filter(F.col("_v").isNotNull())
    return rows.groupBy(*keys, "_m", "_v").agg(F.count(F.lit(1)).alias("_c"))


def exact_quantiles(df: DataFrame, keys, specs: dict) -> DataFrame:
    """specs = {out_name: (value_column, probability)} -> keys + out columns.

    Null values are ignored; a group with no values gets no row (without keys: a row of nulls).
    """
    return _exact(df, list(keys), specs)


def _exact(df: DataFrame, keys: list, specs: dict, most: int | None = None) -> DataFrame:
    return quantiles_of_counts(value_counts(df, keys, sorted({c for c, _ in specs.values()})), keys, specs, most)


def _same(left: str, right: str, columns) -> list[Column]:
    return [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in columns]


def _inside(counts: DataFrame, gk: list, level: int, wanted: DataFrame | None, needs: list) -> DataFrame:
    """The segments of a level that hold a rank, among the pieces of the ``wanted`` ones of the
    level above (None: all): gk, _s, the rows before it ``_low``, the values in it ``_vals``
    and the ranks it holds ``_need``."""
    s = _segment(F.col("_v"), LEVELS[level])
    sums = counts.groupBy(*gk, s.alias("_s")).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_vals"))
    if wanted is None:
        group = Window.partitionBy(*gk)
        sums = (sums.withColumn("_upto", F.sum("_n").over(group.orderBy("_s")))
                .withColumn("_all", F.sum("_n").over(group)).withColumn("_need", F.array(*needs)))
    else:
        # a piece's number shortened is that of its segment; below zero numbers fall with the size
        cut = LEVELS[level] - LEVELS[level - 1]
        up = F.when(F.col("_s") < 0, -F.shiftright(-F.col("_s"), cut)).otherwise(F.shiftright("_s", cut))
        sums = (sums.withColumn("_up", up).alias("c")
                .join(wanted.withColumnRenamed("_s", "_up").alias("w"), _same("c", "w", [*gk, "_up"]))
                .select(*[F.col(f"c.`{k}`").alias(k) for k in [*gk, "_up"]], "c._s", "c._n", "c._vals", "w._low", "w._need")
                .withColumn("_upto", F.col("_low") + F.sum("_n").over(Window.partitionBy(*gk, "_up").orderBy("_s"))))
    low = F.col("_upto") - F.col("_n")
    mine = F.filter("_need", lambda x: (x["m"] == F.col("_m")) & (x["rank"] >= low) & (x["rank"] < F.col("_upto")))
    return (sums.withColumn("_need", mine).filter(F.size("_need") > 0)
            .select(*gk, "_s", low.alias("_low"), "_vals", "_need"))


def quantiles_of_counts(counts: DataFrame, keys, specs: dict, most: int | None = None) -> DataFrame:
    """The same from counts: keys, _m (a name in specs), _v (double) and _c, its rows. ``most``:
    what is known to be the largest number of values in a group; if not given it is counted."""
    keys = list(keys)
    gk = keys + ["_m"]
    # every rank that an output needs
    needs = []
    for name, (c, p) in specs.items():
        at = (F.col("_all") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            needs.append(F.struct(F.lit(name).alias("out"), F.lit(side).alias("side"), F.lit(c).alias("m"),
                                  rank.cast("long").alias("rank"), (at - F.floor(at)).alias("part")))
    if most is None:
        counts = _kept(counts)
        most = counts.groupBy(*gk).agg(F.count(F.lit(1)).alias("_vals")).agg(F.max("_vals")).first()[0] or 0
    if most <= BOUND:  # a group is a segment that can be put in order
        group = Window.partitionBy(*gk)
        placed = (counts.withColumn("_to", F.sum("_c").over(group.orderBy("_v"))).withColumn("_all", F.sum("_c").over(group))
                  .withColumn("_need", F.filter(F.array(*needs), lambda x: x["m"] == F.col("_m"))))
    else:
        placed = _placed(_kept(counts), gk, needs)
    found = placed.select(*keys, "_v", F.explode(F.filter("_need", lambda x: (x["rank"] < F.col("_to"))
                                                          & (x["rank"] >= F.col("_to") - F.col("_c")))).alias("_x"))
    out = []
    for name in specs:
        mine = F.col("_x.out") == name
        lo = F.max(F.when(mine & (F.col("_x.side") == "lo"), F.col("_v")))
        hi = F.max(F.when(mine & (F.col("_x.side") == "hi"), F.col("_v")))
        out.append(_between(lo, hi, F.max(F.when(mine, F.col("_x.part")))).alias(name))
    return found.groupBy(*keys).agg(*out)


def _placed(counts: DataFrame, gk: list, needs: list) -> DataFrame:
    """The values of the segments that hold a wanted rank, with the rows up to each (``_to``);
    segments are cut until each is small enough to be put in order."""
    wanted = None
    for level in range(len(LEVELS)):
        wanted = _kept(_inside(counts, gk, level, wanted, needs))
        most, rows = wanted.agg(F.coalesce(F.max("_vals"), F.lit(0)), F.count(F.lit(1))).first()
        wanted = F.broadcast(wanted) if rows <= BROADCAST_ROWS else wanted
        if most <= BOUND:
            break
    order = Window.partitionBy(*gk, "_s").orderBy("_v")
    return (counts.withColumn("_s", _segment(F.col("_v"), LEVELS[level])).alias("c")
            .join(wanted.alias("w"), _same("c", "w", [*gk, "_s"]))
            .select(*[F.col(f"c.`{k}`").alias(k) for k in gk], "c._s", "c._v", "c._c", "w._low", "w._need")
            .withColumn("_to", F.col("_low") + F.sum("_c").over(order)))


APPROX_ACCURACY = 10000


def approx_quantiles(df: DataFrame, keys, specs: dict) -> DataFrame:
    """The same columns from the built-in sketch (bounded memory, approximate)."""
    return df.groupBy(*keys).agg(*[F.percentile_approx(F.col(c).cast("double"), p, APPROX_ACCURACY).alias(n)
                                   for n, (c, p) in specs.items()])


def distinct_count(c: str, approx: bool = False, rsd: float = 0.02):
    """Exact ``count_distinct`` (default) or the opt-in HyperLogLog++ sketch."""
    return F.approx_count_distinct(F.col(c), rsd) if approx else F.count_distinct(F.col(c))


def _sketch_median(i: int) -> Column:
    """Median from the sketch ``_k<i>`` that holds all of a group's ``_n<i>`` values: the lower
    middle value is the ceil(n / 2)-th, the upper one the next if n is even."""
    lo = F.kll_sketch_get_quantile_double(f"_k{i}", F.lit(0.5))
    hi = F.kll_sketch_get_quantile_double(f"_k{i}", F.lit(0.5 + 0.25 / SKETCH))
    return F.when(F.col(f"_n{i}") > 0, _between(lo, hi, F.when(F.col(f"_n{i}") % 2 == 0, 0.5).otherwise(0.0)))


def _of_groups(df: DataFrame, groups: DataFrame, n: int, keys: list, also: list = []) -> DataFrame:
    """The rows of ``n`` groups, with the columns ``also`` of their group."""
    these = groups.select(*[F.col(k).alias(f"_g{j}") for j, k in enumerate(keys)], *also)
    these = F.broadcast(these) if n <= BROADCAST_BOUNDS else these
    if not keys:
        return df.crossJoin(these)
    return df.join(these, [F.col(k).eqNullSafe(F.col(f"_g{j}")) for j, k in enumerate(keys)])


def _medians_of_large(df: DataFrame, groups: DataFrame, n: int, keys: list, measures: list) -> DataFrame:
    """keys, ``_e<i>``: exact medians of the ``n`` groups whose sketches don't hold all values.

    ``groups`` has bounds ``_a<i>``, ``_z<i>`` of each measure's median. What is outside of them
    counts as one value on each side, which leaves every rank inside where it is."""
    specs = {f"_e{i}": (c, 0.5) for i, c in enumerate(measures)}
    bounds = [f"_{side}{i}" for i in range(len(measures)) for side in "az"]
    inside = []
    for i, c in enumerate(measures):
        v = F.col(c).cast("double")
        inside.append(F.when(v < F.col(f"_a{i}"), float("-inf")).when(v > F.col(f"_z{i}"), float("inf")).otherwise(v).alias(c))
    near = _of_groups(df.select(*keys, *measures), groups, n, keys, bounds).select(*keys, *inside)
    found = _kept(quantiles_of_counts(value_counts(near, keys, measures), keys, specs))
    missed = F.lit(False)
    for e in specs:  # neither -inf, inf nor NaN; a measure without values has no median
        missed = missed | F.coalesce(F.isnan(e) | (F.abs(e) == float("inf")), F.lit(False))
    again = found.where(missed)
    rest = again.count()
    if not rest:
        return found
    whole = _of_groups(df.select(*keys, *measures), again, rest, keys).select(*keys, *measures)
    return found.where(~missed).unionByName(_exact(whole, keys, specs))


def agg_with_quantiles(df: DataFrame, keys, aggs: list, specs: dict, distinct_aggs: list | None = None) -> DataFrame:
    """groupBy(keys).agg(aggs) plus exact quantiles ``specs``.

    ``distinct_aggs`` (count_distinct ...) run as their own aggregate, joined on the key:
    Spark's distinct rewrite expands rows, which is cheap alone.
    """
    keys = list(keys)
    if not specs:
        out = df.groupBy(*keys).agg(*aggs)
        return _joined(out, df.groupBy(*keys).agg(*distinct_aggs), keys) if distinct_aggs else out
    if any(p != 0.5 for _, p in specs.values()):
        out = _joined(df.groupBy(*keys).agg(*aggs), exact_quantiles(df, keys, specs), keys)
        return _joined(out, df.groupBy(*keys).agg(*distinct_aggs), keys) if distinct_aggs else out
    measures = sorted({c for c, _ in specs.values()})
    held = []
    for i, c in enumerate(measures):
        held += [F.count(c).alias(f"_n{i}"), F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH)).alias(f"_k{i}")]
    rows = df.groupBy(*keys).agg(*aggs, *held)
    # the sketch leaves out what is no number; such a group counts as one it doesn't hold
    lacks = [(F.col(f"_n{i}") > SKETCH) | (F.coalesce(F.kll_sketch_get_n_double(f"_k{i}"), F.lit(0)) != F.col(f"_n{i}"))
             for i in range(len(measures))]
    any_lacks = F.lit(False)
    for x in lacks:
        any_lacks = any_lacks | x
    median = [F.when(~x, _sketch_median(i)).alias(f"_q{i}") for i, x in enumerate(lacks)]
    bounds = [F.when(any_lacks & (F.col(f"_n{i}") > 0), F.kll_sketch_get_quantile_double(f"_k{i}", F.lit(p))).alias(f"_{side}{i}")
              for i in range(len(measures)) for side, p in (("a", 0.5 - MARGIN), ("z", 0.5 + MARGIN))]
    names = [c for c in rows.columns if not any(c in (f"_n{i}", f"_k{i}") for i in range(len(measures)))]
    rows = _kept(rows.select(*names, *median, *bounds, any_lacks.alias("_lacks")))
    large = rows.where("_lacks").count()
    at = {c: f"_q{i}" for i, c in enumerate(measures)}
    if large:
        rows = _joined(rows, _medians_of_large(df, rows.where("_lacks"), large, keys, measures), keys)
        at = {c: F.coalesce(F.when(F.col("_lacks"), F.col(f"_e{i}")), F.col(f"_q{i}")) for i, c in enumerate(measures)}
    plain = [c for c in names if c not in keys]
    out = rows.select(*keys, *plain, *[(F.col(at[c]) if isinstance(at[c], str) else at[c]).alias(n)
                                       for n, (c, _) in specs.items()])
    return _joined(out, df.groupBy(*keys).agg(*distinct_aggs), keys) if distinct_aggs else out


def _joined(a: DataFrame, b: DataFrame, keys: list) -> DataFrame:
    """a with the columns of b for the same keys; without keys both are a single row."""
    if keys:
        return a.join(b, keys, "left")
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
