"""Aggregates that a Gold dataset asks for, over rows or over mergeable states.

A dataset names what it needs (mean, deviation, range, counts, medians); ``Rows`` takes it
from observations, ``States`` from cells: rows that hold, for each measure of a group of
observations, the number of values, their mean, the sum of squared distances from that mean,
and the range. Cells of any two groups merge into the cell of both, so a dataset over states
equals the one over the rows they were made from (up to the last bits of float sums).
Medians come from (group, value) counts, which merge by adding up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import not_null_keys, safe_div
from .quantiles import agg_with_quantiles, quantiles_of_counts


class Rows:
    """Aggregates over observations."""

    def mean(self, c: str, where: Column | None = None) -> Column:
        return F.avg(F.col(c) if where is None else F.when(where, F.col(c)))

    def std(self, c: str) -> Column:
        return F.stddev_samp(c)

    def low(self, c: str) -> Column:
        return F.min(c)

    def high(self, c: str) -> Column:
        return F.max(c)

    def count(self, c: str) -> Column:
        return F.count(c)

    def rows(self) -> Column:
        return F.count(F.lit(1))

    def grouped(self, df: DataFrame, keys: list, aggs: list, medians: dict) -> DataFrame:
        return agg_with_quantiles(df, keys, aggs, {n: (c, 0.5) for n, c in medians.items()})


class States:
    """The same over cells (see ``cells``); ``values`` holds the counts for medians."""

    def __init__(self, values: DataFrame | None = None):
        self.values = values

    def mean(self, c: str, where: Column | None = None) -> Column:
        def total(x: Column) -> Column:
            return F.sum(x if where is None else F.when(where, x))

        return safe_div(total(F.col(f"{c}__n") * F.col(f"{c}__mean")), total(F.col(f"{c}__n")))

    def std(self, c: str) -> Column:
        n, mean = F.col(f"{c}__n"), F.col(f"{c}__mean")
        # distances from the cells' means, and of those from the mean of all
        between = F.sum(n * mean * mean) - safe_div(F.sum(n * mean) * F.sum(n * mean), F.sum(n))
        squares = F.sum(f"{c}__m2") + F.greatest(between, F.lit(0.0))
        return F.when(F.sum(n) > 1, F.sqrt(safe_div(squares, F.sum(n) - 1)))

    def low(self, c: str) -> Column:
        return F.min(f"{c}__min")

    def high(self, c: str) -> Column:
        return F.max(f"{c}__max")

    def count(self, c: str) -> Column:
        return F.coalesce(F.sum(f"{c}__n"), F.lit(0))

    def rows(self) -> Column:
        return F.sum("__rows")

    def grouped(self, df: DataFrame, keys: list, aggs: list, medians: dict) -> DataFrame:
        out = df.groupBy(*keys).agg(*aggs)
        if not medians:
            return out
        counts = (not_null_keys(self.values, keys).where(F.col("_m").isin(*set(medians.values())))
                  .groupBy(*keys, "_m", "_v").agg(F.sum("_c").alias("_c")))
        return out.join(quantiles_of_counts(counts, keys, {n: (c, 0.5) for n, c in medians.items()}), keys, "left")


ROWS = Rows()


def cells(df: DataFrame, dims: list, measures: list) -> DataFrame:
    """One row for each combination of ``dims``: ``__rows`` and the state of each measure."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in measures:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
                 (F.var_pop(c) * F.count(c)).alias(f"{c}__m2"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return df.groupBy(*dims).agg(*aggs)


def value_states(df: DataFrame, dims: list, measures: list) -> DataFrame:
    """dims, _m, _v, _c: how often each value of the measures occurs."""
    each = F.array(*[F.struct(F.lit(c).alias("_m"), F.col(c).cast("double").alias("_v")) for c in measures])
    rows = df.select(*dims, F.inline(each)).where("_v IS NOT NULL")
    return rows.groupBy(*dims, "_m", "_v").agg(F.count(F.lit(1)).alias("_c"))
