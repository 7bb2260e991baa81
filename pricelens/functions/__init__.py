"""Column-expression helpers. All are native Catalyst expressions (no UDFs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_he(c, digits: int) -> Column:
    """Half-even rounding as numpy/pandas ``.round(n)``: rint(x * 10^n) / 10^n.

    ``bround`` rounds the decimal text of the double instead, which differs
    on values such as 16447.2875 (binary 16447.287499...).
    """
    p = float(10 ** digits)
    return F.rint(col(c) * F.lit(p)) / F.lit(p)


def avg_fixed(c, digits: int) -> Column:
    """Mean of a column held at ``digits`` decimals, summed exactly as integers
    (deterministic whatever the summation order)."""
    p = float(10 ** digits)
    return F.sum(F.rint(col(c) * F.lit(p))) / F.count(col(c)) / F.lit(p)


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(col(num), col(den))


def pct_change(cur, prev) -> Column:
    """(cur / prev - 1) * 100 with a null-safe divide."""
    return (safe_div(cur, prev) - F.lit(1.0)) * F.lit(100.0)


def safe_corr(x, y) -> Column:
    """Pearson correlation; null (not an error) when a variance is zero.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI in Spark 4 on constant input.
    """
    return F.try_divide(F.covar_samp(col(x), col(y)),
                        F.stddev_samp(col(x)) * F.stddev_samp(col(y)))


def avg_rank(value: str, partition: list, ascending: bool = True) -> Column:
    """Rank with ties averaged (pandas ``rank()`` default), as a double.

    rank() gives the lowest position of a tie group; adding (ties-1)/2 moves
    it to the average position. Both windows run on an aggregated frame.
    """
    order = F.col(value).asc() if ascending else F.col(value).desc()
    w = Window.partitionBy(*partition).orderBy(order)
    ties = Window.partitionBy(*partition, value)
    return (F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0).cast("double")


def first_label_min(label: str, value: str) -> Column:
    """Label of the minimum value; ties go to the smallest label."""
    return F.min_by(F.col(label), F.struct(F.col(value), F.col(label)))


def first_label_max(label: str, value: str) -> Column:
    """Label of the maximum value; ties go to the smallest label."""
    return F.min_by(F.col(label), F.struct(-F.col(value), F.col(label)))


def map_or_keep(c, mapping: dict) -> Column:
    """mapping[c] when c is a key, else c unchanged."""
    if not mapping:
        return col(c)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[col(c)], col(c))


def map_or_null(c, mapping: dict) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return m[col(c)]


def contains_cascade(c, rules, default, null_label=None) -> Column:
    """First rule whose token is a substring of c wins; else default."""
    c = col(c)
    expr = None
    for token, label in rules:
        cond = c.contains(token)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    if null_label is not None:
        expr = F.when(c.isNull(), F.lit(null_label)).otherwise(expr)
    return expr


def band(c, edges, labels) -> Column:
    """Right-closed bins (e0,e1], (e1,e2], ...; the lowest edge is included.

    Values below the lowest edge, or null, get null.
    """
    c = col(c)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = (c >= lo) if i == 0 else (c > lo)
        if hi != float("inf"):
            cond = cond & (c <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def all_of(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)


def not_null_keys(df, keys):
    """The reference's group-by drops rows whose key has a null."""
    keys = [k for k in keys if k is not None]
    return df.filter(all_of([F.col(k).isNotNull() for k in keys])) if keys else df
