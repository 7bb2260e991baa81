"""Enrichment operators (Silver stage 3): calendar, margins, categories, flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import PanelRoles
from ..functions import band, contains_cascade, round_he, safe_div
from .clean import materialize


def temporal_dimensions(df: DataFrame, roles: PanelRoles, v1: bool = True) -> DataFrame:
    """Year, month, quarter, semester, weekday (Mon=0), English month name;
    v1 adds day name and day of month (K25: both weekday forms)."""
    d = F.col(roles.date)
    cols = {
        roles.year: F.year(d),
        roles.month: F.month(d),
        "quarter": F.quarter(d),
        "semester": F.when(F.month(d) <= 6, F.lit(1)).otherwise(F.lit(2)),
        "weekday": F.weekday(d),
        "month_name": F.date_format(d, "MMMM"),
    }
    if v1:
        cols["day_name"] = F.date_format(d, "EEEE")
        cols["day_of_month"] = F.dayofmonth(d)
    return df.withColumns(cols)


def margin_metrics(df: DataFrame, roles: PanelRoles, digits: int | None = None) -> DataFrame:
    """Absolute margin and margin % of cost (null when cost is 0).

    ``digits=2`` gives the v1 rounded percentage.
    """
    m = F.col(roles.price) - F.col(roles.cost)
    pct = safe_div(m, F.col(roles.cost)) * F.lit(100.0)
    if digits is not None:
        pct = round_he(pct, digits)
    return df.withColumns({"margin_abs": m, "margin_pct": pct})


def categorize_product(df: DataFrame, roles: PanelRoles, source: str = "product_norm",
                       out: str = "product_category") -> DataFrame:
    rules = roles.category_rules or C.FUEL_CATEGORY_RULES
    return df.withColumn(out, contains_cascade(source, rules, C.CATEGORY_DEFAULT))


def categorize_product_v1(df: DataFrame, source: str, out: str = "product_category_v1",
                          rules=C.FUEL_CATEGORY_RULES_V1) -> DataFrame:
    return df.withColumn(out, contains_cascade(F.upper(F.col(source)), rules,
                                               C.CATEGORY_DEFAULT, C.CATEGORY_V1_NULL))


def categorize_brand(df: DataFrame, source: str, out: str = "brand_category",
                     rules=C.BRAND_CATEGORY_RULES_V1) -> DataFrame:
    return df.withColumn(out, contains_cascade(F.upper(F.col(source)), rules,
                                               C.BRAND_CATEGORY_V1_DEFAULT, C.BRAND_CATEGORY_V1_NULL))


def brand_size(df: DataFrame, roles: PanelRoles, source: str = "brand_norm",
               out: str = "brand_size") -> DataFrame:
    majors = list(roles.majors_silver)
    return df.withColumn(out, F.when(F.col(source).isin(*majors), F.lit("GRANDE"))
                         .otherwise(F.lit("REGIONAL")))


def price_band(df: DataFrame, roles: PanelRoles, out: str = "price_band") -> DataFrame:
    return df.withColumn(out, band(roles.price, list(roles.band_edges), C.BAND_LABELS))


#: Groups whose means are broadcast to the rows; beyond it rows and means are salted.
BROADCAST_GROUPS = 100_000
#: Pieces that the rows of a group are dealt into, by their key.
SALTS = 64


def join_back(df: DataFrame, means: DataFrame, keys: list, row_key) -> DataFrame:
    """``df`` with the columns of ``means``, a row a group, by ``keys``.

    The means are checkpointed and counted. Up to ``BROADCAST_GROUPS`` they go to the rows,
    which then aren't shuffled; beyond it the rows of every group are dealt into ``SALTS``
    pieces by ``row_key`` and the means are repeated for each, so that a group which holds a
    third of the rows is no single task's."""
    means = materialize(means)
    if means.count() <= BROADCAST_GROUPS:
        return df.join(F.broadcast(means), keys, "left")
    salt = F.pmod(F.xxhash64(*row_key), F.lit(SALTS)).cast("int")
    many = means.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("_salt", salt).join(many, [*keys, "_salt"], "left").drop("_salt")


def pairwise_viability(df: DataFrame, roles: PanelRoles, product: str = "product_norm",
                       out: str = "pair_viable", measured: bool = False) -> DataFrame:
    """Flag substitute rows whose price / (mean reference price, same state and
    day) is <= threshold; null when not the substitute or no reference price.

    The O(n^2) per-row lookup becomes aggregate-then-join: the reference means
    are one row per (state, day). ``measured`` counts them first (``join_back``), which the
    Silver job does on its checkpointed rows; else AQE broadcasts them when small.
    """
    sub, ref = roles.pair
    keys = [roles.state, roles.date]
    means = (df.filter(F.col(product) == ref)
               .groupBy(*keys).agg(F.avg(roles.price).alias("_ref_mean")))
    x = join_back(df, means, keys, roles.key) if measured else df.join(means, keys, "left")
    ratio = safe_div(F.col(roles.price), F.col("_ref_mean"))
    flag = F.when((F.col(product) == sub) & F.col("_ref_mean").isNotNull(),
                  ratio <= F.lit(roles.pair_threshold))
    return x.withColumn(out, flag).drop("_ref_mean")


def regional_price_index(df: DataFrame, roles: PanelRoles, region: str = "region_norm",
                         product: str = "product_norm", out: str = "regional_price_index") -> DataFrame:
    """price / mean(price of the row's region x product) * 100, 2 dp (v1).

    Aggregate then join back (``join_back``), instead of a window over raw rows, so a hot
    (region, product) never lands whole in one task.
    """
    keys = [region, product]
    means = df.groupBy(*keys).agg(F.avg(roles.price).alias("_grp_mean"))
    return (join_back(df, means, keys, roles.key)
              .withColumn(out, round_he(safe_div(F.col(roles.price), F.col("_grp_mean")) * 100.0, 2))
              .drop("_grp_mean"))


def silver_enrich(df: DataFrame, roles: PanelRoles, measured: bool = False, viability: bool = True) -> DataFrame:
    """Calendar, margins, category, brand size, pair viability, price band. Without
    ``viability`` its flag, and the join that it takes, are left out."""
    df = temporal_dimensions(df, roles)
    df = margin_metrics(df, roles)
    df = categorize_product(df, roles)
    df = brand_size(df, roles)
    if viability:
        df = pairwise_viability(df, roles, measured=measured)
    return price_band(df, roles)
