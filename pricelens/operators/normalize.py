"""Normalisation operators (Silver stage 2): synonym maps, brand, codes, geography.

Small fixed maps are literal ``map`` expressions evaluated inside the scan's
codegen stage: no join, no shuffle, nothing broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import PanelRoles
from ..functions import map_or_keep, map_or_null


def normalize_product(df: DataFrame, roles: PanelRoles, out: str = "product_norm") -> DataFrame:
    return df.withColumn(out, map_or_keep(roles.product, roles.product_map))


def normalize_region(df: DataFrame, roles: PanelRoles, out: str = "region_norm") -> DataFrame:
    return df.withColumn(out, map_or_keep(roles.region, roles.region_map))


def brand_expr(c, strip_token=C.BRAND_STRIP_TOKEN, unbranded=C.BRAND_UNBRANDED_VALUES,
               label=C.BRAND_UNBRANDED_LABEL):
    b = F.trim(F.replace(F.col(c), F.lit(strip_token), F.lit("")))
    return F.when(b.isin(*unbranded), F.lit(label)).otherwise(b)


def normalize_brand(df: DataFrame, roles: PanelRoles, out: str = "brand_norm", **kw) -> DataFrame:
    """Remove the station token, trim, and map leftovers to the unbranded label."""
    return df.withColumn(out, brand_expr(roles.brand, **kw))


def clean_tax_id(df: DataFrame, roles: PanelRoles, out: str = "tax_id_clean") -> DataFrame:
    return df.withColumn(out, F.regexp_replace(F.col(roles.tax_id), r"[^0-9]", ""))


def region_from_state(df: DataFrame, state_col: str, region_src_col: str | None,
                      mapping: dict = C.STATE_REGION_MAP) -> DataFrame:
    """v1 geography: derive region from state; flag agreement; derived wins.

    Unknown states derive null; a null on either side compares False (K-rule
    of the pandas ``==``).
    """
    derived = map_or_null(state_col, mapping)
    df = df.withColumn("region_derived", derived)
    if region_src_col and region_src_col in df.columns:
        df = df.withColumn("region_consistent",
                           F.coalesce(F.col(region_src_col) == F.col("region_derived"), F.lit(False)))
    return df.withColumn("region_v1", F.col("region_derived"))


def silver_normalize(df: DataFrame, roles: PanelRoles) -> DataFrame:
    """Product, region, brand, tax id."""
    df = normalize_product(df, roles)
    df = normalize_region(df, roles)
    df = normalize_brand(df, roles)
    if roles.tax_id in df.columns:
        df = clean_tax_id(df, roles)
    return df
