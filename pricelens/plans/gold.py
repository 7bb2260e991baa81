"""Gold analytics, v2: the fifteen datasets (temporal, regional, competitive, product).

Each function takes a Silver frame and its roles and returns one dataset; ``a`` says how
aggregates are taken, from rows or from monthly states (functions/moments.py).
Aggregates are rounded half-even to 3 dp *before* derived columns (K10);
rows with a null group key are dropped (K24). ``ORACLE`` holds the DuckDB
twin of each query over the ``silver`` CTE of plans/silver.py.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PanelRoles
from ..functions import (avg_fixed, avg_rank, first_label_max, first_label_min, not_null_keys,
                         pct_change, round_he, safe_corr, safe_div)
from ..functions.moments import ROWS
from . import sqlgen as S


def _grouped(df, keys, aggs: dict, medians: dict | None = None, a=ROWS):
    """groupBy(keys) with rounded aggregates (+ exact medians, also rounded)."""
    df = not_null_keys(df, keys)
    out = a.grouped(df, keys, [c.alias(n) for n, c in aggs.items()], medians or {})
    names = list(aggs) + list(medians or {})
    return out.select(*keys, *[round_he(n, 3).alias(n) for n in names])


# G1 -------------------------------------------------------------------------
def monthly_price_evolution(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    keys = [r.year, r.month, r.product]
    out = _grouped(df, keys, {
        "price_mean": a.mean(r.price), "price_min": a.low(r.price), "price_max": a.high(r.price),
        "price_count": a.count(r.price), "margin_pct_mean": a.mean("margin_pct"),
    }, {"price_median": r.price, "margin_pct_median": "margin_pct"}, a=a)
    return out.withColumn("price_count", F.col("price_count").cast("long")) \
              .withColumn("period", F.make_date(r.year, r.month, F.lit(1)))


# G2 -------------------------------------------------------------------------
def seasonality(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    out = _grouped(df, [r.month, r.product], {
        "price_mean": a.mean(r.price), "price_std": a.std(r.price),
        "margin_pct_mean": a.mean("margin_pct")}, a=a)
    return out.withColumn("coef_variation", safe_div("price_std", "price_mean"))


# G3 -------------------------------------------------------------------------
def annual_trends(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    out = _grouped(df, [r.year, r.product], {
        "price_mean": a.mean(r.price), "price_count": a.count(r.price),
        "margin_pct_mean": a.mean("margin_pct")}, a=a)
    w = Window.partitionBy(r.product).orderBy(r.year)
    return (out.withColumn("price_count", F.col("price_count").cast("long"))
               .withColumn("growth_pct", pct_change(F.col("price_mean"), F.lag("price_mean").over(w))))


# G4 -------------------------------------------------------------------------
def price_volatility(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    out = _grouped(df, [r.year, r.month, r.product], {
        "price_std": a.std(r.price), "price_min": a.low(r.price), "price_max": a.high(r.price)}, a=a)
    return (out.withColumn("amplitude", F.col("price_max") - F.col("price_min"))
               .withColumn("relative_volatility", safe_div("price_std", "price_max") * 100.0))


# G5 -------------------------------------------------------------------------
def state_price_ranking(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    out = _grouped(df, [r.state, r.product], {
        "price_mean": a.mean(r.price), "price_count": a.count(r.price),
        "margin_pct_mean": a.mean("margin_pct")}, {"price_median": r.price}, a=a)
    return (out.withColumn("price_count", F.col("price_count").cast("long"))
               .withColumn("price_rank", avg_rank("price_mean", [r.product], ascending=True)))


# G6 -------------------------------------------------------------------------
def regional_analysis(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    out = _grouped(df, [r.region, r.product], {
        "price_mean": a.mean(r.price), "price_std": a.std(r.price),
        "price_count": a.count(r.price), "margin_pct_mean": a.mean("margin_pct"),
        "margin_pct_std": a.std("margin_pct"), "cost_mean": a.mean(r.cost)},
        {"price_median": r.price}, a=a)
    # idxmin / idxmax: first region in key order wins ties; max is assigned
    # last, so a one-region product ends MAIS_CARA.
    lo = F.row_number().over(Window.partitionBy(r.product).orderBy(F.col("price_mean").asc(), F.col(r.region)))
    hi = F.row_number().over(Window.partitionBy(r.product).orderBy(F.col("price_mean").desc(), F.col(r.region)))
    cls = (F.when(hi == 1, F.lit("MAIS_CARA")).when(lo == 1, F.lit("MAIS_BARATA"))
             .otherwise(F.lit("INTERMEDIARIA")))
    return out.withColumn("price_count", F.col("price_count").cast("long")).withColumn("classification", cls)


# G7 -------------------------------------------------------------------------
def regional_disparity(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    means = (not_null_keys(df, [r.region, r.product])
             .groupBy(r.region, r.product).agg(a.mean(r.price).alias("m"))
             .filter(F.col("m") > 0))
    out = (means.groupBy(r.product)
                .agg(F.count(F.lit(1)).alias("n_regions"), F.stddev_samp("m").alias("s"),
                     F.avg("m").alias("a"), F.max("m").alias("mx"), F.min("m").alias("mn"),
                     first_label_max(r.region, "m").alias("dearest_region"),
                     first_label_min(r.region, "m").alias("cheapest_region"))
                .filter(F.col("n_regions") > 1))
    return out.select(r.product,
                      round_he(safe_div("s", "a") * 100.0, 3).alias("coef_variation"),
                      round_he(safe_div(F.col("mx") - F.col("mn"), F.col("mn")) * 100.0, 3).alias("amplitude_pct"),
                      "dearest_region", "cheapest_region")


# G8 -------------------------------------------------------------------------
def brand_market_share(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    keys = [r.brand, r.product]
    out = not_null_keys(df, keys).groupBy(*keys).agg(a.rows().alias("n_points"))
    tot = F.sum("n_points").over(Window.partitionBy(r.product))
    out = out.withColumn("market_share_pct", round_he(F.col("n_points") / tot * 100.0, 2))
    return out.withColumn("share_rank", avg_rank("market_share_pct", [r.product], ascending=False))


# G9 -------------------------------------------------------------------------
def brand_positioning(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    out = _grouped(df, [r.brand, r.product], {
        "price_mean": a.mean(r.price), "price_std": a.std(r.price),
        "price_count": a.count(r.price), "margin_pct_mean": a.mean("margin_pct")}, a=a)
    w = Window.partitionBy(r.product)
    q33 = F.percentile("price_mean", 0.33).over(w)
    q67 = F.percentile("price_mean", 0.67).over(w)
    strat = (F.when(F.col("price_mean") <= q33, F.lit("ECONOMICA"))
              .when(F.col("price_mean") <= q67, F.lit("MEDIA"))
              .otherwise(F.lit("PREMIUM")))
    return out.withColumn("price_count", F.col("price_count").cast("long")).withColumn("price_strategy", strat)


# G10 ------------------------------------------------------------------------
def major_brand_competitiveness(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    df = df.filter(F.col(r.brand).isin(*r.majors_gold))
    out = _grouped(df, [r.brand, r.product], {
        "price_mean": a.mean(r.price), "price_count": a.count(r.price),
        "margin_pct_mean": a.mean("margin_pct"), "regional_presence": F.count_distinct(r.region)}, a=a)
    return out.withColumn("price_count", F.col("price_count").cast("long")) \
              .withColumn("regional_presence", F.col("regional_presence").cast("long"))


# G11 ------------------------------------------------------------------------
def pair_monthly_means(df: DataFrame, r: PanelRoles, keys, a=ROWS) -> DataFrame:
    """Mean price of each pair member per cell; a missing member stays null."""
    sub, ref = r.pair
    df = not_null_keys(df.filter(F.col(r.product).isin(sub, ref)), keys)
    return df.groupBy(*keys).agg(
        a.mean(r.price, F.col(r.product) == sub).alias("substitute_price"),
        a.mean(r.price, F.col(r.product) == ref).alias("reference_price"))


def ethanol_ratio_history(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    out = pair_monthly_means(df, r, [r.state, r.year, r.month], a)
    ratio = round_he(safe_div("substitute_price", "reference_price"), 3)
    return (out.withColumn("pair_ratio", ratio)
               .withColumn("substitute_viable", F.col("pair_ratio") <= F.lit(r.pair_threshold)))


# G12 ------------------------------------------------------------------------
def ethanol_viability_by_state(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    h = ethanol_ratio_history(df, r, a)
    out = h.groupBy(r.state).agg(
        round_he(avg_fixed("pair_ratio", 3), 3).alias("ratio_mean"),
        round_he(F.min("pair_ratio"), 3).alias("ratio_min"),
        round_he(F.max("pair_ratio"), 3).alias("ratio_max"),
        F.count_if(F.col("substitute_viable")).cast("long").alias("viable_sum"),
        F.count("substitute_viable").cast("long").alias("viable_count"))
    return out.withColumn("viable_pct", round_he(safe_div("viable_sum", "viable_count") * 100.0, 1))


# G13 ------------------------------------------------------------------------
def variant_comparison(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    df = df.filter(F.col(r.product).contains(r.variant_token))
    out = _grouped(df, [r.product, r.region], {
        "price_mean": a.mean(r.price), "price_count": a.count(r.price),
        "margin_pct_mean": a.mean("margin_pct")}, a=a)
    return out.withColumn("price_count", F.col("price_count").cast("long"))


# G14 ------------------------------------------------------------------------
def category_analysis(df: DataFrame, r: PanelRoles, a=ROWS) -> DataFrame:
    out = _grouped(df, [r.category, r.region], {
        "price_mean": a.mean(r.price), "price_std": a.std(r.price),
        "price_count": a.count(r.price), "margin_pct_mean": a.mean("margin_pct"),
        "n_brands": F.count_distinct(r.brand)}, a=a)
    return out.withColumn("price_count", F.col("price_count").cast("long")) \
              .withColumn("n_brands", F.col("n_brands").cast("long"))


# G15 ------------------------------------------------------------------------
def price_volume_elasticity(df: DataFrame, r: PanelRoles, min_months: int = 3, a=ROWS) -> DataFrame:
    monthly = (not_null_keys(df, [r.product, r.year, r.month])
               .groupBy(r.product, r.year, r.month)
               .agg(a.mean(r.price).alias("m_price"), a.count(r.cost).alias("m_volume")))
    out = monthly.groupBy(r.product).agg(
        safe_corr("m_price", F.col("m_volume").cast("double")).alias("price_volume_corr"),
        F.count(F.lit(1)).cast("long").alias("n_periods"),
        F.avg("m_price").alias("price_mean"))
    return out.filter(F.col("n_periods") > min_months)


QUERIES = {
    "monthly_price_evolution": monthly_price_evolution,
    "seasonality": seasonality,
    "annual_trends": annual_trends,
    "price_volatility": price_volatility,
    "state_price_ranking": state_price_ranking,
    "regional_analysis": regional_analysis,
    "regional_disparity": regional_disparity,
    "brand_market_share": brand_market_share,
    "brand_positioning": brand_positioning,
    "major_brand_competitiveness": major_brand_competitiveness,
    "ethanol_ratio_history": ethanol_ratio_history,
    "ethanol_viability_by_state": ethanol_viability_by_state,
    "variant_comparison": variant_comparison,
    "category_analysis": category_analysis,
    "price_volume_elasticity": price_volume_elasticity,
}


# --------------------------------------------------------------------------
# Oracle SQL bodies over the ``silver`` CTE (star roles: product_norm,
# region_norm, brand_norm, state, year, month, price, cost, margin_pct).
# --------------------------------------------------------------------------
def oracle(r: PanelRoles) -> dict:
    R = S.r
    sub, ref = r.pair
    nn = lambda *ks: " AND ".join(f"{k} IS NOT NULL" for k in ks)
    return {
        "monthly_price_evolution": f"""
SELECT year, month, product_norm,
  {R('avg(price)',3)} AS price_mean, {R('quantile_cont(price, 0.5)',3)} AS price_median,
  {R('min(price)',3)} AS price_min, {R('max(price)',3)} AS price_max,
  count(price) AS price_count, {R('avg(margin_pct)',3)} AS margin_pct_mean,
  {R('quantile_cont(margin_pct, 0.5)',3)} AS margin_pct_median,
  make_date(year, month, 1) AS period
FROM silver WHERE {nn('year','month','product_norm')} GROUP BY year, month, product_norm""",
        "seasonality": f"""
SELECT *, price_std / NULLIF(price_mean, 0) AS coef_variation FROM (
  SELECT month, product_norm, {R('avg(price)',3)} AS price_mean, {R('stddev_samp(price)',3)} AS price_std,
         {R('avg(margin_pct)',3)} AS margin_pct_mean
  FROM silver WHERE {nn('month','product_norm')} GROUP BY month, product_norm)""",
        "annual_trends": f"""
SELECT *, (price_mean / NULLIF(lag(price_mean) OVER (PARTITION BY product_norm ORDER BY year), 0) - 1.0) * 100.0 AS growth_pct
FROM (SELECT year, product_norm, {R('avg(price)',3)} AS price_mean, count(price) AS price_count,
             {R('avg(margin_pct)',3)} AS margin_pct_mean
      FROM silver WHERE {nn('year','product_norm')} GROUP BY year, product_norm)""",
        "price_volatility": f"""
SELECT *, price_max - price_min AS amplitude, price_std / NULLIF(price_max, 0) * 100.0 AS relative_volatility
FROM (SELECT year, month, product_norm, {R('stddev_samp(price)',3)} AS price_std,
             {R('min(price)',3)} AS price_min, {R('max(price)',3)} AS price_max
      FROM silver WHERE {nn('year','month','product_norm')} GROUP BY year, month, product_norm)""",
        "state_price_ranking": f"""
SELECT *, CAST(rank() OVER (PARTITION BY product_norm ORDER BY price_mean)
              + (count(*) OVER (PARTITION BY product_norm, price_mean) - 1) / 2.0 AS DOUBLE) AS price_rank
FROM (SELECT state, product_norm, {R('avg(price)',3)} AS price_mean,
             {R('quantile_cont(price, 0.5)',3)} AS price_median, count(price) AS price_count,
             {R('avg(margin_pct)',3)} AS margin_pct_mean
      FROM silver WHERE {nn('state','product_norm')} GROUP BY state, product_norm)""",
        "regional_analysis": f"""
SELECT g.* EXCLUDE (lo, hi), CASE WHEN hi = 1 THEN 'MAIS_CARA' WHEN lo = 1 THEN 'MAIS_BARATA'
                              ELSE 'INTERMEDIARIA' END AS classification
FROM (SELECT *, row_number() OVER (PARTITION BY product_norm ORDER BY price_mean ASC, region_norm) AS lo,
                row_number() OVER (PARTITION BY product_norm ORDER BY price_mean DESC, region_norm) AS hi
      FROM (SELECT region_norm, product_norm, {R('avg(price)',3)} AS price_mean,
                   {R('quantile_cont(price, 0.5)',3)} AS price_median, {R('stddev_samp(price)',3)} AS price_std,
                   count(price) AS price_count, {R('avg(margin_pct)',3)} AS margin_pct_mean,
                   {R('stddev_samp(margin_pct)',3)} AS margin_pct_std, {R('avg(cost)',3)} AS cost_mean
            FROM silver WHERE {nn('region_norm','product_norm')} GROUP BY region_norm, product_norm)) g""",
        "regional_disparity": f"""
SELECT product_norm,
  {R('stddev_samp(m) / NULLIF(avg(m), 0) * 100.0',3)} AS coef_variation,
  {R('(max(m) - min(m)) / NULLIF(min(m), 0) * 100.0',3)} AS amplitude_pct,
  arg_min(region_norm, (-m, region_norm)) AS dearest_region,
  arg_min(region_norm, (m, region_norm)) AS cheapest_region
FROM (SELECT region_norm, product_norm, avg(price) AS m FROM silver
      WHERE {nn('region_norm','product_norm')} GROUP BY region_norm, product_norm) WHERE m > 0
GROUP BY product_norm HAVING count(*) > 1""",
        "brand_market_share": f"""
SELECT *, CAST(rank() OVER (PARTITION BY product_norm ORDER BY market_share_pct DESC)
              + (count(*) OVER (PARTITION BY product_norm, market_share_pct) - 1) / 2.0 AS DOUBLE) AS share_rank
FROM (SELECT *, {R('n_points / sum(n_points) OVER (PARTITION BY product_norm) * 100.0',2)} AS market_share_pct
      FROM (SELECT brand_norm, product_norm, count(*) AS n_points FROM silver
            WHERE {nn('brand_norm','product_norm')} GROUP BY brand_norm, product_norm))""",
        "brand_positioning": f"""
SELECT *, CASE WHEN price_mean <= quantile_cont(price_mean, 0.33) OVER (PARTITION BY product_norm) THEN 'ECONOMICA'
               WHEN price_mean <= quantile_cont(price_mean, 0.67) OVER (PARTITION BY product_norm) THEN 'MEDIA'
               ELSE 'PREMIUM' END AS price_strategy
FROM (SELECT brand_norm, product_norm, {R('avg(price)',3)} AS price_mean, {R('stddev_samp(price)',3)} AS price_std,
             count(price) AS price_count, {R('avg(margin_pct)',3)} AS margin_pct_mean
      FROM silver WHERE {nn('brand_norm','product_norm')} GROUP BY brand_norm, product_norm)""",
        "major_brand_competitiveness": f"""
SELECT brand_norm, product_norm, {R('avg(price)',3)} AS price_mean, count(price) AS price_count,
       {R('avg(margin_pct)',3)} AS margin_pct_mean, count(DISTINCT region_norm) AS regional_presence
FROM silver WHERE brand_norm IN {S.in_list(r.majors_gold)} AND {nn('brand_norm','product_norm')}
GROUP BY brand_norm, product_norm""",
        "ethanol_ratio_history": f"""
SELECT *, pair_ratio <= {r.pair_threshold!r} AS substitute_viable FROM (
  SELECT *, {R('substitute_price / NULLIF(reference_price, 0)',3)} AS pair_ratio FROM (
    SELECT state, year, month,
           avg(CASE WHEN product_norm = {S.q(sub)} THEN price END) AS substitute_price,
           avg(CASE WHEN product_norm = {S.q(ref)} THEN price END) AS reference_price
    FROM silver WHERE product_norm IN ({S.q(sub)}, {S.q(ref)}) AND {nn('state','year','month')}
    GROUP BY state, year, month))""",
        "ethanol_viability_by_state": f"""
SELECT *, {R('viable_sum / NULLIF(viable_count, 0) * 100.0',1)} AS viable_pct FROM (
  SELECT state, {R('sum(round_even(pair_ratio * 1000.0, 0)) / count(pair_ratio) / 1000.0',3)} AS ratio_mean, {R('min(pair_ratio)',3)} AS ratio_min,
         {R('max(pair_ratio)',3)} AS ratio_max, CAST(count_if(substitute_viable) AS BIGINT) AS viable_sum,
         count(substitute_viable) AS viable_count
  FROM (SELECT *, pair_ratio <= {r.pair_threshold!r} AS substitute_viable FROM (
          SELECT *, {R('substitute_price / NULLIF(reference_price, 0)',3)} AS pair_ratio FROM (
            SELECT state, year, month,
                   avg(CASE WHEN product_norm = {S.q(sub)} THEN price END) AS substitute_price,
                   avg(CASE WHEN product_norm = {S.q(ref)} THEN price END) AS reference_price
            FROM silver WHERE product_norm IN ({S.q(sub)}, {S.q(ref)}) AND {nn('state','year','month')}
            GROUP BY state, year, month)))
  GROUP BY state)""",
        "variant_comparison": f"""
SELECT product_norm, region_norm, {R('avg(price)',3)} AS price_mean, count(price) AS price_count,
       {R('avg(margin_pct)',3)} AS margin_pct_mean
FROM silver WHERE contains(product_norm, {S.q(r.variant_token)}) AND {nn('product_norm','region_norm')}
GROUP BY product_norm, region_norm""",
        "category_analysis": f"""
SELECT product_category, region_norm, {R('avg(price)',3)} AS price_mean, {R('stddev_samp(price)',3)} AS price_std,
       count(price) AS price_count, {R('avg(margin_pct)',3)} AS margin_pct_mean,
       count(DISTINCT brand_norm) AS n_brands
FROM silver WHERE {nn('product_category','region_norm')} GROUP BY product_category, region_norm""",
        "price_volume_elasticity": f"""
SELECT product_norm, covar_samp(m_price, m_volume) / NULLIF(stddev_samp(m_price) * stddev_samp(m_volume), 0) AS price_volume_corr,
       count(*) AS n_periods, avg(m_price) AS price_mean
FROM (SELECT product_norm, year, month, avg(price) AS m_price, CAST(count(cost) AS DOUBLE) AS m_volume
      FROM silver WHERE {nn('product_norm','year','month')} GROUP BY product_norm, year, month)
GROUP BY product_norm HAVING count(*) > 3""",
    }
