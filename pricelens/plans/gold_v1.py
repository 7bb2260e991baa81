"""Gold analytics, first generation (N0-N14) and the declared analyses.

v1 works on the row-rounded margin (2 dp) and does not round aggregates,
except where a column is stated as rounded. Group keys with nulls drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PanelRoles
from ..functions import (first_label_max, first_label_min, not_null_keys, pct_change,
                         round_he, safe_div)
from ..functions.quantiles import agg_with_quantiles
from . import sqlgen as S


def v1_margin(df: DataFrame) -> DataFrame:
    """v1 stores the margin percentage rounded to 2 dp per row."""
    return df.withColumn("margin_pct", round_he("margin_pct", 2))


def avg_2dp(c: str):
    """Mean of a column held at 2 dp, summed exactly as integer hundredths."""
    return F.sum(F.rint(F.col(c) * 100.0)) / F.count(c) / 100.0


def _agg(df, keys, aggs: dict, medians: dict | None = None, distinct: dict | None = None):
    """Grouped statistics, exact medians and distinct counts over non-null keys."""
    df = not_null_keys(df, keys)
    plain = [c.alias(n) for n, c in aggs.items()]
    dist = [c.alias(n) for n, c in (distinct or {}).items()]
    if not medians:
        return df.groupBy(*keys).agg(*plain, *dist)
    return agg_with_quantiles(df, keys, plain, {n: (c, 0.5) for n, c in medians.items()},
                              distinct_aggs=dist or None)


# N0 -------------------------------------------------------------------------
def price_summary_cube(df: DataFrame, r: PanelRoles) -> DataFrame:
    df = v1_margin(df)
    keys = [r.year, r.month, r.region, r.state, r.product, r.brand]
    return _agg(df, keys, {
        "price_mean": F.avg(r.price), "price_min": F.min(r.price), "price_max": F.max(r.price),
        "price_std": F.stddev_samp(r.price), "n_obs": F.count(r.price),
        "cost_mean": F.avg(r.cost), "margin_mean": avg_2dp("margin_pct"),
    }, {"price_median": r.price, "cost_median": r.cost, "margin_median": "margin_pct"},
        {"n_cities": F.count_distinct(r.city), "n_stations": F.count_distinct(r.station)})


# N1 -------------------------------------------------------------------------
def monthly_change(df: DataFrame, r: PanelRoles) -> DataFrame:
    df = v1_margin(df)
    out = _agg(df, [r.year, r.month, r.product], {
        "price_mean": F.avg(r.price), "price_std": F.stddev_samp(r.price),
        "price_count": F.count(r.price), "cost_mean": F.avg(r.cost),
        "margin_mean": avg_2dp("margin_pct")}, {"price_median": r.price})
    w = Window.partitionBy(r.product).orderBy(r.year, r.month)
    return out.withColumn("monthly_change_pct", pct_change(F.col("price_mean"), F.lag("price_mean").over(w)))


# N2 -------------------------------------------------------------------------
def seasonal_index(df: DataFrame, r: PanelRoles) -> DataFrame:
    base = not_null_keys(df, [r.month, r.product])
    m = base.groupBy(r.month, r.product).agg(F.avg(r.price).alias("price_mean"))
    overall = not_null_keys(df, [r.product]).groupBy(r.product).agg(F.avg(r.price).alias("overall_mean"))
    return (m.join(overall, r.product, "left")
             .withColumn("seasonal_index", round_he(safe_div("price_mean", "overall_mean") * 100.0, 2)))


# N3 -------------------------------------------------------------------------
def annual_growth_presence(df: DataFrame, r: PanelRoles) -> DataFrame:
    df = v1_margin(df)
    out = _agg(df, [r.year, r.product], {
        "price_mean": F.avg(r.price), "price_std": F.stddev_samp(r.price),
        "margin_mean": avg_2dp("margin_pct"), "n_cities": F.count_distinct(r.city),
        "n_stations": F.count_distinct(r.station)})
    w = Window.partitionBy(r.product).orderBy(r.year)
    return out.withColumn("annual_growth_pct", pct_change(F.col("price_mean"), F.lag("price_mean").over(w)))


# N4 -------------------------------------------------------------------------
def regional_dense_ranking(df: DataFrame, r: PanelRoles) -> DataFrame:
    out = _agg(df, [r.region, r.product], {
        "price_mean": F.avg(r.price), "price_std": F.stddev_samp(r.price)},
        {"price_median": r.price},
        {"n_cities": F.count_distinct(r.city), "n_stations": F.count_distinct(r.station)})
    w = Window.partitionBy(r.product).orderBy(F.col("price_mean").desc())
    return out.withColumn("price_rank", F.dense_rank().over(w))


# N5 -------------------------------------------------------------------------
def state_vs_region(df: DataFrame, r: PanelRoles) -> DataFrame:
    df = v1_margin(df)
    st = _agg(df, [r.region, r.state, r.product], {
        "price_mean": F.avg(r.price), "margin_mean": avg_2dp("margin_pct")})
    reg = _agg(df, [r.region, r.product], {"regional_mean": F.avg(r.price)})
    return (st.join(reg, [r.region, r.product], "left")
              .withColumn("regional_diff_pct", pct_change(F.col("price_mean"), F.col("regional_mean"))))


# N6 -------------------------------------------------------------------------
def regional_dispersion(df: DataFrame, r: PanelRoles) -> DataFrame:
    out = _agg(df, [r.region, r.product], {
        "price_min": F.min(r.price), "price_max": F.max(r.price),
        "price_std": F.stddev_samp(r.price), "_mean": F.avg(r.price)})
    return (out.withColumn("amplitude", F.col("price_max") - F.col("price_min"))
               .withColumn("coef_variation", round_he(safe_div("price_std", "_mean") * 100.0, 2))
               .drop("_mean"))


# N7 -------------------------------------------------------------------------
def brand_competition(df: DataFrame, r: PanelRoles) -> DataFrame:
    df = v1_margin(df)
    out = _agg(df, [r.brand, r.product], {
        "price_mean": F.avg(r.price), "price_count": F.count(r.price),
        "margin_mean": avg_2dp("margin_pct"), "margin_std": F.stddev_samp("margin_pct")},
        {"price_median": r.price}, {"n_states": F.count_distinct(r.state)})
    tot = F.sum("price_count").over(Window.partitionBy(r.product))
    w = Window.partitionBy(r.product).orderBy(F.col("price_mean").asc())
    return (out.withColumn("market_share", round_he(F.col("price_count") / tot * 100.0, 2))
               .withColumn("price_rank", F.dense_rank().over(w)))


# N8 -------------------------------------------------------------------------
def brand_price_percentile(df: DataFrame, r: PanelRoles) -> DataFrame:
    out = _agg(df, [r.brand, r.region, r.product], {"price_mean": F.avg(r.price)})
    w = Window.partitionBy(r.region, r.product).orderBy("price_mean")
    return out.withColumn("price_percentile", F.cume_dist().over(w) * 100.0)


# N9 -------------------------------------------------------------------------
def brand_margin_analysis(df: DataFrame, r: PanelRoles) -> DataFrame:
    df = v1_margin(df)
    return _agg(df, [r.brand, r.product], {
        "margin_abs_mean": F.avg("margin_abs"), "margin_abs_std": F.stddev_samp("margin_abs"),
        "margin_pct_mean": avg_2dp("margin_pct"), "margin_pct_std": F.stddev_samp("margin_pct")},
        {"margin_abs_median": "margin_abs", "margin_pct_median": "margin_pct"})


# N10 ------------------------------------------------------------------------
def pair_ratio_monthly(df: DataFrame, r: PanelRoles, threshold_pct: float = 70.0) -> DataFrame:
    from .gold import pair_monthly_means
    out = pair_monthly_means(df, r, [r.year, r.month])
    return (out.withColumn("ratio_pct", round_he(safe_div("substitute_price", "reference_price") * 100.0, 2))
               .withColumn("substitute_economic", F.col("ratio_pct") <= F.lit(threshold_pct)))


# N11 ------------------------------------------------------------------------
def product_volatility(df: DataFrame, r: PanelRoles) -> DataFrame:
    m = _agg(df, [r.product, r.year, r.month], {
        "m_mean": F.avg(r.price), "m_std": F.stddev_samp(r.price)})
    m = m.withColumn("cv", round_he(safe_div("m_std", "m_mean") * 100.0, 2))
    return m.groupBy(r.product).agg(avg_2dp("cv").alias("cv_mean"), F.stddev_samp("cv").alias("cv_std"),
                                    F.stddev_samp("m_mean").alias("monthly_mean_std"))


# N12 ------------------------------------------------------------------------
def product_penetration(df: DataFrame, r: PanelRoles) -> DataFrame:
    out = _agg(df, [r.region, r.product], {
        "n_cities": F.count_distinct(r.city), "n_stations": F.count_distinct(r.station),
        "n_obs": F.count(r.price)})
    tot = _agg(df, [r.region], {"_region_cities": F.count_distinct(r.city)})
    return (out.join(tot, r.region, "left")
               .withColumn("city_penetration_pct", round_he(safe_div("n_cities", "_region_cities") * 100.0, 2))
               .drop("_region_cities"))


# N13 ------------------------------------------------------------------------
def _month_of_layer(df: DataFrame, r: PanelRoles, ano: int, mes: int) -> DataFrame:
    """A month's rows by partition values; a row whose date lies in another month is an error."""
    rows = df.filter((F.col("ano") == ano) & (F.col("mes") == mes))
    right = F.coalesce((F.year(r.date) == ano) & (F.month(r.date) == mes), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit(f"partition ano={ano}/mes={mes} holds a row of "), F.coalesce(F.col(r.date).cast("string"), F.lit("no date"))))
    return rows.filter(F.when(right, F.lit(True)).otherwise(wrong.cast("boolean")))


def dashboard_metrics(df: DataFrame, r: PanelRoles, latest: tuple[int, int] | None = None) -> DataFrame:
    """Latest month per product vs the previous calendar month, plus a GERAL row.

    ``latest``: the latest (ano, mes) of a layer partitioned by them, so that both months are
    read by partition; without it they follow from the largest date."""
    df = v1_margin(df)
    if latest is None:
        mx = df.agg(F.max(r.date)).scalar()
        month0 = F.trunc(F.col(r.date), "MM")
        cur, prev = df.filter(month0 == F.trunc(mx, "MM")), df.filter(month0 == F.add_months(F.trunc(mx, "MM"), -1))
    else:
        ano, mes = latest
        cur = _month_of_layer(df, r, ano, mes)
        prev = _month_of_layer(df, r, *((ano, mes - 1) if mes > 1 else (ano - 1, 12)))
        mx = cur.agg(F.max(r.date)).scalar()
    cur, prev = not_null_keys(cur, [r.product]), not_null_keys(prev, [r.product])
    stats = agg_with_quantiles(cur, [r.product], [
        F.avg(r.price).alias("price_mean_current"), F.count(F.lit(1)).alias("n_obs"),
        F.count_distinct(r.state).alias("n_states"), F.count_distinct(r.region).alias("n_regions"),
        avg_2dp("margin_pct").alias("margin_mean")], {"price_median_current": (r.price, 0.5)})
    p = prev.groupBy(r.product).agg(F.avg(r.price).alias("_prev"))
    regs = (not_null_keys(cur, [r.region]).groupBy(r.product, r.region).agg(F.avg(r.price).alias("_m"))
               .groupBy(r.product).agg(first_label_max(r.region, "_m").alias("dearest_region"),
                                       F.max("_m").alias("dearest_region_price")))
    brands = (not_null_keys(cur, [r.brand]).groupBy(r.product, r.brand).agg(F.avg(r.price).alias("_m"))
                 .groupBy(r.product).agg(first_label_min(r.brand, "_m").alias("cheapest_brand"),
                                         F.min("_m").alias("cheapest_brand_price")))
    ref_date = F.date_format(mx, "yyyy-MM-dd")
    per = (stats.join(p, r.product, "left").join(regs, r.product, "left").join(brands, r.product, "left")
                .withColumn("monthly_change_pct", pct_change(F.col("price_mean_current"), F.col("_prev")))
                .drop("_prev").withColumn("ref_date", ref_date)
                .withColumnRenamed(r.product, "product"))
    total = df.agg(
        F.avg(r.price).alias("price_mean_current"), F.count(F.lit(1)).alias("n_obs"),
        F.count_distinct(r.product).alias("n_products"), F.count_distinct(r.brand).alias("n_brands"),
        F.concat(F.date_format(F.min(r.date), "yyyy-MM-dd"), F.lit(" a "),
                 F.date_format(F.max(r.date), "yyyy-MM-dd")).alias("data_period"),
    ).withColumn("product", F.lit("GERAL")).withColumn("ref_date", ref_date)
    return per.unionByName(total, allowMissingColumns=True)


# N14 ------------------------------------------------------------------------
def regional_price_index_rows(df: DataFrame, r: PanelRoles) -> DataFrame:
    from ..operators.enrich import regional_price_index
    out = regional_price_index(not_null_keys(df, [r.region, r.product]), r, r.region, r.product)
    return out.select(*r.key, r.region, r.product, r.price, "regional_price_index")


# A22 ------------------------------------------------------------------------
def price_by_grain(df: DataFrame, r: PanelRoles, grains=("day", "week", "month", "quarter", "year")) -> DataFrame:
    """One pass for all grains: each row is tagged with its period at every
    grain, then a single grouped aggregate (partial aggregation collapses the
    copies map-side)."""
    df = not_null_keys(df, [r.product, r.date])
    tagged = df.select(r.product, r.price, F.explode(F.array(*[
        F.struct(F.lit(g).alias("grain"), F.to_date(F.date_trunc(g, F.col(r.date))).alias("period"))
        for g in grains])).alias("_g")).select(r.product, r.price, "_g.grain", "_g.period")
    return tagged.groupBy("grain", "period", r.product).agg(
        F.avg(r.price).alias("price_mean"), F.count(r.price).alias("n_obs"))


# A23 ------------------------------------------------------------------------
GROUPING_SETS = (("region", "month"), ("state", "product"), ("brand", "product"), ("city", "quarter"))


def price_grouping_sets(df: DataFrame, r: PanelRoles) -> DataFrame:
    """Declared dimension sets in one GROUPING SETS aggregate (one shuffle)."""
    role = {"region": r.region, "month": r.month, "state": r.state, "product": r.product,
            "brand": r.brand, "city": r.city, "quarter": "quarter"}
    cols = list(dict.fromkeys(role[c] for s in GROUPING_SETS for c in s))
    sets = [[F.col(role[c]) for c in s] for s in GROUPING_SETS]
    # Each declared set has one column no other set uses; grouping(col) = 0
    # on that column names the set of the output row.
    label = None
    for s in GROUPING_SETS:
        cond = F.grouping(role[s[0]]) == 0
        lab = "_".join(s)
        label = F.when(cond, F.lit(lab)) if label is None else label.when(cond, F.lit(lab))
    # A row whose key is null in a set it belongs to is no group of that set (K24); it is
    # told from a column that the set leaves out by grouping().
    real = F.lit(True)
    for c in cols:
        real = real & ((F.grouping(c) == 1) | F.col(c).isNotNull())
    return (df.groupingSets(sets, *cols)
              .agg(F.avg(r.price).alias("price_mean"), F.count(r.price).alias("n_obs"),
                   label.alias("grouping_set"), real.alias("_real"))
              .filter("_real").drop("_real"))


# A24 ------------------------------------------------------------------------
def mean_price_state_month(df: DataFrame, r: PanelRoles) -> DataFrame:
    keys = [r.state, r.year, r.month, r.product]
    return not_null_keys(df, keys).groupBy(*keys).agg(
        F.avg(r.price).alias("price_mean"), F.count(r.price).alias("n_obs"))


QUERIES = {
    "price_summary_cube": price_summary_cube,
    "monthly_change": monthly_change,
    "seasonal_index": seasonal_index,
    "annual_growth_presence": annual_growth_presence,
    "regional_dense_ranking": regional_dense_ranking,
    "state_vs_region": state_vs_region,
    "regional_dispersion": regional_dispersion,
    "brand_competition": brand_competition,
    "brand_price_percentile": brand_price_percentile,
    "brand_margin_analysis": brand_margin_analysis,
    "pair_ratio_monthly": pair_ratio_monthly,
    "product_volatility": product_volatility,
    "product_penetration": product_penetration,
    "dashboard_metrics": dashboard_metrics,
    "regional_price_index": regional_price_index_rows,
    "price_by_grain": price_by_grain,
    "price_grouping_sets": price_grouping_sets,
    "mean_price_state_month": mean_price_state_month,
}

# Float outputs presented at 6 dp by the registry (sum-order dependent).
STABLE = {
    "price_summary_cube": ["price_mean", "price_std", "cost_mean", "margin_mean", "price_median",
                           "cost_median", "margin_median"],
    "monthly_change": ["price_mean", "price_std", "cost_mean", "margin_mean", "price_median",
                       "monthly_change_pct"],
    "seasonal_index": ["price_mean", "overall_mean"],
    "annual_growth_presence": ["price_mean", "price_std", "margin_mean", "annual_growth_pct"],
    "regional_dense_ranking": ["price_mean", "price_std", "price_median"],
    "state_vs_region": ["price_mean", "margin_mean", "regional_mean", "regional_diff_pct"],
    "regional_dispersion": ["price_std"],
    "brand_competition": ["price_mean", "margin_mean", "margin_std", "price_median"],
    "brand_price_percentile": ["price_mean", "price_percentile"],
    "brand_margin_analysis": ["margin_abs_mean", "margin_abs_std", "margin_pct_mean", "margin_pct_std",
                              "margin_abs_median", "margin_pct_median"],
    "pair_ratio_monthly": ["substitute_price", "reference_price"],
    "product_volatility": ["cv_mean", "cv_std", "monthly_mean_std"],
    "price_by_grain": ["price_mean"],
    "price_grouping_sets": ["price_mean"],
    "mean_price_state_month": ["price_mean"],
    "dashboard_metrics": ["price_mean_current", "price_median_current", "margin_mean",
                          "monthly_change_pct", "dearest_region_price", "cheapest_brand_price"],
}


def oracle(r: PanelRoles) -> dict:
    R = S.r
    sub, ref = r.pair
    nn = lambda *ks: " AND ".join(f"{k} IS NOT NULL" for k in ks)
    v1 = f"(SELECT * REPLACE ({R('margin_pct', 2)} AS margin_pct) FROM silver)"
    grains = ["day", "week", "month", "quarter", "year"]
    return {
        "price_summary_cube": f"""
SELECT year, month, region_norm, state, product_norm, brand_norm,
  avg(price) AS price_mean, quantile_cont(price, 0.5) AS price_median, min(price) AS price_min,
  max(price) AS price_max, stddev_samp(price) AS price_std, count(price) AS n_obs,
  avg(cost) AS cost_mean, quantile_cont(cost, 0.5) AS cost_median,
  (sum(round_even(margin_pct * 100.0, 0)) / count(margin_pct) / 100.0) AS margin_mean, quantile_cont(margin_pct, 0.5) AS margin_median,
  count(DISTINCT city) AS n_cities, count(DISTINCT station) AS n_stations
FROM {v1} s WHERE {nn('year','month','region_norm','state','product_norm','brand_norm')}
GROUP BY year, month, region_norm, state, product_norm, brand_norm""",
        "monthly_change": f"""
SELECT *, (price_mean / NULLIF(lag(price_mean) OVER (PARTITION BY product_norm ORDER BY year, month), 0) - 1.0) * 100.0 AS monthly_change_pct
FROM (SELECT year, month, product_norm, avg(price) AS price_mean, quantile_cont(price, 0.5) AS price_median,
             stddev_samp(price) AS price_std, count(price) AS price_count, avg(cost) AS cost_mean,
             (sum(round_even(margin_pct * 100.0, 0)) / count(margin_pct) / 100.0) AS margin_mean
      FROM {v1} s WHERE {nn('year','month','product_norm')} GROUP BY year, month, product_norm)""",
        "seasonal_index": f"""
SELECT m.*, o.overall_mean, {R('m.price_mean / NULLIF(o.overall_mean, 0) * 100.0', 2)} AS seasonal_index
FROM (SELECT month, product_norm, avg(price) AS price_mean FROM silver
      WHERE {nn('month','product_norm')} GROUP BY month, product_norm) m
LEFT JOIN (SELECT product_norm, avg(price) AS overall_mean FROM silver WHERE product_norm IS NOT NULL
           GROUP BY product_norm) o ON m.product_norm = o.product_norm""",
        "annual_growth_presence": f"""
SELECT *, (price_mean / NULLIF(lag(price_mean) OVER (PARTITION BY product_norm ORDER BY year), 0) - 1.0) * 100.0 AS annual_growth_pct
FROM (SELECT year, product_norm, avg(price) AS price_mean, stddev_samp(price) AS price_std,
             (sum(round_even(margin_pct * 100.0, 0)) / count(margin_pct) / 100.0) AS margin_mean, count(DISTINCT city) AS n_cities, count(DISTINCT station) AS n_stations
      FROM {v1} s WHERE {nn('year','product_norm')} GROUP BY year, product_norm)""",
        "regional_dense_ranking": f"""
SELECT *, CAST(dense_rank() OVER (PARTITION BY product_norm ORDER BY price_mean DESC) AS INTEGER) AS price_rank
FROM (SELECT region_norm, product_norm, avg(price) AS price_mean, quantile_cont(price, 0.5) AS price_median,
             stddev_samp(price) AS price_std, count(DISTINCT city) AS n_cities, count(DISTINCT station) AS n_stations
      FROM silver WHERE {nn('region_norm','product_norm')} GROUP BY region_norm, product_norm)""",
        "state_vs_region": f"""
SELECT s.*, g.regional_mean, (s.price_mean / NULLIF(g.regional_mean, 0) - 1.0) * 100.0 AS regional_diff_pct
FROM (SELECT region_norm, state, product_norm, avg(price) AS price_mean, (sum(round_even(margin_pct * 100.0, 0)) / count(margin_pct) / 100.0) AS margin_mean
      FROM {v1} s WHERE {nn('region_norm','state','product_norm')} GROUP BY region_norm, state, product_norm) s
LEFT JOIN (SELECT region_norm, product_norm, avg(price) AS regional_mean FROM silver
           WHERE {nn('region_norm','product_norm')} GROUP BY region_norm, product_norm) g
  ON s.region_norm = g.region_norm AND s.product_norm = g.product_norm""",
        "regional_dispersion": f"""
SELECT region_norm, product_norm, min(price) AS price_min, max(price) AS price_max,
       stddev_samp(price) AS price_std, max(price) - min(price) AS amplitude,
       {R('stddev_samp(price) / NULLIF(avg(price), 0) * 100.0', 2)} AS coef_variation
FROM silver WHERE {nn('region_norm','product_norm')} GROUP BY region_norm, product_norm""",
        "brand_competition": f"""
SELECT *, {R('price_count / sum(price_count) OVER (PARTITION BY product_norm) * 100.0', 2)} AS market_share,
       CAST(dense_rank() OVER (PARTITION BY product_norm ORDER BY price_mean ASC) AS INTEGER) AS price_rank
FROM (SELECT brand_norm, product_norm, avg(price) AS price_mean, quantile_cont(price, 0.5) AS price_median,
             count(price) AS price_count, (sum(round_even(margin_pct * 100.0, 0)) / count(margin_pct) / 100.0) AS margin_mean, stddev_samp(margin_pct) AS margin_std,
             count(DISTINCT state) AS n_states
      FROM {v1} s WHERE {nn('brand_norm','product_norm')} GROUP BY brand_norm, product_norm)""",
        "brand_price_percentile": f"""
SELECT *, cume_dist() OVER (PARTITION BY region_norm, product_norm ORDER BY price_mean) * 100.0 AS price_percentile
FROM (SELECT brand_norm, region_norm, product_norm, avg(price) AS price_mean FROM silver
      WHERE {nn('brand_norm','region_norm','product_norm')} GROUP BY brand_norm, region_norm, product_norm)""",
        "brand_margin_analysis": f"""
SELECT brand_norm, product_norm, avg(margin_abs) AS margin_abs_mean, quantile_cont(margin_abs, 0.5) AS margin_abs_median,
       stddev_samp(margin_abs) AS margin_abs_std, (sum(round_even(margin_pct * 100.0, 0)) / count(margin_pct) / 100.0) AS margin_pct_mean,
       quantile_cont(margin_pct, 0.5) AS margin_pct_median, stddev_samp(margin_pct) AS margin_pct_std
FROM {v1} s WHERE {nn('brand_norm','product_norm')} GROUP BY brand_norm, product_norm""",
        "pair_ratio_monthly": f"""
SELECT *, ratio_pct <= 70.0 AS substitute_economic FROM (
  SELECT *, {R('substitute_price / NULLIF(reference_price, 0) * 100.0', 2)} AS ratio_pct FROM (
    SELECT year, month,
           avg(CASE WHEN product_norm = {S.q(sub)} THEN price END) AS substitute_price,
           avg(CASE WHEN product_norm = {S.q(ref)} THEN price END) AS reference_price
    FROM silver WHERE product_norm IN ({S.q(sub)}, {S.q(ref)}) AND {nn('year','month')}
    GROUP BY year, month))""",
        "product_volatility": f"""
SELECT product_norm, sum(round_even(cv * 100.0, 0)) / count(cv) / 100.0 AS cv_mean, stddev_samp(cv) AS cv_std, stddev_samp(m_mean) AS monthly_mean_std
FROM (SELECT product_norm, year, month, avg(price) AS m_mean,
             {R('stddev_samp(price) / NULLIF(avg(price), 0) * 100.0', 2)} AS cv
      FROM silver WHERE {nn('product_norm','year','month')} GROUP BY product_norm, year, month)
GROUP BY product_norm""",
        "product_penetration": f"""
SELECT p.*, {R('p.n_cities / NULLIF(t.rc, 0) * 100.0', 2)} AS city_penetration_pct
FROM (SELECT region_norm, product_norm, count(DISTINCT city) AS n_cities, count(DISTINCT station) AS n_stations,
             count(price) AS n_obs
      FROM silver WHERE {nn('region_norm','product_norm')} GROUP BY region_norm, product_norm) p
LEFT JOIN (SELECT region_norm, count(DISTINCT city) AS rc FROM silver WHERE region_norm IS NOT NULL
           GROUP BY region_norm) t ON p.region_norm = t.region_norm""",
        "dashboard_metrics": ([f"v AS (SELECT * FROM {v1} s)", "mx AS (SELECT max(obs_date) AS d FROM v)", f"""

cur AS (SELECT v.* FROM v, mx WHERE date_trunc('month', v.obs_date) = date_trunc('month', mx.d) AND v.product_norm IS NOT NULL),
prv AS (SELECT v.* FROM v, mx WHERE date_trunc('month', v.obs_date) = date_trunc('month', mx.d) - INTERVAL 1 MONTH
        AND v.product_norm IS NOT NULL),
st AS (SELECT product_norm, avg(price) AS price_mean_current, quantile_cont(price, 0.5) AS price_median_current,
              count(*) AS n_obs, count(DISTINCT state) AS n_states, count(DISTINCT region_norm) AS n_regions,
              (sum(round_even(margin_pct * 100.0, 0)) / count(margin_pct) / 100.0) AS margin_mean FROM cur GROUP BY product_norm),
pv AS (SELECT product_norm, avg(price) AS p FROM prv GROUP BY product_norm),
rg AS (SELECT product_norm, arg_min(region_norm, (-m, region_norm)) AS dearest_region, max(m) AS dearest_region_price
       FROM (SELECT product_norm, region_norm, avg(price) AS m FROM cur WHERE region_norm IS NOT NULL GROUP BY ALL)
       GROUP BY product_norm),
br AS (SELECT product_norm, arg_min(brand_norm, (m, brand_norm)) AS cheapest_brand, min(m) AS cheapest_brand_price
       FROM (SELECT product_norm, brand_norm, avg(price) AS m FROM cur WHERE brand_norm IS NOT NULL GROUP BY ALL)
       GROUP BY product_norm)"""], """
SELECT st.product_norm AS product, price_mean_current, price_median_current, n_obs, n_states, n_regions,
       margin_mean, strftime(mx.d, '%Y-%m-%d') AS ref_date,
       (price_mean_current / NULLIF(pv.p, 0) - 1.0) * 100.0 AS monthly_change_pct,
       dearest_region, dearest_region_price, cheapest_brand, cheapest_brand_price,
       CAST(NULL AS BIGINT) AS n_products, CAST(NULL AS BIGINT) AS n_brands, CAST(NULL AS VARCHAR) AS data_period
FROM st CROSS JOIN mx LEFT JOIN pv USING (product_norm) LEFT JOIN rg USING (product_norm) LEFT JOIN br USING (product_norm)
UNION ALL
SELECT 'GERAL', avg(price), NULL, count(*), NULL, NULL, NULL, strftime(max(obs_date), '%Y-%m-%d'), NULL, NULL, NULL,
       NULL, NULL, count(DISTINCT product_norm), count(DISTINCT brand_norm),
       strftime(min(obs_date), '%Y-%m-%d') || ' a ' || strftime(max(obs_date), '%Y-%m-%d')
FROM v"""),
        "regional_price_index": f"""
SELECT {', '.join(r.key)}, region_norm, product_norm, price,
       {R('price / NULLIF(avg(price) OVER (PARTITION BY region_norm, product_norm), 0) * 100.0', 2)} AS regional_price_index
FROM silver WHERE {nn('region_norm','product_norm')}""",
        "price_by_grain": "\nUNION ALL\n".join(f"""
SELECT '{g}' AS grain, CAST(date_trunc('{g}', obs_date) AS DATE) AS period, product_norm,
       avg(price) AS price_mean, count(price) AS n_obs
FROM silver WHERE {nn('product_norm','obs_date')} GROUP BY ALL""" for g in grains),
        "price_grouping_sets": f"""
SELECT region_norm, month, state, product_norm, brand_norm, city, quarter,
       avg(price) AS price_mean, count(price) AS n_obs,
       CASE WHEN grouping(region_norm) = 0 THEN 'region_month' WHEN grouping(state) = 0 THEN 'state_product'
            WHEN grouping(brand_norm) = 0 THEN 'brand_product' WHEN grouping(city) = 0 THEN 'city_quarter'
       END AS grouping_set
FROM silver
GROUP BY GROUPING SETS ((region_norm, month), (state, product_norm), (brand_norm, product_norm), (city, quarter))
HAVING {" AND ".join(f"(grouping({c}) = 1 OR {c} IS NOT NULL)" for c in
                     ("region_norm", "month", "state", "product_norm", "brand_norm", "city", "quarter"))}""",
        "mean_price_state_month": f"""
SELECT state, year, month, product_norm, avg(price) AS price_mean, count(price) AS n_obs
FROM silver WHERE {nn('state','year','month','product_norm')} GROUP BY state, year, month, product_norm""",
    }
