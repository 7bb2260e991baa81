"""Dashboard aggregations (D1-D12, O4-O6, J2) over a monthly dashboard frame.

The dashboard frame is the Silver panel aggregated to (year, month, state,
region, product, brand) with mean price, mean margin and distinct stations;
every chart aggregation is a further (small) aggregate of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PanelRoles
from ..functions import avg_fixed, not_null_keys, round_he, safe_div
from . import sqlgen as S

DASH_KEYS = ["year", "month", "state", "region", "product", "brand"]


def dash_frame(df: DataFrame, r: PanelRoles) -> DataFrame:
    keys = [r.year, r.month, r.state, r.region, r.product, r.brand]
    out = not_null_keys(df, keys).groupBy(*keys).agg(
        F.avg(r.price).alias("price_mean"), F.avg("margin_pct").alias("margin_pct"),
        F.count_distinct(r.station).alias("n_stations"))
    return (out.select(*[F.col(k).alias(n) for k, n in zip(keys, DASH_KEYS)],
                       "price_mean", "margin_pct", "n_stations")
               .withColumn("date", F.make_date("year", "month", F.lit(1))))


def dash_evolution(d: DataFrame, r: PanelRoles) -> DataFrame:
    return d.groupBy("date", "product").agg(F.avg("price_mean").alias("price_mean"))


def dash_regional_main(d: DataFrame, r: PanelRoles) -> DataFrame:
    return (d.filter(F.col("product").isin(*r.main_products))
             .groupBy("region", "product").agg(F.avg("price_mean").alias("price_mean")))


def viability_by_state_month(d: DataFrame, r: PanelRoles) -> DataFrame:
    """Each substitute row vs the mean reference price of its state-month
    (inner: rows without a reference price are left out)."""
    sub, ref = r.pair
    keys = ["state", "year", "month"]
    refm = d.filter(F.col("product") == ref).groupBy(*keys).agg(F.avg("price_mean").alias("_ref"))
    out = d.filter(F.col("product") == sub).join(refm, keys, "inner")
    ratio = safe_div(F.col("price_mean"), F.col("_ref"))
    return out.select(*keys, ratio.alias("pair_ratio"),
                      (ratio <= F.lit(r.pair_threshold)).alias("substitute_viable"))


def dash_viability_summary(d: DataFrame, r: PanelRoles) -> DataFrame:
    v = viability_by_state_month(d, r)
    out = v.groupBy("state").agg(F.count_if("substitute_viable").cast("long").alias("viable_cases"),
                                 F.count(F.lit(1)).cast("long").alias("total_cases"),
                                 round_he(F.avg("pair_ratio"), 3).alias("ratio_mean"))
    return out.withColumn("viable_pct", round_he(safe_div("viable_cases", "total_cases") * 100.0, 1))


def dash_market_share(d: DataFrame, r: PanelRoles, product: str | None = None) -> DataFrame:
    product = product or r.pair[1]
    s = d.groupBy("brand", "product").agg(F.sum("n_stations").alias("n_stations"))
    s = s.withColumn("market_share_pct", round_he(
        F.col("n_stations") / F.sum("n_stations").over(Window.partitionBy("product")) * 100.0, 1))
    return s.filter(F.col("product") == product)


def dash_seasonal(d: DataFrame, r: PanelRoles) -> DataFrame:
    return (d.filter(F.col("product").isin(*r.pair))
             .groupBy("month", "product").agg(F.avg("price_mean").alias("price_mean")))


def dash_kpis(d: DataFrame, r: PanelRoles) -> DataFrame:
    sub, ref = r.pair
    k = d.agg(F.avg(F.when(F.col("product") == ref, F.col("price_mean"))).alias("reference_price"),
              F.avg(F.when(F.col("product") == sub, F.col("price_mean"))).alias("substitute_price"),
              F.sum("n_stations").alias("total_stations"))
    ratio = safe_div("substitute_price", "reference_price")
    return (k.withColumn("pair_ratio", ratio)
             .withColumn("substitute_viable", F.col("pair_ratio") <= F.lit(r.pair_threshold)))


def dash_regional_rank(d: DataFrame, r: PanelRoles, product: str | None = None) -> DataFrame:
    product = product or r.pair[1]
    g = (d.filter(F.col("product") == product)
          .groupBy("region", "product").agg(F.avg("price_mean").alias("price_mean")))
    return g.withColumn("position", F.row_number().over(
        Window.partitionBy("product").orderBy("price_mean", "region")))


def dash_overall_viability(d: DataFrame, r: PanelRoles) -> DataFrame:
    v = viability_by_state_month(d, r)
    return v.agg((F.avg(F.col("substitute_viable").cast("double")) * 100.0).alias("overall_viability_pct"))


def best_viability_state(d: DataFrame, r: PanelRoles) -> DataFrame:
    """State with the highest viable share; first state wins ties."""
    v = viability_by_state_month(d, r)
    s = v.groupBy("state").agg(F.avg(F.col("substitute_viable").cast("double")).alias("viability_rate"))
    return s.orderBy(F.col("viability_rate").desc(), F.col("state")).limit(1)


def dash_brand_positioning(d: DataFrame, r: PanelRoles, product: str | None = None) -> DataFrame:
    product = product or r.pair[1]
    g = (d.groupBy("brand", "product").agg(F.avg("price_mean").alias("price_mean"),
                                           F.sum("n_stations").alias("n_stations"))
          .filter(F.col("product") == product))
    w = Window.partitionBy("product")
    q33 = F.percentile("price_mean", 0.33).over(w)
    q67 = F.percentile("price_mean", 0.67).over(w)
    strat = (F.when(F.col("price_mean") > q67, F.lit("Premium"))
              .when(F.col("price_mean") < q33, F.lit("Econômico")).otherwise(F.lit("Médio")))
    return g.withColumn("price_strategy", strat)


def dash_brand_avg(df: DataFrame, r: PanelRoles) -> DataFrame:
    """v1 brand chart: mean market share and mean of mean price per brand."""
    bc = not_null_keys(df, [r.brand, r.product]).groupBy(r.brand, r.product).agg(
        F.avg(r.price).alias("price_mean"), F.count(r.price).alias("price_count"))
    bc = bc.withColumn("market_share", round_he(
        F.col("price_count") / F.sum("price_count").over(Window.partitionBy(r.product)) * 100.0, 2))
    return bc.groupBy(r.brand).agg(avg_fixed("market_share", 2).alias("market_share_mean"),
                                   F.avg("price_mean").alias("price_mean"))


def slice_filter(d: DataFrame, years, products, regions) -> DataFrame:
    """Years x products x regions; on a year-partitioned table the
    year predicate prunes partitions."""
    return d.filter(F.col("year").isin(*years) & F.col("product").isin(*products)
                    & F.col("region").isin(*regions))


def latest_years_slice(d: DataFrame, n: int = 2) -> DataFrame:
    """Rows of the latest ``n`` years (semi-join with a bounded n-row list)."""
    years = d.select("year").distinct().orderBy(F.col("year").desc()).limit(n)
    return d.join(F.broadcast(years), "year", "left_semi")


def top_k_ranking(df: DataFrame, r: PanelRoles, k: int = 10) -> DataFrame:
    """The k states with the highest mean price (the limit is the feature)."""
    g = not_null_keys(df, [r.state]).groupBy(r.state).agg(
        round_he(F.avg(r.price), 3).alias("price_mean"), F.count(r.price).alias("n_obs"))
    return g.orderBy(F.col("price_mean").desc(), F.col(r.state)).limit(k)


def dash_sql(r: PanelRoles) -> str:
    """CTE ``dash`` over ``silver``."""
    return f"""dash AS (
  SELECT year, month, state, region_norm AS region, product_norm AS product, brand_norm AS brand,
         avg(price) AS price_mean, avg(margin_pct) AS margin_pct, count(DISTINCT station) AS n_stations,
         make_date(year, month, 1) AS date
  FROM silver WHERE year IS NOT NULL AND month IS NOT NULL AND state IS NOT NULL AND region_norm IS NOT NULL
    AND product_norm IS NOT NULL AND brand_norm IS NOT NULL
  GROUP BY year, month, state, region_norm, product_norm, brand_norm)"""


def viab_sql(r: PanelRoles) -> str:
    sub, ref = r.pair
    return f"""viab AS (
  SELECT d.state, d.year, d.month, d.price_mean / NULLIF(m.ref, 0) AS pair_ratio,
         d.price_mean / NULLIF(m.ref, 0) <= {r.pair_threshold!r} AS substitute_viable
  FROM dash d JOIN (SELECT state, year, month, avg(price_mean) AS ref FROM dash WHERE product = {S.q(ref)}
                    GROUP BY state, year, month) m
    ON d.state = m.state AND d.year = m.year AND d.month = m.month
  WHERE d.product = {S.q(sub)})"""


def oracle(r: PanelRoles, slice_params: dict) -> dict:
    R = S.r
    sub, ref = r.pair
    D, V = dash_sql(r), viab_sql(r)
    yrs, prods, regs = slice_params["years"], slice_params["products"], slice_params["regions"]
    return {
        "dash_evolution": ([D], "SELECT date, product, avg(price_mean) AS price_mean FROM dash GROUP BY date, product"),
        "dash_regional_main": ([D], f"""SELECT region, product, avg(price_mean) AS price_mean FROM dash
            WHERE product IN {S.in_list(r.main_products)} GROUP BY region, product"""),
        "viability_by_state_month": ([D, V], "SELECT * FROM viab"),
        "dash_viability_summary": ([D, V], f"""SELECT *, {R('viable_cases / NULLIF(total_cases, 0) * 100.0', 1)} AS viable_pct
            FROM (SELECT state, CAST(count_if(substitute_viable) AS BIGINT) AS viable_cases, count(*) AS total_cases,
                         {R('avg(pair_ratio)', 3)} AS ratio_mean FROM viab GROUP BY state)"""),
        "dash_market_share": ([D], f"""SELECT * FROM (
            SELECT brand, product, CAST(sum(n_stations) AS BIGINT) AS n_stations,
                   {R('sum(n_stations) / sum(sum(n_stations)) OVER (PARTITION BY product) * 100.0', 1)} AS market_share_pct
            FROM dash GROUP BY brand, product) WHERE product = {S.q(ref)}"""),
        "dash_seasonal": ([D], f"""SELECT month, product, avg(price_mean) AS price_mean FROM dash
            WHERE product IN ({S.q(sub)}, {S.q(ref)}) GROUP BY month, product"""),
        "dash_kpis": ([D], f"""SELECT *, substitute_price / NULLIF(reference_price, 0) AS pair_ratio,
              substitute_price / NULLIF(reference_price, 0) <= {r.pair_threshold!r} AS substitute_viable
            FROM (SELECT avg(CASE WHEN product = {S.q(ref)} THEN price_mean END) AS reference_price,
                         avg(CASE WHEN product = {S.q(sub)} THEN price_mean END) AS substitute_price,
                         CAST(sum(n_stations) AS BIGINT) AS total_stations FROM dash)"""),
        "dash_regional_rank": ([D], f"""SELECT *, CAST(row_number() OVER (PARTITION BY product ORDER BY price_mean, region) AS INTEGER) AS position
            FROM (SELECT region, product, avg(price_mean) AS price_mean FROM dash WHERE product = {S.q(ref)}
                  GROUP BY region, product)"""),
        "dash_overall_viability": ([D, V], "SELECT avg(CAST(substitute_viable AS DOUBLE)) * 100.0 AS overall_viability_pct FROM viab"),
        "best_viability_state": ([D, V], """SELECT state, avg(CAST(substitute_viable AS DOUBLE)) AS viability_rate
            FROM viab GROUP BY state ORDER BY viability_rate DESC, state LIMIT 1"""),
        "dash_brand_positioning": ([D], f"""SELECT *, CASE
              WHEN price_mean > quantile_cont(price_mean, 0.67) OVER (PARTITION BY product) THEN 'Premium'
              WHEN price_mean < quantile_cont(price_mean, 0.33) OVER (PARTITION BY product) THEN 'Econômico'
              ELSE 'Médio' END AS price_strategy
            FROM (SELECT brand, product, avg(price_mean) AS price_mean, CAST(sum(n_stations) AS BIGINT) AS n_stations
                  FROM dash GROUP BY brand, product) WHERE product = {S.q(ref)}"""),
        "dash_brand_avg": ([f"""v1 AS (SELECT * REPLACE ({R('margin_pct', 2)} AS margin_pct) FROM silver)""",
                            """bc AS (SELECT brand_norm, product_norm, avg(price) AS price_mean, count(price) AS price_count
                                      FROM v1 WHERE brand_norm IS NOT NULL AND product_norm IS NOT NULL GROUP BY ALL)"""],
                           f"""SELECT brand_norm, sum(round_even(market_share * 100.0, 0)) / count(market_share) / 100.0 AS market_share_mean, avg(price_mean) AS price_mean
            FROM (SELECT *, {R('price_count / sum(price_count) OVER (PARTITION BY product_norm) * 100.0', 2)} AS market_share FROM bc)
            GROUP BY brand_norm"""),
        "slice_filter": ([D], f"""SELECT * FROM dash WHERE year IN ({', '.join(str(y) for y in yrs)})
            AND product IN {S.in_list(prods)} AND region IN {S.in_list(regs)}"""),
        "latest_years_slice": ([D], """SELECT * FROM dash WHERE year IN (SELECT DISTINCT year FROM dash ORDER BY year DESC LIMIT 2)"""),
        "top_k_ranking": ([], f"""SELECT state, {R('avg(price)', 3)} AS price_mean, count(price) AS n_obs FROM silver
            WHERE state IS NOT NULL GROUP BY state ORDER BY price_mean DESC, state LIMIT 10"""),
    }
