"""Registered queries of incremental Gold: the layer's months are computed once, one month
changes, one goes, and the datasets are merged from the states of all."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import STAR, silver_roles
from ..session import scratch_path
from ..sources import files
from . import gold, incremental_gold
from .silver import silver_sql_ctes, star_silver
from . import sqlgen as S

SR = silver_roles(STAR)
#: The month whose prices change, and the one that goes.
CHANGED, GONE = (1996, 3), (1996, 5)
#: One dataset of each family, so that means, deviations, medians, distinct counts and ranges
#: are all merged; tests hold all fifteen against a full run.
DATASETS = ["monthly_price_evolution", "regional_analysis", "brand_positioning", "category_analysis"]


def changed_layer(spark, d) -> tuple[str, str, list]:
    """(Silver's path, the states' path, the months of the last refresh)."""
    layer, root = scratch_path(spark, "silver"), scratch_path(spark, "gold-states")
    rows = scratch_path(spark, "rows")
    silver = star_silver(spark, d, checkpoint=rows).withColumns({"ano": F.col("year"), "mes": F.col("month")})
    files.write_layer(silver, layer, clustered=True)
    files.delete_path(spark, rows)
    incremental_gold.refresh(spark, layer, SR, root)
    staged = scratch_path(spark, "silver-month")
    month = files.read_layer(spark, layer).where((F.col("ano") == CHANGED[0]) & (F.col("mes") == CHANGED[1]))
    month.withColumn("price", F.col("price") * 1.5).write.parquet(staged)
    files.write_layer(spark.read.parquet(staged), layer)
    files.delete_path(spark, f"{layer}/ano={GONE[0]}/mes={GONE[1]}")
    return layer, root, incremental_gold.refresh(spark, layer, SR, root)


def _query(name):
    def run(spark, d):
        _, root, _ = changed_layer(spark, d)
        return incremental_gold.datasets(spark, SR, root)[name]
    return run


QUERIES = {f"incremental_{n}": _query(n) for n in DATASETS}


def oracle() -> dict:
    *before, last = silver_sql_ctes()
    changed = f"""silver AS (SELECT * REPLACE (CASE WHEN year = {CHANGED[0]} AND month = {CHANGED[1]} THEN price * 1.5
        ELSE price END AS price) FROM silver0 WHERE NOT (year = {GONE[0]} AND month = {GONE[1]}))"""
    sql = gold.oracle(SR)
    return {f"incremental_{n}": S.with_ctes(*before, last.replace("silver AS (", "silver0 AS (", 1), changed, body=sql[n])
            for n in DATASETS}


STABLE = {}
