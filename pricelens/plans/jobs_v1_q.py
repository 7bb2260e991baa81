"""Registered queries of the first generation's layers, and its analytics by category."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..session import scratch_path
from ..sources import files
from ..sources.panel import PANEL_SQL, star_panel
from . import gold_v1, jobs_v1, silver_v1
from . import sqlgen as S
from .stages import DIRTY_V1_SQL, KEY, dirty_raw_v1, star_v1, v1_ctes

LOAD_TS, BATCH = "2024-01-01 00:00:00", "batch_20240101_000000"
#: The star panel's product categories take the place of the fuels in the pair ratio.
ROLES = silver_v1.ROLES.with_(pair=("BUDGET", "SIZED"))
#: v1 Silver's columns as the oracle of the analytics names them.
NAMES = {"ano": "year", "mes": "month", "regiao_sigla": "region_norm", "estado_sigla": "state",
         "categoria_produto": "product_norm", "categoria_bandeira": "brand_norm", "municipio": "city",
         "revenda": "station", "valor_venda": "price", "valor_compra": "cost", "data_coleta": "obs_date"}
ANALYTICS = [n for n in jobs_v1.GOLD if n != "dashboard_metrics"]


def _bronze(spark, d):
    raw = dirty_raw_v1(star_panel(spark, d))
    return jobs_v1.ingest(raw, BATCH, LOAD_TS, "raw", star_v1(spark, d))


def q_bronze_write_v1(spark, d):
    """The written Bronze rows with their batch, by year and region."""
    out = scratch_path(spark, "bronze-v1")
    jobs_v1.write_bronze(_bronze(spark, d), out)
    return files.read_layer(spark, out).select(*KEY, "ano", "semestre", "regiao", "valor_venda", *jobs_v1.META)


def _silver(spark, d, by):
    return silver_v1.build_silver_v1(dirty_raw_v1(star_panel(spark, d)), star_v1(spark, d), by)


def _write_silver(spark, d, root):
    return jobs_v1.write_silver(_silver(spark, d, jobs_v1.silver_parts()), root, clustered=True)


def q_silver_write_v1(spark, d):
    """The written observations by year, region and category."""
    paths = _write_silver(spark, d, scratch_path(spark, "silver-v1"))
    return files.read_layer(spark, paths["observations"]).select(*KEY, *jobs_v1.SILVER_PARTS, "valor_venda", "margin_pct")


def q_silver_summary_v1(spark, d):
    """The summary beside them, read as one dataset."""
    paths = _write_silver(spark, d, scratch_path(spark, "silver-v1"))
    return _named(spark.read.parquet(paths["fuel_summary"]))


def q_gold_write_v1(spark, d):
    """Which folder each dataset went to, and its rows."""
    root = scratch_path(spark, "v1")
    _write_silver(spark, d, f"{root}/silver")
    out = jobs_v1.write_gold(spark, f"{root}/silver", f"{root}/gold", ROLES)
    return out.select("category", "dataset", "records", F.col("path").isNotNull().alias("written"))


def q_run_v1(spark, d):
    """The three jobs of the first generation, one after the other."""
    return jobs_v1.run(spark, dirty_raw_v1(star_panel(spark, d)), scratch_path(spark, "v1"), BATCH, LOAD_TS, "raw",
                       star_v1(spark, d), ROLES)


def _named(df):
    return df.withColumnsRenamed({k: v for k, v in NAMES.items() if k in df.columns})


def _analytic(name):
    def run(spark, d):
        # its clean rows are written once: a dataset takes several passes
        silver = _silver(spark, d, []).select(*NAMES, "margin_abs", "margin_pct")
        return _named(gold_v1.QUERIES[name](silver, ROLES))
    return run


QUERIES = {
    "bronze_write_v1": q_bronze_write_v1, "silver_write_v1": q_silver_write_v1, "silver_summary_v1": q_silver_summary_v1,
    "gold_write_v1": q_gold_write_v1, "run_v1": q_run_v1,
    **{f"v1_{n}": _analytic(n) for n in ANALYTICS},
}

STABLE = {**{f"v1_{n}": cols for n, cols in gold_v1.STABLE.items() if n in ANALYTICS},
          "silver_summary_v1": gold_v1.STABLE["price_summary_cube"], "silver_write_v1": ["margin_pct"]}


def oracle() -> dict:
    names = ", ".join(f"{k} AS {v}" for k, v in NAMES.items())
    silver = f"silver AS (SELECT {names}, margin_pct, valor_venda - valor_compra AS margin_abs FROM v1_silver)"
    sql = gold_v1.oracle(ROLES)

    def V(body, *ctes):
        return S.with_ctes(PANEL_SQL, *DIRTY_V1_SQL, *v1_ctes(), silver, *ctes, body=body)

    bronze = "(SELECT count(*) FROM std)"
    ctes, parts = [], []
    for n in jobs_v1.GOLD:
        extra, body = sql[n] if isinstance(sql[n], tuple) else ((), sql[n])
        ctes += [c for c in extra if c not in ctes]
        parts.append(f"SELECT '{jobs_v1.category(n)}' AS category, '{n}' AS dataset, (SELECT count(*) FROM ({body}\n) AS g) AS records")
    gold = "gold AS (" + " UNION ALL ".join(parts) + ")"
    key = ", ".join(KEY)
    meta = f"'raw' AS _source_file, CAST(TIMESTAMP '{LOAD_TS}' AS TIMESTAMP) AS _ingestion_timestamp, '{BATCH}' AS _batch_id"
    null = "CAST(NULL AS VARCHAR) AS error"
    return {
        "bronze_write_v1": V(f"""SELECT {key}, CAST(year(data_coleta) AS INTEGER) AS ano,
            CAST(CASE WHEN month(data_coleta) <= 6 THEN 1 WHEN month(data_coleta) > 6 THEN 2 END AS INTEGER) AS semestre,
            regiao_sigla AS regiao, valor_venda, {meta} FROM std"""),
        "silver_write_v1": V(f"SELECT {key}, ano, regiao_sigla AS regiao, categoria_produto, valor_venda, margin_pct FROM v1_silver"),
        "silver_summary_v1": V(sql["price_summary_cube"]),
        "gold_write_v1": V("SELECT category, dataset, records, records > 0 AS written FROM gold", *ctes, gold),
        "run_v1": V(f"""SELECT 'bronze' AS layer, 'completed' AS status, {bronze} AS records, {null}
            UNION ALL SELECT 'silver', 'completed', (SELECT count(*) FROM v1_silver), NULL
            UNION ALL SELECT 'gold', 'completed', (SELECT CAST(sum(records) AS BIGINT) FROM gold), NULL""", *ctes, gold),
        **{f"v1_{n}": V(sql[n]) for n in ANALYTICS},
    }
