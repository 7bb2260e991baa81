"""Bronze, Silver and Gold of the first generation as they were laid out: Bronze by year and
region with ingestion metadata, Silver by year, region and product category with a summary
beside it, Gold with the dashboard metrics apart from the aggregations.

Each layer is written once, partitioned; the second, unpartitioned copy of the same rows that
the old layout kept is left out, as a scan of the partitioned one gives it. Rows without a
year or region stay, in Spark's partition for nulls.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from . import gold_v1, silver_v1
from .silver_v1 import ROLES, V1Settings

META = ("_source_file", "_ingestion_timestamp", "_batch_id")
BRONZE_PARTS = ["ano", "regiao"]
SILVER_PARTS = ["ano", "regiao", "categoria_produto"]
#: Datasets that are no aggregation.
ANALYTICS = ("dashboard_metrics",)
#: The thirteen datasets of the old Gold job, and the metrics.
GOLD = ["price_summary_cube", "monthly_change", "seasonal_index", "annual_growth_presence", "regional_dense_ranking",
        "state_vs_region", "regional_dispersion", "brand_competition", "brand_price_percentile", "brand_margin_analysis",
        "pair_ratio_monthly", "product_volatility", "product_penetration", "dashboard_metrics"]


def ingest(raw: DataFrame, batch_id: str, load_ts=None, source_file: str | None = None,
           s: V1Settings = V1Settings()) -> DataFrame:
    """P2 + P3: standard names and types, ``_source_file``, ``_ingestion_timestamp`` and
    ``_batch_id``. Without ``source_file`` the scanned file's name is taken."""
    raw = raw.withColumn("_source_file", F.lit(source_file) if source_file else F.col("_metadata.file_name"))
    ts = F.lit(load_ts).cast("timestamp") if load_ts is not None else F.current_timestamp()
    return silver_v1.standardize(raw, s).withColumns({"_ingestion_timestamp": ts, "_batch_id": F.lit(batch_id)})


def write_bronze(df: DataFrame, out: str) -> str:
    """By year and region, with the half of the year."""
    d = F.col("data_coleta")
    df = df.withColumns({"ano": F.year(d), "semestre": F.when(F.month(d) <= 6, 1).when(F.month(d) > 6, 2),
                         "regiao": F.col("regiao_sigla")})
    return files.write_layer(df, out, BRONZE_PARTS)


def summary(df: DataFrame) -> DataFrame:
    """The Silver summary: N0 by the first generation's keys."""
    return gold_v1.price_summary_cube(df, ROLES)


def silver_parts() -> list:
    """What Silver's partitions are computed from, before the calendar is."""
    return [F.year("data_coleta"), F.col("regiao_sigla"), F.col("categoria_produto")]


def write_silver(df: DataFrame, root: str, clustered: bool = False) -> dict:
    """``observations`` by year, region and product category, ``fuel_summary`` beside it.
    Rows that are ``clustered`` so are written as they come."""
    root = root.rstrip("/")
    path = files.write_layer(df.withColumn("regiao", F.col("regiao_sigla")), f"{root}/observations", SILVER_PARTS,
                             clustered=clustered)
    summary(files.read_layer(df.sparkSession, path)).write.mode("overwrite").parquet(f"{root}/fuel_summary")
    return {"observations": path, "fuel_summary": f"{root}/fuel_summary"}


def category(dataset: str) -> str:
    """The folder that a dataset goes to."""
    return "analytics" if dataset in ANALYTICS else "aggregations"


def write_gold(spark: SparkSession, silver: str, root: str, roles=ROLES) -> DataFrame:
    """S13 + S14: all datasets from the written Silver, each in its category's folder."""
    df = files.read_layer(spark, f"{silver.rstrip('/')}/observations")
    return files.write_gold({n: (category(n), gold_v1.QUERIES[n](df, roles)) for n in GOLD}, root)


def run(spark: SparkSession, raw: DataFrame, root: str, batch_id: str, load_ts=None, source_file: str | None = None,
        s: V1Settings = V1Settings(), roles=ROLES) -> DataFrame:
    """The three jobs in order; a row each (layer, status, records, error), stopping at the
    first that fails."""
    from .pipeline import timed_report
    root, reports = root.rstrip("/"), []

    def step(layer: str, job) -> bool:
        report = timed_report(layer)
        try:
            reports.append(report("completed", records=job()))
            return True
        except Exception as e:  # noqa: BLE001 - the report carries the failure
            reports.append(report("failed", error=str(e)))
            return False

    def bronze() -> int:
        write_bronze(ingest(raw, batch_id, load_ts, source_file, s), f"{root}/bronze")
        return files.record_counts(spark, [files.read_layer(spark, f"{root}/bronze")])[0]

    def silver() -> int:
        df = files.read_layer(spark, f"{root}/bronze").drop("ano", "semestre", "regiao")
        # Bronze lies by year and region already, so Silver is written from it without a shuffle of rows
        rows = silver_v1.build_silver_v1(df, replace(s, keep=(*s.keep, *META)), silver_parts(), written=True)
        paths = write_silver(rows, f"{root}/silver", clustered=True)
        return files.record_counts(spark, [files.read_layer(spark, paths["observations"])])[0]

    def gold() -> int:
        return write_gold(spark, f"{root}/silver", f"{root}/gold", roles).agg(F.sum("records")).first()[0]

    for layer, job in (("bronze", bronze), ("silver", silver), ("gold", gold)):
        if not step(layer, job):
            break
    rows = [(r["layer"], r["status"], r.get("records"), r.get("error")) for r in reports]
    return spark.createDataFrame(rows, "layer string, status string, records long, error string")
