"""Bronze -> Silver -> Gold jobs (R1-R4) with one report schema and one
status vocabulary (K1/K2 fixed: every job reports ``status='completed'`` or
``'failed'`` and the same fields)."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import PanelRoles, silver_roles
from ..operators import quality as Q
from ..operators.clean import clustered, write_rows
from ..session import scratch_path
from ..sources import files
from . import gold
from .silver import build_silver

GOLD_FAMILIES = {
    "temporal": ["monthly_price_evolution", "seasonality", "annual_trends", "price_volatility"],
    "regional": ["state_price_ranking", "regional_analysis", "regional_disparity"],
    "competitive": ["brand_market_share", "brand_positioning", "major_brand_competitiveness"],
    "product": ["ethanol_ratio_history", "ethanol_viability_by_state", "variant_comparison",
                "category_analysis", "price_volume_elasticity"],
}

GOLD_DESCRIPTIONS = {
    "monthly_price_evolution": "mean, median, range and deviation of prices per product and month",
    "seasonality": "mean price per product and calendar month",
    "annual_trends": "yearly mean price per product and its change",
    "price_volatility": "spread of prices per product and month",
    "state_price_ranking": "states ranked by mean price per product",
    "regional_analysis": "prices per region and product with the dearest and cheapest marked",
    "regional_disparity": "distance between the dearest and the cheapest region per product",
    "brand_market_share": "share of observations per brand and product",
    "brand_positioning": "brands by price tier per product",
    "major_brand_competitiveness": "major brands against the product mean",
    "ethanol_ratio_history": "price ratio of the substitute pair over time",
    "ethanol_viability_by_state": "share of days on which the substitute pays, per state",
    "variant_comparison": "plain against variant product prices",
    "category_analysis": "prices, brands and places per product category",
    "price_volume_elasticity": "correlation of price and number of observations",
}


def record_id(columns):
    """128-bit digest of a raw row: every column with its nulls marked, so equal rows, and
    only they, share an id whatever file they come from."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("~")) for c in columns]
    sized = [F.concat(F.length(c).cast("string"), c) for c in cells]
    return F.md5(F.concat(*sized).cast("binary"))


def add_technical_columns(df: DataFrame, roles: PanelRoles, load_ts=None, source_file: str | None = None,
                          date_source: str | None = None, fmt: str = C.DATE_FORMAT) -> DataFrame:
    """Load timestamp, source file, content id, parsed date, ano, mes.

    ``source_file`` names the origin of rows that no file scan produced; without it the
    scanned file's name is taken. The record id is a 128-bit digest of the raw row, computed
    in place: rows that repeat have one id.
    """
    ts = F.lit(load_ts).cast("timestamp") if load_ts is not None else F.current_timestamp()
    src = F.lit(source_file) if source_file else F.col("_metadata.file_name")
    return df.withColumns({
        "bronze_load_timestamp": ts, "bronze_source_file": src,
        "bronze_record_id": record_id(df.columns), "data_coleta_parsed": _parsed(roles, date_source, fmt),
    }).withColumns({"ano": F.year("data_coleta_parsed"), "mes": F.month("data_coleta_parsed")})


def _parsed(roles: PanelRoles, date_source: str | None, fmt: str = C.DATE_FORMAT):
    return F.to_date(F.try_to_timestamp(F.col(date_source), F.lit(fmt))) if date_source else F.col(roles.date)


def _bronze_rows(raw: DataFrame, roles: PanelRoles, path: str, date_source: str | None, load_ts, source_file: str | None) -> DataFrame:
    """``add_technical_columns`` of the raw rows, which are written to ``path`` clustered by month;
    the digests, which don't compress, are computed where the rows are read."""
    ts = load_ts if load_ts is not None else raw.sparkSession.range(1).select(F.current_timestamp()).first()[0]
    kept = raw if source_file else raw.withColumn("bronze_source_file", F.col("_metadata.file_name"))
    when = _parsed(roles, date_source)
    kept = write_rows(clustered(kept, [F.year(when), F.month(when)]), path)
    if source_file:
        return add_technical_columns(kept, roles, load_ts=ts, source_file=source_file, date_source=date_source)
    names = [*raw.columns, "bronze_load_timestamp", "bronze_source_file", "bronze_record_id", "data_coleta_parsed", "ano", "mes"]
    b = kept.select("*", F.lit(ts).cast("timestamp").alias("bronze_load_timestamp"),
                    record_id(raw.columns).alias("bronze_record_id"), when.alias("data_coleta_parsed"))
    return b.withColumns({"ano": F.year("data_coleta_parsed"), "mes": F.month("data_coleta_parsed")}).select(*names)


def timed_report(layer: str):
    """A report maker for a job that starts now."""
    t0 = time.time()
    return lambda status, **kw: _report(layer, status, t0, **kw)


def _report(layer, status, t0, **kw) -> dict:
    return {"layer": layer, "status": status, "seconds": round(time.time() - t0, 3), **kw}


def run_bronze(spark: SparkSession, raw: DataFrame, roles: PanelRoles, out: str,
               rules: dict | None = None, keys=None, date_source: str | None = None, load_ts=None,
               source_file: str | None = "raw", strict: bool = False) -> dict:
    """Validate -> technical columns -> partitioned write -> report.

    Rows without a parseable date are written to ``<out>_rejects`` and counted, so that
    records + rejected is the number of input rows; with ``strict`` they fail the job.
    ``source_file=None`` takes the file name of a file scan.
    """
    t0 = time.time()
    try:
        score, issues = None, []
        # computed once: report, rejects and layer read the written rows
        kept = scratch_path(spark, "rows")
        b = _bronze_rows(raw, roles, kept, date_source, load_ts, source_file)
        if rules is not None:
            # Q8: the raw rule set; below the minimum score the issues are
            # reported (the data is still ingested, as in the source design).
            report = Q.quality_report(b.select(*[Q.qc(c) for c in raw.columns]), rules, keys)
            score = Q.overall_score(report).first()["overall_score"]
            if score < C.MIN_QUALITY_SCORE:
                issues = [r["issue"] for r in Q.quality_issues(report).collect()]
        bad = f"{out.rstrip('/')}_rejects"
        seen = Observation()
        (b.filter(F.col("ano").isNull()).observe(seen, F.count(F.lit(1)).alias("rejected"))
          .write.mode("overwrite").parquet(bad))
        rejected = seen.get["rejected"]
        if rejected and strict:
            raise ValueError(f"{rejected} rows without a parseable date, see {bad}")
        good = Observation()
        files.write_layer(b.filter(F.col("ano").isNotNull()).observe(good, F.count(F.lit(1)).alias("records")), out, clustered=True)
        files.delete_path(spark, kept)
        parts = files.partition_inventory(spark, out).count() if good.get["records"] else 0
        return _report("bronze", "completed", t0, records=good.get["records"], rejected=rejected, partitions=parts,
                       quality_score=score, quality_issues=issues, path=out)
    except Exception as e:  # noqa: BLE001 - the report carries the failure
        return _report("bronze", "failed", t0, error=str(e))


def silver_rules(roles: PanelRoles, valid_products=None, valid_regions=None,
                 price_range=(C.MIN_PRICE, C.MAX_PRICE)) -> dict:
    """Q9: the Silver rule set (normalised product/region, price range, margin 0-100)."""
    return {
        "product_norm": {"values": list(valid_products or C.VALID_PRODUCTS)},
        "region_norm": {"values": list(valid_regions or C.VALID_REGIONS)},
        roles.price: {"min": price_range[0], "max": price_range[1]},
        "margin_pct": {"min": 0.0, "max": 100.0},
    }


def run_silver(spark: SparkSession, bronze_path: str, roles: PanelRoles, out: str,
               rules: dict | None = None) -> dict:
    """R2: scan -> clean -> normalise -> enrich -> write (partitioned by ano, mes)
    -> Q9 quality score of what was written."""
    t0 = time.time()
    try:
        b = files.read_layer(spark, bronze_path)
        s = build_silver(b, roles.with_(date="data_coleta_parsed"), written=True)
        s = s.withColumns({"ano": F.col(roles.year), "mes": F.col(roles.month)}) \
            if roles.year != "ano" else s
        files.write_layer(s, out, clustered=True)
        written = files.read_layer(spark, out)
        n = written.count()
        rep = Q.quality_report(written, rules or silver_rules(roles),
                               [roles.tax_id if roles.tax_id in written.columns else roles.station,
                                "data_coleta_parsed", "product_norm"])
        score = Q.overall_score(rep).first()["overall_score"]
        return _report("silver", "completed", t0, records=n, quality_score=score, path=out)
    except Exception as e:  # noqa: BLE001
        return _report("silver", "failed", t0, error=str(e))


def run_gold(spark: SparkSession, silver_path: str, roles: PanelRoles, out: str) -> dict:
    """Scan Silver once, compute the fifteen datasets, write each."""
    t0 = time.time()
    try:
        s = files.read_layer(spark, silver_path)
        sr = silver_roles(roles).with_(date="data_coleta_parsed")
        ds = {name: (cat, gold.QUERIES[name](s, sr)) for cat, names in GOLD_FAMILIES.items() for name in names}
        written = files.write_gold(ds, out)
        return _report("gold", "completed", t0, datasets=written.filter("records > 0").count(), path=out)
    except Exception as e:  # noqa: BLE001
        return _report("gold", "failed", t0, error=str(e))


def run_pipeline(spark: SparkSession, raw: DataFrame, roles: PanelRoles, root: str,
                 rules=None, keys=None, date_source=None, load_ts=None) -> DataFrame:
    """Bronze -> Silver -> Gold, stopping at the first failed layer; the
    summary is appended to ``root/logs`` and returned as rows."""
    root = root.rstrip("/")
    reports = [run_bronze(spark, raw, roles, f"{root}/bronze", rules, keys, date_source, load_ts)]
    if reports[-1]["status"] == "completed":
        reports.append(run_silver(spark, f"{root}/bronze", roles, f"{root}/silver"))
    if reports[-1]["status"] == "completed":
        reports.append(run_gold(spark, f"{root}/silver", roles, f"{root}/gold"))
    files.write_run_log(spark, {"layers": reports}, f"{root}/logs")
    rows = [(r["layer"], r["status"], r.get("records"), r.get("seconds")) for r in reports]
    return spark.createDataFrame(rows, "layer string, status string, records long, seconds double")
