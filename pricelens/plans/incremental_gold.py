"""Incremental Gold: monthly states of Silver, and the fifteen datasets merged from them.

For every (ano, mes) of Silver two tables hold mergeable states: cells (counts, means, squared
distances and ranges by region, state, product, brand and category) and value counts for the
medians. A refresh compares the files of each month with those its states were made from, and
recomputes the months that differ, from their partitions alone; Gold is then computed from
the states, which are smaller than Silver by the number of observations in a cell.

The manifest (month -> fingerprint of its files) is written last, and a missing or partial one
means that months are computed again: a refresh that fails on the way is simply repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import PanelRoles
from ..functions.moments import States, cells, value_states
from ..sources import files
from . import gold

PARTS = list(C.PARTITION_COLUMNS)
MANIFEST = "ano int, mes int, fingerprint string"


def _dims(r: PanelRoles) -> list[str]:
    return [r.year, r.month, r.region, r.state, r.product]


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """ano, mes, fingerprint: a digest of the names, sizes and times of a month's files."""
    one = F.concat_ws("|", F.element_at(F.split("path", "/"), -1), F.col("length").cast("string"),
                      F.unix_micros("modificationTime").cast("string"))
    return (files.partition_files(spark, path).groupBy(*PARTS)
            .agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(one))), 256).alias("fingerprint"))
            .select(*[F.col(c).cast("int").alias(c) for c in PARTS], "fingerprint"))


def changed_months(spark: SparkSession, path: str, root: str) -> tuple[list, list, DataFrame]:
    """(months to compute, months that are gone, fingerprints now); a row a month."""
    now = fingerprints(spark, path)
    if files.path_exists(spark, f"{root}/manifest/_SUCCESS"):
        old = spark.read.schema(MANIFEST).json(f"{root}/manifest")
    else:
        old = spark.createDataFrame([], MANIFEST)
    both = now.withColumnRenamed("fingerprint", "new").join(old, PARTS, "full").where(
        ~F.col("new").eqNullSafe(F.col("fingerprint"))).collect()
    months = sorted((r["ano"], r["mes"]) for r in both if r["new"] is not None)
    gone = sorted((r["ano"], r["mes"]) for r in both if r["new"] is None)
    return months, gone, now


def months_of(df: DataFrame, months: list) -> DataFrame:
    """The rows of some months, as partition filters."""
    inside = F.lit(False)
    for ano, mes in months:
        inside = inside | ((F.col("ano") == ano) & (F.col("mes") == mes))
    return df.where(inside)


def refresh(spark: SparkSession, silver_path: str, roles: PanelRoles, root: str) -> list:
    """Bring the states below ``root`` up to date; the months that were computed.

    ``roles`` name Silver's columns (``silver_roles``)."""
    root = root.rstrip("/")
    months, gone, now = changed_months(spark, silver_path, root)
    if not months and not gone:
        return []
    prints = now.collect()  # a row a month
    # from here on the states may be ahead of the manifest, never the other way round
    files.delete_path(spark, f"{root}/manifest/_SUCCESS")
    if months:
        rows = months_of(files.read_layer(spark, silver_path), months)
        if roles.year not in PARTS:
            rows = rows.withColumns({c: F.col(c).cast("int") for c in PARTS})
        dims = list(dict.fromkeys([*PARTS, *_dims(roles)]))
        measures = [roles.price, roles.cost, "margin_pct"]
        files.write_layer(cells(rows, [*dims, roles.brand, roles.category], measures), f"{root}/cells")
        files.write_layer(value_states(rows, dims, [roles.price, "margin_pct"]), f"{root}/values")
    for ano, mes in gone:
        for table in ("cells", "values"):
            files.delete_path(spark, f"{root}/{table}/ano={ano}/mes={mes}")
    (spark.createDataFrame([tuple(r) for r in prints], MANIFEST).coalesce(1)
     .write.mode("overwrite").json(f"{root}/manifest"))
    return months


def datasets(spark: SparkSession, roles: PanelRoles, root: str) -> dict:
    """name -> Gold dataset, merged from the states below ``root``."""
    root = root.rstrip("/")
    state = files.read_layer(spark, f"{root}/cells")
    a = States(files.read_layer(spark, f"{root}/values"))
    return {name: fn(state, roles, a=a) for name, fn in gold.QUERIES.items()}


def run_gold_incremental(spark: SparkSession, silver_path: str, roles: PanelRoles, out: str, root: str) -> dict:
    """R3 by months: refresh the states, write the datasets, report as ``run_gold`` does."""
    from .pipeline import GOLD_FAMILIES, timed_report
    report = timed_report("gold")
    try:
        months = refresh(spark, silver_path, roles, root)
        made = datasets(spark, roles, root)
        written = files.write_gold({n: (cat, made[n]) for cat, names in GOLD_FAMILIES.items() for n in names}, out)
        return report("completed", datasets=written.filter("records > 0").count(), path=out, months=months)
    except Exception as e:  # noqa: BLE001 - the report carries the failure
        return report("failed", error=str(e))
