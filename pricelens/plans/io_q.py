"""Registered queries for sources, sinks, the layer pipeline and streaming.

Each writes under the shared folder named by ``spark.checkpoint.dir`` (a
fresh sub-folder per call) and returns what Spark reads back, so the work
grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..config import STAR, silver_roles
from ..operators import quality as Q
from ..operators.clean import clustered, write_rows
from ..session import scratch_path
from ..sources import files
from ..sources.panel import star_columns, star_panel, star_rows
from ..streaming.incremental import incremental_ingest
from . import gold, gold_v1, pipeline
from .quality_q import KEYS_V2, RULES_V2, bronze_raw, report_sql
from .silver import build_silver, silver_sql, star_silver
from .stages import DIRTY_V2_SQL, KEY, RAW_V2_SQL, dirty_raw_v2, raw_v2

RAW_V2_SCHEMA = T.StructType(
    [T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType())]
    + [T.StructField(c, T.DoubleType() if c in ("Valor_Venda", "Valor_Compra") else T.StringType())
       for c in C.FUEL_RAW_COLUMNS])
LOAD_TS = "2024-01-01 00:00:00"
# Raw-file roles: the whole raw row breaks ties between duplicate keys.
V2_ROLES = STAR.with_(date="data_coleta_parsed", key=tuple(KEY), tiebreak=tuple(C.FUEL_RAW_COLUMNS))


def _csv(spark, d):
    path = scratch_path(spark, "raw-csv")
    files.write_csv(raw_v2(star_panel(spark, d)), path)
    return path


def q_csv_scan(spark, d):
    return files.read_csv(spark, _csv(spark, d), RAW_V2_SCHEMA)


def q_csv_sink(spark, d):
    path = _csv(spark, d)
    return files.read_csv(spark, path, RAW_V2_SCHEMA).select(*KEY, "Produto", "Valor_Venda")


def q_csv_header_check(spark, d):
    path = _csv(spark, d)
    res = files.csv_header_check(spark, path, C.FUEL_RAW_COLUMNS)
    # The header verdict, next to the row count of the file it describes.
    return files.read_csv(spark, path, RAW_V2_SCHEMA).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(res["valid"]).alias("valid"), F.lit(",".join(res["missing_columns"])).alias("missing_columns"),
        F.lit(len(res["columns"])).alias("n_columns"), "n_rows")


def q_file_profile(spark, d):
    """The profiles of a dirty raw file's parts, summed up (how many parts Spark writes is its affair)."""
    path = scratch_path(spark, "raw-csv")
    files.write_csv(dirty_raw_v2(star_panel(spark, d)), path)
    per = files.file_profile(files.read_csv(spark, path, RAW_V2_SCHEMA, glob="*.csv"), "Valor_Venda",
                             expected=[*C.FUEL_RAW_COLUMNS, "Latitude"])
    return per.agg(F.sum("rows").alias("n_rows"), F.sum("null_cells").alias("null_cells"),
                   F.sum(F.col("nulls")["Produto"]).alias("null_products"), F.sum("duplicate_rows").alias("duplicate_rows"),
                   F.sum("bad_prices").alias("bad_prices"), F.bool_or("valid").alias("valid"),
                   F.max(F.array_join("missing_columns", ",")).alias("missing_columns"))


def _bronze_frame(spark, d, rows=None):
    raw = dirty_raw_v2(star_panel(spark, d) if rows is None else star_columns(rows))
    return pipeline.add_technical_columns(raw, V2_ROLES, load_ts=LOAD_TS, source_file="raw",
                                          date_source="Data_Coleta")


TECHNICAL = ["bronze_load_timestamp", "bronze_source_file", "data_coleta_parsed", "ano", "mes"]


def q_add_technical_columns(spark, d):
    """The technical columns; of the content id, that equal rows, and only they, share it."""
    b = _bronze_frame(spark, d)
    w = Window.partitionBy("bronze_record_id")
    return b.select(*KEY, *TECHNICAL, F.count(F.lit(1)).over(w).alias("same_id"))


def _bronze(spark, d, rows=None):
    """``rows``: the panel's joined rows, written by month."""
    path = scratch_path(spark, "bronze")
    files.write_layer(_bronze_frame(spark, d, rows).filter("ano IS NOT NULL"), path, clustered=rows is not None)
    return path


def q_bronze_write(spark, d):
    return files.read_layer(spark, _bronze(spark, d)).select(*KEY, "Produto", "Valor_Venda", *TECHNICAL)


def q_bronze_scan(spark, d):
    return files.read_layer(spark, _bronze(spark, d)).groupBy("ano", "mes").count()


def _silver(spark, d, rows=None):
    """``rows`` as in ``_bronze``."""
    path, kept = scratch_path(spark, "silver"), scratch_path(spark, "rows")
    s = star_silver(spark, d, checkpoint=kept) if rows is None else build_silver(rows, STAR, written=True, derive=star_columns)
    files.write_layer(s.withColumns({"ano": F.col("year"), "mes": F.col("month")}), path, clustered=True)
    files.delete_path(spark, kept)
    return path


def _layers(spark, d):
    """(Bronze, Silver): both from the panel's joined rows, which are written once by month."""
    path = scratch_path(spark, "panel")
    rows = write_rows(clustered(star_rows(spark, d), [F.year("obs_date"), F.month("obs_date")]), path)
    layers = _bronze(spark, d, rows), _silver(spark, d, rows)
    files.delete_path(spark, path)
    return layers


def q_silver_write(spark, d):
    return files.read_layer(spark, _silver(spark, d)).select(
        *KEY, "product_norm", "brand_norm", "region_norm", "price", "margin_pct", "price_band", "ano", "mes")


def q_silver_scan(spark, d):
    return files.read_layer(spark, _silver(spark, d)).groupBy("ano", "mes", "product_norm").count()


def q_dashboard_metrics_layer(spark, d):
    """N13 over the written Silver layer: both months by the layer's partitions."""
    path = _silver(spark, d)
    return gold_v1.dashboard_metrics(files.read_layer(spark, path), silver_roles(STAR), files.latest_month(spark, path))


def _gold(spark, silver, root):
    s = files.read_layer(spark, silver)
    sr = silver_roles(STAR)
    ds = {n: (cat, gold.QUERIES[n](s, sr)) for cat, ns in pipeline.GOLD_FAMILIES.items() for n in ns}
    return files.write_gold(ds, root)


def q_gold_write(spark, d):
    out = _gold(spark, _silver(spark, d), scratch_path(spark, "gold"))
    return out.select("category", "dataset", "records", F.col("path").isNotNull().alias("written"))


def q_partition_inventory(spark, d):
    inv = files.partition_inventory(spark, _bronze(spark, d))
    return inv.select("ano", "mes", (F.col("files") > 0).alias("has_files"), (F.col("size_mb") > 0).alias("has_size"))


def q_layer_validation(spark, d):
    """The written layers, Gold with all its datasets, and the same with a layer missing."""
    gold_root, (bronze, silver) = scratch_path(spark, "gold"), _layers(spark, d)
    _gold(spark, silver, gold_root)
    good = files.layer_validation(spark, {"bronze": bronze, "silver": silver, "gold": gold_root})
    bad = files.layer_validation(spark, {"bronze": bronze, "silver": f"{silver}-missing", "gold": gold_root})
    both = good.withColumn("case", F.lit("all")).unionByName(bad.withColumn("case", F.lit("missing")))
    return both.select("case", "layer", "exists", "datasets", "records", (F.col("size_mb") > 0).alias("has_size"), "status")


def q_dataset_catalog(spark, d):
    gold_root, (bronze, silver) = scratch_path(spark, "gold"), _layers(spark, d)
    written = _gold(spark, silver, gold_root)
    out = files.dataset_catalog(spark, [
        files.catalog_entry("bronze", "observations", files.read_layer(spark, bronze),
                            C.PARTITION_COLUMNS, "raw rows with technical columns"),
        files.catalog_entry("silver", "observations", files.read_layer(spark, silver),
                            C.PARTITION_COLUMNS, "cleaned, normalised, enriched rows"),
        *[files.catalog_entry("gold", r["dataset"], files.read_gold(spark, gold_root, r["dataset"], r["category"]),
                              (), pipeline.GOLD_DESCRIPTIONS[r["dataset"]]) for r in written.collect() if r["path"]],
    ])
    return out.select("layer", "dataset", "records", F.array_join("partitioning", ",").alias("partitioning"), "description")


def q_run_log(spark, d):
    root = scratch_path(spark, "runlog")
    n = star_panel(spark, d).count()
    files.write_run_log(spark, {"layer": "panel", "status": "completed", "records": n}, root)
    return spark.read.json(root).select("summary")


def q_quality_report_sink(spark, d):
    """The quality report written as Parquet and read back."""
    path = scratch_path(spark, "quality")
    Q.quality_report(bronze_raw(spark, d), RULES_V2, KEYS_V2).write.parquet(path)
    return spark.read.parquet(path)


def _report_df(spark, *reports):
    rows = [(r["layer"], r["status"], r.get("records"), r.get("rejected"), r.get("datasets"), r.get("error")) for r in reports]
    return spark.createDataFrame(rows, "layer string, status string, records long, rejected long, datasets long, error string")


def q_run_bronze(spark, d):
    raw = dirty_raw_v2(star_panel(spark, d))
    return _report_df(spark, pipeline.run_bronze(spark, raw, V2_ROLES, scratch_path(spark, "rb"), RULES_V2, KEYS_V2,
                                                 "Data_Coleta", LOAD_TS))


def _v2_silver_roles():
    return V2_ROLES.with_(price="Valor_Venda", cost="Valor_Compra",
                      product="Produto", brand="Bandeira", region="Regiao", state="Estado",
                      city="Municipio", station="Revenda", tax_id="CNPJ")


def q_run_silver(spark, d):
    raw = raw_v2(star_panel(spark, d))
    root = scratch_path(spark, "rs")
    pipeline.run_bronze(spark, raw, V2_ROLES, f"{root}/bronze", date_source="Data_Coleta", load_ts=LOAD_TS)
    return _report_df(spark, pipeline.run_silver(spark, f"{root}/bronze", _v2_silver_roles(), f"{root}/silver"))


def q_run_gold(spark, d):
    raw = raw_v2(star_panel(spark, d))
    root = scratch_path(spark, "rg")
    r = _v2_silver_roles()
    pipeline.run_bronze(spark, raw, V2_ROLES, f"{root}/bronze", date_source="Data_Coleta", load_ts=LOAD_TS)
    pipeline.run_silver(spark, f"{root}/bronze", r, f"{root}/silver")
    return _report_df(spark, pipeline.run_gold(spark, f"{root}/silver", r, f"{root}/gold"))


def q_run_pipeline(spark, d):
    raw = raw_v2(star_panel(spark, d))
    out = pipeline.run_pipeline(spark, raw, _v2_silver_roles().with_(date="data_coleta_parsed"),
                                scratch_path(spark, "rp"), RULES_V2, KEYS_V2, "Data_Coleta", LOAD_TS)
    return out.select("layer", "status", "records")


def q_incremental_ingest(spark, d):
    """The raw file's parts, a third of the rows landed twice, ingested three files a batch."""
    raw = dirty_raw_v2(star_panel(spark, d))
    again = raw.filter("l_orderkey % 3 = 0").withColumn("Valor_Venda", F.col("Valor_Venda") + 1.0)
    landing = scratch_path(spark, "raw-csv")
    files.write_csv(raw.unionByName(again).repartition(8, "Produto", "l_linenumber"), landing, compression="gzip")
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    incremental_ingest(spark, landing, RAW_V2_SCHEMA, V2_ROLES, out, ckpt, max_files_per_trigger=3).awaitTermination()
    return files.read_layer(spark, out).select(*KEY, *C.FUEL_RAW_COLUMNS, "data_coleta_parsed", "ano", "mes")


QUERIES = {
    "csv_scan": q_csv_scan, "csv_sink": q_csv_sink, "csv_header_check": q_csv_header_check,
    "file_profile": q_file_profile, "add_technical_columns": q_add_technical_columns,
    "bronze_write": q_bronze_write, "bronze_scan": q_bronze_scan, "silver_write": q_silver_write,
    "silver_scan": q_silver_scan, "gold_write": q_gold_write, "partition_inventory": q_partition_inventory,
    "layer_validation": q_layer_validation, "dataset_catalog": q_dataset_catalog, "run_log": q_run_log,
    "quality_report_sink": q_quality_report_sink, "dashboard_metrics_layer": q_dashboard_metrics_layer, "run_bronze": q_run_bronze, "run_silver": q_run_silver,
    "run_gold": q_run_gold, "run_pipeline": q_run_pipeline, "incremental_ingest": q_incremental_ingest,
}

# Rounded by the registry like the queries whose values these are.
STABLE = {"silver_write": ["price", "margin_pct"], "quality_report_sink": ["score"],
          "dashboard_metrics_layer": gold_v1.STABLE["dashboard_metrics"]}


def _gold_counts() -> list[tuple[str, str, str, tuple]]:
    """(category, dataset, body over silver, extra CTEs) of every Gold dataset."""
    sql, out = gold.oracle(silver_roles(STAR)), []
    for cat, names in pipeline.GOLD_FAMILIES.items():
        for n in names:
            ctes, body = sql[n] if isinstance(sql[n], tuple) else ((), sql[n])
            out.append((cat, n, body, tuple(ctes)))
    return out


def oracle() -> dict:
    from ..sources.panel import PANEL_SQL
    from . import sqlgen as S
    parsed = "CAST(try_strptime(\"Data_Coleta\", '%d/%m/%Y') AS DATE)"
    bronze = f"""bronze AS (SELECT *, CAST(TIMESTAMP '{LOAD_TS}' AS TIMESTAMP) AS bronze_load_timestamp, 'raw' AS bronze_source_file,
      {parsed} AS data_coleta_parsed, CAST(year({parsed}) AS INTEGER) AS ano, CAST(month({parsed}) AS INTEGER) AS mes FROM raw_v2)"""
    tech, key = ", ".join(TECHNICAL), ", ".join(KEY)
    raw_cols = ", ".join(f'"{c}"' for c in C.FUEL_RAW_COLUMNS)
    nulls = " + ".join(f'count_if("{c}" IS NULL)' for c in [*KEY, *C.FUEL_RAW_COLUMNS])

    def B(body, *ctes):
        return S.with_ctes(PANEL_SQL, *DIRTY_V2_SQL, bronze, *ctes, body=body)

    golds = _gold_counts()
    gold_ctes = list(dict.fromkeys(c for _, _, _, ctes in golds for c in ctes))

    def G(body, *ctes):
        counts = "gold AS (" + " UNION ALL ".join(
            f"SELECT '{cat}' AS category, '{n}' AS dataset, '{pipeline.GOLD_DESCRIPTIONS[n]}' AS description, "
            f"(SELECT count(*) FROM ({sql}\n) AS g{k}) AS records" for k, (cat, n, sql, _) in enumerate(golds)) + ")"
        return silver_sql(body, extra_ctes=(*gold_ctes, counts, *DIRTY_V2_SQL, bronze, *ctes))

    n_bronze, n_silver = "(SELECT count(*) FROM bronze WHERE ano IS NOT NULL)", "(SELECT count(*) FROM silver)"
    n_gold, n_sets = "(SELECT CAST(sum(records) AS BIGINT) FROM gold)", "(SELECT CAST(count(*) AS INTEGER) FROM gold WHERE records > 0)"
    order = ", ".join(f'"{c}" ASC NULLS FIRST' for c in C.FUEL_RAW_COLUMNS)
    run = "CAST(NULL AS BIGINT)"
    # the raw file's columns, as the panel has them, break ties between its duplicates
    by_raw = STAR.with_(tiebreak=("region", "state", "city", "station_code", "product",
                                  "strftime(obs_date, '%d/%m/%Y')", "price", "cost", "brand"))
    return {
        "csv_scan": S.with_ctes(PANEL_SQL, RAW_V2_SQL, body="SELECT * FROM raw_v2"),
        "csv_sink": S.with_ctes(PANEL_SQL, RAW_V2_SQL,
                                body='SELECT l_orderkey, l_linenumber, "Produto", "Valor_Venda" FROM raw_v2'),
        "csv_header_check": S.with_ctes(PANEL_SQL, RAW_V2_SQL, body=f"""SELECT true AS valid, '' AS missing_columns,
            CAST({len(RAW_V2_SCHEMA)} AS INTEGER) AS n_columns, count(*) AS n_rows FROM raw_v2"""),
        # CSV can't tell an empty text from a null one
        "file_profile": B(f"""SELECT count(*) AS n_rows, CAST({nulls} AS BIGINT) AS null_cells,
            CAST(count_if("Produto" IS NULL) AS BIGINT) AS null_products, CAST(0 AS BIGINT) AS duplicate_rows,
            CAST(count_if("Valor_Venda" <= 0 OR "Valor_Venda" > 50) AS BIGINT) AS bad_prices, false AS valid,
            'Latitude' AS missing_columns FROM (SELECT * REPLACE (nullif("Bandeira", '') AS "Bandeira") FROM raw_v2)"""),
        "add_technical_columns": B(f"SELECT {key}, {tech}, count(*) OVER (PARTITION BY {key}, {raw_cols}) AS same_id FROM bronze"),
        "bronze_write": B(f'SELECT {key}, "Produto", "Valor_Venda", {tech} FROM bronze WHERE ano IS NOT NULL'),
        "bronze_scan": B("SELECT ano, mes, count(*) AS count FROM bronze WHERE ano IS NOT NULL GROUP BY ano, mes"),
        "silver_write": silver_sql(f"""SELECT {key}, product_norm, brand_norm, region_norm, price, margin_pct, price_band,
            year AS ano, month AS mes FROM silver"""),
        "silver_scan": silver_sql("SELECT year AS ano, month AS mes, product_norm, count(*) AS count FROM silver GROUP BY ALL"),
        "gold_write": G("SELECT category, dataset, records, records > 0 AS written FROM gold"),
        "partition_inventory": B("SELECT DISTINCT ano, mes, true AS has_files, true AS has_size FROM bronze WHERE ano IS NOT NULL"),
        "layer_validation": G(f"""SELECT 'all' AS "case", 'bronze' AS layer, true AS "exists", CAST(1 AS INTEGER) AS datasets,
              {n_bronze} AS records, true AS has_size, 'passed' AS status
            UNION ALL SELECT 'all', 'silver', true, 1, {n_silver}, true, 'passed'
            UNION ALL SELECT 'all', 'gold', true, {n_sets}, {n_gold}, true, 'passed'
            UNION ALL SELECT 'all', 'overall', NULL, 2 + {n_sets}, {n_bronze} + {n_silver} + {n_gold}, true, 'passed'
            UNION ALL SELECT 'missing', 'bronze', true, 1, {n_bronze}, true, 'passed'
            UNION ALL SELECT 'missing', 'silver', false, NULL, NULL, NULL, 'failed'
            UNION ALL SELECT 'missing', 'gold', NULL, NULL, NULL, NULL, 'skipped'
            UNION ALL SELECT 'missing', 'overall', NULL, 1, {n_bronze}, true, 'failed'"""),
        "dataset_catalog": G(f"""SELECT 'bronze' AS layer, 'observations' AS dataset, {n_bronze} AS records, 'ano,mes' AS partitioning,
              'raw rows with technical columns' AS description
            UNION ALL SELECT 'silver', 'observations', {n_silver}, 'ano,mes', 'cleaned, normalised, enriched rows'
            UNION ALL SELECT 'gold', dataset, records, '', description FROM gold WHERE records > 0"""),
        "run_log": S.with_ctes(PANEL_SQL, body="""SELECT '{"layer": "panel", "status": "completed", "records": ' || count(*) || '}'
            AS summary FROM panel"""),
        "quality_report_sink": report_sql(),
        "dashboard_metrics_layer": silver_sql(gold_v1.oracle(silver_roles(STAR))["dashboard_metrics"][1],
                                              extra_ctes=gold_v1.oracle(silver_roles(STAR))["dashboard_metrics"][0]),
        "run_bronze": B(f"""SELECT 'bronze' AS layer, 'completed' AS status, CAST(count(ano) AS BIGINT) AS records,
            CAST(count_if(ano IS NULL) AS BIGINT) AS rejected, {run} AS datasets, CAST(NULL AS VARCHAR) AS error FROM bronze"""),
        "run_silver": silver_sql(f"""SELECT 'silver' AS layer, 'completed' AS status, count(*) AS records, {run} AS rejected,
            {run} AS datasets, CAST(NULL AS VARCHAR) AS error FROM silver""", roles=by_raw),
        "run_gold": G(f"""SELECT 'gold' AS layer, 'completed' AS status, {run} AS records, {run} AS rejected,
            CAST({n_sets} AS BIGINT) AS datasets, CAST(NULL AS VARCHAR) AS error"""),
        "run_pipeline": silver_sql("""SELECT 'bronze' AS layer, 'completed' AS status, (SELECT count(*) FROM panel) AS records
            UNION ALL SELECT 'silver', 'completed', (SELECT count(*) FROM silver)
            UNION ALL SELECT 'gold', 'completed', NULL""", roles=by_raw),
        "incremental_ingest": B(f"""SELECT {key}, {raw_cols}, data_coleta_parsed, ano, mes FROM (
              SELECT * REPLACE (nullif("Bandeira", '') AS "Bandeira") FROM bronze
              UNION ALL SELECT * REPLACE ("Valor_Venda" + 1.0 AS "Valor_Venda", nullif("Bandeira", '') AS "Bandeira")
              FROM bronze WHERE l_orderkey % 3 = 0)
            WHERE ano IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""),
    }
