"""Registered queries for the Silver-stage operators (P*, J*, F*, W8, R5-R7).

Each runs one operator over the whole star panel (or a raw-file-shaped view
that Spark derives from it) and returns the key columns, the operator's
inputs and its outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import STAR, silver_roles
from ..operators import clean, enrich, normalize
from ..sources.panel import PANEL_SQL, padded, star_panel, table
from . import silver_v1
from . import sqlgen as S
from .silver import STAR_STRING_COLS, silver_sql, star_silver

R = STAR
SR = silver_roles(STAR)
KEY = list(STAR.key)
KEYS = ", ".join(KEY)

# v1 category rules for the star panel (first match wins: BRAND#1 also
# matches BRAND#10..#19).
STAR_BRAND_RULES_V1 = (("BRAND#1", "FIRST_TIER"), ("BRAND#2", "SECOND_TIER"))
STAR_PRICE_RANGE = (1.0, 50000.0)
STAR_DATE_RANGE = ("1995-01-01", "2000-12-31")


def raw_v1(panel: DataFrame) -> DataFrame:
    """The panel shaped as a first-generation raw file (16 columns, text values)."""
    return panel.select(
        *KEY,
        F.col("region").alias("Regiao - Sigla"), F.col("state").alias("Estado - Sigla"),
        F.col("city").alias("Municipio"), F.col("station_code").alias("Revenda"),
        F.col("station_code").alias("CNPJ da Revenda"), F.lit("RUA").alias("Nome da Rua"),
        F.col("l_linenumber").cast("string").alias("Numero Rua"),
        F.lit(None).cast("string").alias("Complemento"), F.col("city").alias("Bairro"),
        padded("l_partkey", 8).alias("Cep"),
        F.col("product").alias("Produto"), F.col("obs_date").cast("string").alias("Data da Coleta"),
        F.col("price").cast("string").alias("Valor de Venda"),
        F.col("cost").cast("string").alias("Valor de Compra"),
        F.lit("R$ / UN").alias("Unidade de Medida"), F.col("brand").alias("Bandeira"))


RAW_V1_SQL = """raw_v1 AS (SELECT l_orderkey, l_linenumber,
  region AS "Regiao - Sigla", state AS "Estado - Sigla", city AS "Municipio", station_code AS "Revenda",
  station_code AS "CNPJ da Revenda", 'RUA' AS "Nome da Rua", CAST(l_linenumber AS VARCHAR) AS "Numero Rua",
  CAST(NULL AS VARCHAR) AS "Complemento", city AS "Bairro", printf('%08d', l_partkey) AS "Cep",
  product AS "Produto", CAST(obs_date AS VARCHAR) AS "Data da Coleta",
  CAST(price AS VARCHAR) AS "Valor de Venda", CAST(cost AS VARCHAR) AS "Valor de Compra",
  'R$ / UN' AS "Unidade de Medida", brand AS "Bandeira" FROM panel)"""


def raw_v2(panel: DataFrame) -> DataFrame:
    """The panel shaped as a second-generation raw file (12 columns, dd/MM/yyyy dates)."""
    return panel.select(
        *KEY,
        F.col("region").alias("Regiao"), F.col("state").alias("Estado"), F.col("city").alias("Municipio"),
        F.col("station_code").alias("Revenda"), F.col("station_code").alias("CNPJ"),
        F.concat(F.lit("RUA "), F.col("l_linenumber").cast("string"), F.lit(", CENTRO")).alias("Endereco"),
        F.col("product").alias("Produto"), F.date_format("obs_date", "dd/MM/yyyy").alias("Data_Coleta"),
        F.col("price").alias("Valor_Venda"), F.col("cost").alias("Valor_Compra"),
        F.lit("R$ / UN").alias("Unidade_Medida"), F.col("brand").alias("Bandeira"))


RAW_V2_SQL = """raw_v2 AS (SELECT l_orderkey, l_linenumber, region AS "Regiao", state AS "Estado",
  city AS "Municipio", station_code AS "Revenda", station_code AS "CNPJ",
  'RUA ' || CAST(l_linenumber AS VARCHAR) || ', CENTRO' AS "Endereco", product AS "Produto",
  strftime(obs_date, '%d/%m/%Y') AS "Data_Coleta", price AS "Valor_Venda", cost AS "Valor_Compra",
  'R$ / UN' AS "Unidade_Medida", brand AS "Bandeira" FROM panel)"""


# --- dirty values -------------------------------------------------------------
# Cleaning operators need something to clean. Rows take one of 25 slots by their key, and
# some slots get a defect; both engines derive the same values from the tables.
SLOT = "(l_orderkey * 7 + l_linenumber) % 25"
DEFECTS = {
    "price": "CASE {slot} WHEN 1 THEN NULL WHEN 2 THEN 0.0 WHEN 3 THEN -price ELSE price END",
    "cost": "CASE {slot} WHEN 4 THEN -cost ELSE cost END",
    "city": "CASE {slot} WHEN 8 THEN ' nan ' WHEN 9 THEN 'None' ELSE city END",
    "brand": "CASE {slot} WHEN 10 THEN '' WHEN 11 THEN concat('POSTO ', brand) WHEN 12 THEN 'POSTO DA ESQUINA' ELSE brand END",
    "station_code": "CASE {slot} WHEN 13 THEN 'S-12' ELSE station_code END",
    "product": "CASE {slot} WHEN 14 THEN 'PROMOTIONAL' WHEN 19 THEN NULL ELSE product END",
    "region": "CASE {slot} WHEN 15 THEN 'AFRICA' WHEN 18 THEN NULL ELSE region END",
    "state": "CASE {slot} WHEN 16 THEN NULL WHEN 17 THEN 'ATLANTIS' ELSE state END",
}
BAD_DATES = "CASE {slot} WHEN 5 THEN '31/02/1996' WHEN 6 THEN 'sem data' ELSE {date} END"
EMPTY_SLOT = 7


def dirty_panel(panel: DataFrame) -> DataFrame:
    """The panel with defects by slot (see ``DEFECTS``)."""
    return panel.withColumns({c: F.expr(e.format(slot=SLOT)) for c, e in DEFECTS.items()})


DIRTY_SQL = "dirty AS (SELECT * REPLACE (" + ", ".join(
    f"{e.format(slot=SLOT)} AS {c}" for c, e in DEFECTS.items()) + ") FROM panel)"


def dirty_raw_v1(panel: DataFrame) -> DataFrame:
    """A first-generation raw file with defects; rows of one slot are empty but for their key."""
    raw = raw_v1(dirty_panel(panel))
    return raw.select(*KEY, *[F.when(F.expr(SLOT) != EMPTY_SLOT, F.col(f"`{c}`")).alias(c)
                              for c in raw.columns if c not in KEY])


def dirty_raw_v2(panel: DataFrame) -> DataFrame:
    """A second-generation raw file with defects, dates that can't be parsed among them."""
    return raw_v2(dirty_panel(panel)).withColumn("Data_Coleta", F.expr(BAD_DATES.format(slot=SLOT, date="Data_Coleta")))


DIRTY_V1_SQL = [DIRTY_SQL, RAW_V1_SQL.replace("raw_v1 AS", "full_v1 AS").replace("FROM panel", "FROM dirty"),
                "raw_v1 AS (SELECT l_orderkey, l_linenumber, " + ", ".join(
                    f'CASE WHEN {SLOT} <> {EMPTY_SLOT} THEN "{c}" END AS "{c}"' for c in C.FUEL_V1_RAW_COLUMNS)
                + " FROM full_v1)"]
DIRTY_V2_SQL = [DIRTY_SQL, RAW_V2_SQL.replace("raw_v2 AS", "full_v2 AS").replace("FROM panel", "FROM dirty"),
                "raw_v2 AS (SELECT * REPLACE (" + BAD_DATES.format(slot=SLOT, date='"Data_Coleta"')
                + ' AS "Data_Coleta") FROM full_v2)']


def _panel_sql(body: str, *ctes) -> str:
    return S.with_ctes(PANEL_SQL, *ctes, body=body)


# ---------------------------------------------------------------------------
def q_clean_text(spark, d):
    return clean.clean_text(star_panel(spark, d)).select(*KEY, *STAR_STRING_COLS)


def q_clean_text_nullify(spark, d):
    cols = ["city", "station_code", "brand", "product"]
    return clean.clean_text_nullify(dirty_panel(star_panel(spark, d)), cols).select(*KEY, *cols)


def q_positive_prices(spark, d):
    return clean.positive_prices(dirty_panel(star_panel(spark, d)), R).select(*KEY, "price", "cost")


def q_sigma_outlier_filter(spark, d):
    return clean.sigma_outlier_filter(star_panel(spark, d), R).select(*KEY, "price", "cost")


def q_valid_dates(spark, d):
    df = dirty_raw_v2(star_panel(spark, d))
    return clean.valid_dates(df, "data_coleta_parsed", "Data_Coleta").select(*KEY, "Data_Coleta", "data_coleta_parsed")


def q_drop_all_null_rows(spark, d):
    raw = dirty_raw_v1(star_panel(spark, d)).drop(*KEY)   # the key would keep an empty row
    return clean.drop_all_null_rows(raw).select("Cep", "Municipio", "Produto", "Complemento")


def q_standardize_columns(spark, d):
    return clean.standardize_columns(raw_v1(star_panel(spark, d)))


def q_drop_missing_required(spark, d):
    df = clean.standardize_columns(dirty_raw_v1(star_panel(spark, d)))
    df = enrich.categorize_product_v1(df, "produto", "categoria_produto", rules=C.FUEL_CATEGORY_RULES_V1)
    return clean.drop_missing_required(df, C.FUEL_V1_REQUIRED).select(*KEY, *C.FUEL_V1_REQUIRED)


def q_nullify_out_of_range(spark, d):
    df = clean.standardize_columns(raw_v1(star_panel(spark, d)))
    df = clean.nullify_out_of_range(df, "valor_venda", *STAR_PRICE_RANGE)
    df = clean.nullify_out_of_range(df, "data_coleta", *STAR_DATE_RANGE)
    return df.select(*KEY, "valor_venda", "data_coleta")


def q_clean_digits_code(spark, d):
    df = clean.standardize_columns(dirty_raw_v1(star_panel(spark, d)))
    df = clean.clean_digits_code(df, "cnpj_revenda", 6)
    df = clean.clean_digits_code(df, "cep", 8)
    return df.select(*KEY, "cnpj_revenda", "cep")


def q_dedup_keep_first(spark, d):
    return clean.dedup_keep_first(star_panel(spark, d), R).select(*KEY, *R.tiebreak, "price")


def q_dedup_keep_last(spark, d):
    return clean.dedup_keep_last(star_panel(spark, d), R).select(*KEY, *R.tiebreak, "price")


def q_normalize_product(spark, d):
    return normalize.normalize_product(dirty_panel(star_panel(spark, d)), R).select(*KEY, "product", "product_norm")


def q_normalize_region(spark, d):
    return normalize.normalize_region(star_panel(spark, d), R).select(*KEY, "region", "region_norm")


def q_normalize_brand(spark, d):
    df = clean.clean_text(dirty_panel(star_panel(spark, d)))
    return normalize.normalize_brand(df, R).select(*KEY, "brand", "brand_norm")


def q_clean_tax_id(spark, d):
    return normalize.clean_tax_id(star_panel(spark, d), R).select(*KEY, "station_code", "tax_id_clean")


def q_region_from_state(spark, d):
    """v1 geography with the star schema's own state -> region dimension (25 nations, fixed
    by the schema) as the mapping, over states and regions with defects."""
    nat = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    mapping = {r["n_name"]: r["r_name"] for r in nat.select("n_name", "r_name").collect()}
    df = dirty_panel(star_panel(spark, d)).select(*KEY, "state", "region")
    return normalize.region_from_state(df, "state", "region", mapping)


def q_categorize_product(spark, d):
    df = normalize.normalize_product(star_panel(spark, d), R)
    return enrich.categorize_product(df, R).select(*KEY, "product_norm", "product_category")


def q_categorize_product_v1(spark, d):
    df = star_panel(spark, d)
    return enrich.categorize_product_v1(df, "product", rules=C.STAR_CATEGORY_RULES) \
                 .select(*KEY, "product", "product_category_v1")


def q_categorize_brand(spark, d):
    df = star_panel(spark, d)
    return enrich.categorize_brand(df, "brand", rules=STAR_BRAND_RULES_V1).select(*KEY, "brand", "brand_category")


def q_brand_size(spark, d):
    df = normalize.normalize_brand(clean.clean_text(star_panel(spark, d)), R)
    return enrich.brand_size(df, R).select(*KEY, "brand_norm", "brand_size")


def q_temporal_dimensions(spark, d):
    df = enrich.temporal_dimensions(star_panel(spark, d), R)
    return df.select(*KEY, "obs_date", "year", "month", "quarter", "semester", "weekday",
                     "month_name", "day_name", "day_of_month")


def q_margin_metrics(spark, d):
    return enrich.margin_metrics(star_panel(spark, d), R).select(*KEY, "price", "cost", "margin_abs", "margin_pct")


def q_price_band(spark, d):
    return enrich.price_band(star_panel(spark, d), R).select(*KEY, "price", "price_band")


def q_pairwise_viability(spark, d):
    return star_silver(spark, d).select(*KEY, "state", "obs_date", "product_norm", "price", "pair_viable")


def q_silver_clean(spark, d):
    return clean.silver_clean(star_panel(spark, d), R).select(*KEY, *STAR_STRING_COLS, "price", "cost", "obs_date")


def q_silver_normalize(spark, d):
    df = normalize.silver_normalize(clean.silver_clean(star_panel(spark, d), R), R)
    return df.select(*KEY, "product_norm", "region_norm", "brand_norm", "tax_id_clean")


def q_silver_enrich(spark, d):
    return star_silver(spark, d).select(
        *KEY, "year", "month", "quarter", "semester", "weekday", "month_name", "margin_abs", "margin_pct",
        "product_category", "brand_size", "pair_viable", "price_band")


V1_COLUMNS = ["regiao_sigla", "estado_sigla", "municipio", "revenda", "cnpj_revenda", "cep", "produto", "data_coleta",
              "valor_venda", "valor_compra", "categoria_produto", "categoria_bandeira", "region_consistent", "ano", "mes",
              "margin_pct"]


def star_v1(spark, d) -> silver_v1.V1Settings:
    """v1 settings of the star panel; its state -> region dimension has 25 rows by schema."""
    nat = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    regions = {r["n_name"]: r["r_name"] for r in nat.select("n_name", "r_name").collect()}
    return silver_v1.V1Settings(price_range=STAR_PRICE_RANGE, cost_range=STAR_PRICE_RANGE, date_range=STAR_DATE_RANGE,
                                regions=regions, product_rules=C.STAR_CATEGORY_RULES, brand_rules=STAR_BRAND_RULES_V1,
                                code_lengths={"cnpj_revenda": 6, "cep": 8}, keep=tuple(KEY))


def q_run_silver_v1(spark, d):
    """The v1 Silver job's written rows."""
    from ..session import scratch_path
    from ..sources import files
    out = scratch_path(spark, "silver-v1")
    report = silver_v1.run_silver_v1(spark, dirty_raw_v1(star_panel(spark, d)), out, star_v1(spark, d))
    if report["status"] != "completed":
        raise RuntimeError(report["error"])
    return files.read_layer(spark, out).select(*KEY, *V1_COLUMNS)


def q_run_checks_v1(spark, d):
    """Q17 on the dirty raw rows, standardised and enriched but not yet cleaned."""
    s = star_v1(spark, d)
    raw = silver_v1.standardize(dirty_raw_v1(star_panel(spark, d)), s)
    df = enrich.categorize_product_v1(raw, "produto", "categoria_produto", rules=s.product_rules).drop(*KEY)
    return silver_v1.run_checks_v1(df, s)


QUERIES = {
    "run_silver_v1": q_run_silver_v1, "run_checks_v1": q_run_checks_v1, "clean_text": q_clean_text, "clean_text_nullify": q_clean_text_nullify,
    "positive_prices": q_positive_prices, "sigma_outlier_filter": q_sigma_outlier_filter,
    "valid_dates": q_valid_dates, "drop_all_null_rows": q_drop_all_null_rows,
    "standardize_columns": q_standardize_columns, "drop_missing_required": q_drop_missing_required,
    "nullify_out_of_range": q_nullify_out_of_range, "clean_digits_code": q_clean_digits_code,
    "dedup_keep_first": q_dedup_keep_first, "dedup_keep_last": q_dedup_keep_last,
    "normalize_product": q_normalize_product, "normalize_region": q_normalize_region,
    "normalize_brand": q_normalize_brand, "clean_tax_id": q_clean_tax_id,
    "region_from_state": q_region_from_state, "categorize_product": q_categorize_product,
    "categorize_product_v1": q_categorize_product_v1, "categorize_brand": q_categorize_brand,
    "brand_size": q_brand_size, "temporal_dimensions": q_temporal_dimensions,
    "margin_metrics": q_margin_metrics, "price_band": q_price_band,
    "pairwise_viability": q_pairwise_viability, "silver_clean": q_silver_clean,
    "silver_normalize": q_silver_normalize, "silver_enrich": q_silver_enrich,
}


def v1_ctes() -> list[str]:
    """CTEs from the raw file of the first generation to its Silver: std ... v1_silver."""
    std = f"""std AS (SELECT l_orderkey, l_linenumber,
      "Regiao - Sigla" AS regiao_sigla, "Estado - Sigla" AS estado_sigla, "Municipio" AS municipio,
      "Revenda" AS revenda, "CNPJ da Revenda" AS cnpj_revenda, "Nome da Rua" AS nome_rua, "Numero Rua" AS numero_rua,
      "Complemento" AS complemento, "Bairro" AS bairro, "Cep" AS cep, "Produto" AS produto,
      CAST(TRY_CAST("Data da Coleta" AS TIMESTAMP) AS DATE) AS data_coleta,
      TRY_CAST("Valor de Venda" AS DOUBLE) AS valor_venda, TRY_CAST("Valor de Compra" AS DOUBLE) AS valor_compra,
      "Unidade de Medida" AS unidade_medida, "Bandeira" AS bandeira FROM raw_v1)"""
    def nul(c):
        return (f"CASE WHEN upper(trim({c})) IN {S.in_list(C.NULL_TEXT_TOKENS)} THEN NULL ELSE upper(trim({c})) END AS {c}")

    def code(c, n):
        digits = f"regexp_replace({c}, '[^0-9]', '', 'g')"
        return f"CASE WHEN length({digits}) = {n} THEN {digits} END AS {c}"

    lo, hi = STAR_PRICE_RANGE
    v1_cols = [c for c in C.FUEL_V1_RENAME.values()]
    v1 = [f"""v1_clean AS (SELECT * REPLACE ({", ".join(nul(c) for c in [*C.FUEL_V1_TEXT_COLUMNS, "regiao_sigla", "estado_sigla"])},
        {code("cnpj_revenda", 6)}, {code("cep", 8)},
        CASE WHEN valor_venda BETWEEN {lo!r} AND {hi!r} THEN valor_venda END AS valor_venda,
        CASE WHEN valor_compra BETWEEN {lo!r} AND {hi!r} THEN valor_compra END AS valor_compra,
        CASE WHEN data_coleta BETWEEN DATE '{STAR_DATE_RANGE[0]}' AND DATE '{STAR_DATE_RANGE[1]}' THEN data_coleta END AS data_coleta)
      FROM std WHERE NOT ({" AND ".join(f"{c} IS NULL" for c in v1_cols)}))""",
          f"""v1_rich AS (SELECT c.* REPLACE (COALESCE(m.r_name, c.regiao_sigla) AS regiao_sigla),
        {S.cascade("upper(produto)", C.STAR_CATEGORY_RULES, C.CATEGORY_DEFAULT, C.CATEGORY_V1_NULL)} AS categoria_produto,
        {S.cascade("upper(bandeira)", STAR_BRAND_RULES_V1, C.BRAND_CATEGORY_V1_DEFAULT, C.BRAND_CATEGORY_V1_NULL)} AS categoria_bandeira,
        COALESCE(c.regiao_sigla = m.r_name, false) AS region_consistent,
        CAST(year(data_coleta) AS INTEGER) AS ano, CAST(month(data_coleta) AS INTEGER) AS mes,
        {S.r("(valor_venda - valor_compra) / NULLIF(valor_compra, 0) * 100.0", 2)} AS margin_pct
      FROM v1_clean c LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) m
        ON c.estado_sigla = m.n_name)""",
          f"""v1_silver AS (SELECT * FROM v1_rich WHERE {" AND ".join(f"{c} IS NOT NULL" for c in C.FUEL_V1_REQUIRED)}
        QUALIFY row_number() OVER (PARTITION BY {", ".join(C.FUEL_V1_KEY)}
          ORDER BY {", ".join(f"{c} DESC NULLS LAST" for c in [*KEY, *silver_v1.TIES])}) = 1)"""]
    return [std, *v1]


def oracle() -> dict:
    txt = ", ".join(f"upper(trim({c})) AS {c}" for c in STAR_STRING_COLS)
    nullify = ", ".join(
        f"CASE WHEN upper(trim(CAST({c} AS VARCHAR))) IN {S.in_list(C.NULL_TEXT_TOKENS)} THEN NULL "
        f"ELSE upper(trim(CAST({c} AS VARCHAR))) END AS {c}" for c in ["city", "station_code", "brand", "product"])
    order_first = ", ".join(f"{c} ASC NULLS FIRST" for c in R.tiebreak)
    order_last = ", ".join(f"{c} DESC NULLS LAST" for c in R.tiebreak)
    tb = ", ".join(R.tiebreak)
    std, *v1 = v1_ctes()
    brand_raw = f"trim(replace(upper(trim(brand)), {S.q(C.BRAND_STRIP_TOKEN)}, ''))"
    brand_norm = (f"CASE WHEN {brand_raw} IN {S.in_list(C.BRAND_UNBRANDED_VALUES)} "
                  f"THEN {S.q(C.BRAND_UNBRANDED_LABEL)} ELSE {brand_raw} END")
    sigma = ["p2 AS (SELECT * FROM panel WHERE price <= (SELECT avg(price) + 3.0 * stddev_samp(price) FROM panel))",
             "c2 AS (SELECT * FROM p2 WHERE cost <= (SELECT avg(cost) + 3.0 * stddev_samp(cost) FROM p2))"]
    v1cat = S.cascade("upper(produto)", C.FUEL_CATEGORY_RULES_V1, C.CATEGORY_DEFAULT, C.CATEGORY_V1_NULL)
    lo, hi = STAR_PRICE_RANGE
    v1_cols = [c for c in C.FUEL_V1_RENAME.values()]
    n_null = " + ".join(f"count_if({c} IS NULL)" for c in v1_cols)   # the category is never null
    price_bad = " + ".join([f"count_if({c} IS NULL OR {c} < {lo!r} OR {c} > {hi!r})" for c in ("valor_venda", "valor_compra")]
                           + ["count_if(valor_venda <= valor_compra)"])

    def fences(c):
        return (f"""SELECT count_if(v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) / count(*) AS rate FROM
          (SELECT {c} AS v, quantile_cont({c}, 0.25) OVER () AS q1, quantile_cont({c}, 0.75) OVER () AS q3 FROM std WHERE {c} IS NOT NULL)""")
    required = " OR ".join(f"count_if({c} IS NULL) > 0" for c in C.FUEL_V1_REQUIRED if c != "categoria_produto")
    complete = f"1.0 - ({n_null}) / (count(*) * {float(len(v1_cols) + 1)!r})"
    return {
        "run_silver_v1": _panel_sql(f"SELECT {KEYS}, {', '.join(V1_COLUMNS)} FROM v1_silver", *DIRTY_V1_SQL, std, *v1),
        "run_checks_v1": _panel_sql(f"""SELECT 'completeness' AS "check", {complete} AS value, {complete} >= {C.V1_MIN_COMPLETENESS!r} AS passed FROM std
          UNION ALL SELECT 'critical_fields', CAST({required} AS INTEGER), NOT ({required}) FROM std
          UNION ALL SELECT 'duplicates', 1.0 - count(*) / sum(n), 1.0 - count(*) / sum(n) <= {C.V1_MAX_DUPLICATE_RATE!r}
            FROM (SELECT count(*) AS n FROM std GROUP BY {", ".join(v1_cols)})
          UNION ALL SELECT 'prices', {price_bad}, ({price_bad}) = 0 FROM std
          UNION ALL SELECT 'dates', count_if(data_coleta IS NULL) + n, count_if(data_coleta IS NULL) + n = 0 FROM std,
            (SELECT count_if(data_coleta < DATE '{STAR_DATE_RANGE[0]}' OR data_coleta > DATE '{STAR_DATE_RANGE[1]}') AS n FROM std) GROUP BY n
          UNION ALL SELECT 'geography', sum(n), sum(n) = 0 FROM (
            SELECT count_if(COALESCE(regiao_sigla NOT IN (SELECT r_name FROM region), true)) AS n FROM std
            UNION ALL SELECT count_if(COALESCE(estado_sigla NOT IN (SELECT n_name FROM nation), true)) FROM std)
          UNION ALL SELECT 'outliers', avg(rate), avg(rate) <= {C.V1_MAX_OUTLIER_RATE!r}
            FROM ({fences("valor_venda")} UNION ALL {fences("valor_compra")})""", *DIRTY_V1_SQL, std),
        "clean_text": _panel_sql(f"SELECT {KEYS}, {txt} FROM panel"),
        "clean_text_nullify": _panel_sql(f"SELECT {KEYS}, {nullify} FROM dirty", DIRTY_SQL),
        "positive_prices": _panel_sql(f"SELECT {KEYS}, price, cost FROM dirty WHERE price > 0 AND cost > 0", DIRTY_SQL),
        "sigma_outlier_filter": _panel_sql(f"SELECT {KEYS}, price, cost FROM c2", *sigma),
        "valid_dates": _panel_sql(f"""SELECT * FROM (SELECT {KEYS}, "Data_Coleta",
              CAST(try_strptime("Data_Coleta", '%d/%m/%Y') AS DATE) AS data_coleta_parsed FROM raw_v2)
            WHERE data_coleta_parsed IS NOT NULL""", *DIRTY_V2_SQL),
        "drop_all_null_rows": _panel_sql(
            'SELECT "Cep", "Municipio", "Produto", "Complemento" FROM raw_v1 WHERE NOT ('
            + " AND ".join(f'"{c}" IS NULL' for c in C.FUEL_V1_RAW_COLUMNS) + ")", *DIRTY_V1_SQL),
        "standardize_columns": _panel_sql("SELECT * FROM std", RAW_V1_SQL, std),
        "drop_missing_required": _panel_sql(f"""SELECT * FROM (SELECT {KEYS}, regiao_sigla, estado_sigla,
              {v1cat} AS categoria_produto, data_coleta, valor_venda FROM std)
            WHERE regiao_sigla IS NOT NULL AND estado_sigla IS NOT NULL AND categoria_produto IS NOT NULL
              AND data_coleta IS NOT NULL AND valor_venda IS NOT NULL""", *DIRTY_V1_SQL, std),
        "nullify_out_of_range": _panel_sql(f"""SELECT {KEYS},
              CASE WHEN valor_venda BETWEEN {STAR_PRICE_RANGE[0]!r} AND {STAR_PRICE_RANGE[1]!r} THEN valor_venda END AS valor_venda,
              CASE WHEN data_coleta BETWEEN DATE '{STAR_DATE_RANGE[0]}' AND DATE '{STAR_DATE_RANGE[1]}' THEN data_coleta END AS data_coleta
            FROM std""", RAW_V1_SQL, std),
        "clean_digits_code": _panel_sql(f"""SELECT {KEYS},
              CASE WHEN length(regexp_replace(cnpj_revenda, '[^0-9]', '', 'g')) = 6 THEN regexp_replace(cnpj_revenda, '[^0-9]', '', 'g') END AS cnpj_revenda,
              CASE WHEN length(regexp_replace(cep, '[^0-9]', '', 'g')) = 8 THEN regexp_replace(cep, '[^0-9]', '', 'g') END AS cep
            FROM std""", *DIRTY_V1_SQL, std),
        "dedup_keep_first": _panel_sql(f"""SELECT {KEYS}, {tb}, price FROM panel
            QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY {order_first}) = 1"""),
        "dedup_keep_last": _panel_sql(f"""SELECT {KEYS}, {tb}, price FROM panel
            QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY {order_last}) = 1"""),
        "normalize_product": _panel_sql(f"SELECT {KEYS}, product, {S.map_keep('product', R.product_map)} AS product_norm FROM dirty", DIRTY_SQL),
        "normalize_region": _panel_sql(f"SELECT {KEYS}, region, {S.map_keep('region', R.region_map)} AS region_norm FROM panel"),
        "normalize_brand": _panel_sql(f"SELECT {KEYS}, upper(trim(brand)) AS brand, {brand_norm} AS brand_norm FROM dirty", DIRTY_SQL),
        "clean_tax_id": _panel_sql(f"SELECT {KEYS}, station_code, regexp_replace(station_code, '[^0-9]', '', 'g') AS tax_id_clean FROM panel"),
        "region_from_state": _panel_sql(f"""SELECT p.state, {', '.join('p.' + k for k in KEY)}, p.region, m.r_name AS region_derived,
              COALESCE(p.region = m.r_name, false) AS region_consistent, m.r_name AS region_v1
            FROM dirty p LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) m
              ON p.state = m.n_name""", DIRTY_SQL),
        "categorize_product": _panel_sql(f"""SELECT {KEYS}, product_norm,
              {S.cascade('product_norm', R.category_rules, C.CATEGORY_DEFAULT)} AS product_category
            FROM (SELECT *, {S.map_keep('product', R.product_map)} AS product_norm FROM panel)"""),
        "categorize_product_v1": _panel_sql(f"""SELECT {KEYS}, product,
              {S.cascade('upper(product)', C.STAR_CATEGORY_RULES, C.CATEGORY_DEFAULT, C.CATEGORY_V1_NULL)} AS product_category_v1 FROM panel"""),
        "categorize_brand": _panel_sql(f"""SELECT {KEYS}, brand,
              {S.cascade('upper(brand)', STAR_BRAND_RULES_V1, C.BRAND_CATEGORY_V1_DEFAULT, C.BRAND_CATEGORY_V1_NULL)} AS brand_category FROM panel"""),
        "brand_size": _panel_sql(f"""SELECT {KEYS}, brand_norm,
              CASE WHEN brand_norm IN {S.in_list(R.majors_silver)} THEN 'GRANDE' ELSE 'REGIONAL' END AS brand_size
            FROM (SELECT *, {brand_norm} AS brand_norm FROM panel)"""),
        "temporal_dimensions": _panel_sql(f"""SELECT {KEYS}, obs_date, CAST(year(obs_date) AS INTEGER) AS year,
              CAST(month(obs_date) AS INTEGER) AS month, CAST(quarter(obs_date) AS INTEGER) AS quarter, CASE WHEN month(obs_date) <= 6 THEN 1 ELSE 2 END AS semester,
              CAST(isodow(obs_date) - 1 AS INTEGER) AS weekday, monthname(obs_date) AS month_name,
              dayname(obs_date) AS day_name, CAST(day(obs_date) AS INTEGER) AS day_of_month FROM panel"""),
        "margin_metrics": _panel_sql(f"""SELECT {KEYS}, price, cost, price - cost AS margin_abs,
              (price - cost) / NULLIF(cost, 0) * 100.0 AS margin_pct FROM panel"""),
        "price_band": _panel_sql(f"SELECT {KEYS}, price, {S.band_case('price', R.band_edges, C.BAND_LABELS)} AS price_band FROM panel"),
        "pairwise_viability": silver_sql(f"SELECT {KEYS}, state, obs_date, product_norm, price, pair_viable FROM silver"),
        "silver_clean": silver_sql(f"SELECT {KEYS}, {', '.join(STAR_STRING_COLS)}, price, cost, obs_date FROM d1"),
        "silver_normalize": silver_sql(f"SELECT {KEYS}, product_norm, region_norm, brand_norm, tax_id_clean FROM norm"),
        "silver_enrich": silver_sql(f"""SELECT {KEYS}, year, month, quarter, semester, weekday, month_name, margin_abs,
              margin_pct, product_category, brand_size, pair_viable, price_band FROM silver"""),
    }


