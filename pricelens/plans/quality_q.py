"""Registered data-quality queries (Q1-Q18) over raw-file views of the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import clean, quality as Q
from ..sources.panel import PANEL_SQL, star_panel
from . import sqlgen as S
from .stages import DIRTY_V1_SQL, DIRTY_V2_SQL, KEY, STAR_DATE_RANGE, STAR_PRICE_RANGE, dirty_raw_v1, dirty_raw_v2

STAR_PRODUCTS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
STAR_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
STAR_STATES = [f"NATION_{i}" for i in range(25)]   # rule of the schema, not a copied list
RULES_V2 = {
    "Valor_Venda": {"min": STAR_PRICE_RANGE[0], "max": STAR_PRICE_RANGE[1]},
    "Valor_Compra": {"min": STAR_PRICE_RANGE[0], "max": STAR_PRICE_RANGE[1]},
    "Produto": {"values": STAR_PRODUCTS},
    "Regiao": {"values": STAR_REGIONS},
    "Data_Coleta": {"date_format": C.DATE_FORMAT},
}
KEYS_V2 = ["CNPJ", "Data_Coleta", "Produto"]
RAW_V2_COLS = [("Regiao", "s"), ("Estado", "s"), ("Municipio", "s"), ("Revenda", "s"), ("CNPJ", "s"),
               ("Endereco", "s"), ("Produto", "s"), ("Data_Coleta", "s"), ("Valor_Venda", "d"),
               ("Valor_Compra", "d"), ("Unidade_Medida", "s"), ("Bandeira", "s")]
V1_REQUIRED = ["regiao_sigla", "estado_sigla", "produto", "data_coleta", "valor_venda"]
V1_COLS = ["regiao_sigla", "estado_sigla", "municipio", "revenda", "cnpj_revenda", "nome_rua", "numero_rua",
           "complemento", "bairro", "cep", "produto", "data_coleta", "valor_venda", "valor_compra",
           "unidade_medida", "bandeira"]


def bronze_raw(spark, d):
    return dirty_raw_v2(star_panel(spark, d)).drop(*KEY)


def std_v1(spark, d):
    return clean.standardize_columns(dirty_raw_v1(star_panel(spark, d))).drop(*KEY)


def _report(spark, d):
    return Q.quality_report(bronze_raw(spark, d), RULES_V2, KEYS_V2)


def _prices(spark, d):
    return Q.price_validation(std_v1(spark, d), "valor_venda", "valor_compra", STAR_PRICE_RANGE, STAR_PRICE_RANGE)


def _outliers(spark, d):
    return Q.iqr_outliers(std_v1(spark, d), ["valor_venda", "valor_compra"])


def _weighted(spark, d):
    return Q.run_quality_checks_v1(std_v1(spark, d), V1_REQUIRED, "valor_venda", "valor_compra", "data_coleta",
                                   STAR_PRICE_RANGE, STAR_PRICE_RANGE, STAR_DATE_RANGE, {"region": ("regiao_sigla", STAR_REGIONS)}
                                   )["score"].select("quality_score")


def _schema_check(spark, d):
    df = std_v1(spark, d)
    res = Q.schema_check(df, C.FUEL_V1_REQUIRED)
    # The schema verdict, next to the row count of the data it describes.
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(",".join(res["missing_columns"])).alias("missing_columns"),
        F.lit(",".join(res["extra_columns"])).alias("extra_columns"),
        F.lit(res["schema_valid"]).alias("schema_valid"), "n_rows")


QUERIES = {
    "quality_completeness": lambda s, d: Q.completeness(bronze_raw(s, d)),
    "quality_validity": lambda s, d: Q.validity(bronze_raw(s, d), RULES_V2),
    "quality_uniqueness": lambda s, d: Q.uniqueness(bronze_raw(s, d), KEYS_V2),
    "quality_consistency": lambda s, d: Q.consistency(bronze_raw(s, d)),
    "quality_report": _report,
    "quality_overall": lambda s, d: Q.overall_score(_report(s, d)),
    "quality_issues": lambda s, d: Q.quality_issues(_report(s, d)),
    "quality_v1_checks": lambda s, d: Q.v1_checks(std_v1(s, d), V1_REQUIRED),
    "price_validation": _prices,
    "date_validation": lambda s, d: Q.date_validation(std_v1(s, d), "data_coleta", STAR_DATE_RANGE),
    "geo_validation": lambda s, d: Q.geo_validation(std_v1(s, d), {
        "region": ("regiao_sigla", STAR_REGIONS), "state": ("estado_sigla", STAR_STATES)}),
    "iqr_outliers": _outliers,
    "quality_weighted_score": _weighted,
    "quality_status_band": lambda s, d: Q.status_band(_weighted(s, d)),
    "schema_check": _schema_check,
}

STABLE = {
    "quality_overall": ["overall_score"],
    "quality_report": ["score"],
    "quality_issues": ["score"],
    "iqr_outliers": ["q1", "q3", "median", "iqr", "lower_bound", "upper_bound", "rate", "overall_rate"],
    "quality_weighted_score": ["quality_score"],
    "quality_status_band": ["quality_score"],
}


def report_sql() -> str:
    """The quality report's SQL, for the query that writes the report."""
    return oracle()["quality_report"]


def _dq(c):
    return '"' + c + '"'


def oracle() -> dict:
    B = "b AS (SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM raw_v2)"
    std = f"""std AS (SELECT "Regiao - Sigla" AS regiao_sigla, "Estado - Sigla" AS estado_sigla,
      "Municipio" AS municipio, "Revenda" AS revenda, "CNPJ da Revenda" AS cnpj_revenda, "Nome da Rua" AS nome_rua,
      "Numero Rua" AS numero_rua, "Complemento" AS complemento, "Bairro" AS bairro, "Cep" AS cep,
      "Produto" AS produto, CAST(TRY_CAST("Data da Coleta" AS TIMESTAMP) AS DATE) AS data_coleta,
      TRY_CAST("Valor de Venda" AS DOUBLE) AS valor_venda, TRY_CAST("Valor de Compra" AS DOUBLE) AS valor_compra,
      "Unidade de Medida" AS unidade_medida, "Bandeira" AS bandeira FROM raw_v1)"""

    def comp_sql():
        return "\nUNION ALL\n".join(
            f"SELECT 'completeness' AS metric, '{c}' AS column_name, CAST(count({_dq(c)}) AS DOUBLE) / count(*) AS score FROM b"
            for c, _ in RAW_V2_COLS)

    def rule(c, r):
        x = _dq(c)
        if "min" in r:
            return f"{x} >= {r['min']!r} AND {x} <= {r['max']!r}"
        if "values" in r:
            return f"{x} IN {S.in_list(r['values'])}"
        return f"try_strptime({x}, '%d/%m/%Y') IS NOT NULL"

    def val_sql():
        return "\nUNION ALL\n".join(
            f"SELECT 'validity' AS metric, '{c}' AS column_name, CAST(count_if(COALESCE({rule(c, r)}, false)) AS DOUBLE) / count(*) AS score FROM b"
            for c, r in RULES_V2.items())

    def cons_sql():
        parts = []
        for c, t in RAW_V2_COLS:
            if t == "s":
                parts.append(f"""SELECT 'consistency' AS metric, '{c}' AS column_name,
                  COALESCE(CAST(max(k) AS DOUBLE) / sum(k), 1.0) AS score
                  FROM (SELECT length({_dq(c)}) AS len, count(*) AS k FROM b WHERE {_dq(c)} IS NOT NULL GROUP BY 1)""")
            else:
                parts.append(f"SELECT 'consistency' AS metric, '{c}' AS column_name, CAST(count({_dq(c)}) AS DOUBLE) / count(*) AS score FROM b")
        return "\nUNION ALL\n".join(parts)

    key_cols = ", ".join(_dq(k) for k in KEYS_V2)
    uniq = f"SELECT COALESCE(CAST(count(*) AS DOUBLE) / sum(c), 1.0) AS uniqueness FROM (SELECT count(*) AS c FROM b GROUP BY {key_cols})"
    report = f"""report AS (
      SELECT 'total_rows' AS metric, CAST(NULL AS VARCHAR) AS column_name, CAST(count(*) AS DOUBLE) AS score FROM b
      UNION ALL SELECT 'total_columns', NULL, {float(len(RAW_V2_COLS))!r}
      UNION ALL {comp_sql()}
      UNION ALL {cons_sql()}
      UNION ALL {val_sql()}
      UNION ALL SELECT 'uniqueness', NULL, uniqueness FROM ({uniq}))"""
    overall = """SELECT COALESCE(avg(m), 0.0) AS overall_score FROM (
      SELECT metric, avg(score) AS m FROM report WHERE metric IN ('completeness', 'validity', 'consistency', 'uniqueness')
      GROUP BY metric)"""
    pct = "CAST(round_even(score * 100.0 * 10.0, 0) / 10.0 AS VARCHAR)"
    issues = f"""SELECT metric, column_name, score,
        CASE WHEN column_name IS NULL THEN 'low ' || metric || ': ' || {pct} || '%'
             ELSE 'column ''' || column_name || ''' low ' || metric || ': ' || {pct} || '%' END AS issue
      FROM report WHERE (metric = 'completeness' AND score < {C.ISSUE_MIN_COMPLETENESS!r})
        OR (metric = 'validity' AND score < {C.ISSUE_MIN_VALIDITY!r})
        OR (metric = 'uniqueness' AND score < {C.ISSUE_MIN_UNIQUENESS!r})
      UNION ALL
      SELECT 'overall', NULL, overall_score,
             'overall quality below target: ' || CAST(round_even(overall_score * 100.0 * 10.0, 0) / 10.0 AS VARCHAR) || '%'
      FROM ({overall}) WHERE overall_score < {C.ISSUE_MIN_OVERALL!r}"""

    nulls = " + ".join(f"count_if({c} IS NULL)" for c in V1_COLS)
    crit = " OR ".join(f"count_if({c} IS NULL) > 0" for c in V1_REQUIRED)
    grp = ", ".join(V1_COLS)
    v1c = f"""v1c AS (SELECT comp AS completeness, comp >= {C.V1_MIN_COMPLETENESS!r} AS completeness_passed,
        crit AS critical_fields_missing, dup AS duplicate_count, COALESCE(dup / NULLIF(n, 0), 0.0) AS duplicate_rate,
        COALESCE(dup / NULLIF(n, 0), 0.0) <= {C.V1_MAX_DUPLICATE_RATE!r} AS duplicates_passed
      FROM (SELECT 1.0 - a.nulls / NULLIF(a.n * {float(len(V1_COLS))!r}, 0) AS comp, a.crit, a.n,
                   CAST(COALESCE(d.t - d.k, 0) AS BIGINT) AS dup
            FROM (SELECT count(*) AS n, {nulls} AS nulls, ({crit}) AS crit FROM std) a,
                 (SELECT sum(c) AS t, count(*) AS k FROM (SELECT count(*) AS c FROM std GROUP BY {grp})) d))"""

    lo, hi = STAR_PRICE_RANGE
    prices = f"""pv AS (
      SELECT 'valor_venda' AS measure, CAST(count_if(valor_venda IS NULL OR valor_venda < {lo!r} OR valor_venda > {hi!r}) AS BIGINT) AS invalid_count,
             count_if(valor_venda IS NULL OR valor_venda < {lo!r} OR valor_venda > {hi!r}) / count(*) AS invalid_rate,
             CAST({lo!r} AS DOUBLE) AS min_valid, CAST({hi!r} AS DOUBLE) AS max_valid, min(valor_venda) AS actual_min, max(valor_venda) AS actual_max FROM std
      UNION ALL
      SELECT 'valor_compra', CAST(count_if(valor_compra IS NULL OR valor_compra < {lo!r} OR valor_compra > {hi!r}) AS BIGINT),
             count_if(valor_compra IS NULL OR valor_compra < {lo!r} OR valor_compra > {hi!r}) / count(*),
             {lo!r}, {hi!r}, min(valor_compra), max(valor_compra) FROM std
      UNION ALL
      SELECT 'relation', CAST(count_if(valor_venda <= valor_compra) AS BIGINT), count_if(valor_venda <= valor_compra) / count(*),
             NULL, NULL, NULL, NULL FROM std)"""

    def iqr_one(c):
        return f"""SELECT '{c}' AS measure, q1, q3, median, iqr, lower_bound, upper_bound,
            CAST(cnt AS BIGINT) AS count, cnt / n AS rate FROM (
          SELECT q.*, count_if(x.v < q.lower_bound OR x.v > q.upper_bound) AS cnt, count(*) AS n
          FROM (SELECT {c} AS v FROM std WHERE {c} IS NOT NULL) x,
               (SELECT q1, q3, median, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
                FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.5) AS median
                      FROM std WHERE {c} IS NOT NULL)) q
          GROUP BY ALL)"""
    iqr = f"""iqr AS (SELECT u.*, o.overall_rate, o.overall_rate <= {C.V1_MAX_OUTLIER_RATE!r} AS passed
      FROM ({iqr_one('valor_venda')} UNION ALL {iqr_one('valor_compra')}) u,
           (SELECT avg(rate) AS overall_rate FROM ({iqr_one('valor_venda')} UNION ALL {iqr_one('valor_compra')})) o)"""
    w = C.V1_SCORE_WEIGHTS
    weighted = f"""ws AS (SELECT (v.completeness * {w['completeness']!r} + (1.0 - v.duplicate_rate) * {w['duplicates']!r}
        + {w['schema']!r} + p.pp * {w['prices']!r} + (1.0 - o.oo) * {w['outliers']!r}) / {sum(w.values())!r} * 100.0 AS quality_score
      FROM v1c v, (SELECT avg(1.0 - invalid_rate) AS pp FROM pv WHERE measure <> 'relation') p,
           (SELECT first(overall_rate) AS oo FROM iqr) o)"""
    band = " ".join(f"WHEN quality_score >= {lo_!r} THEN {S.q(lab)}" for lo_, lab in C.V1_STATUS_BANDS)

    def P(body, *ctes):
        return S.with_ctes(PANEL_SQL, *DIRTY_V2_SQL, B, *ctes, body=body)

    def V(body, *ctes):
        return S.with_ctes(PANEL_SQL, *DIRTY_V1_SQL, std, *ctes, body=body)

    dlo, dhi = STAR_DATE_RANGE
    def geo(lvl, c, vals):
        return (f"""SELECT '{lvl}' AS level, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows,
            COALESCE({c} IN {S.in_list(vals)}, false) AS is_valid FROM std GROUP BY {c}""")
    missing = sorted(set(C.FUEL_V1_REQUIRED) - set(V1_COLS))
    extra = sorted(set(V1_COLS) - set(C.FUEL_V1_REQUIRED))
    return {
        "schema_check": V(f"SELECT {S.q(','.join(missing))} AS missing_columns, {S.q(','.join(extra))} AS extra_columns, "
                          f"{not missing} AS schema_valid, count(*) AS n_rows FROM std"),
        "quality_completeness": P(comp_sql()),
        "quality_validity": P(val_sql()),
        "quality_uniqueness": P(uniq),
        "quality_consistency": P(cons_sql()),
        "quality_report": P("SELECT * FROM report", report),
        "quality_overall": P(overall, report),
        "quality_issues": P(issues, report),
        "quality_v1_checks": V("SELECT * FROM v1c", v1c),
        "price_validation": V("SELECT * FROM pv", prices),
        "date_validation": V(f"""SELECT *, invalid_format_count + out_of_range_count = 0 AS passed FROM (
            SELECT CAST(count_if(data_coleta IS NULL) AS BIGINT) AS invalid_format_count,
                   CAST(count_if(data_coleta < DATE '{dlo}' OR data_coleta > DATE '{dhi}') AS BIGINT) AS out_of_range_count,
                   min(data_coleta) AS min_date, max(data_coleta) AS max_date FROM std)"""),
        "geo_validation": V(geo("region", "regiao_sigla", STAR_REGIONS) + "\nUNION ALL\n"
                            + geo("state", "estado_sigla", STAR_STATES)),
        "iqr_outliers": V("SELECT * FROM iqr", iqr),
        "quality_weighted_score": V("SELECT * FROM ws", v1c, prices, iqr, weighted),
        "quality_status_band": V(f"SELECT quality_score, CASE {band} ELSE {S.q(C.V1_STATUS_DEFAULT)} END AS status FROM ws",
                                 v1c, prices, iqr, weighted),
    }
