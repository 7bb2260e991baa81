"""Silver: panel -> clean -> normalise -> enrich, in Spark and as oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..config import STAR, PanelRoles
from ..operators.clean import silver_clean
from ..operators.enrich import silver_enrich
from ..operators.normalize import silver_normalize
from ..sources.panel import PANEL_SQL, star_columns, star_rows
from . import sqlgen as S


def build_silver(df: DataFrame, roles: PanelRoles, date_source: str | None = None,
                 checkpoint: bool | str = False, viability: bool = True, written: bool = False, derive=None) -> DataFrame:
    """R5 -> R6 -> R7. Lazy by default, so a query that needs five columns
    reads five; a job that writes every column checkpoints the rows, or names
    rows that are ``written``, instead of re-running the joins for each sigma pass."""
    df = silver_clean(df, roles, date_source=date_source, checkpoint=checkpoint, written=written,
                      derive=derive)
    df = silver_normalize(df, roles)
    return silver_enrich(df, roles, measured=bool(checkpoint) or written, viability=viability)


def star_silver(spark: SparkSession, sf_dir: str, roles: PanelRoles = STAR, viability: bool = True,
                checkpoint: bool | str = False) -> DataFrame:
    """Silver of the star panel (``checkpoint`` as in ``build_silver``); a query that doesn't look at the viability flag leaves it out,
    as Catalyst keeps its join (and the second panel behind it) even if no one reads the flag."""
    rows = star_rows(spark, sf_dir)
    if not {*roles.key, *roles.tiebreak} <= {*rows.columns}:  # a dedup by computed columns comes after them
        return build_silver(star_columns(rows), roles, checkpoint=checkpoint, viability=viability)
    return build_silver(rows, roles, checkpoint=checkpoint, viability=viability, derive=star_columns)


STAR_STRING_COLS = ["region", "state", "city", "station_code", "product", "brand",
                    "l_returnflag", "l_linestatus"]


def silver_sql_ctes(roles: PanelRoles = STAR) -> list[str]:
    """CTE chain ending in ``silver``; mirrors build_silver on the star panel."""
    key = ", ".join(roles.key)
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in roles.tiebreak)
    txt = ", ".join(f"upper(trim({c})) AS {c}" for c in STAR_STRING_COLS)
    sub, ref = roles.pair
    brand_raw = f"trim(replace(brand, {S.q(C.BRAND_STRIP_TOKEN)}, ''))"
    return [
        PANEL_SQL,
        f"""dedup AS (SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)""",
        f"""txt AS (SELECT * REPLACE ({txt}) FROM dedup)""",
        """p1 AS (SELECT * FROM txt WHERE price > 0)""",
        """p2 AS (SELECT * FROM p1 WHERE price <= (SELECT avg(price) + 3.0 * stddev_samp(price) FROM p1))""",
        """c1 AS (SELECT * FROM p2 WHERE cost > 0)""",
        """c2 AS (SELECT * FROM c1 WHERE cost <= (SELECT avg(cost) + 3.0 * stddev_samp(cost) FROM c1))""",
        """d1 AS (SELECT * FROM c2 WHERE obs_date IS NOT NULL)""",
        f"""norm AS (SELECT *,
              {S.map_keep('product', roles.product_map)} AS product_norm,
              {S.map_keep('region', roles.region_map)} AS region_norm,
              CASE WHEN {brand_raw} IN {S.in_list(C.BRAND_UNBRANDED_VALUES)}
                   THEN {S.q(C.BRAND_UNBRANDED_LABEL)} ELSE {brand_raw} END AS brand_norm,
              regexp_replace(station_code, '[^0-9]', '', 'g') AS tax_id_clean
            FROM d1)""",
        f"""enr AS (SELECT *,
              CAST(year(obs_date) AS INTEGER) AS year, CAST(month(obs_date) AS INTEGER) AS month, CAST(quarter(obs_date) AS INTEGER) AS quarter,
              CASE WHEN month(obs_date) <= 6 THEN 1 ELSE 2 END AS semester,
              CAST(isodow(obs_date) - 1 AS INTEGER) AS weekday, monthname(obs_date) AS month_name,
              dayname(obs_date) AS day_name, CAST(day(obs_date) AS INTEGER) AS day_of_month,
              price - cost AS margin_abs,
              (price - cost) / NULLIF(cost, 0) * 100.0 AS margin_pct,
              {S.cascade('product_norm', roles.category_rules, C.CATEGORY_DEFAULT)} AS product_category,
              CASE WHEN brand_norm IN {S.in_list(roles.majors_silver)} THEN 'GRANDE' ELSE 'REGIONAL' END AS brand_size,
              {S.band_case('price', roles.band_edges, C.BAND_LABELS)} AS price_band
            FROM norm)""",
        f"""refm AS (SELECT state, obs_date, avg(price) AS _ref_mean FROM enr
              WHERE product_norm = {S.q(ref)} GROUP BY state, obs_date)""",
        f"""silver AS (SELECT enr.*,
              CASE WHEN enr.product_norm = {S.q(sub)} AND refm._ref_mean IS NOT NULL
                   THEN enr.price / NULLIF(refm._ref_mean, 0) <= {roles.pair_threshold!r} END AS pair_viable
            FROM enr LEFT JOIN refm ON enr.state = refm.state AND enr.obs_date = refm.obs_date)""",
    ]


def silver_sql(body: str, extra_ctes=(), roles: PanelRoles = STAR) -> str:
    return S.with_ctes(*silver_sql_ctes(roles), *extra_ctes, body=body)
