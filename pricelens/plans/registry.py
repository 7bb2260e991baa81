"""Registered queries: name -> (spark builder, oracle SQL or None).

Every builder takes (spark, sf_dir) and reads the whole star-schema tables
through the panel (plans/silver.py); nothing is subset or capped.

Outputs that the reference leaves unrounded and that come from float sums
(means, deviations, correlations) depend on summation order in the last bits;
registered queries present those named columns at 6 dp, identically in both
engines (``STABLE``). The library operators themselves do not round.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import STAR, silver_roles
from ..functions import round_he
from . import dashboard, gold, gold_v1, incremental_q, io_q, jobs_v1_q, quality_q, stages
from . import sqlgen as S
from .silver import silver_sql, star_silver

SR = silver_roles(STAR)
DIGITS = 6
SLICE = {"years": [1996, 1997, 1998], "products": ["STANDARD", "ECONOMY", "PROMO"],
         "regions": ["AMERICA", "ASIA", "EUROPE"]}

STABLE = {
    "ethanol_ratio_history": ["substitute_price", "reference_price"],
    "price_volume_elasticity": ["price_volume_corr", "price_mean"],
    **gold_v1.STABLE,
    **quality_q.STABLE,
    **io_q.STABLE,
    **jobs_v1_q.STABLE,
    **incremental_q.STABLE,
    "dash_evolution": ["price_mean"],
    "dash_regional_main": ["price_mean"],
    "viability_by_state_month": ["pair_ratio"],
    "dash_seasonal": ["price_mean"],
    "dash_kpis": ["reference_price", "substitute_price", "pair_ratio"],
    "dash_regional_rank": ["price_mean"],
    "dash_overall_viability": ["overall_viability_pct"],
    "best_viability_state": ["viability_rate"],
    "dash_brand_positioning": ["price_mean"],
    "dash_brand_avg": ["market_share_mean", "price_mean"],
    "slice_filter": ["price_mean", "margin_pct"],
    "latest_years_slice": ["price_mean", "margin_pct"],
}


def _stabilize_df(df, cols):
    return df.withColumns({c: round_he(F.col(c), DIGITS) for c in cols}) if cols else df


def _stabilize_sql(sql: str, cols) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"{S.r(c, DIGITS)} AS {c}" for c in cols)
    head, sep, body = sql.rpartition("\n-- body\n")
    return f"{head}{sep}SELECT * REPLACE ({rep}) FROM (\n{body}\n) AS _stable"


def _sql(entry):
    """An oracle entry is a body over ``silver`` or (extra CTEs, body)."""
    if entry is None:
        return None
    if isinstance(entry, tuple):
        ctes, body = entry
        return silver_sql(body, extra_ctes=ctes)
    return silver_sql(entry)


def _on_silver(fn):
    def run(spark, sf_dir):
        return fn(star_silver(spark, sf_dir, viability=False, checkpoint=True), SR)
    return run


def _on_dash(fn):
    def run(spark, sf_dir):
        return fn(dashboard.dash_frame(star_silver(spark, sf_dir, viability=False, checkpoint=True), SR), SR)
    return run


def _register(reg, name, fn, sql):
    cols = STABLE.get(name, [])

    def run(spark, sf_dir, fn=fn, cols=cols):
        return _stabilize_df(fn(spark, sf_dir), cols)
    run.__name__ = name
    reg[name] = (run, _stabilize_sql(sql, cols) if sql is not None else None)


def registry() -> dict:
    reg = {}
    g_sql = gold.oracle(SR)
    for name, fn in gold.QUERIES.items():
        _register(reg, name, _on_silver(fn), _sql(g_sql[name]))
    v_sql = gold_v1.oracle(SR)
    for name, fn in gold_v1.QUERIES.items():
        _register(reg, name, _on_silver(fn), _sql(v_sql[name]))

    d_sql = dashboard.oracle(SR, SLICE)
    D = dashboard
    for name, fn in {
        "dash_evolution": D.dash_evolution, "dash_regional_main": D.dash_regional_main,
        "viability_by_state_month": D.viability_by_state_month,
        "dash_viability_summary": D.dash_viability_summary, "dash_market_share": D.dash_market_share,
        "dash_seasonal": D.dash_seasonal, "dash_kpis": D.dash_kpis,
        "dash_regional_rank": D.dash_regional_rank, "dash_overall_viability": D.dash_overall_viability,
        "best_viability_state": D.best_viability_state,
        "dash_brand_positioning": D.dash_brand_positioning,
    }.items():
        _register(reg, name, _on_dash(fn), _sql(d_sql[name]))
    _register(reg, "dash_brand_avg", _on_silver(D.dash_brand_avg), _sql(d_sql["dash_brand_avg"]))
    _register(reg, "top_k_ranking", _on_silver(D.top_k_ranking), _sql(d_sql["top_k_ranking"]))
    _register(reg, "slice_filter",
              lambda spark, d: D.slice_filter(D.dash_frame(star_silver(spark, d, viability=False, checkpoint=True), SR), **SLICE),
              _sql(d_sql["slice_filter"]))
    _register(reg, "latest_years_slice",
              lambda spark, d: D.latest_years_slice(D.dash_frame(star_silver(spark, d, viability=False, checkpoint=True), SR)),
              _sql(d_sql["latest_years_slice"]))
    q_sql = quality_q.oracle()
    for name, fn in quality_q.QUERIES.items():
        _register(reg, name, fn, q_sql.get(name))
    io_sql = io_q.oracle()
    for name, fn in io_q.QUERIES.items():
        _register(reg, name, fn, io_sql.get(name))
    for module in (jobs_v1_q, incremental_q):
        sql = module.oracle()
        for name, fn in module.QUERIES.items():
            _register(reg, name, fn, sql.get(name))
    st_sql = stages.oracle()
    for name, fn in stages.QUERIES.items():
        _register(reg, name, fn, st_sql.get(name))
    return reg
