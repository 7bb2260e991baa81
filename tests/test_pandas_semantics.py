"""Brute-force cross-check against pandas (the reference's engine) on a small
seeded fixture: group means/medians with .round(3), average-tie rank,
interpolated quantile thresholds, shares, dense rank and pct_change."""

import numpy as np
import pandas as pd
import pytest

from pricelens.config import STAR
from pricelens.plans import gold, gold_v1

R = STAR.with_(product="product", region="region", brand="brand", state="state", year="year", month="month")


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(11)
    n = 3000
    pdf = pd.DataFrame({
        "product": rng.choice(["A", "B", "C"], n), "region": rng.choice(["N", "S", "E"], n),
        "brand": rng.choice([f"B{i}" for i in range(9)], n), "state": rng.choice([f"S{i}" for i in range(7)], n),
        "year": rng.choice([2020, 2021, 2022], n).astype("int32"), "month": rng.integers(1, 13, n).astype("int32"),
        "price": np.round(rng.lognormal(1.5, 0.3, n), 3),
        "city": rng.choice(["C1", "C2", "C3", "C4"], n), "station": rng.integers(0, 40, n),
    })
    pdf["cost"] = np.round(pdf["price"] * rng.uniform(0.85, 0.95, n), 3)
    pdf["margin_pct"] = (pdf["price"] - pdf["cost"]) / pdf["cost"] * 100
    return pdf, spark.createDataFrame(pdf)


def _by(df, keys):
    return df.sort_values(keys).reset_index(drop=True)


def test_state_ranking_matches_pandas(frames):
    pdf, sdf = frames
    g = pdf.groupby(["state", "product"]).agg(price_mean=("price", "mean"), price_median=("price", "median"),
                                               price_count=("price", "count")).round(3).reset_index()
    g["price_rank"] = g.groupby("product")["price_mean"].rank(ascending=True)
    got = _by(gold.state_price_ranking(sdf, R).toPandas(), ["state", "product"])
    want = _by(g, ["state", "product"])
    for c in ["price_mean", "price_median", "price_rank"]:
        np.testing.assert_allclose(got[c], want[c], rtol=0, atol=1e-9)


def test_brand_positioning_and_share_match_pandas(frames):
    pdf, sdf = frames
    bp = pdf.groupby(["brand", "product"]).agg(price_mean=("price", "mean")).round(3).reset_index()
    for p, grp in bp.groupby("product"):
        q33, q67 = grp["price_mean"].quantile(0.33), grp["price_mean"].quantile(0.67)
        bp.loc[grp.index, "price_strategy"] = np.select(
            [grp["price_mean"] <= q33, grp["price_mean"] <= q67], ["ECONOMICA", "MEDIA"], default="PREMIUM")
    got = _by(gold.brand_positioning(sdf, R).toPandas(), ["brand", "product"])
    assert list(got["price_strategy"]) == list(_by(bp, ["brand", "product"])["price_strategy"])

    ms = pdf.groupby(["brand", "product"]).size().reset_index(name="n_points")
    tot = ms.groupby("product")["n_points"].transform("sum")
    ms["market_share_pct"] = (ms["n_points"] / tot * 100).round(2)
    ms["share_rank"] = ms.groupby("product")["market_share_pct"].rank(ascending=False)
    got = _by(gold.brand_market_share(sdf, R).toPandas(), ["brand", "product"])
    want = _by(ms, ["brand", "product"])
    np.testing.assert_allclose(got["market_share_pct"], want["market_share_pct"], atol=1e-12)
    np.testing.assert_allclose(got["share_rank"], want["share_rank"], atol=1e-12)


def test_trends_and_v1_ranks_match_pandas(frames):
    pdf, sdf = frames
    yt = pdf.groupby(["year", "product"]).agg(price_mean=("price", "mean")).round(3).reset_index()
    yt = yt.sort_values(["product", "year"])
    yt["growth_pct"] = yt.groupby("product")["price_mean"].pct_change() * 100
    got = _by(gold.annual_trends(sdf, R).toPandas(), ["year", "product"])
    want = _by(yt, ["year", "product"])
    np.testing.assert_allclose(got["growth_pct"].astype(float), want["growth_pct"].astype(float), atol=1e-9)

    rr = pdf.groupby(["region", "product"]).agg(m=("price", "mean")).reset_index()
    rr["price_rank"] = rr.groupby("product")["m"].rank(method="dense", ascending=False).astype(int)
    got = _by(gold_v1.regional_dense_ranking(sdf, R).toPandas(), ["region", "product"])
    assert list(got["price_rank"]) == list(_by(rr, ["region", "product"])["price_rank"])

    pp = pdf.groupby(["brand", "region", "product"]).agg(m=("price", "mean")).reset_index()
    pp["pct"] = pp.groupby(["region", "product"])["m"].transform(lambda s: [(s <= v).sum() / len(s) * 100 for v in s])
    got = _by(gold_v1.brand_price_percentile(sdf, R).toPandas(), ["brand", "region", "product"])
    np.testing.assert_allclose(got["price_percentile"], _by(pp, ["brand", "region", "product"])["pct"], atol=1e-9)
