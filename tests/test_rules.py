"""Hand-made edge frames for the semantic rules."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.config import STAR, PanelRoles
from pricelens.functions import avg_rank, band, first_label_max, first_label_min, round_he, safe_corr
from pricelens.functions.quantiles import exact_quantiles, value_counts
from pricelens.operators import clean, enrich, normalize
from pricelens.plans import gold
from pricelens import config as C


def test_half_even_rounding_matches_numpy(spark):
    vals = [0.125, 0.375, 2.675, 0.0005, 16447.2875, -2.675]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double")
           .select(round_he("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]
    assert spark.range(1).select(round_he(F.lit(16447.2875), 3)).first()[0] == 16447.287


def test_average_rank_ties(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", 2.0), ("p", 2.0), ("p", 3.0)], "prod string, v double")
    got = sorted(r[0] for r in df.select(avg_rank("v", ["prod"])).collect())
    assert got == [1.0, 2.5, 2.5, 4.0]


def test_first_label_wins_ties(spark):
    df = spark.createDataFrame([("B", 1.0), ("A", 1.0), ("C", 5.0), ("D", 5.0)], "lab string, v double")
    r = df.agg(first_label_min("lab", "v").alias("lo"), first_label_max("lab", "v").alias("hi")).first()
    assert (r.lo, r.hi) == ("A", "C")


def test_safe_corr_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    assert df.agg(safe_corr("x", "y")).first()[0] is None


def test_bands_right_closed(spark):
    vals = [-1.0, 0.0, 2.0, 2.0001, 4.0, 6.0, 8.0, 9.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r[0] for r in df.select(band("p", C.FUEL_BAND_EDGES, C.BAND_LABELS)).collect()]
    assert got == [None, "MUITO_BAIXO", "MUITO_BAIXO", "BAIXO", "BAIXO", "MEDIO", "ALTO", "MUITO_ALTO", None]


def test_brand_normalisation(spark):
    df = spark.createDataFrame([(" posto da esquina ",), ("POSTO SHELL",), ("",), ("POSTO",), (None,)], "b string")
    df = clean.clean_text(df)
    got = [r[0] for r in normalize.normalize_brand(df, PanelRoles(brand="b")).select("brand_norm").collect()]
    assert got == ["BRANCA", "SHELL", "BRANCA", "BRANCA", None]


def test_text_clean_keeps_null(spark):
    df = spark.createDataFrame([(" a ",), (None,), ("nan",)], "t string")
    assert [r[0] for r in clean.clean_text(df).collect()] == ["A", None, "NAN"]
    assert [r[0] for r in clean.clean_text_nullify(df, ["t"]).collect()] == ["A", None, None]


def test_dates_and_weekday(spark):
    df = spark.createDataFrame([("05/03/2021",), ("25/03/2021",), ("2021-03-25",), ("01/01/2024",)], "d string")
    out = clean.valid_dates(df, "obs_date", "d")
    assert out.count() == 3  # only the declared format parses
    r = enrich.temporal_dimensions(out, PanelRoles()).filter("d = '01/01/2024'").first()
    assert (r.weekday, r.day_name, r.semester, r.month_name) == (0, "Monday", 1, "January")


def test_dedup_keep_first_last_deterministic(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 1, 3.0), (2, 1, 7.0)], "k1 int, k2 int, tb double")
    r = PanelRoles(key=("k1", "k2"), tiebreak=("tb",))
    assert sorted(x.tb for x in clean.dedup_keep_first(df, r).collect()) == [3.0, 7.0]
    assert sorted(x.tb for x in clean.dedup_keep_last(df, r).collect()) == [5.0, 7.0]


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k1"), F.lit(1).alias("k2"), F.col("id").alias("tb"))
    plan = clean.dedup(df, ["k1", "k2"], ["tb"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sigma_cut_sequential(spark):
    rows = [(float(v), float(v)) for v in [1] * 20 + [100]]
    df = spark.createDataFrame(rows, "price double, cost double")
    out = clean.sigma_outlier_filter(df, PanelRoles())
    assert out.count() == 20


def test_singleton_std_null_and_missing_pair(spark):
    r = STAR.with_(product="product", year="y", month="m", state="state")
    df = spark.createDataFrame([
        ("S1", 2020, 1, "ECONOMY", 1.0, 1.0), ("S1", 2020, 1, "STANDARD", 2.0, 2.0),
        ("S2", 2020, 1, "ECONOMY", 1.0, 1.0),          # reference missing -> null ratio
        ("S3", 2020, 1, "STANDARD", 2.0, 2.0),         # substitute missing -> null ratio
    ], "state string, y int, m int, product string, price double, cost double").withColumn("margin_pct", F.lit(0.0))
    h = {x.state: x for x in gold.ethanol_ratio_history(df, r).collect()}
    assert h["S1"].pair_ratio == 0.5 and h["S1"].substitute_viable is True
    assert h["S2"].pair_ratio is None and h["S2"].substitute_viable is None
    assert h["S3"].pair_ratio is None
    s = gold.seasonality(df, r).filter("product = 'ECONOMY'").first()
    assert s.price_std == 0.0
    one = gold.seasonality(df.filter("state = 'S3'"), r).first()
    assert one.price_std is None and one.coef_variation is None


def test_one_region_product_is_dearest(spark):
    r = STAR.with_(product="product", region="region")
    df = spark.createDataFrame([("R1", "X", 1.0, 1.0, 0.0), ("R1", "Y", 1.0, 1.0, 0.0), ("R2", "Y", 2.0, 2.0, 0.0)],
                               "region string, product string, price double, cost double, margin_pct double")
    got = {(x.region, x.product): x.classification for x in gold.regional_analysis(df, r).collect()}
    assert got[("R1", "X")] == "MAIS_CARA"
    assert got[("R1", "Y")] == "MAIS_BARATA" and got[("R2", "Y")] == "MAIS_CARA"


def test_null_group_keys_dropped(spark):
    r = STAR.with_(product="product", year="y", month="m")
    df = spark.createDataFrame([(2020, 1, None, 1.0, 1.0, 0.0), (2020, 1, "A", 2.0, 2.0, 0.0)],
                               "y int, m int, product string, price double, cost double, margin_pct double")
    assert gold.price_volatility(df, r).count() == 1


def test_exact_quantiles_skewed_group(spark):
    rng = np.random.default_rng(7)
    hot = rng.lognormal(3, 1, 3000)          # one group holds most rows
    cold = rng.normal(10, 2, 40)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold] + [("cold", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    q = {x.g: x for x in exact_quantiles(df, ["g"], {"q25": ("v", 0.25), "med": ("v", 0.5),
                                                    "q67": ("v", 0.67)}).collect()}
    for g, arr in [("hot", hot), ("cold", cold)]:
        for name, p in [("q25", 0.25), ("med", 0.5), ("q67", 0.67)]:
            assert getattr(q[g], name) == pytest.approx(float(np.quantile(arr, p)), rel=1e-12)


def test_rerun_leaves_counts_unchanged(spark, tmp_path_factory):
    from pricelens.session import scratch_path
    from pricelens.sources import files
    df = spark.createDataFrame([(2020, 1, 1.0), (2020, 2, 2.0), (2021, 1, 3.0)], "ano int, mes int, v double")
    path = scratch_path(spark, "rerun")
    files.write_layer(df, path)
    files.write_layer(df, path)
    assert files.read_layer(spark, path).count() == 3
    files.write_layer(df.filter("mes = 2"), path)   # dynamic overwrite: only that partition
    assert files.read_layer(spark, path).count() == 3


def test_approx_opt_in_close_to_exact(spark):
    from pricelens.functions.quantiles import approx_quantiles, distinct_count
    rng = np.random.default_rng(5)
    vals = rng.normal(100, 15, 20000)
    df = spark.createDataFrame([("g", float(v), int(i % 5000)) for i, v in enumerate(vals)], "g string, v double, k int")
    q = approx_quantiles(df, ["g"], {"med": ("v", 0.5)}).first()
    assert abs(q.med - float(np.median(vals))) < 0.5
    assert abs(df.agg(distinct_count("k", approx=True)).first()[0] - 5000) < 250
    assert df.agg(distinct_count("k")).first()[0] == 5000


def test_quantiles_of_several_columns_and_of_all(spark):
    rng = np.random.default_rng(9)
    hot, cold = rng.lognormal(2, 1, 2500), rng.normal(0, 1, 60)
    rows = [("hot", float(v), float(v) * 2) for v in hot] + [(None, float(v), -float(v)) for v in cold]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(5)
    specs = {"med": ("v", 0.5), "q25": ("v", 0.25), "wmed": ("w", 0.5), "low": ("w", 0.0), "top": ("w", 1.0)}
    got = {r.g: r for r in exact_quantiles(df, ["g"], specs).collect()}
    for g, v, w in [("hot", hot, hot * 2), (None, cold, -cold)]:
        for name, (c, p) in specs.items():
            assert got[g][name] == pytest.approx(float(np.quantile(v if c == "v" else w, p)), rel=1e-12)
    whole = exact_quantiles(df, [], {"med": ("v", 0.5)}).first()
    assert whole.med == pytest.approx(float(np.quantile(np.concatenate([hot, cold]), 0.5)), rel=1e-12)


def test_segments_grow_with_the_values(spark):
    from pricelens.functions.quantiles import _segment
    values = [float("-inf"), -1e308, -5.0, -1.01, -1.0, -1e-300, -5e-324, 0.0, 5e-324, 1e-300, 0.5, 1.0, 1.01, 5.0, 1e308,
              float("inf"), float("nan")]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(_segment(F.col("v"))).collect()]
    assert got == sorted(got) and len(set(got)) >= len(got) - 2


def test_one_value_in_a_third_of_the_rows(spark):
    """The hot value reaches the shuffle as one row per map task."""
    df = spark.range(90_000, numPartitions=6).selectExpr(
        "'g' AS g", "IF(id % 3 = 0, 7.5, CAST(1 + (id * 7919) % 50021 AS DOUBLE)) AS v")
    q = exact_quantiles(df, ["g"], {"med": ("v", 0.5), "p10": ("v", 0.1)})
    vals = np.array([r["v"] for r in df.collect()])
    got = q.first()
    assert got.med == np.quantile(vals, 0.5) and got.p10 == pytest.approx(np.quantile(vals, 0.1), rel=1e-12)
    # the counts are checkpointed, so they are looked at by themselves
    plan = value_counts(df, ["g"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan and "rangepartitioning" not in plan
    counts = df.groupBy("g", "v").count().withColumn("p", F.expr("pmod(hash(g, v), 8)"))
    assert max(r["n"] for r in counts.groupBy("p").agg(F.count("*").alias("n")).collect()) < 0.2 * counts.count()
