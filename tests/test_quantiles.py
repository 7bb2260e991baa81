"""Exact quantiles: sketches of small groups, whole groups in order, segments cut again."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.functions import quantiles as Q
from pricelens.session import scratch_path


def _read_once(df):
    """(df, rows read so far): counts every row that passes."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema), seen


def test_dense_values_are_cut_by_their_own_bounds(spark):
    """Two million distinct values between 100 and 100.5: one read, no window over more
    values than the bound, whatever the number of values in a segment."""
    n = 2_000_000
    path = scratch_path(spark, "dense")
    spark.range(n, numPartitions=8).select(F.lit("g").alias("g"), (100.0 + F.pmod(F.col("id") * 1_000_003, F.lit(n)) * (0.5 / n)).alias("v")) \
        .write.parquet(path)
    df, seen = _read_once(spark.read.parquet(path))
    got = Q.exact_quantiles(df, ["g"], {"q25": ("v", 0.25), "med": ("v", 0.5), "q9": ("v", 0.9)}).first()
    v = np.sort(100.0 + np.arange(n) * (0.5 / n))
    assert (got.med, got.q25, got.q9) == (np.quantile(v, 0.5), pytest.approx(np.quantile(v, 0.25), rel=1e-13),
                                          pytest.approx(np.quantile(v, 0.9), rel=1e-13))
    assert seen.value == n
    counts = Q.value_counts(spark.read.parquet(path), ["g"], ["v"])
    first = counts.groupBy(Q._segment(F.col("_v"))).count().agg(F.max("count")).first()[0]
    cut = counts.groupBy(Q._segment(F.col("_v"), Q.LEVELS[1])).count().agg(F.max("count"), F.count("*")).first()
    assert first > Q.BOUND >= cut[0] and cut[1] <= 1 << (Q.LEVELS[1] - Q.LEVELS[0])


@pytest.mark.parametrize("bound", [0, 2, 40, 1 << 16])
def test_every_way_gives_the_same_values(spark, monkeypatch, bound):
    """Whole groups in order, and segments of each level, on ties, signs, zeros and extremes."""
    rng = np.random.default_rng(3)
    groups = {"mixed": np.concatenate([rng.normal(0, 1, 300), -rng.lognormal(0, 8, 200), [0.0] * 40, [-0.5] * 30, [5e-324, -5e-324, 1e308, -1e308]]),
              "near": 100 + rng.integers(0, 50, 700) * 2.0**-44, "one": np.array([7.25]), "two": np.array([1.0, 2.0]),
              "below": -100 - rng.integers(0, 50, 500) * 2.0**-44}
    rows = [(g, float(v), float(-v)) for g, vs in groups.items() for v in vs] + [("none", None, None), (None, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(5)
    specs = {"q0": ("v", 0.0), "q33": ("v", 0.33), "med": ("v", 0.5), "wmed": ("w", 0.5), "q1": ("w", 1.0)}
    monkeypatch.setattr(Q, "BOUND", bound)
    got = {r.g: r for r in Q.exact_quantiles(df, ["g"], specs).collect()}
    assert set(got) == {*groups, None} and (got[None].med, got[None].q1) == (3.0, 4.0)
    for g, v in groups.items():
        for name, (c, p) in specs.items():
            x = np.sort(v if c == "v" else -v)
            lo, hi = x[int(np.floor((len(x) - 1) * p))], x[int(np.ceil((len(x) - 1) * p))]
            part = (len(x) - 1) * p - np.floor((len(x) - 1) * p)
            assert got[g][name] == ((lo + hi) * 0.5 if part == 0.5 else lo + part * (hi - lo)), (g, name)


@pytest.mark.parametrize("sketch", [8, 2048])
def test_medians_beside_other_aggregates(spark, monkeypatch, sketch):
    rng = np.random.default_rng(8)
    rows = [(g, float(np.round(v, 2)), float(v)) for g, n in (("a", 8), ("b", 9), ("c", 400), ("d", 1)) for v in rng.normal(3, 2, n)]
    rows += [("e", None, 1.0), ("f", float("nan"), 2.0), ("f", 1.0, 3.0), (None, 5.0, 6.0), (None, 7.0, None)]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(6)
    monkeypatch.setattr(Q, "SKETCH", sketch)
    out = Q.agg_with_quantiles(df, ["g"], [F.count("v").alias("n")], {"v_med": ("v", 0.5), "w_med": ("w", 0.5)},
                               [F.count_distinct("v").alias("d")])
    got = {r.g: r for r in out.collect()}
    assert set(got) == {"a", "b", "c", "d", "e", "f", None} and out.columns == ["g", "n", "v_med", "w_med", "d"]
    for g in ("a", "b", "c", "d"):
        v, w = ([r[k] for r in rows if r[0] == g] for k in (1, 2))
        assert (got[g].v_med, got[g].w_med, got[g].n) == (np.quantile(v, 0.5), np.quantile(w, 0.5), len(v))
    assert got["e"].v_med is None and got["e"].w_med == 1.0
    assert np.isnan(got["f"].v_med) and got["f"].w_med == 2.5   # no number counts as the largest value
    assert got[None].v_med == 6.0 and got[None].w_med == 6.0
    whole = Q.agg_with_quantiles(df.where("g = 'c'"), [], [F.count("v").alias("n")], {"m": ("v", 0.5)}).first()
    assert (whole.n, whole.m) == (400, got["c"].v_med)


def test_small_groups_are_read_once(spark):
    """Medians and the other aggregates of small groups: one pass over the rows."""
    df, seen = _read_once(spark.range(3000, numPartitions=4).selectExpr("id % 30 AS g", "CAST(id AS DOUBLE) AS v"))
    out = Q.agg_with_quantiles(df, ["g"], [F.avg("v").alias("m")], {"med": ("v", 0.5)}).collect()
    assert len(out) == 30 and seen.value == 3000
