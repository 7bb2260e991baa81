"""Quality metrics on a tiny frame, expected values worked out by hand with
the reference's pandas semantics (count skips nulls, isin/range on null is
False, drop_duplicates treats nulls as equal, value_counts of lengths)."""

import pytest

from pricelens.operators import quality as Q


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([("x", 1.0), ("yy", None), (None, 3.0), ("zz", 4.0)], "a string, b double")


def _long(d):
    return {(r.metric, r.column_name): r.score for r in d.collect()}


def test_completeness_consistency_validity(df):
    c = _long(Q.completeness(df))
    assert c == {("completeness", "a"): 0.75, ("completeness", "b"): 0.75}
    k = _long(Q.consistency(df))
    assert k[("consistency", "a")] == pytest.approx(2 / 3)   # lengths 1,2,2 -> modal 2 of 3
    assert k[("consistency", "b")] == 0.75                   # 1 - null rate
    v = _long(Q.validity(df, {"b": {"min": 0.0, "max": 3.0}, "a": {"values": ["x"]}, "c": {"values": ["q"]}}))
    assert v == {("validity", "b"): 0.5, ("validity", "a"): 0.25, ("validity", "c"): 0.0}


def test_uniqueness_and_overall(spark, df):
    assert Q.uniqueness(df, ["a"]).first()[0] == 1.0            # x, yy, null, zz
    dup = spark.createDataFrame([(None, 1), (None, 1), ("k", 2)], "a string, n int")
    assert Q.uniqueness(dup, ["a", "n"]).first()[0] == pytest.approx(2 / 3)   # nulls compare equal
    assert Q.uniqueness(dup, []).first()[0] == 1.0
    assert Q.uniqueness(dup, ["zz"]).first()[0] == 0.0
    rep = Q.quality_report(df, {"b": {"min": 0.0, "max": 3.0}, "a": {"values": ["x"]}, "c": {"values": ["q"]}}, ["a"])
    overall = Q.overall_score(rep).first()[0]
    want = (0.75 + (0.5 + 0.25 + 0.0) / 3 + (2 / 3 + 0.75) / 2 + 1.0) / 4
    assert overall == pytest.approx(want)
    issues = {(r.metric, r.column_name) for r in Q.quality_issues(rep).collect()}
    assert ("completeness", "a") in issues and ("validity", "c") in issues and ("overall", None) in issues


def test_v1_checks_and_outliers(spark):
    rows = [(1.0, 0.9), (1.0, 0.9), (2.0, 1.5), (3.0, None), (100.0, 2.0)]
    d = spark.createDataFrame(rows, "p double, c double")
    v = Q.v1_checks(d, ["p", "c"]).first()
    assert v.duplicate_count == 1 and v.duplicate_rate == pytest.approx(0.2)
    assert v.completeness == pytest.approx(1 - 1 / 10) and v.critical_fields_missing is True
    pv = {r.measure: r for r in Q.price_validation(d, "p", "c", (0.5, 50.0), (0.5, 50.0)).collect()}
    assert pv["p"].invalid_count == 1 and pv["c"].invalid_count == 1   # 100 out of range; null invalid
    assert pv["relation"].invalid_count == 0
    o = {r.measure: r for r in Q.iqr_outliers(d, ["p"]).collect()}
    # p: q1=1, q3=3, iqr=2, fences -2 .. 6 -> 100 is the one outlier of 5
    assert (o["p"].q1, o["p"].q3, o["p"]["count"]) == (1.0, 3.0, 1) and o["p"].rate == pytest.approx(0.2)
    band = Q.status_band(spark.createDataFrame([(95.0,), (80.0,), (60.0,), (10.0,)], "quality_score double"))
    assert [r.status for r in band.collect()] == ["EXCELENTE", "BOM", "REGULAR", "CRÍTICO"]
