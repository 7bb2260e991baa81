"""Plan-shape checks: no Python UDFs, no un-partitioned windows on raw rows,
pruned scans and pushed filters."""

import pytest

import __spark_entry__ as E
from pricelens.session import scratch_path
from pricelens.sources import files

SF = "/root/testdata/sf0.001"
BAD = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["monthly_price_evolution", "state_price_ranking", "regional_price_index",
                                  "price_summary_cube", "quality_report", "pairwise_viability",
                                  "dashboard_metrics", "brand_price_percentile"])
def test_no_python_udf(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert not any(b in p for b in BAD)


def test_scan_is_pruned(spark):
    p = plan(E.queries()["annual_trends"](spark, SF))
    # lineitem scan must not read columns the query never uses
    assert "l_comment" not in p and "p_name" not in p and "o_totalprice" not in p


def test_partition_filter_pushed(spark):
    df = spark.createDataFrame([(2020, 1, 1.0), (2021, 2, 2.0)], "ano int, mes int, v double")
    path = scratch_path(spark, "prune")
    files.write_layer(df, path)
    p = plan(files.read_layer(spark, path).filter("ano = 2021"))
    assert "PartitionFilters: [isnotnull(ano" in p and "= 2021" in p


def test_limits_only_where_they_are_the_feature():
    """Registered queries run over whole tables: a LIMIT appears only in the
    top-k report, the latest-years slice and the arg-max state."""
    import re
    allowed = {"top_k_ranking", "latest_years_slice", "best_viability_state"}
    for name, sql in E.oracle_sql().items():
        if re.search(r"\bLIMIT\b", sql, re.I):
            assert name in allowed, name
