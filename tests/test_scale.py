"""What a query reads, shuffles and writes: large groups, repeated keys, rows written once."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from pricelens import config as C
from pricelens.config import STAR
from pricelens.functions import quantiles
from pricelens.operators import clean
from pricelens.plans import io_q, jobs_v1, jobs_v1_q, silver_v1
from pricelens.plans.silver import build_silver, star_silver
from pricelens.session import SORTED_BYTES, compiled_code, small_splits
from pricelens.sources import files
from pricelens.sources.panel import padded, star_panel, star_rows

SF = "/root/testdata/sf0.001"


def _groups(spark):
    """Two groups of 40,000 and 9,000 distinct values, and small ones."""
    rnd = random.Random(3)
    rows = [(k, rnd.gauss(5.0, 2.0)) for k, n in (("a", 40_001), ("b", 9_000), ("c", 3)) for _ in range(n)]
    rows += [("a", None), ("d", None)]
    want = {}
    for k in ("a", "b", "c"):
        v = sorted(x for g, x in rows if g == k and x is not None)
        want[k] = (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2
    return spark.createDataFrame(rows, "k string, v double").repartition(7), want | {"d": None}


def _medians(df):
    return {r["k"]: r["m"] for r in quantiles.agg_with_quantiles(df, ["k"], [F.count("v").alias("n")], {"m": ("v", 0.5)}).collect()}


def test_large_groups_count_the_values_near_their_median(spark, monkeypatch):
    df, want = _groups(spark)
    sizes, plain = [], quantiles.quantiles_of_counts

    def seen(counts, *a):
        sizes.append(counts.count())
        return plain(counts, *a)

    monkeypatch.setattr(quantiles, "quantiles_of_counts", seen)
    assert _medians(df) == want
    assert len(sizes) == 1 and sizes[0] < 0.1 * 49_001


@pytest.mark.parametrize("margin", [0.0, -0.2])
def test_medians_outside_their_bounds_are_counted_whole(spark, monkeypatch, margin):
    monkeypatch.setattr(quantiles, "MARGIN", margin)
    df, want = _groups(spark)
    assert _medians(df) == want


def test_medians_of_infinite_values(spark):
    inf = float("inf")
    df = spark.range(5000).select(F.lit("a").alias("k"), F.when(F.col("id") < 3000, -inf).otherwise(F.col("id") * 1.0).alias("v"))
    assert _medians(df) == {"a": -inf}


@pytest.mark.parametrize("most", [0, 1_000_000])
@pytest.mark.parametrize("keep", ["first", "last"])
def test_dedup_of_written_rows(spark, monkeypatch, most, keep):
    monkeypatch.setattr(clean, "REPEATED_KEYS", most)
    rows = [(i % 50 if i % 7 else None, "x" if i % 3 else None, i * 37 % 101, "t") for i in range(200)] + [(1000 + i, "y", i, "u") for i in range(100)]
    df = clean.write_rows(spark.createDataFrame(rows, "a int, b string, t int, c string"))
    got = clean.dedup_written(df, ["a", "b"], ["t"], keep, ["c"])
    assert got.columns == df.columns
    want = clean.dedup(df, ["a", "b"], ["t"], keep)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_rows_without_repeated_keys_are_not_shuffled(spark):
    df = clean.write_rows(spark.range(100).withColumn("t", F.lit(1)))
    assert "Exchange" not in clean.dedup_written(df, ["id"], ["t"])._jdf.queryExecution().executedPlan().toString()


def test_analytics_of_v1_silver_read_written_rows(spark):
    """The panel's joins and the dedup run once, whatever the number of passes."""
    for name in ("v1_price_summary_cube", "v1_product_penetration", "v1_state_vs_region"):
        read = jobs_v1_q.QUERIES[name](spark, SF).inputFiles()
        assert read and not any("lineitem" in f for f in read), name


def test_materialized_rows_are_columns_in_files(spark, tmp_path):
    df = clean.write_rows(spark.range(5), str(tmp_path / "rows"))
    assert df.count() == 5 and files.path_exists(spark, str(tmp_path / "rows/_SUCCESS"))


def test_code_limit_is_given_back(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), compiled_code(spark):
        assert spark.conf.get(name) == "8000"
        raise ValueError
    assert spark.conf.get(name) == before


def test_clustered_layer_has_few_files(spark, tmp_path):
    df = spark.range(2000).select("id", (F.col("id") % 2 + 2000).cast("int").alias("ano"), (F.col("id") % 12 + 1).cast("int").alias("mes")).repartition(8)
    rows = clean.write_rows(clean.clustered(df, [F.col("ano"), F.col("mes")]))
    files.write_layer(rows, str(tmp_path / "layer"), clustered=True)
    n = files.partition_files(spark, str(tmp_path / "layer")).count()
    assert files.read_layer(spark, str(tmp_path / "layer")).count() == 2000 and n <= 24


def _raw_v1(spark, n=400):
    """First-generation raw rows: every third key occurs twice, some rows lack a price or a state."""
    rows = []
    for i in range(n):
        row = {"Regiao - Sigla": "SE", "Estado - Sigla": None if i % 17 == 0 else ("SP", "RJ", "BA")[i % 3], "Municipio": f"c{i % 7}",
               "Revenda": f"posto {i}", "Produto": "GASOLINA" if i % 2 else "ETANOL", "Data da Coleta": f"202{i % 3}-0{i % 9 + 1}-05",
               "Valor de Venda": "x" if i % 13 == 0 else str(4 + i / 100), "Valor de Compra": "3.5", "Bandeira": "SHELL"}
        rows += [row] if i % 3 else [row, row | {"Valor de Compra": "3.75"}]
    cols = C.FUEL_V1_RAW_COLUMNS
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], ", ".join(f"`{c}` string" for c in cols))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_v1_silver_shuffles_no_rows_once_written(spark):
    raw = _raw_v1(spark)
    lazy = silver_v1.build_silver_v1(raw)
    for by in ([], jobs_v1.silver_parts()):
        got = silver_v1.build_silver_v1(raw, by=by)
        assert got.columns == lazy.columns and _rows(got) == _rows(lazy)
        assert "hashpartitioning" not in _plan(got)
    written = clean.write_rows(raw)
    assert _rows(silver_v1.build_silver_v1(written, by=[], written=True)) == _rows(lazy)


def test_v1_dedup_orders_rows_before_the_calendar(spark):
    name = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(name)
    spark.conf.set(name, "500")
    try:
        plan = _plan(silver_v1.build_silver_v1(_raw_v1(spark)))
    finally:
        spark.conf.set(name, before)
    assert plan.index("day_name") < plan.index("Window [")  # above it in the plan
    assert "day_name" not in plan[plan.index("Window ["):]


def test_run_v1_silver_is_written_from_bronze_as_it_lies(spark, monkeypatch, tmp_path):
    shuffled, plain = {}, files.write_layer

    def seen(df, path, parts=C.PARTITION_COLUMNS, mode="overwrite", clustered=False):
        shuffled[path.rsplit("/", 1)[1]] = not clustered
        return plain(df, path, parts, mode, clustered)

    monkeypatch.setattr(files, "write_layer", seen)
    raw = _raw_v1(spark)
    got = {r["layer"]: r for r in jobs_v1.run(spark, raw, str(tmp_path), "b", "2024-01-01 00:00:00", "raw",
                                              roles=jobs_v1_q.ROLES).collect()}
    assert shuffled == {"bronze": True, "observations": False}
    assert got["silver"]["records"] == silver_v1.build_silver_v1(raw).count() and got["gold"]["status"] == "completed", got


def test_keys_are_padded_as_a_formatter_does(spark):
    df = spark.createDataFrame([(k,) for k in (0, 7, 99, 100, 12345, -1, -12345, None)], "k long")
    got = df.select(padded("k", 2).alias("a"), F.format_string("%02d", "k").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)


def test_small_splits_hold_while_a_clustered_layer_is_written(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with small_splits(spark):
        assert int(spark.conf.get(name)) <= SORTED_BYTES
    assert spark.conf.get(name) == before


def test_many_repeated_keys_are_told_by_a_filter(spark, monkeypatch):
    """Past the broadcast bound only the rows of repeated keys are put in order, and few others."""
    monkeypatch.setattr(clean, "REPEATED_KEYS", 10)
    df = clean.write_rows(spark.range(6000).select((F.when(F.col("id") < 4000, F.col("id")).otherwise(F.col("id") % 400)).alias("k"),
                                                   F.col("id").alias("t"), F.lit("x").alias("c")).repartition(4))
    sizes, plain = [], clean.dedup

    def seen(rows, *a):
        sizes.append(rows.count())
        return plain(rows, *a)

    monkeypatch.setattr(clean, "dedup", seen)
    got = clean.dedup_written(df, ["k"], ["t"], "last")
    assert _rows(got) == _rows(plain(df, ["k"], ["t"], "last"))
    assert 2400 <= sizes[0] < 2500
    monkeypatch.setattr(clean, "FILTER_BITS", 12)   # too small for them: more rows pass, the result stays
    assert _rows(clean.dedup_written(df, ["k"], ["t"], "last")) == _rows(got)
    assert sizes[1] >= sizes[0]


def test_negative_hashes_find_their_bit(spark):
    hashes = spark.createDataFrame([(h,) for h in (-1, -2**63, 2**63 - 1, 0, 63, 64, -64, 12345678901)], "_kh long")
    pieces = clean.hash_filter(hashes)
    others = spark.range(100, 5000).select(F.col("id").alias("_kh"))
    assert clean.marked(hashes, pieces).where("_maybe").count() == hashes.count()
    assert clean.marked(others, pieces).where("_maybe").count() == 0


def test_shuffle_files_go_with_their_job(spark):
    """A job that writes rows leaves no shuffle behind, and the session's setting is given back."""
    def shuffles():
        root = spark._jvm.java.io.File(spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()[0].getPath())
        return {f.getName() for d in root.listFiles() if d.isDirectory() for f in d.listFiles() if f.getName().startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, own = shuffles(), spark.conf.get(name)
    df = clean.write_rows(clean.clustered(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), [F.col("k")]))
    assert not shuffles() - before and spark.conf.get(name) == own
    assert df.count() == 10


def test_queries_on_silver_read_written_rows(spark):
    """The panel's joins and the dedup run once, whatever the number of passes."""
    for name in ("price_summary_cube", "regional_dense_ranking", "dash_kpis"):
        read = E.queries()[name](spark, SF).inputFiles()
        assert read and not any("lineitem" in f for f in read), name


def test_silver_is_written_without_a_shuffle_for_its_dedup(spark, tmp_path):
    """Rows lie by order after the panel's joins: the dedup by (order, line) needs no shuffle, and
    what follows from a row's columns isn't moved."""
    name, own = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "-1")
    try:
        plan = _plan(clean.dedup_keep_first(star_rows(spark, SF), STAR))
    finally:
        spark.conf.set(name, own)
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "l_linenumber" not in "".join(
        x for x in plan.split("\n") if "hashpartitioning" in x and "l_linenumber" in x.split("hashpartitioning")[1])
    rows = tmp_path / "rows"
    got = star_silver(spark, SF, checkpoint=str(rows))
    stored = spark.read.parquet(str(rows))
    assert not {"price", "cost", "station_code"} & set(stored.columns) and stored.count() == stored.dropDuplicates(list(STAR.key)).count()
    assert _rows(got.select(*STAR.key, "price", "cost", "pair_viable", "year")) == _rows(
        build_silver(star_panel(spark, SF), STAR).select(*STAR.key, "price", "cost", "pair_viable", "year"))


def test_layers_of_one_query_share_the_panel(spark, monkeypatch):
    """Bronze and Silver of the catalog come from rows that are joined once."""
    joined, plain = [], io_q.star_rows
    monkeypatch.setattr(io_q, "star_rows", lambda *a: joined.append(1) or plain(*a))
    monkeypatch.setattr(io_q, "star_panel", lambda *a: joined.append(1) or star_panel(*a))
    monkeypatch.setattr(io_q, "star_silver", lambda *a, **k: joined.append(1) or star_silver(*a, **k))
    bronze, silver = io_q._layers(spark, SF)
    assert len(joined) == 1
    assert files.read_layer(spark, silver).count() == star_silver(spark, SF).count()
    assert files.read_layer(spark, bronze).count() == io_q._bronze_frame(spark, SF).where("ano IS NOT NULL").count()
