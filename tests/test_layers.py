"""Layers: incremental Gold, months by partition, records from footers, first-generation jobs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pricelens import config as C
from pricelens.config import STAR, silver_roles
from pricelens.operators import enrich
from pricelens.plans import gold, gold_v1, incremental_gold, jobs_v1, pipeline
from pricelens.plans.incremental_q import changed_layer
from pricelens.session import scratch_path
from pricelens.sources import files

SF = "/root/testdata/sf0.001"
SR = silver_roles(STAR)


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.8g}")
    return v


def _rows(df):
    names = sorted(df.columns)
    return sorted(tuple(repr(_value(r[c])) for c in names) for r in df.collect())


@pytest.fixture(scope="module")
def refreshed(spark):
    return changed_layer(spark, SF)


def test_only_the_changed_month_is_computed(spark, refreshed):
    layer, root, months = refreshed
    assert months == [(1996, 3)]
    read = incremental_gold.months_of(files.read_layer(spark, layer), months)
    assert read.inputFiles() and all("/ano=1996/mes=3/" in f for f in
                                     {r[0] for r in read.select("_metadata.file_path").distinct().collect()})
    assert "PartitionFilters: [" in read._jdf.queryExecution().executedPlan().toString()
    assert incremental_gold.refresh(spark, layer, SR, root) == []


@pytest.mark.parametrize("name", sorted(gold.QUERIES))
def test_gold_of_states_equals_a_full_run(spark, refreshed, name):
    layer, root, _ = refreshed
    want = gold.QUERIES[name](files.read_layer(spark, layer), SR)
    got = incremental_gold.datasets(spark, SR, root)[name]
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_a_refresh_that_failed_is_repeated(spark, refreshed, monkeypatch):
    layer, _, _ = refreshed
    root = scratch_path(spark, "states")
    write = files.write_layer

    def fail(df, path, *a, **k):
        if path.endswith("/values"):
            raise OSError("lost")
        return write(df, path, *a, **k)

    monkeypatch.setattr(files, "write_layer", fail)
    report = incremental_gold.run_gold_incremental(spark, layer, SR, scratch_path(spark, "gold"), root)
    assert report["status"] == "failed" and "lost" in report["error"]
    monkeypatch.setattr(files, "write_layer", write)
    months, _, _ = incremental_gold.changed_months(spark, layer, root)
    report = incremental_gold.run_gold_incremental(spark, layer, SR, scratch_path(spark, "gold"), root)
    assert report["status"] == "completed" and report["datasets"] == 15 and report["months"] == months and len(months) > 50


def test_months_of_the_dashboard_are_partitions(spark, refreshed):
    layer, _, _ = refreshed
    latest = files.latest_month(spark, layer)
    df = files.read_layer(spark, layer)
    top = df.agg(F.max(F.struct("ano", "mes"))).first()[0]
    assert latest == tuple(top)
    for ano, mes in (latest, (latest[0], latest[1] - 1) if latest[1] > 1 else (latest[0] - 1, 12)):
        plan = gold_v1._month_of_layer(df, SR, ano, mes)._jdf.queryExecution().executedPlan().toString()
        assert f"(ano#" in plan and f"= {ano})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    wrong = scratch_path(spark, "wrong")
    files.write_layer(df.where((F.col("ano") == latest[0]) & (F.col("mes") == latest[1])).withColumn(
        "obs_date", F.to_date(F.lit("1990-01-01"))), wrong)
    with pytest.raises(Exception, match="holds a row of 1990-01-01"):
        gold_v1.dashboard_metrics(files.read_layer(spark, wrong), SR, files.latest_month(spark, wrong)).collect()
    assert files.latest_month(spark, layer) and files.partition_inventory(spark, layer).count() == df.select("ano", "mes").distinct().count()


def test_records_come_from_footers_in_one_job(spark, refreshed):
    layer, root, _ = refreshed
    frames = [files.read_layer(spark, p) for p in (layer, f"{root}/cells", f"{root}/values")]
    assert files.record_counts(spark, frames) == [df.count() for df in frames]
    plan = frames[0].select(F.lit(0).alias("k")).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    listing = files.partition_files(spark, layer)
    assert "content" not in listing.columns and {"ano", "mes", "length"} <= set(listing.columns)
    assert files.record_counts(spark, []) == []


@pytest.mark.parametrize("limit", [100_000, 0])
def test_join_back_of_a_hot_group(spark, monkeypatch, limit):
    """A third of the rows in one group: not shuffled below the limit, dealt out beyond it."""
    monkeypatch.setattr(enrich, "BROADCAST_GROUPS", limit)
    rows = spark.range(30_000, numPartitions=6).selectExpr(
        "id AS l_orderkey", "CAST(0 AS INT) AS l_linenumber", "IF(id % 3 = 0, 'hot', concat('r', id % 50)) AS region_norm",
        "'p' AS product_norm", "CAST(id % 7 AS DOUBLE) + 1 AS price")
    out = enrich.regional_price_index(rows, SR)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.columns == [*rows.columns[2:4], *rows.columns[:2], "price", "regional_price_index"] or set(out.columns) == {*rows.columns, "regional_price_index"}
    if limit:
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    else:
        salted = rows.withColumn("p", F.expr(f"pmod(hash(region_norm, product_norm, CAST(pmod(xxhash64(l_orderkey, l_linenumber), {enrich.SALTS}) AS INT)), 8)"))
        assert "_salt" in plan and max(r["count"] for r in salted.groupBy("p").count().collect()) < 0.25 * 30_000
    mean = {r[0]: r[1] for r in rows.groupBy("region_norm").agg(F.avg("price")).collect()}
    got = out.collect()
    assert len(got) == 30_000
    for r in random.Random(1).sample(got, 500):
        assert r["regional_price_index"] == pytest.approx(r["price"] / mean[r["region_norm"]] * 100, abs=0.0051)


def test_raw_side_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [("SE", "SP", "C", "A", str(k), "R", "GASOLINA", "05/03/2021" if k % 5 else "x", 5.0 + k, 4.0, "L", "SHELL") for k in range(50)]
    raw = spark.createDataFrame(rows, files.fuel_raw_schema())
    raw = raw.mapInArrow(count, raw.schema)
    report = pipeline.run_bronze(spark, raw, C.FUEL, scratch_path(spark, "bronze"),
                                 {"Produto": {"values": ["GASOLINA"]}}, ["CNPJ"], "Data_Coleta")
    assert (report["status"], report["records"], report["rejected"]) == ("completed", 40, 10)
    assert report["quality_score"] is not None and seen.value == 50


def test_silver_score_against_plain_python(spark):
    """Q9: the score that the Silver job reports, worked out from the written rows."""
    rows = [("SE", "SP", "C", "A", f"{k:014d}", "R", r, "05/03/2021", 5.0 + k / 10, 4.0 + k / 100, "L", b)
            for k, (r, b) in enumerate([("GASOLINA", "SHELL"), ("ETANOL", "BRANCA"), ("OUTRO", "IPIRANGA")] * 6)]
    raw = spark.createDataFrame(rows, files.fuel_raw_schema())
    root = scratch_path(spark, "q9")
    pipeline.run_bronze(spark, raw, C.FUEL, f"{root}/bronze", date_source="Data_Coleta", load_ts="2024-01-01 00:00:00")
    report = pipeline.run_silver(spark, f"{root}/bronze", C.FUEL, f"{root}/silver")
    assert report["status"] == "completed", report
    df = files.read_layer(spark, f"{root}/silver")
    got, kinds = [r.asDict() for r in df.collect()], dict(df.dtypes)
    n = len(got)
    assert n == report["records"] > 10
    filled = {c: sum(r[c] is not None for r in got) / n for c in df.columns}
    even = []
    for c in df.columns:
        sizes = [len(r[c]) for r in got if r[c] is not None] if kinds[c] == "string" else None
        even.append(filled[c] if sizes is None else max((sizes.count(s) for s in sizes), default=1) / max(1, len(sizes)))
    rules = pipeline.silver_rules(C.FUEL)
    valid = []
    for c, rule in rules.items():
        ok = [r[c] is not None and (r[c] in rule["values"] if "values" in rule else rule["min"] <= r[c] <= rule["max"]) for r in got]
        valid.append(sum(ok) / n)
    unique = len({(r["CNPJ"], r["data_coleta_parsed"], r["product_norm"]) for r in got}) / n
    want = (sum(filled.values()) / len(filled) + sum(valid) / len(valid) + sum(even) / len(even) + unique) / 4
    assert report["quality_score"] == pytest.approx(want, rel=1e-12)


def test_first_generation_jobs(spark):
    base = {"Regiao - Sigla": "SE", "Estado - Sigla": "SP", "Municipio": "campinas", "Revenda": "Posto A",
            "CNPJ da Revenda": "12.345.678/0001-95", "Nome da Rua": "X", "Numero Rua": "1", "Complemento": None, "Bairro": "Centro",
            "Cep": "13000-000", "Produto": "GASOLINA", "Data da Coleta": "2021-03-05", "Valor de Venda": "5.5",
            "Valor de Compra": "5.0", "Unidade de Medida": "R$ / litro", "Bandeira": "SHELL"}
    cases = [{}, {"Data da Coleta": "2021-09-05"}, {"Data da Coleta": "sem data", "Revenda": "B"},
             {"Regiao - Sigla": None, "Estado - Sigla": "RJ", "Revenda": "C"}]
    raw = spark.createDataFrame([tuple((base | c)[k] for k in C.FUEL_V1_RAW_COLUMNS) for c in cases],
                                ", ".join(f"`{c}` string" for c in C.FUEL_V1_RAW_COLUMNS))
    root = scratch_path(spark, "v1")
    out = {r["layer"]: r for r in jobs_v1.run(spark, raw, root, "batch_7", "2024-01-01 00:00:00", "a.csv").collect()}
    assert [out[k]["status"] for k in ("bronze", "silver", "gold")] == ["completed"] * 3, out
    assert (out["bronze"]["records"], out["silver"]["records"]) == (4, 3)
    bronze = spark.read.parquet(f"{root}/bronze")
    assert {(r["_batch_id"], r["_source_file"]) for r in bronze.collect()} == {("batch_7", "a.csv")}
    assert sorted((r["ano"], r["semestre"], r["regiao"]) for r in bronze.where("ano IS NOT NULL AND regiao IS NOT NULL").collect()) \
        == [(2021, 1, "SE"), (2021, 2, "SE")]
    gold_root = {r["name"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                 .load(f"{root}/gold").select(F.regexp_extract("path", "/gold/([^/]+/[^/]+)/", 1).alias("name")).collect()}
    assert "analytics/dashboard_metrics" in gold_root and "aggregations/price_summary_cube" in gold_root
    assert spark.read.parquet(f"{root}/silver/fuel_summary").count() >= 2
    failed = jobs_v1.run(spark, raw.drop("Produto"), scratch_path(spark, "v1"), "b", None, "a.csv").collect()
    assert [r["status"] for r in failed][-1] == "failed" and failed[-1]["error"]
