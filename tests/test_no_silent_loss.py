"""Nothing is dropped without a trace: damaged files, bad dates, missing folders."""

import pytest
from pyspark.sql import functions as F

from pricelens import session
from pricelens.config import FUEL, STAR
from pricelens.operators import clean
from pricelens.plans import pipeline
from pricelens.plans.gold_v1 import price_grouping_sets
from pricelens.session import scratch_path
from pricelens.sources import files


@pytest.fixture
def damaged(spark):
    path = scratch_path(spark, "damaged")
    spark.range(90).withColumns({"ano": F.lit(2021), "mes": (F.col("id") % 3 + 1).cast("int")}).repartition(
        3, "mes").write.partitionBy("ano", "mes").parquet(path)
    victim = next(f for f in spark.read.parquet(path).inputFiles() if "mes=2" in f).removeprefix("file://")
    with open(victim, "rb+") as f:
        f.truncate(20)
    return path


def test_damaged_file_is_an_error(spark, damaged):
    with pytest.raises(Exception):  # noqa: B017 - Spark's reader chooses the class
        files.read_layer(spark, damaged).select("id").collect()


def test_skipped_files_are_named(spark, damaged):
    schema = "id long, ano int, mes int"
    df, skipped = files.read_layer_skipping(spark, damaged, schema)
    assert df.count() == 60
    assert [r["file"].split("/")[-2] for r in skipped.collect()] == ["mes=2"]


def _raw(spark, n_bad=3):
    rows = [("SE", "SP", "C", "R", str(k), "A", "GASOLINA", "05/03/2021" if k >= n_bad else "x", 5.0, 4.0, "u", "B")
            for k in range(10)]
    return spark.createDataFrame(rows, files.fuel_raw_schema())


def test_bronze_counts_its_rejects(spark):
    out = scratch_path(spark, "bronze")
    rep = pipeline.run_bronze(spark, _raw(spark), FUEL, out, date_source="Data_Coleta")
    assert (rep["status"], rep["records"], rep["rejected"]) == ("completed", 7, 3)
    assert spark.read.parquet(f"{out}_rejects").select("Data_Coleta").distinct().collect()[0][0] == "x"
    rep = pipeline.run_bronze(spark, _raw(spark), FUEL, scratch_path(spark, "bronze"), date_source="Data_Coleta", strict=True)
    assert rep["status"] == "failed" and "3 rows" in rep["error"]


def test_source_file_of_a_scan(spark):
    path = scratch_path(spark, "csv")
    files.write_csv(_raw(spark, 0).coalesce(1), path)
    out = scratch_path(spark, "bronze")
    raw = files.read_csv(spark, path, files.fuel_raw_schema())
    assert pipeline.run_bronze(spark, raw, FUEL, out, date_source="Data_Coleta", source_file=None)["status"] == "completed"
    assert files.read_layer(spark, out).select("bronze_source_file").first()[0].endswith(".csv")


def test_record_ids(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, "a"), ("", "a"), ("a=", ""), ("a", "=")], "x string, y string")
    ids = [r[0] for r in df.select(pipeline.record_id(["x", "y"])).collect()]
    assert ids[0] == ids[1] and len(set(ids)) == 5 and len(ids[0]) == 32


def test_whole_error_is_reported(spark):
    rep = pipeline.run_silver(spark, "/nowhere/" + "x" * 900, FUEL, "/nowhere/out")
    assert rep["status"] == "failed" and "x" * 900 in rep["error"]


class _Session:
    """Just enough of a session whose cluster names no shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "yarn"


def test_no_shared_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session)


def test_materialize_writes(spark):
    df = clean.materialize(spark.range(5))
    assert df.count() == 5 and "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_empty_gold_dataset_leaves_no_folder(spark):
    root = scratch_path(spark, "gold")
    out = files.write_gold({"some": ("a", spark.range(3)), "none": ("a", spark.range(0))}, root).collect()
    assert [(r["dataset"], r["records"], r["path"] is None) for r in out] == [("some", 3, False), ("none", 0, True)]
    assert not files.path_exists(spark, f"{root}/a/none")


def test_grouping_sets_have_no_null_keys(spark):
    rows = [("A", "S1", "c", "P", None, 1, 1, 2.0), ("A", None, "c", "P", "B", 1, 1, 4.0)]
    df = spark.createDataFrame(rows, "region string, state string, city string, product string, brand string, month int, quarter int, price double")
    roles = STAR.with_(region="region", state="state", city="city", product="product", brand="brand", month="month", price="price")
    got = {(r["grouping_set"], r["n_obs"]) for r in price_grouping_sets(df, roles).collect()}
    assert got == {("region_month", 2), ("state_product", 1), ("brand_product", 1), ("city_quarter", 2)}
