"""File sources and sinks: CSV, partitioned Parquet layers, Gold datasets,
run logs, catalogs and partition inventories.

Writes replace whole partitions (dynamic partition overwrite), so re-running a
batch that carries whole (ano, mes) partitions leaves row counts unchanged
(K4 fixed). Paths are plain strings: any Hadoop-compatible shared store.
"""

from __future__ import annotations

import json
import time
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import freed_shuffles, small_splits, writing


# --- CSV ---------------------------------------------------------------------
def fuel_raw_schema() -> T.StructType:
    fields = [T.StructField(c, T.DoubleType() if c in ("Valor_Venda", "Valor_Compra") else T.StringType())
              for c in C.FUEL_RAW_COLUMNS]
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             encoding: str = "UTF-8", sep: str = ",", glob: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass)."""
    r = (spark.read.option("header", True).option("encoding", encoding).option("sep", sep)
         .option("mode", "PERMISSIVE"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def csv_columns(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Header names only (no inferSchema: Spark reads just the first line)."""
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def csv_header_check(spark: SparkSession, path: str, expected) -> dict:
    """Does the file carry every expected column?"""
    cols = csv_columns(spark, path)
    missing = sorted(set(expected) - set(cols))
    return {"valid": not missing, "missing_columns": missing, "columns": cols}


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8",
              mode: str = "overwrite", compression: str = "none") -> str:
    """Header CSV sink; blanks around a value are part of it."""
    (df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding)
       .option("compression", compression).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def file_profile(df: DataFrame, price: str, cost: str | None = None, hi: float = 50.0,
                 expected=(), min_completeness: float = 0.95) -> DataFrame:
    """S3 (v1 file validator) per source file: rows, nulls in all and per column, expected
    columns that are missing, duplicate rows, prices <= 0 or > hi, completeness, and whether
    the file is valid (has rows, no column is missing, completeness high enough). ``df`` must
    come from a file scan."""
    cols = [c for c in df.columns]
    missing = sorted(set(expected) - set(cols))
    f = df.select("*", F.col("_metadata.file_name").alias("_file"))
    null_of = {c: F.count_if(F.col(f"`{c}`").isNull()) for c in cols}
    per = f.groupBy("_file").agg(
        F.count(F.lit(1)).alias("rows"), sum(null_of.values(), F.lit(0)).alias("null_cells"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*null_of.values())).alias("nulls"),
        F.count_if((F.col(price) <= 0) | (F.col(price) > hi)).alias("bad_prices"))
    dist = (f.groupBy("_file", *[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_k"))
              .groupBy("_file").agg(F.count(F.lit(1)).alias("_distinct")))
    out = per.join(dist, "_file", "left")
    complete = 1.0 - F.col("null_cells") / (F.col("rows") * float(len(cols)))
    return out.select(F.col("_file").alias("file_name"), "rows", "null_cells", "nulls",
                      F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing_columns"),
                      (F.col("rows") - F.col("_distinct")).alias("duplicate_rows"), "bad_prices",
                      complete.alias("completeness"),
                      ((F.col("rows") > 0) & F.lit(not missing) & (complete >= min_completeness)).alias("valid"))


# --- Parquet layers ------------------------------------------------------------
def write_layer(df: DataFrame, path: str, partition_cols=C.PARTITION_COLUMNS,
                mode: str = "overwrite", clustered: bool = False, shuffled: bool = False) -> str:
    """Partitioned Parquet; refuses when a partition column is missing.

    The ``rebalance`` hint clusters rows by the partition columns and lets AQE
    size the writer tasks to ``advisoryPartitionSizeInBytes``: a month holding
    a third of the data is split over many tasks, small months are coalesced,
    so file sizes stay bounded whatever the volume; rows read from files that are
    ``clustered`` so are written as they come, from small splits, and so are those ``shuffled`` by
    the caller. Dynamic overwrite replaces only the partitions present.
    """
    missing = [c for c in partition_cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing partition columns: {missing}")
    spark = df.sparkSession
    with writing(spark), small_splits(spark) if clustered else nullcontext():
        ((df if clustered or shuffled else df.hint("rebalance", *partition_cols))
           .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
           .partitionBy(*partition_cols).parquet(path))
    return path


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """Recursive Parquet with partition discovery. A file that can't be read is an error."""
    return spark.read.option("basePath", path).parquet(path)


def read_layer_skipping(spark: SparkSession, path: str, schema) -> tuple[DataFrame, DataFrame]:
    """S10/S11 for a damaged layer of a known schema: what can be read, and the files that were skipped.

    The second frame has file, size_mb of every file that exists in the layer but whose
    rows can't be read; nothing is skipped without a row there."""
    df = spark.read.schema(schema).option("basePath", path).option("ignoreCorruptFiles", "true").parquet(path)
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
              .load(path).select(F.col("path").alias("file"), (F.col("length") / (1024.0 * 1024.0)).alias("size_mb")))
    # a column is read, so that a file whose footer alone is sound doesn't count as read
    seen = df.select(F.col("_metadata.file_path").alias("file"), F.col(df.columns[0])).select("file").distinct()
    return df, listed.join(seen, "file", "left_anti")


def write_gold(datasets: dict, root: str) -> DataFrame:
    """``{name: (category, df)}`` -> ``root/category/name``. Returns one row per dataset
    with its written row count.

    Each dataset is one job: rows are counted while they are written (``observe``); a
    dataset that turns out empty is removed again, so empty ones leave no folder."""
    rows = []
    spark = None
    for name, (category, df) in datasets.items():
        spark = df.sparkSession
        path = f"{root.rstrip('/')}/{category}/{name}"
        seen = Observation()
        with freed_shuffles(spark):
            df.observe(seen, F.count(F.lit(1)).alias("records")).write.mode("overwrite").parquet(path)
        records = seen.get["records"]
        if not records:
            delete_path(spark, path)
        rows.append((category, name, path if records else None, records))
    return spark.createDataFrame(rows, "category string, dataset string, path string, records long")


def read_gold(spark: SparkSession, root: str, name: str, category: str | None = None) -> DataFrame:
    """A Gold dataset by name (``root/<category>/<name>``; any category when omitted)."""
    path = f"{root.rstrip('/')}/{category}/{name}" if category else f"{root.rstrip('/')}/*/{name}"
    return spark.read.parquet(path)


def write_run_log(spark: SparkSession, summary: dict, path: str) -> DataFrame:
    """One JSON line per run (append)."""
    df = spark.createDataFrame([(json.dumps(summary, default=str), time.strftime("%Y-%m-%dT%H:%M:%S"))],
                               "summary string, logged_at string")
    df.coalesce(1).write.mode("append").json(path)
    return df


def record_counts(spark: SparkSession, frames: list[DataFrame]) -> list[int]:
    """Rows of each of some written datasets, by one job. No column is read, so Parquet
    answers from its footers."""
    if not frames:
        return []
    tagged = [df.select(F.lit(k).alias("k")) for k, df in enumerate(frames)]
    found = {r["k"]: r["count"] for r in reduce(DataFrame.unionByName, tagged).groupBy("k").count().collect()}
    return [found.get(k, 0) for k in range(len(frames))]


def catalog_entry(layer: str, dataset: str, df: DataFrame, partitioning=(), description: str = "") -> dict:
    """The catalog's entry for a written dataset; columns from its schema, rows counted later."""
    return {"layer": layer, "dataset": dataset, "frame": df, "columns": df.columns,
            "partitioning": list(partitioning), "description": description}


def dataset_catalog(spark: SparkSession, entries) -> DataFrame:
    """(layer, dataset, records, columns, partitioning, description); all datasets are
    counted by one job."""
    entries = list(entries)
    counted = iter(record_counts(spark, [e["frame"] for e in entries if "records" not in e]))
    rows = [(e["layer"], e["dataset"], int(e["records"] if "records" in e else next(counted)), list(e["columns"]),
             list(e.get("partitioning", [])), e.get("description", "")) for e in entries]
    return spark.createDataFrame(rows, "layer string, dataset string, records long, columns array<string>, "
                                       "partitioning array<string>, description string")


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """path, modificationTime, length and the partition columns of a layer's files, from the
    distributed file listing; no file is opened."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", path)
            .load(path).drop("content"))


def latest_month(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """The latest (ano, mes) of a layer that has a file, from the listing."""
    ym = F.struct(*[F.col(c).cast("int").alias(c) for c in C.PARTITION_COLUMNS])
    got = partition_files(spark, path).where("ano IS NOT NULL AND mes IS NOT NULL").agg(F.max(ym).alias("ym")).first()["ym"]
    return (got["ano"], got["mes"]) if got is not None else None


def partition_inventory(spark: SparkSession, path: str, partition_cols=C.PARTITION_COLUMNS) -> DataFrame:
    """Files and MB per partition, from the file listing alone."""
    return partition_files(spark, path).groupBy(*partition_cols).agg(
        F.count(F.lit(1)).alias("files"), (F.sum("length") / (1024.0 * 1024.0)).alias("size_mb"))


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours from any Hadoop file system; a missing one is fine."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def _dataset_roots(spark: SparkSession, path: str) -> list[str]:
    """The Parquet datasets below ``path``: itself if it holds files or partitions, else the
    ``category/dataset`` folders of a Gold root."""
    fs, p = _hadoop(spark, path)
    out = []
    for entry in fs.listStatus(p):
        name = entry.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if not entry.isDirectory() or "=" in name:
            return [path]
        out += _dataset_roots(spark, entry.getPath().toString())
    return sorted(out)


def layer_validation(spark: SparkSession, layers: dict) -> DataFrame:
    """``{layer: path}`` in order; a layer is checked only if the previous one passed.

    One row per layer: exists, datasets, records, columns (of the widest dataset), size_mb,
    status; the last row, ``overall``, sums up: ``passed`` if every layer did, ``failed`` if
    one is missing, else ``warning``."""
    kind = "layer string, exists boolean, datasets int, records long, columns int, size_mb double, status string"
    rows, ok = [], True
    for layer, path in layers.items():
        if not ok:
            rows.append((layer, None, None, None, None, None, "skipped"))
            continue
        if not path_exists(spark, path):
            rows.append((layer, False, None, None, None, None, "failed"))
            ok = False
            continue
        frames = [read_layer(spark, root) for root in _dataset_roots(spark, path)]
        records = sum(record_counts(spark, frames))
        fs, p = _hadoop(spark, path)
        size = fs.getContentSummary(p).getLength() / (1024.0 * 1024.0)
        ok = bool(frames) and records > 0
        rows.append((layer, True, len(frames), records, max((len(df.columns) for df in frames), default=0), size,
                     "passed" if ok else "warning"))
    states = {r[-1] for r in rows}
    overall = "failed" if "failed" in states else "passed" if states <= {"passed"} else "warning"
    done = [r for r in rows if r[3] is not None]
    rows.append(("overall", None, sum(r[2] for r in done), sum(r[3] for r in done), None, sum(r[5] for r in done), overall))
    return spark.createDataFrame(rows, kind)
