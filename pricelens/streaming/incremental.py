"""Incremental Bronze ingest with Structured Streaming.

New raw CSV files in a landing folder are picked up as they arrive. Each batch gets
the technical columns and is merged into the partitioned Bronze layer: among all rows
of a business key, already written or new, the first by the tie-break columns stays
(the rule of the batch path), so the result does not depend on how files fall into
batches or on their order. Rows without a parseable date go to a reject folder, one
sub-folder per batch, and are never dropped.

Merging rewrites the (ano, mes) partitions that the batch touches, by dynamic partition
overwrite from a staged copy under the checkpoint folder. A key index (``keyindex.py``)
says which partitions hold the batch's keys, so what a batch reads doesn't grow with the
layer. A batch that is replayed after a failure finds its staged copy and writes the same
files again. Rows of the layer whose keys the batch doesn't bring are staged as they are; only
the others are put in order. Staged rows lack the columns that follow from the raw row
(``DERIVED``), which are computed as the layer is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..config import PanelRoles
from ..operators.clean import clustered, dedup, hash_filter, marked, write_rows
from ..session import writing
from ..sources import files
from .keyindex import FIRST, KeyIndex, key_hash

PARTS = list(C.PARTITION_COLUMNS)
#: Technical columns that follow from ``event_ts`` and the raw row, and all of them.
DERIVED = ("bronze_record_id", "data_coleta_parsed", *PARTS)
TECHNICAL = ("bronze_load_timestamp", "bronze_source_file", "event_ts", *DERIVED)


def _first_by_key(df: DataFrame, keys: list[str], tiebreak: list[str]) -> DataFrame:
    return dedup(df, keys, tiebreak, "first")


def _dates() -> dict:
    return {"data_coleta_parsed": F.to_date("event_ts"), "ano": F.year("event_ts"), "mes": F.month("event_ts")}


def _stored(df: DataFrame) -> DataFrame:
    """What is staged of a frame with all technical columns."""
    return df.drop(*DERIVED) if {*TECHNICAL} <= {*df.columns} else df


def _whole(df: DataFrame, columns: list) -> DataFrame:
    """Staged rows with all ``columns`` of the batch."""
    if {*columns} <= {*df.columns}:
        return df.select(*columns)
    from ..plans.pipeline import record_id
    raw = [c for c in columns if c not in TECHNICAL]
    return df.withColumns({"bronze_record_id": record_id(raw), **_dates()}).select(*columns)


def _staged(spark: SparkSession, path: str) -> DataFrame:
    """Rows that an earlier step staged, with the types that they were written with."""
    return spark.read.parquet(path)


def merge_batch(batch: DataFrame, batch_id: int, out: str, rejects: str, staging: str,
                keys: list[str], tiebreak: list[str], index: str | None = None) -> dict:
    """Merge one batch (with technical columns) into the layer ``out``.

    Which partitions hold keys of the batch comes from the key index (``<out>_keys`` by
    default), so no batch scans the layer. Returns what was touched: partitions, and buckets
    of the index."""
    spark, columns = batch.sparkSession, batch.columns
    staged = f"{staging}/{batch_id}"
    known = KeyIndex(spark, index or f"{out}_keys")
    if not files.path_exists(spark, f"{staged}-rows/_SUCCESS"):
        write_rows(_stored(batch), f"{staged}-rows")  # the files are parsed once
    rows = _whole(_staged(spark, f"{staged}-rows"), columns)
    fresh = rows.filter(F.col("ano").isNotNull())
    if not files.path_exists(spark, f"{staged}-keys/_SUCCESS"):
        write_rows(fresh.select(key_hash(keys).alias("key_hash")).distinct(), f"{staged}-keys")
    hashes = _staged(spark, f"{staged}-keys")
    stats = {"partitions": 0, "buckets": []}
    if not files.path_exists(spark, f"{staged}/_SUCCESS"):
        with writing(spark):
            rows.filter(F.col("ano").isNull()).write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        new, gone = _first_by_key(_stored(fresh), keys, tiebreak), []
        if files.path_exists(spark, out):
            written = spark.read.schema(batch.schema).option("basePath", out).parquet(out)
            if not known.state():
                known.update(written.select(key_hash(keys).alias("key_hash"), *PARTS).distinct(), FIRST)
            # partitions that hold a key of this batch, and those its rows belong to
            held, stats["buckets"] = known.lookup(hashes)
            touched = [tuple(r) for r in held.union(fresh.select(*PARTS)).distinct().collect()]
            inside = F.lit(False)
            for ano, mes in touched:   # one entry per month, read as partition filters
                inside = inside | ((F.col("ano") == ano) & (F.col("mes") == mes))
            old = written.filter(inside)
            if known.from_layer():     # its rows may repeat a key that no batch brings
                new = _first_by_key(_stored(old.unionByName(fresh)), keys, tiebreak)
            else:
                pieces = write_rows(hash_filter(hashes.select(F.col("key_hash").alias("_kh"))), f"{staged}-filter")
                told = marked(_stored(old).withColumn("_kh", key_hash(keys)), pieces)
                some, others = (told.where(c).drop("_kh", "_maybe") for c in ("_maybe", "NOT _maybe"))
                new = _first_by_key(some.unionByName(_stored(fresh)), keys, tiebreak).unionByName(others)
            gone, stats["partitions"] = [(ano, mes, True) for ano, mes in touched], len(touched)
        write_rows(new, staged)
        if gone:
            spark.createDataFrame(gone, "ano int, mes int, touched boolean").coalesce(1).write.mode("overwrite").parquet(
                f"{staged}-touched")
    stored = _staged(spark, staged)
    merged = _whole(stored, columns)
    if not merged.isEmpty():
        months = [F.col(c) for c in PARTS] if {*PARTS} <= {*stored.columns} else [F.year("event_ts"), F.month("event_ts")]
        files.write_layer(_whole(clustered(stored, months), columns), out, shuffled=True)
    if files.path_exists(spark, f"{staged}-touched/_SUCCESS"):
        # a partition whose rows have all moved to another one holds nothing any more
        left = {tuple(r) for r in merged.select(*PARTS).distinct().collect()}
        for r in spark.read.parquet(f"{staged}-touched").collect():
            if (r["ano"], r["mes"]) not in left:
                files.delete_path(spark, f"{out}/ano={r['ano']}/mes={r['mes']}")
    # after the layer: should the batch fail in between, its replay finds the old entries
    places = write_rows(merged.select(key_hash(keys).alias("key_hash"), *PARTS).join(hashes, "key_hash", "left_semi").distinct(),
                        f"{staged}-places")
    known.update(places, batch_id, replaced=hashes)
    for part in ("", "-rows", "-keys", "-filter", "-places", "-touched"):
        files.delete_path(spark, f"{staging}/{batch_id - 1}{part}")
    return stats


def incremental_ingest(spark: SparkSession, landing: str, schema: T.StructType, roles: PanelRoles,
                       out: str, checkpoint: str, date_source: str = "Data_Coleta",
                       rejects: str | None = None, fmt: str = C.DATE_FORMAT,
                       available_now: bool = True, max_files_per_trigger: int = 1000):
    """Start the ingest; ``max_files_per_trigger`` bounds a batch and has no effect on the result."""
    stream = (spark.readStream.schema(schema).option("header", True)
              .option("maxFilesPerTrigger", max_files_per_trigger).csv(landing))
    keys = [k for k in roles.key if k in schema.fieldNames()]
    # the raw row, then the file, break ties, so equal raw rows agree on their file
    tiebreak = [c for c in [*roles.tiebreak, *schema.fieldNames()] if c in schema.fieldNames() and c not in keys]
    tiebreak = [*dict.fromkeys(tiebreak), "bronze_source_file", "bronze_load_timestamp"]
    ts = F.try_to_timestamp(F.col(date_source), F.lit(fmt))
    rows = stream.withColumns({
                "bronze_load_timestamp": F.current_timestamp(),
                "bronze_source_file": F.col("_metadata.file_name"),
                "event_ts": ts})
    root = checkpoint.rstrip("/")
    bad = rejects or f"{out.rstrip('/')}_rejects"

    def sink(batch: DataFrame, batch_id: int) -> None:
        # the stream's plan ends here: what it computes is computed for every row, needed or not
        merge_batch(_whole(batch, [*schema.fieldNames(), *TECHNICAL]), batch_id, out.rstrip("/"), bad, f"{root}/merge", keys, tiebreak)

    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", root)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
