"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Word separators of every operator here: space and the ASCII controls 9-13.
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends
    there, so a lost executor re-reads files instead of recomputing the plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words of a text (null and blank texts: an empty array), JVM-side."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def sampled(df: DataFrame, key: str, size: int, rows: int) -> DataFrame:
    """About ``size`` of the ``rows`` rows, chosen by the hash of ``key`` where they are, so
    that a task sends no more than its share. At most ``2 * size`` rows are all taken."""
    if rows <= 2 * size:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)) < int(size / rows * (1 << 40)))


def give_back() -> None:
    """In a task: returns memory that was freed to the system. Python workers live on from
    stage to stage, and what they keep adds up in an executor's memory."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
