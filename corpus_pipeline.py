"""The corpus pipeline: documents to token ids in five stages, each one operator of
``pricelens.llm`` over all that the stage before kept.

1. language_id: documents without a recognised language go.
2. line_dedup: lines that occur before go, and documents that lose all of theirs.
3. simhash_near_dedup: one document of each group of near copies stays.
4. mixing: every document as often as the mix takes it; documents taken no time go.
5. bpe: token ids of every document, and the check that they decode to its text.

All but the last return the columns of ``documents``, with text and n_chars up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelens.llm import bpe, langid, linededup, mixing, simhash
from pricelens.llm.common import read, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accept(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.apply(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, bpe.default_path(), keep_ids=True)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("mixing", mix_sources), ("bpe", encode)]

#: No stage can be put in SQL; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
