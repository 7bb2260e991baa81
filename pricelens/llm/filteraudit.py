"""Audit of how document filters interact, by counting paths through their subset lattice.

A state is the set of filters that have been applied, an edge applies one more. ``forward``
counts the orders that reach a state, ``backward`` those that lead on from it, so an edge
lies on ``forward(state) * backward(next)`` orders. What a filter removes on an edge depends
on the state alone, not on the way there: the rows that fail it and none of the state's
filters. Weighted by the edges' orders, the removals add up to the filter's Shapley value
(times the number of orders); the steps of every single order are read from the same edges.

Rows enter only as counts by (part, set of failed filters), so the audit costs one pass over
the texts and two shuffles of small rows, whatever the number of orders.

Filters, by words (runs of characters other than space and the controls 9-13, case-sensitive):
A under 200 words; B 100 * distinct words < 50 * words; C 100 * [A-Z] characters > 3 * code
points; D holds any of ``#$%&*|``; E identical to the text of a smaller doc_id.

Defined results: a null text is empty, a null lang or label is the part "" or no mark; a doc_id
with several label rows has a mark if any row has it; rows that repeat a doc_id and text are
counted each, and don't fail E for each other; a null doc_id has no order and never fails E
nor makes another row fail it. No rows give no parts. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Filters in the order of the bits of a mask; all orders are listed, so some seven at most.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 3
_UPPER, _SIGNS, _INNER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|", bytes(range(0x80, 0xC0))
_SPACE, _PIECE = re.compile(rb"[\x20\x09-\x0D]"), 1 << 20


def lattice(n: int) -> tuple[list[int], list[int], list[tuple[int, int, int]]]:
    """Orders that reach each state, orders that lead on from it, and the edges
    (state, filter, orders through the edge) of ``n`` filters."""
    full = (1 << n) - 1
    forward, backward = [1] + [0] * full, [0] * full + [1]
    for state in range(full + 1):
        for f in range(n):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in range(full - 1, -1, -1):
        backward[state] = sum(backward[state | 1 << f] for f in range(n) if not state >> f & 1)
    return forward, backward, [(state, f, forward[state] * backward[state | 1 << f])
                               for state in range(full + 1) for f in range(n) if not state >> f & 1]


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text cut between words into pieces of about a megabyte."""
    at = 0
    while len(raw) - at > _PIECE:
        gap = _SPACE.search(raw, at + _PIECE)
        end = gap.start() if gap else len(raw)
        yield raw[at:end]
        at = end
    yield raw[at:]


def fails(raw: bytes) -> int:
    """Filters A to D that a text in UTF-8 fails, as bits."""
    words, distinct = 0, set()
    for piece in _pieces(raw):
        found = piece.split()
        words += len(found)
        distinct.update(found)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    points = len(raw.translate(None, _INNER))
    signs = len(raw.translate(None, _SIGNS)) < len(raw)
    return ((words < MIN_WORDS) | (100 * len(distinct) < MIN_DISTINCT * words) << 1
            | (100 * upper > MAX_UPPER * points) << 2 | signs << 3)


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, the text's SHA-256 and the mask of filters A to D that it fails."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            masks, digests = [], []
            for text in batch.column(2):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                masks.append(fails(raw))
                digests.append(sha256(raw).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()),
                                              pa.array(masks, pa.int32())], names=["doc_id", "part", "digest", "mask"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, "doc_id long, part string, digest binary, mask int")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask of all five filters, and numbers of documents: n, good, toxic."""
    rows = judged(docs).groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # rows without doc_id match no label; their second key deals them out
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("spread", spread).join(marks.withColumn("spread", F.lit(0).cast("long")),
                                                  ["doc_id", "spread"], "left")
    good, toxic = (F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic"))
    # a text's rows become one for each part and marks, however often it is repeated
    texts = rows.groupBy("digest", "part", "mask", good, toxic).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("at_low"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"))
    first = F.min("low").over(Window.partitionBy("digest"))
    stay = F.col("unnamed") + F.when(F.col("low") == F.col("first"), F.col("at_low")).otherwise(0)
    split = F.explode(F.array(F.struct(F.col("mask"), F.col("stay").alias("n")),
                              F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - F.col("stay")).alias("n"))))
    return (texts.withColumn("first", first).withColumn("stay", stay).select("part", "good", "toxic", split.alias("x"))
            .where("x.n > 0").groupBy("part", "x.mask")
            .agg(F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"),
                 F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")))


def edges(counts: DataFrame, n: int = len(FILTERS)) -> DataFrame:
    """What each edge of the lattice removes, keeps and finds removed, by part: ``counts`` has
    part, mask, n, good, toxic, and any number of rows for a mask."""
    of = F.explode(F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"),
                                      F.lit(w).cast("long").alias("orders")) for s, f, w in lattice(n)[2]]))
    rows = counts.withColumn("e", of).select("*", "e.*")
    mask, state, bit = F.col("mask"), F.col("state"), F.col("bit")
    failing, before = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(state) != 0

    def total(what: str, when, name: str):
        return F.sum(F.when(when, F.col(what)).otherwise(0)).alias(name)

    out = rows.groupBy("part", "state", "filter", "orders").agg(
        total("n", ~failing & ~before, "kept"), total("n", failing & ~before, "removed"),
        total("n", failing & before, "redundant"), total("n", mask == bit, "unique_fails"),
        total("good", failing & ~before, "good_lost"), total("toxic", failing & ~before, "toxic_lost"))
    return out.withColumn("shapley", F.sum(F.col("orders") * F.col("removed")).over(Window.partitionBy("part", "filter")))


def steps(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row for each part, order of the filters and step, read from the lattice's edges."""
    rows = []
    for order in itertools.permutations(range(len(filters))):
        state = 0
        for k, f in enumerate(order, 1):
            rows.append((state, f, "".join(filters[i] for i in order), k))
            state |= 1 << f
    walks = counts.sparkSession.createDataFrame(rows, "state int, filter int, filter_order string, step int")
    return edges(counts, len(filters)).join(F.broadcast(walks), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The steps of every order of the five filters over ``docs`` (doc_id, text, lang), with
    the losses among the documents that ``labels`` (doc_id, quality, toxic) marks."""
    return steps(failures(docs, labels))
