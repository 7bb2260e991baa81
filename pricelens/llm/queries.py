"""The registered queries of the corpus operators: each applies its operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bottomk, bpe, codebooks, covertree, filteraudit, hosttrust, langid, linededup, mixing, perspectives,
               simhash, toxicity, warc)
from .common import read


def op1_url_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosttrust.judge(read(spark, sf_dir, "pages"))


def op2_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(read(spark, sf_dir, "documents"))


def op3_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.assign(read(spark, sf_dir, "documents"))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), bpe.default_path())


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.link(read(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.deduplicate(docs).select(
        "row.doc_id", "n_lines", "n_equal", "n_near", "row.text")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labelled = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return labelled.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.compare_with_edits(read(spark, sf_dir, "documents"))


def op10_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered dialogues with their masks; spans as ``start-end`` pairs."""
    out = perspectives.rotate(read(spark, sf_dir, "conversations"))
    return out.select("conv_id", "speaker", "part", "piece", "rendered", "mask", "n_turns", "n_trained",
                      F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
                      .alias("spans"), "trained_chars")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts; passages as ``start-end`` pairs."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         F.array_join(F.transform("passages", lambda p: F.concat_ws("-", p["start"], p["end"])), ",")
                         .alias("passages"))


def op13_vector_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.compress(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_host_trust, op2_entropy_mix, op3_warc_bundles, op4_simhash_near_dedup, op5_bpe_round_trip, op6_embedding_near_dedup, op7_line_dedup,
                              op8_language_id, op9_document_fingerprints, op10_chat_perspectives, op11_filter_audit,
                              op12_toxic_passages, op13_vector_codebooks)
}

#: op10 in DuckDB: the same rendering by string aggregation over (conversation, speaker, part).
_OP10 = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (
  SELECT t.conv_id, s.speaker, t.turn // 64 AS part, t.turn, t.role, t.text, (t.role = s.speaker) AS own,
    '<|im_start|>' || CASE WHEN t.role = 'system' THEN 'system' WHEN t.role = s.speaker THEN 'assistant'
      ELSE 'user name=' || regexp_replace(t.role, '[^\p{L}\p{N}_-]', '_', 'g') END || chr(10) AS head,
    replace(replace(t.text, '<|im_start|>', '<' || chr(8203) || '|im_start|>'),
            '<|im_end|>', '<' || chr(8203) || '|im_end|>') || '<|im_end|>' AS body
  FROM t JOIN s ON t.conv_id = s.conv_id),
p AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
      PARTITION BY conv_id, speaker, part ORDER BY turn, role, text
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS pos FROM r)
SELECT conv_id, speaker, part, CAST(0 AS INTEGER) AS piece,
  string_agg(head || body || chr(10), '' ORDER BY turn, role, text) AS rendered,
  string_agg(CASE WHEN own THEN '010' ELSE '000' END, '' ORDER BY turn, role, text) AS mask,
  CAST(count(*) AS INTEGER) AS n_turns, CAST(count(*) FILTER (own) AS INTEGER) AS n_trained,
  coalesce(string_agg(CAST(pos AS BIGINT) || '-' || CAST(pos + length(body) AS BIGINT), ','
    ORDER BY turn, role, text) FILTER (own), '') AS spans,
  CAST(coalesce(sum(length(body)) FILTER (own), 0) AS INTEGER) AS trained_chars
FROM p GROUP BY conv_id, speaker, part
"""

#: op11 in DuckDB: every order is walked on its own over counts by (part, failed filters).
_OP11 = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
f AS (
  SELECT doc_id, part, CAST(len(words) < 200 AS INTEGER)
    + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INTEGER)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS INTEGER) AS mask FROM w),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, mask),
a AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM a p JOIN a q ON q.x <> p.x JOIN a r ON r.x NOT IN (p.x, q.x) JOIN a s ON s.x NOT IN (p.x, q.x, r.x)
  JOIN a t ON t.x NOT IN (p.x, q.x, r.x, s.x)),
e AS (
  SELECT filter_order, k AS step, substr(filter_order, k, 1) AS filter, 1 << (ascii(substr(filter_order, k, 1)) - 65) AS bit,
    list_sum(list_transform(range(1, k), lambda j: 1 << (ascii(substr(filter_order, j, 1)) - 65))) AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
s AS (
  SELECT part, filter_order, step, filter,
    sum(n) FILTER (mask & bit = 0 AND mask & coalesce(before, 0) = 0) AS kept,
    sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0) = 0) AS removed,
    sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0) <> 0) AS redundant,
    sum(n) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0) = 0) AS good_lost,
    sum(toxic) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0) = 0) AS toxic_lost
  FROM c, e GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, filter), 0) AS BIGINT) AS shapley
FROM s
"""


def _op13() -> str:
    """op13 in DuckDB: six rounds over all pairs of a part and an entry, unrolled."""
    parts = """
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS MATERIALIZED (
  SELECT r, vec_id, label, p, x[p * len(x) // 8 + 1 : (p + 1) * len(x) // 8] AS x
  FROM v, (SELECT unnest(range(8)) AS p)),
b0 AS MATERIALIZED (SELECT p, CAST(r - 1 AS BIGINT) AS e, x FROM q WHERE r <= 16)"""
    for k in range(7):
        parts += f""",
n{k} AS MATERIALIZED (
  SELECT q.r, q.p, min((list_sum(list_transform(list_zip(q.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.e)) AS best
  FROM q JOIN b{k} b ON q.p = b.p GROUP BY q.r, q.p)"""
        if k < 6:
            parts += f""",
m{k} AS (
  SELECT p, e, list(CAST(floor(s / c) AS BIGINT) ORDER BY d) AS x FROM (
    SELECT q.p, n.best[2] AS e, u.d, sum(q.x[u.d]) AS s, count(*) AS c
    FROM q JOIN n{k} n ON q.r = n.r AND q.p = n.p, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM q))) AS d) u
    WHERE u.d <= len(q.x) GROUP BY 1, 2, 3) GROUP BY p, e),
b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.e = m.e)"""
    return parts + """,
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b6),
c AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM n6 GROUP BY r)
SELECT v.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, h.codebooks_sha256
FROM v JOIN c ON v.r = c.r, h
"""


ORACLE_SQL: dict[str, str] = {"op10_chat_perspectives": _OP10, "op11_filter_audit": _OP11, "op13_vector_codebooks": _op13()}
