"""URL filters by rules and by trust and distrust that spread over the host graph.

Rules name a host (with all its subdomains) and a path prefix. Pages that a rule fits get
its verdict. The rest is judged by host: hosts of allowed pages seed a personalised
PageRank along the host edges, hosts of blocked pages seed another one against them (who
links to the blocked is distrusted), both in proportion to their pages; a host with more
distrust than ``ratio`` times its trust is blocked, any other allowed.

Host edges: hyperlinks of the pages to other hosts, weighted by the logarithm of their
number, and, of weight ``family``, between a host of three labels or more and its parent
domain. All graph tables stay in Spark; a round is a join of the edges with the ranks and a
map-side combined sum, and its result is written to the shared folder.

Defined results: a null url or one without ``://`` has an empty host and path, no rule and
the verdict allow; null html has no links; rows that repeat count as often as they occur;
a host with neither trust nor distrust is allowed. Without allowed (blocked) pages there is
no trust (distrust) at all.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

DAMPING, ROUNDS, TOLERANCE, RATIO, FAMILY = 0.7, 25, 1e-4, 1.0, 1.0


class Rule(NamedTuple):
    """``text`` is host and path prefix, like ``net/`` or ``example.org/en/1``."""

    verdict: str
    text: str


#: The production rules.
RULES = (Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
         Rule("allow", "com/fr/"), Rule("block", "com/de/"))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url() -> tuple[Column, Column]:
    """Host and path of the column ``__url``."""
    has = F.instr("__url", "://") > 0
    after = F.expr("substring(__url, instr(__url, '://') + 3)")
    host = F.when(has, lower_ascii(F.regexp_extract(after, r"^([^/?#]*)", 1))).otherwise("")
    path = F.when(has, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def matched(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        at = rule.text.index("/")
        fits = ((host == rule.text[:at]) | host.endswith("." + rule.text[:at])) & path.startswith(rule.text[at:])
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def judged(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """page_id, host, path, and hit: the rule's struct."""
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("__url"))
    host, path = split_url()
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    return rows.withColumn("hit", matched(F.col("host"), F.col("path"), rules))


def edges(pages: DataFrame, family: float = FAMILY) -> DataFrame:
    """(src, dst, weight) between different hosts."""
    rows = pages.select(F.coalesce(F.col("url").cast("string"), F.lit("")).alias("__url"), "html")
    host, _ = split_url()
    rows = rows.select(host.alias("src"), "html").where("src <> ''")
    found = F.expr(r"""regexp_extract_all(html, '(?i)\\bhref\\s*=\\s*["\']?\\s*(?:https?:)?//([^/"\'\\s<>?#]+)', 1)""")
    links = rows.select("src", F.explode(found).alias("dst")).withColumn("dst", lower_ascii(F.col("dst")))
    links = links.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    links = stored(links.select("src", "dst", F.log1p("n").alias("weight")), "host_links")
    hosts = rows.select(F.col("src").alias("host")).distinct().union(links.select("dst")).distinct()
    child = hosts.where(F.size(F.split("host", r"\.")) >= 3).withColumn("parent", F.expr("substring(host, instr(host, '.') + 1)"))
    ties = child.select("host", "parent").union(child.select("parent", "host")).toDF("src", "dst")
    both = links.unionByName(ties.withColumn("weight", F.lit(float(family))).where(F.lit(family > 0)))
    return both.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS,
           tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) by two personalised PageRanks over ``links`` (src, dst, weight):
    trust along them from ``seeds.allow``, distrust against them from ``seeds.block``. What
    reaches a host without way out goes back to the seeds, so each rank sums up to 1."""
    both = links.select(F.lit("allow").alias("kind"), "src", "dst", "weight").unionByName(
        links.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    shares = stored(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("share")),
                    "host_edges")
    totals = seeds.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    hosts = seeds.select("host").union(links.select("src")).union(links.select("dst")).distinct()
    hosts = hosts.join(seeds, "host", "left")
    rows = hosts.select("host", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), (F.coalesce(F.col(k), F.lit(0)) / F.lit(float(totals[k] or 1))).alias("seed"))
        for k in ("allow", "block")])).alias("s")).select("host", "s.*")
    ways = shares.select("kind", F.col("src").alias("host")).distinct().withColumn("way_out", F.lit(True))
    state = rows.join(ways, ["kind", "host"], "left").withColumn("rank", F.col("seed")).select(
        "kind", "host", "seed", F.coalesce("way_out", F.lit(False)).alias("way_out"), "rank", F.lit(1.0).alias("before"))
    state = stored(state, "host_ranks")
    for _ in range(rounds):
        moving = {r["kind"]: r for r in state.groupBy("kind").agg(
            F.sum(F.when(F.col("way_out"), F.col("rank"))).alias("on"),
            F.sum(F.abs(F.col("rank") - F.col("before"))).alias("change")).collect()}
        if all(r["change"] <= tolerance for r in moving.values()):
            break
        back = F.lit(0.0)
        for kind, r in moving.items():
            back = F.when(F.col("kind") == kind, 1 - damping * (r["on"] or 0.0)).otherwise(back)
        arrives = (shares.join(state.select("kind", F.col("host").alias("src"), "rank"), ["kind", "src"])
                   .groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("share") * F.col("rank")).alias("arrives")))
        now = damping * F.coalesce("arrives", F.lit(0.0)) + back * F.col("seed")
        state = stored(state.join(arrives, ["kind", "host"], "left").select(
            "kind", "host", "seed", "way_out", now.alias("now"), F.col("rank").alias("before"))
            .withColumnRenamed("now", "rank"), "host_ranks")
    return state.groupBy("host").agg(
        F.round(F.sum(F.when(F.col("kind") == "allow", F.col("rank"))), 12).alias("trust"),
        F.round(F.sum(F.when(F.col("kind") == "block", F.col("rank"))), 12).alias("distrust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, ratio: float = RATIO, family: float = FAMILY,
          damping: float = DAMPING) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    rows = judged(pages, rules)
    seeds = rows.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("hit.verdict") == "allow").alias("allow"),
        F.count_if(F.col("hit.verdict") == "block").alias("block"))
    ranks = stored(spread(stored(edges(pages, family), "host_graph"), stored(seeds, "host_seeds"), damping), "host_trust")
    blocked = F.col("distrust") > ratio * F.col("trust")
    verdict = F.when(F.col("hit").isNotNull(), F.col("hit.verdict")).when(blocked, "block").otherwise("allow")
    return rows.join(ranks, "host", "left").select(
        "page_id", "host", "path", "hit.rule", verdict.alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
