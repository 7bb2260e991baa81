import random
import re

import pytest

from pricelens.llm import hosttrust as H

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
URLS = [None, "", "no host", "http://", "HTTP://A.Example.ORG/en/1x?q#f", "http://example.org/en/2", "http://example.org/es/",
        "http://notexample.org/es/1", "//x.org/", "https://org", "https://org/", "http://com/fr/#x", "http://x.com/fr", "http://y.com/de/1",
        "http://É.com/de/", "ftp://u@x.com:80/fr/a://b", "http://x.com?p=http://a.org/", "http://x.com#a/b", "a://b\nc.org/es/\n?"]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    best = (None, None)
    for verdict, rule in sorted(RULES, key=lambda r: len(r[1])):
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            best = (rule, verdict)
    return host, path, *best


def plain_ranks(edges, seeds, damping, rounds=400):
    total = sum(seeds.values())
    if not total:
        return {}
    hosts = {h for e in edges for h in e} | set(seeds)
    out = {h: sum(w for (s, _), w in edges.items() if s == h) for h in hosts}
    rank = {h: seeds.get(h, 0) / total for h in hosts}
    for _ in range(rounds):
        back = 1 - damping * sum(rank[h] for h in hosts if out[h])
        now = {h: back * seeds.get(h, 0) / total for h in hosts}
        for (s, d), w in edges.items():
            now[d] += damping * rank[s] * w / out[s]
        rank = now
    return rank


def test_rules(spark):
    df = spark.createDataFrame([(k, u, None, "x") for k, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in H.judge(df).collect()}
    for k, url in enumerate(URLS):
        host, path, rule, verdict = plain(url)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule), url
        assert got[k]["verdict"] == verdict if rule else got[k]["verdict"] in ("allow", "block")


@pytest.mark.parametrize("seed", range(2))
def test_ranks(spark, seed):
    r = random.Random(seed)
    hosts = [f"h{k}" for k in range(12)]
    edges = {(r.choice(hosts), r.choice(hosts)): float(r.randrange(1, 5)) for _ in range(25)}
    edges = {e: w for e, w in edges.items() if e[0] != e[1]}
    seeds = [(h, r.randrange(3), r.randrange(2) * seed) for h in [*hosts[:5], "alone"]]
    out = H.spread(spark.createDataFrame([(*e, w) for e, w in edges.items()], "src string, dst string, weight double"),
                   spark.createDataFrame(seeds, "host string, allow long, block long"), rounds=100, tolerance=1e-9).collect()
    trust = plain_ranks(edges, {h: a for h, a, _ in seeds}, H.DAMPING)
    against = plain_ranks({(d, s): w for (s, d), w in edges.items()}, {h: b for h, _, b in seeds}, H.DAMPING)
    for x in out:
        assert x["trust"] == pytest.approx(trust.get(x["host"], 0), abs=1e-6)
        assert x["distrust"] == pytest.approx(against.get(x["host"], 0), abs=1e-6)


def test_links_and_verdicts(spark):
    link = lambda *hs: "".join(f'<a href="http://{h}/x">' for h in hs)
    rows = [(1, "http://good.org/", link("LINKED.net", "good.org") + "<a HREF = '//b.net?x'><a href=/rel><a href=rel://no>"),
            (2, "http://linked.net/", None), (3, "http://bad.com/de/", ""), (4, "http://friend.net/", link("bad.com")),
            (5, "http://b.net/p", ""), (6, "http://far.net/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r["src"], r["dst"]) for r in H.edges(df).collect()}
    assert got == {("good.org", "linked.net"), ("good.org", "b.net"), ("friend.net", "bad.com")}
    verdict = {r["page_id"]: r["verdict"] for r in H.judge(df).collect()}
    assert verdict == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "allow"}
    family = H.edges(spark.createDataFrame([(1, "http://a.b.c/", "")], "page_id long, url string, html string")).collect()
    assert {(r["src"], r["dst"]) for r in family} == {("a.b.c", "b.c"), ("b.c", "a.b.c")}
    assert H.judge(df.limit(0)).collect() == []
