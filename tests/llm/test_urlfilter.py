import random

import pytest
from pyspark.sql import functions as F

from tamarack.llm import urlfilter
from tamarack.llm.scratch import Scratch


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")


def rank(edges, seeds, damping=0.85, rounds=400):
    """Power iteration until nothing moves; what no link carries goes back to the seeds."""
    out = {}
    for (s, _), n in edges.items():
        out[s] = out.get(s, 0) + n
    mass, score = sum(seeds.values()), dict(seeds)
    for _ in range(rounds):
        stays = sum(v for h, v in score.items() if h not in out)
        new = {h: (1 - damping) * v + damping * stays * v / mass for h, v in seeds.items()}
        for (s, d), n in edges.items():
            new[d] = new.get(d, 0) + damping * score.get(s, 0) * n / out[s]
        score = new
    return score


def edge_table(spark, forward):
    rows = [(k, *((s, d) if k == "trust" else (d, s)), n) for (s, d), n in forward.items() for k in ("trust", "distrust")]
    return spark.createDataFrame(rows, "kind string, src string, dst string, links long")


def test_scores_are_personalised_pageranks(spark):
    draw = random.Random(3)
    forward = {(f"h{draw.randrange(12)}", f"h{draw.randrange(16)}"): draw.randint(1, 4) for _ in range(30)}
    forward = {e: n for e, n in forward.items() if e[0] != e[1]}
    seeds = {"trust": {"h1": 0.25, "h2": 0.25, "alone": 0.1}, "distrust": {"h15": 0.4}}
    table = spark.createDataFrame([(k, h, v) for k, given in seeds.items() for h, v in given.items()], "kind string, host string, seed double")
    got = urlfilter.propagated(edge_table(spark, forward), table, urlfilter.Propagation(), Scratch(spark, "test")).collect()
    for kind, given in seeds.items():
        edges = forward if kind == "trust" else {(d, s): n for (s, d), n in forward.items()}
        expected = {h: v for h, v in rank(edges, given).items() if v}
        found = {r.host: r.score for r in got if r.kind == kind and r.score}
        assert found == pytest.approx(expected, abs=1e-8)
        assert sum(found.values()) == pytest.approx(sum(given.values()), abs=1e-8)


def test_long_chains_lead_to_their_end(spark):
    """Each of 41 hosts links to the next, the last to a blocked page: distrust reaches all of them."""
    rows = [(f"http://h{i}.net/", f'<a href="http://h{i + 1}.net/">x</a>') for i in range(40)]
    rows += [("http://h40.net/", '<a href="http://bad.com/de/">x</a>'), ("http://bad.com/de/", ""), ("http://other.net/", '<a href="http://h3.org/">x</a>')]
    got = {r._host: r._verdict for r in urlfilter.filtered_urls(pages(spark, rows)).collect()}
    assert got == {f"h{i}.net": "block" for i in range(41)} | {"bad.com": "block", "other.net": "allow"}


def test_propagation_over_links(spark):
    link = lambda *urls: "".join(f'<a class="x" HREF = "{u}">t</a>' for u in urls)
    rows = [
        ("https://good.org/a", link("https://friend.net/x", "//friend.net/y", "/own", "#top", "mailto:a@b.c")),
        ("http://www.shop.com/de/1", link("http://victim.net/")),
        ("http://Farm.net/1?x=://y", link("http://www.shop.com/de/1", "http://www.shop.com/de/2")),
        ("http://farm.net/2", None), ("http://friend.net/z", ""), ("http://victim.net/q", "<a>"), ("http://far.net/", link("http://farm.net/2")),
        ("http://www.shop.com/fr/2", ""), ("http://www.shop.com/en/2", ""), (None, link("http://a.b/")), ("no url", ""), ("http://sub.example.org/en/12", ""), ("http://example.org", ""),
    ]
    df = pages(spark, rows).withColumn("_rule", F.lit("clash")).withColumn("host", F.lit("clash"))
    got = {r.page_id: (r._host, r._path, r._rule, r._verdict) for r in urlfilter.filtered_urls(df).collect()}
    forward = {("good.org", "friend.net"): 2, ("www.shop.com", "victim.net"): 1, ("farm.net", "www.shop.com"): 2, ("far.net", "farm.net"): 1}
    backward = {(d, s): n for (s, d), n in forward.items()}
    allowed, blocked, n = {"good.org": 1, "www.shop.com": 1}, {"www.shop.com": 1, "sub.example.org": 1}, 4
    trust = rank(forward, {h: v / n for h, v in allowed.items()})
    distrust = rank(backward, {h: v / n for h, v in blocked.items()})
    for host in ("friend.net", "victim.net", "farm.net", "far.net", "www.shop.com"):
        bad = distrust.get(host, 0) > trust.get(host, 0) * (1 + 1e-9)
        verdicts = {v for h, _, rule, v in got.values() if h == host and rule is None}
        assert verdicts == {"block" if bad else "allow"}, host
    assert got[2][0] == "farm.net" and got[2][3] == got[6][3] == "block"  # they lead to a blocked page
    assert got[4][3] == got[5][3] == "allow"
    assert got[0] == ("good.org", "/a", "org/", "allow") and got[1][2:] == ("com/de/", "block") and got[7][2:] == ("com/fr/", "allow")
    assert got[9] == got[10] == ("", "", None, "allow")
    assert got[11] == ("sub.example.org", "/en/12", "example.org/en/1", "block")
    assert got[12] == ("example.org", "", None, "allow")


def test_no_pages_and_no_links(spark):
    assert urlfilter.filtered_urls(pages(spark, [])).count() == 0
    got = urlfilter.filtered_urls(pages(spark, [("http://a.net/", None), ("http://a.net/", None), ("http://a.net/" + "x" * 100_000, "")])).collect()
    assert [r._verdict for r in got] == ["allow"] * 3
