"""URL filter: host rules first, then propagation over the link graph.

Trust flows along links from the hosts of allowed pages, distrust against them from the hosts of blocked pages, each
a personalised PageRank over host edges computed by Spark: what reaches a host without links to other hosts goes back to
the seeds, so each kind keeps its whole mass. Rounds go on until one brings no more than
``tolerance``, at most ``log(tolerance) / log(damping)`` of them, however long the chains of links. A page without a rule of its own is blocked
where its host's distrust exceeds its trust, and the tolerance.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
``#`` or the end. Rows: a null url, or one without ``://``, has an empty host and path, no rule and no links, and is
allowed; a null html has no links; repeated rows are rows of their own and their links count again; an empty table
gives an empty one; other columns are ignored.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.scratch import Scratch

SALTS = 16
#: Rounds whose tables are summed into one.
ROUNDS_PER_SUM = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


@dataclass(frozen=True)
class Propagation:
    damping: float = 0.85
    tolerance: float = 1e-9
    #: A host is blocked if its distrust exceeds ``ratio`` times its trust by more than ``margin``.
    ratio: float = 1.0
    margin: float = 1e-9

    def most_rounds(self) -> int:
        """Each round brings at most ``damping`` times what the last one brought."""
        return math.ceil(math.log(self.tolerance) / math.log(self.damping))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name())):  # the last that fits wins
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, F.lit(rule.name())).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def judged_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """The pages with ``_host``, ``_path``, ``_rule`` and ``_verdict`` (null without a rule), replacing columns of these names."""
    parts = pages.drop("_host", "_path", "_rule", "_verdict", "_salt", "_bad", "_bad_salt").select("*", host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path"))
    name, verdict = longest_rule(F.col("_host"), F.col("_path"), rules)
    return parts.select("*", name.alias("_rule"), verdict.alias("_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, links: how many links lead from pages of one ``_host`` to another host."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""), 1)
    found = pages.select(F.col("_host").alias("src"), F.explode(links).alias("link")).where("src <> ''")
    absolute = F.col("link").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://")
    target = F.when(absolute, host_of(F.col("link"))).when(F.col("link").startswith("//"), host_of(F.concat(F.lit("x:"), F.col("link")))).when(
        F.col("link").rlike(r"^(#|[A-Za-z][A-Za-z0-9+.-]*:)"), F.lit("")).otherwise(F.col("src"))
    return found.select("src", target.alias("dst")).where("dst <> '' and dst <> src").groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagated(edges: DataFrame, seeds: DataFrame, how: Propagation, scratch: Scratch) -> DataFrame:
    """kind, host, score: a personalised PageRank of each kind, over edges (kind, src, dst, links), from seeds (kind, host, seed).

    A round carries on what the last one brought, so chains without cycles end by themselves. Where links carry nothing
    on, mass goes back to the seeds; all that comes of it is in proportion to what came of the seeds, so the sums are
    scaled to the seeds' mass in the end. Each round is written: a lost executor costs a part of one round.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("links").alias("out_links"))
    steps = scratch.write(edges.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("links") / F.col("out_links") * how.damping).alias("part")), "steps")
    brought = scratch.write(seeds.select("kind", "host", F.col("seed").alias("score")), "round-0")
    sums = brought
    for i in range(1, how.most_rounds() + 1):
        flow = brought.join(steps, ["kind", "host"]).groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("score") * F.col("part")).alias("score"))
        brought = scratch.write(flow, f"round-{i}")
        if (brought.agg(F.sum("score")).first()[0] or 0.0) <= how.tolerance:
            break
        sums = sums.unionAll(brought)
        if i % ROUNDS_PER_SUM == 0:
            sums = scratch.write(sums.groupBy("kind", "host").agg(F.sum("score").alias("score")), f"sum-{i}")
    scores = scratch.write(sums.groupBy("kind", "host").agg(F.sum("score").alias("score")), "scores")
    masses = seeds.groupBy("kind").agg(F.sum("seed").alias("mass")).join(scores.groupBy("kind").agg(F.sum("score").alias("all")), "kind")
    return scores.join(F.broadcast(masses), "kind").select("kind", "host", (F.col("score") * F.col("mass") / F.col("all")).alias("score"))  # two rows


def host_scores(judged: DataFrame, how: Propagation = Propagation()) -> DataFrame:
    """host, trust, distrust of every host that either reaches, from pages with ``_host``, ``_rule``, ``_verdict``.

    Seeds are page counts over one total, so that as many allowed as blocked pages weigh the same.
    """
    scratch = Scratch(judged.sparkSession, "url-filter")
    forward = scratch.write(host_edges(judged), "edges")
    edges = forward.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionAll(forward.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    kind = F.when(F.col("_verdict") == "allow", "trust").otherwise("distrust").alias("kind")
    counts = scratch.write(judged.where("_rule is not null").groupBy(kind, F.col("_host").alias("host")).agg(F.count("*").alias("n")), "ruled")
    total = counts.agg(F.sum("n").alias("total"))  # one row
    seeds = scratch.write(counts.join(F.broadcast(total)).select("kind", "host", (F.col("n") / F.col("total")).alias("seed")), "seeds")
    scores = propagated(edges, seeds, how, scratch)
    scratch.drop("edges", "steps")
    of = lambda name: F.sum(F.when(F.col("kind") == name, F.col("score")).otherwise(0.0)).alias(name)
    return scores.groupBy("host").agg(of("trust"), of("distrust"))


def filtered_urls(pages: DataFrame, rules=RULES, how: Propagation = Propagation()) -> DataFrame:
    """The pages with ``_host``, ``_path``, ``_rule`` and ``_verdict``: allow or block.

    Blocked hosts meet their pages under ``SALTS`` keys each, so the pages of a hot host go to as many tasks.
    """
    judged = judged_urls(pages, rules)
    blocked = host_scores(judged, how).where((F.col("distrust") > F.col("trust") * how.ratio * (1 + how.margin)) & (F.col("distrust") > how.tolerance))
    salted = blocked.select(F.col("host").alias("_bad"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_bad_salt"))
    salt = F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int")
    met = judged.withColumn("_salt", salt).join(salted, (F.col("_host") == F.col("_bad")) & (F.col("_salt") == F.col("_bad_salt")), "left")
    verdict = F.coalesce("_verdict", F.when(F.col("_bad").isNotNull(), "block").otherwise("allow"))
    return met.withColumn("_verdict", verdict).drop("_bad", "_bad_salt", "_salt")
