"""URL rules, and trust and distrust spread over a host graph.

A page's verdict is that of the longest rule that fits its host and path. The
other pages follow their host: personalised PageRank carries trust from the
hosts with allowed pages along the links, and distrust from the hosts with
blocked pages against the links; a host with more distrust than THRESHOLD
times its trust is blocked, any other allowed. Host edges are the links to
absolute addresses in the pages, and, both ways, those between a host and
its parent domain, over which hosts without links to each other are related
(a top-level domain is no parent: it would join hosts that have nothing in common).

Ranks are whole numbers that start as a mass over the seeds, in proportion to
their number, and each share is rounded down before it is added, so results do not
depend on the order of addition. Rounds go on until no more than TOLERANCE of
the mass can still move - each passes on DAMPING of what the last one moved, which
gives ROUNDS - and beyond that for as long as they reach further hosts; ranks
that a round leaves as they are end them at once, as all further rounds would.

Null or very long urls and pages, and repeated rows, are judged like any other;
columns of any name stay inside ``doc``; an empty table gives none. DataFrame
functions only."""

from __future__ import annotations

import string
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlake.llm.common import stage

#: Rules of the registered query: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING, THRESHOLD, TOLERANCE = 0.85, 1.0, 0.001
#: Units of mass for each seed page, of which at least as many are taken to be; rounds in a job, and all.
UNIT, SEEDS, STEP = 10**6, 10**6, 4
ROUNDS = STEP * ceil(log(TOLERANCE) / log(DAMPING) / STEP)
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


def _lower(x: Column) -> Column:
    return F.translate(x, string.ascii_uppercase, string.ascii_lowercase)


def host(url: Column) -> Column:
    """Behind the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in ordered]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def _parents(host: Column) -> Column:
    """A host and its parent domains of two labels or more, as (child, parent) pairs."""
    labels = F.split(host, r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.transform(F.slice(names, 1, F.greatest(F.size(names) - 2, F.lit(0))), lambda x, i: F.struct(x.alias("child"), F.get(names, i + 1).alias("parent")))


def edges(pages: DataFrame, domains: bool = True) -> DataFrame:
    """(src, dst, weight) between hosts, from ``pages`` (host, html): links counted
    per pair of hosts, links within a host left out, and with ``domains`` one
    edge each way between a host and its parent domain."""
    links = pages.where("host <> ''").select("host", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("to"))
    found = links.select(F.col("host").alias("src"), _lower(F.col("to")).alias("dst")).where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))
    if not domains:
        return found
    names = pages.where("host <> ''").select("host").distinct().union(found.select("dst")).distinct()
    tree = names.select(F.inline(_parents(F.col("host")))).distinct()
    both = tree.select(F.col("child").alias("src"), F.col("parent").alias("dst")).union(tree.select(F.col("parent").alias("src"), F.col("child").alias("dst")))
    return found.unionByName(both.withColumn("weight", F.lit(1).cast("long"))).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """host, trust, distrust (long) once the rounds end. ``seeds``: host, trusted,
    blocked (counts). Trust follows the links, distrust runs against them;
    what a host without outgoing edges would pass on is lost."""
    ways = links.select(F.lit(0).alias("kind"), "src", "dst", "weight").union(links.select(F.lit(1), F.col("dst"), F.col("src"), F.col("weight")))
    out = ways.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    steps = stage(ways.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("all")).alias("share")), "host-edges")
    given = stage(seeds.select(F.lit(0).alias("kind"), "host", F.col("trusted").alias("n")).union(seeds.select(F.lit(1), F.col("host"), F.col("blocked"))).where("n > 0"), "seeds")
    totals = given.groupBy("kind").agg(F.sum("n").alias("all"))
    mass = UNIT * max(SEEDS, given.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    start = stage(given.join(totals, "kind").select("kind", "host", F.floor(F.lit(float(mass)) * (F.col("n") / F.col("all"))).alias("rank")), "start")
    base = start.select("kind", "host", F.floor((1 - DAMPING) * F.col("rank")).alias("rank"))

    def passed(rank: DataFrame) -> DataFrame:
        moved = rank.join(steps, ["kind", "host"]).select("kind", F.col("dst").alias("host"), F.floor(DAMPING * (F.col("rank") * F.col("share"))).alias("rank"))
        return moved.union(base).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))

    def state(rank: DataFrame):
        """(hosts reached, the same for equal ranks)."""
        return tuple(rank.agg(F.count(F.when(F.col("rank") > 0, 1)), F.sum(F.xxhash64("kind", "host", "rank").cast("decimal(38,0)"))).first())

    rank, seen, rounds = start, None, 0
    while True:
        for _ in range(STEP - 1):
            rank = passed(rank)
        rank, rounds = stage(passed(rank), "ranks"), rounds + STEP
        now = state(rank)
        if now == seen or (rounds >= ROUNDS and seen and now[0] <= seen[0]):
            break
        seen = now
    return rank.groupBy("host").agg(F.sum(F.when(F.col("kind") == 0, F.col("rank")).otherwise(0)).alias("trust"),
                                    F.sum(F.when(F.col("kind") == 1, F.col("rank")).otherwise(0)).alias("distrust"))


def judge(pages: DataFrame, rules=RULES, url: str = "url", html: str = "html", domains: bool = True) -> DataFrame:
    """``doc`` (the whole row), host, path, rule, verdict, trust, distrust.

    A url that is null or has no :// has neither host nor path: no rule fits
    and it is allowed, as is every host that neither trust nor distrust
    reaches. Null html has no links; repeated rows count and are judged each."""
    rows = pages.select(F.struct("*").alias("doc"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), F.col(html).alias("html"))
    rows = rows.withColumn("__rule", rule(F.col("host"), F.col("path"), rules))
    counted = rows.where("host <> ''").groupBy("host").agg(*[F.count(F.when(F.col("__rule.verdict") == v, 1)).alias(n) for v, n in (("allow", "trusted"), ("block", "blocked"))])
    known = propagate(edges(rows.select("host", "html"), domains), counted.where("trusted + blocked > 0"))
    own = F.when(F.coalesce("distrust", F.lit(0)) > THRESHOLD * F.coalesce("trust", F.lit(0)), "block").otherwise("allow")
    return rows.drop("html").join(known, "host", "left").select(
        "doc", "host", "path", F.col("__rule.rule").alias("rule"), F.coalesce("__rule.verdict", own).alias("verdict"), "trust", "distrust")
