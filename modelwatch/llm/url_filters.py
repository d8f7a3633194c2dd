"""URL verdicts: rules on host and path first, else trust and distrust propagated over links between hosts."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwatch.llm.common import pick, stage_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """``place`` is a host and a path in one, like ``net/es/``; the rule fits the host and all its subdomains."""

    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.place.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


#: The rules of the registered query.
RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(place, verdict) of the longest fitting rule, or nulls; of equally long ones the first in alphabetical order."""
    ordered = sorted(rules, key=lambda r: (-len(r.place), r.place))
    place = verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = rule.fits(host, path)
        place = F.when(fits, F.lit(rule.place)).otherwise(place)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return place, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): pages of ``src`` that link to ``dst``, another host; ``pages`` has host and html.

    Only links that name a host count: a relative link stays on its own host, and a host's word about itself is none.
    """
    link = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/"'?#\s>]+)"""
    found = pages.where("host <> '' AND html IS NOT NULL").select(
        F.col("host").alias("src"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(link), 1))).alias("dst")
    )
    found = found.withColumn("dst", F.translate("dst", UPPER, LOWER)).where("src <> dst")
    return found.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def personalised_rank(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(host, rank): personalised PageRank over ``edges(src, dst, weight)`` from ``seeds(host, weight)``.

    Ranks sum to 1 (no seeds: no rows). The mass of hosts without links goes back to the seeds. Rounds stop when all
    ranks together change by ``tolerance`` or less; each is written to the shared folder. A round changes them by at most
    ``damping`` times the change before, so there are at most 91 with the given values; hosts more links away from all
    seeds have no row, and would have less than ``tolerance``.
    """
    total = seeds.agg(F.sum("weight")).first()[0]
    if not total:
        return seeds.select("host", F.lit(0.0).alias("rank")).limit(0)
    base = stage_table(seeds.select("host", (F.col("weight") / total).alias("base")), "rank-seeds")
    out = edges.groupBy("src").agg(F.sum("weight").alias("all"))
    step = stage_table(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("all")).alias("share")), "rank-edges")
    rank = base.select("host", F.col("base").alias("rank"))
    for _ in range(1 + math.ceil(math.log(tolerance / 2) / math.log(damping))):
        sent = step.join(rank, step["src"] == rank["host"]).groupBy("dst").agg(F.sum(F.col("share") * F.col("rank")).alias("got"))
        moved = sent.select(F.col("dst").alias("host"), (F.col("got") * damping).alias("got"))
        arrived = moved.agg(F.sum("got")).first()[0] or 0.0
        own = base.select("host", (F.col("base") * (1.0 - arrived)).alias("got"))
        new = stage_table(moved.unionByName(own).groupBy("host").agg(F.sum("got").alias("new")), "rank-round")
        change = new.join(rank, "host", "full").agg(F.sum(F.abs(F.coalesce("new", F.lit(0.0)) - F.coalesce("rank", F.lit(0.0))))).first()[0]
        rank = new.select("host", F.col("new").alias("rank"))
        if (change or 0.0) <= tolerance:
            break
    return rank


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    ratio: float = 1.0,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's trust and distrust.

    Where a rule fits, it decides. Else the host does: trust is personalised PageRank along the links from hosts with
    allowed pages, distrust the same against the links from hosts with blocked pages (seed weight: their number); the
    host is blocked if its distrust is over ``ratio`` times its trust. A host that neither reaches is allowed.

    Null urls and urls without ``://`` have empty host and path, fit no rule and are allowed. A null html has no links.
    Repeated pages come back repeated, and count as often. An empty table gives no rows.
    """
    rows = pick(pages, page_id=page_id, url=url, html=html)
    place, verdict = rule_for(F.col("host"), F.col("path"), rules)
    known = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    told = known.select("page_id", "host", "path", place.alias("rule"), verdict.alias("told"))
    # One scan gives the hosts with their seeds, one the links.
    counts = stage_table(
        told.where("host <> ''").groupBy("host").agg(F.count_if(F.col("told") == "allow").alias("good"), F.count_if(F.col("told") == "block").alias("bad")), "url-hosts"
    )
    edges = stage_table(host_edges(known), "url-edges")
    trust = personalised_rank(edges, counts.where("good > 0").select("host", F.col("good").cast("double").alias("weight")))
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = personalised_rank(against, counts.where("bad > 0").select("host", F.col("bad").cast("double").alias("weight")))
    hosts = trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full")
    hosts = stage_table(hosts.fillna(0.0, ["trust", "distrust"]), "url-scores")
    scored = told.join(hosts, "host", "left").fillna(0.0, ["trust", "distrust"])
    blocked = F.when(F.col("distrust") > ratio * F.col("trust"), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("told", blocked).alias("verdict"), "trust", "distrust")
