"""Page filter by rules and by trust that spreads along links between hosts.

Rules name a host and the beginning of a path; they hold for the host and its subdomains, and the longest that fits
decides. Where none fits, the host decides: pages that rules allow give their host trust, pages that rules block give
it distrust. Trust flows forward along links (a trusted host vouches for what it links to), distrust flows backward
(who links to a blocked host is doubtful), both as personalised PageRank. A host whose distrust is above ``ratio``
times its trust is blocked; without distrust it is allowed.

Scores are whole numbers, so no order of summing changes them. They only grow from round to round and each round passes
on less than it got, so passing ends by itself, and it goes on until nothing changes: no chain of hosts is cut. Links are counted per pair of hosts before anything is
joined; a host with very many links is one row per neighbour, and its rank is one row.

A null url, or one without ``://``, has an empty host and path; an empty host has no links, and no rule fits it.
Self-links are ignored. Equal rows are judged alike and stay apart. Null HTML has no links. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import drop_staged, staged

# Share of a rank that is passed on, below 1, and rounds of passing between two written tables.
DAMPING = 0.85
ROUNDS_A_STAGE = 4
# A page's trust or distrust in whole units.
UNIT = 1_000_000_000
# Absolute links in HTML: the host after the scheme, or after a bare //.
_LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    after = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def deciding_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host/path) that fits; at equal length, blocking goes first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        name, begin = text.split("/", 1)
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + begin)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """Links between different hosts: src, dst, links. ``pages``: host, html."""
    found = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
    found = found.select("src", F.translate("dst", _UPPER, _LOWER).alias("dst")).where("src <> '' and src <> dst")
    return found.groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = DAMPING) -> DataFrame:
    """Trust and distrust of each host that has any: host, trust, distrust.

    ``seeds``: host, trust, distrust in whole units. A host without links keeps nothing to pass on.
    Equal sums of two written tables mean equal ranks, since no rank ever falls.
    """
    if not 0 <= damping < 1:
        raise ValueError(f"passing never ends with damping {damping}")
    out = links.groupBy("src").agg(F.sum("links").alias("all"))
    into = links.groupBy("dst").agg(F.sum("links").alias("all"))
    forward = links.join(out, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"), F.lit(True).alias("good"), "links", "all")
    backward = links.join(into, "dst").select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(False).alias("good"), "links", "all")
    edges = staged(forward.unionByName(backward), "host-links")
    seeds = staged(seeds, "seeds")
    if edges.isEmpty():
        return seeds
    share = lambda rank, good: F.when(
        F.col("good") == good, F.floor(F.col(rank) * F.lit(damping) * F.col("links") / F.col("all")).cast("bigint")
    ).otherwise(F.lit(0).cast("bigint"))
    total = lambda ranks: tuple(ranks.agg(*(F.sum(F.col(c).cast("decimal(38,0)")) for c in ("trust", "distrust"))).first())
    ranks, mark = seeds, total(seeds)
    while True:
        later = ranks
        for _ in range(ROUNDS_A_STAGE):
            passed = edges.join(later, "host").select(
                F.col("to").alias("host"), share("trust", True).alias("trust"), share("distrust", False).alias("distrust")
            )
            later = (
                seeds.unionByName(passed)
                .groupBy("host")
                .agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
            )
        later = staged(later, "ranks")
        if ranks is not seeds:
            drop_staged(ranks)
        now = total(later)
        if now == mark:
            return later
        ranks, mark = later, now


def judged_pages(pages: DataFrame, rules: list[tuple[str, str]], ratio: float = 1.0) -> DataFrame:
    """``pages`` (page_id, url, html) as page_id, host, path, rule, verdict, trust and distrust of the host."""
    host, path = host_and_path(F.col("url"))
    named = pages.select("page_id", "url", "html").withColumn("host", host).withColumn("path", path)
    rule, verdict = deciding_rule(F.col("host"), F.col("path"), rules)
    ruled = named.withColumn("rule", rule).withColumn("said", verdict)
    counts = ruled.where("said is not null").groupBy("host").agg(
        (F.count_if(F.col("said") == "allow") * UNIT).alias("trust"),
        (F.count_if(F.col("said") == "block") * UNIT).alias("distrust"),
    )
    ranks = spread(counts, host_links(ruled.select("host", "html")))
    doubtful = F.coalesce(F.col("distrust") > ratio * F.col("trust"), F.lit(False))
    return ruled.drop("html").join(ranks, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("said", F.when(doubtful, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"),
        F.coalesce("distrust", F.lit(0)).alias("distrust"),
    )
