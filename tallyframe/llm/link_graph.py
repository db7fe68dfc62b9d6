"""URL filter: rules by host and path first, then trust and distrust that travel along the links between hosts.

Trust starts at hosts with pages that a rule allows and follows links; distrust starts at hosts that a rule blocks as a
whole and follows links backwards, to those who link there.  Both are personalised PageRank over host edges, computed
with joins and aggregations; a host is blocked when its distrust outweighs its trust.  No Python runs on any row.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.store import written

#: Share of a host's rank that its links pass on.
DAMPING = 0.85
#: Change of every host's rank, as a share of it, below which the rounds end.
SETTLED = 1e-6
#: Share of distrust in a host's trust and distrust above which it is blocked.
DISTRUST_SHARE = 0.5
# An attribute that names another host, with or without quotes and scheme.
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, action), or null.

    ``rules`` are (action, "host/path"): a rule fits its host and all subdomains if the path begins with its own.
    They become part of the plan, so this is for rule lists of up to some hundreds.
    """
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``a``, ``b``, ``w``: links from pages of host ``a`` to other hosts ``b``, counted."""
    source = host_and_path(F.col(f"`{url}`"))[0]
    links = F.explode(F.regexp_extract_all(F.col(f"`{html}`"), F.lit(_LINK), F.lit(1)))
    rows = pages.select(source.alias("a"), links.alias("link"))
    target = host_and_path(F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("x:"), "link")).otherwise(F.col("link")))[0]
    rows = rows.select("a", target.alias("b")).where("a <> '' and b <> '' and a <> b")
    return rows.groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("w"))


def ranks(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, settled: float = SETTLED) -> DataFrame:
    """``host``, ``rank``: personalised PageRank along ``edges`` (a, b, w) from ``seeds`` (host, weight > 0).

    Ranks add up to 1; what hosts without links hold goes back to the seeds.  Hosts out of reach have no row, and
    without seeds there are none.  Rounds go on until no host is newly reached and no rank changes by more than the share
    ``settled`` of it, or end after ``rounds``.  Each is written, so a lost executor costs no more than one.
    """
    total = seeds.agg(F.sum("weight")).first()[0]
    if not total:
        return seeds.select("host", F.col("weight").alias("rank")).limit(0)
    start = written(seeds.groupBy("host").agg((F.sum("weight") / total).alias("rank")), "rank")
    out = edges.groupBy("a").agg(F.sum("w").alias("out"))
    shares = written(edges.join(out, "a").select("a", "b", (F.col("w") / F.col("out")).alias("share")), "edges")
    linking = out.select(F.col("a").alias("host"), F.lit(True).alias("links"))
    now = start
    for _ in count() if rounds is None else range(rounds):
        passed = now.join(shares, now.host == shares.a).groupBy("b").agg(F.sum(F.col("rank") * F.col("share")).alias("moved"))
        held = now.join(linking, "host", "left").where("links is null").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        back = start.select("host", (F.col("rank") * (1 - damping + damping * held)).alias("rank"))
        after = back.unionByName(passed.select(F.col("b").alias("host"), (F.col("moved") * damping).alias("rank")))
        after = written(after.groupBy("host").agg(F.sum("rank").alias("rank")), "rank")
        # Verdicts compare ranks of one host, so small ranks have to settle as well; a new host's changes by all of it.
        both = now.select("host", (-F.col("rank")).alias("change"), F.lit(0.0).alias("rank"))
        both = both.unionByName(after.select("host", F.col("rank").alias("change"), "rank"))
        both = both.groupBy("host").agg(F.abs(F.sum("change")).alias("change"), F.sum("rank").alias("rank"))
        moving = both.where(F.col("change") > F.lit(settled) * F.col("rank")).limit(1).count()
        now = after
        if not moving:
            break
    return now


def judged(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    url: str = "url",
    html: str = "html",
    distrust_share: float = DISTRUST_SHARE,
    **walk,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``trust``, ``distrust`` and ``verdict`` ('allow' or 'block').

    A fitting rule decides; otherwise the host's ranks do, and a host that neither reaches is allowed.  Rules for a part
    of a host's paths give it trust where they allow, but only rules for whole hosts give distrust.  Null urls and
    those without a host have no links and are allowed; null html has no links.  Columns of these names are replaced,
    all others and repeated rows pass through.
    """
    added = ["host", "path", "rule", "trust", "distrust", "verdict"]
    host, path = host_and_path(F.col(f"`{url}`"))
    named = pages.select(host.alias("host"), path.alias("path"))
    named = named.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    whole = F.endswith("found.rule", F.lit("/")) & (F.length(F.regexp_replace("found.rule", "[^/]", "")) == 1)
    seeds = named.where("host <> ''").groupBy("host").agg(
        F.avg(F.coalesce((F.col("found.action") == "allow").cast("double"), F.lit(0.0))).alias("allowed"),
        F.avg(F.coalesce(((F.col("found.action") == "block") & whole).cast("double"), F.lit(0.0))).alias("blocked"),
    )
    seeds = written(seeds, "seeds")
    edges = written(host_edges(pages, url, html), "edges")
    trust = ranks(edges, seeds.where("allowed > 0").select("host", F.col("allowed").alias("weight")), **walk)
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")
    distrust = ranks(turned, seeds.where("blocked > 0").select("host", F.col("blocked").alias("weight")), **walk)
    hosts = trust.select("host", F.col("rank").alias("trust"), F.lit(0.0).alias("distrust")).unionByName(
        distrust.select("host", F.lit(0.0).alias("trust"), F.col("rank").alias("distrust"))
    )
    hosts = hosts.groupBy("host").agg(F.sum("trust").alias("__trust"), F.sum("distrust").alias("__distrust"))
    hosts = written(hosts.withColumnRenamed("host", "__host"), "hosts")
    kept = [c for c in pages.columns if c not in added or c in (url, html)]
    out = pages.select(*(F.col(f"`{c}`") for c in kept), host.alias("__page_host"), path.alias("__page_path"))
    out = out.withColumn("__found", rule_of(F.col("__page_host"), F.col("__page_path"), rules))
    out = out.join(hosts, F.col("__page_host") == F.col("__host"), "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("__trust", "__distrust"))
    by_links = F.when(distrust > F.lit(distrust_share) * (trust + distrust), "block").otherwise("allow")
    new = {
        "host": F.col("__page_host"),
        "path": F.col("__page_path"),
        "rule": F.col("__found.rule"),
        "trust": trust,
        "distrust": distrust,
        "verdict": F.coalesce(F.col("__found.action"), by_links),
    }
    return out.select(*(F.col(f"`{c}`") for c in kept if c not in new), *(c.alias(n) for n, c in new.items()))
