"""URL verdicts by rules, and for the rest by trust and distrust over the link graph.

A rule names a host and a path; it fits that host and its subdomains where the
url's path starts with the rule's, and the longest fitting rule decides (by host,
then by path). Urls without a rule are judged by their host. Trust is a
personalised PageRank from hosts that rules allow, along the links. Distrust is one
from hosts that rules block, against the links: who links to blocked hosts is
suspect. Links count once for each pair of hosts, weighted by the number of pages that
hold them. What a seed starts with is not held for or against it, as a rule may speak of a
part of a host: a host is blocked if the distrust that reaches it over links is
``least`` times an even share or more, and exceeds the trust that does. All other hosts
are allowed, among them those that no link joins to a seed.

Host and path of a null url, or of one without ``://``, are empty; no rule fits an
empty host. Null html has no links. Every row gets a verdict; repeated rows get
equal ones, and their links count each time. An empty table gives an empty result.
Columns other than id, url and html are not read.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import written

# Group 1 is the target of a link to another host, of either quoting.
LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(value: Column) -> Column:
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct of the rule's text and whether it allows; null where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r.host), -len(r.path), r.text))
    found = None
    for rule in ordered:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.allow).alias("allow"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,allow:boolean>")


def host_links(pages: DataFrame) -> DataFrame:
    """``src, dst, n`` between different hosts, from ``host`` and ``html``."""
    targets = F.explode(F.regexp_extract_all("html", F.lit(LINK), 1))
    url = F.when(F.col("target").startswith("//"), F.concat(F.lit("http:"), "target")).otherwise(F.col("target"))
    return (pages.where(F.col("host") != "").select(F.col("host").alias("src"), targets.alias("target"))
            .select("src", split_url(url)[0].alias("dst"))
            .where((F.col("dst") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count("*").alias("n")))


def propagate(links: DataFrame, seeds: DataFrame, damping: float,
              tolerance: float, max_rounds: int) -> DataFrame:
    """``host, trust, distrust`` from ``seeds`` (``host, trusted, blocked``: shares that add to one).

    Rounds go on until what all later ones can still change, summed over the hosts, is
    at most ``tolerance``; more than ``max_rounds`` are an error. One join and one aggregate a round carry both: trust along each link
    and distrust back along it. Both sides of the join are written tables or plain
    shuffles, and a hub's many links are summed before they are shuffled.
    """
    out = links.groupBy("src").agg(F.sum("n").alias("all"))
    into = links.groupBy("dst").agg(F.sum("n").alias("all"))
    forward = links.join(out, "src").select(
        F.col("src").alias("at"), F.col("dst").alias("host"),
        (F.col("n") / F.col("all")).alias("trust_share"), F.lit(0.0).alias("distrust_share"))
    back = links.join(into, "dst").select(
        F.col("dst").alias("at"), F.col("src").alias("host"),
        F.lit(0.0).alias("trust_share"), (F.col("n") / F.col("all")).alias("distrust_share"))
    flows = written(forward.unionByName(back), "host-flows")
    ranks = seeds.select("host", F.col("trusted").alias("trust"), F.col("blocked").alias("distrust"))
    base = ranks.select("host", ((1 - damping) * F.col("trust")).alias("trust"),
                        ((1 - damping) * F.col("distrust")).alias("distrust"))
    for _ in range(max_rounds):
        moved = flows.join(ranks.withColumnRenamed("host", "at"), "at").select(
            "host", (damping * F.col("trust") * F.col("trust_share")).alias("trust"),
            (damping * F.col("distrust") * F.col("distrust_share")).alias("distrust"))
        none = [F.lit(0.0).alias("old_trust"), F.lit(0.0).alias("old_distrust")]
        old = ranks.select("host", F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"),
                           F.col("trust").alias("old_trust"), F.col("distrust").alias("old_distrust"))
        now = written(moved.unionByName(base).select("*", *none).unionByName(old).groupBy("host").agg(
            *[F.sum(c).alias(c) for c in ("trust", "distrust", "old_trust", "old_distrust")]), "host-ranks")
        change = now.agg(F.sum(F.abs(F.col("trust") - F.col("old_trust"))
                               + F.abs(F.col("distrust") - F.col("old_distrust")))).first()[0] or 0.0
        ranks = now.select("host", "trust", "distrust")
        if change * damping / (1 - damping) <= tolerance:
            return ranks
    raise RuntimeError(f"trust did not settle in {max_rounds} rounds")


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", max_rounds: int = 1000, damping: float = 0.85,
          least: float = 0.1) -> DataFrame:
    """``id, host, path, rule, verdict, trust, distrust`` of every page."""
    host, path = split_url(F.col(url_col))
    split = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"),
                         F.col(html_col).alias("html"))
    split = split.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    links = written(host_links(split), "host-links")
    hosts = written(split.groupBy("host").agg(
        F.sum(F.when(F.col("fit.allow"), 1).otherwise(0)).alias("allowed"),
        F.sum(F.when(~F.col("fit.allow"), 1).otherwise(0)).alias("blocked")), "hosts")
    sums = hosts.agg(F.sum(F.when(F.col("allowed") > F.col("blocked"), 1)).alias("good"),
                     F.sum(F.when(F.col("blocked") > F.col("allowed"), 1)).alias("bad"),
                     F.count("*").alias("all")).first()
    good, bad, all_hosts = (x or 0 for x in sums)
    seeds = written(hosts.where("allowed <> blocked").select(
        "host", F.when(F.col("allowed") > F.col("blocked"), 1.0 / max(good, 1)).otherwise(0.0).alias("trusted"),
        F.when(F.col("blocked") > F.col("allowed"), 1.0 / max(bad, 1)).otherwise(0.0).alias("blocked")),
        "host-seeds")
    settled = propagate(links, seeds, damping, 1e-3 * least / max(all_hosts, 1), max_rounds)
    ranks = (settled.join(seeds, "host", "left")
             .select("host", *[(F.col(r) - (1 - damping) * F.coalesce(F.col(s), F.lit(0.0))).alias(r)
                               for r, s in (("trust", "trusted"), ("distrust", "blocked"))]))
    bad_host = (F.col("distrust") >= least / max(all_hosts, 1)) & (F.col("distrust") > F.col("trust"))
    known = written(ranks.withColumn("blocked", bad_host), "host-verdicts")
    rest = split.drop("html").join(known, "host", "left")
    verdict = F.when(F.coalesce("fit.allow", ~F.coalesce("blocked", F.lit(False))), "allow").otherwise("block")
    return rest.select("id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"),
                       F.coalesce("trust", F.lit(0.0)).alias("trust"),
                       F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
