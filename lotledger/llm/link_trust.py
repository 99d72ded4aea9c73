"""URL verdicts: rules first, then trust and distrust spread over links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import lower_ascii, settled

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Host of every absolute or scheme-relative link.
LINK_HOST = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/"'\s>?#]+)"""


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules``: for every host of ``hosts`` the rules on it and its parent domains."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")
    )
    above = hosts.select("host", F.explode(suffixes).alias("rule_host"))
    return above.join(rules, "rule_host").groupBy("host").agg(
        F.array_sort(F.collect_set(F.struct("rule_host", "rule_path", "rule_verdict"))).alias("rules")
    )


def best_rule(rules: Column, path: Column) -> Column:
    """The longest rule whose path begins ``path``; of equal length the longer host, then block."""
    fits = F.filter(rules, lambda r: F.startswith(path, r["rule_path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(
        (F.length(r["rule_host"]) + F.length(r["rule_path"])).alias("size"),
        F.length(r["rule_host"]).alias("host_size"),
        r["rule_verdict"].alias("verdict"),
        F.concat(r["rule_host"], r["rule_path"]).alias("rule"),
    )))


def host_edges(pages: DataFrame) -> DataFrame:
    """``source, target, links``: links from pages of one host to another host."""
    found = pages.select(
        url_host(F.col("url")).alias("source"),
        F.explode(F.regexp_extract_all("html", F.lit(LINK_HOST), F.lit(1))).alias("target"),
    ).select("source", lower_ascii(F.col("target")).alias("target"))
    return found.filter("source <> '' and source <> target").groupBy("source", "target").agg(
        F.count("*").alias("links")
    )


def spread(edges: DataFrame, seeds: DataFrame, damping: float, rounds: int) -> DataFrame:
    """``host, trust, distrust`` after ``rounds`` rounds of personalised PageRank.

    ``seeds``: host, trust, distrust in [0, 1]. In each round a host keeps its seed value
    and gets ``damping`` times the shares of the hosts linking to it (trust), or of the
    hosts it links to (distrust, the reversed direction). A share is by number of links.
    Values are the PageRank times 1 / (1 - damping): a host that nobody touches scores its
    own seed.
    """
    out = edges.groupBy("source").agg(F.sum("links").alias("n"))
    back = edges.groupBy("target").agg(F.sum("links").alias("n"))
    share = F.lit(damping) * F.col("links") / F.col("n")
    moves = settled(
        edges.join(out, "source").select(
            F.lit("trust").alias("kind"), F.col("source").alias("from"), F.col("target").alias("to"), share.alias("share"))
        .unionAll(edges.join(back, "target").select(
            F.lit("distrust").alias("kind"), F.col("target").alias("from"), F.col("source").alias("to"), share.alias("share"))),
        "host-moves",
    )
    base = settled(
        seeds.select("host", F.explode(F.create_map(
            F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "score")),
        "host-seeds",
    )
    now = base
    for i in range(rounds):
        given = moves.join(
            now.select("kind", F.col("host").alias("from"), "score"), ["kind", "from"]
        ).groupBy("kind", F.col("to").alias("host")).agg(F.sum(F.col("score") * F.col("share")).alias("score"))
        now = base.unionByName(given).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if i % 4 == 3:
            now = settled(now, "host-scores")
    return now.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
    )


def judge_pages(
    pages: DataFrame, rules: DataFrame, damping: float = 0.85, rounds: int = 16,
    threshold: float = 0.5,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``pages``: page_id, url, html. ``rules``: rule_host, rule_path, rule_verdict (allow or
    block); a rule fits its host and all subdomains where the path begins with the rule's,
    the longest wins. Where no rule fits, the host decides: seeds are the shares of a
    host's own pages that rules allow (trust) or block (distrust), spread over links;
    ``distrust - trust >= threshold`` blocks, anything else, also an unknown host, allows.
    With 0.5, a host is blocked alone by its own pages when rules block half of them.

    A null url, or one without ``://``, has an empty host and path, no rule, and is allowed.
    Null html has no links. Repeated rows are judged alike and count as often as they
    stand. Empty pages give no rows. Other columns are not read. Hosts are aggregated
    before they meet; a host with a third of all pages is one row of a partial
    aggregation, and joined by the adaptive skew join.
    """
    named = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    known = host_rules(named.select("host").distinct().filter("host <> ''"), rules)
    ruled = settled(
        named.join(known, "host", "left").select(
            "page_id", "host", "path", best_rule(F.col("rules"), F.col("path")).alias("best")
        ).select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled")),
        "ruled-pages",
    )
    is_ = lambda v: F.avg(F.when(F.col("ruled") == v, 1.0).otherwise(0.0))
    seeds = ruled.filter("host <> ''").groupBy("host").agg(is_("allow").alias("trust"), is_("block").alias("distrust"))
    hosts = spread(host_edges(pages), seeds, damping, rounds).select(
        "host", F.when(F.col("distrust") - F.col("trust") >= threshold, "block").otherwise("allow").alias("by_host")
    )
    return ruled.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "by_host", F.lit("allow")).alias("verdict")
    )
