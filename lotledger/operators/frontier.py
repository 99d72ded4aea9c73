"""Seed and link frontier: which URLs belong to a dealer, in which order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions import text as X
from ..functions import urls as U
from .keyed import first_by
from .rows import settle


def valid_seeds(seeds: DataFrame) -> DataFrame:
    return seeds.filter(U.is_web_url(F.col("url")))


def unique_seeds(seeds: DataFrame) -> DataFrame:
    """The first row per exact URL."""
    return first_by(seeds, ["url"], [F.col("ord")])


def clean_seed_urls(lines: DataFrame) -> DataFrame:
    """Cleaned URLs of non-blank lines, distinct, with the first place of each."""
    return (
        lines.filter(F.trim("line") != "")
        .select("ord", U.clean_url(F.col("line")).alias("url"))
        .filter("url is not null")
        .groupBy("url").agg(F.min("ord").alias("ord"))
    )


def discard_stats(lines: DataFrame) -> DataFrame:
    lines = lines.filter(F.trim("line") != "")
    return lines.agg(
        F.count("*").alias("entries"),
        F.count_distinct(U.clean_url(F.col("line"))).alias("unique_valid"),
    ).withColumn("discarded", F.col("entries") - F.col("unique_valid"))


def clean_fleet(lines: DataFrame, exclude: str) -> DataFrame:
    """Fleet list: drop test rows by pattern, clean, keep the first row per domain."""
    kept = (
        lines.filter(~F.col("line").rlike(exclude))
        .select("ord", U.clean_url(F.col("line")).alias("url"))
        .filter("url is not null")
        .withColumn("domain", U.domain(F.col("url")))
    )
    return first_by(kept, ["domain"], [F.col("ord")])


def _exploded(df: DataFrame, items: Column, name: str, place: str) -> DataFrame:
    return df.select("*", F.posexplode(items).alias(place, name))


def candidate_pages(seeds: DataFrame, paths: list[str] = V.INVENTORY_PATHS) -> DataFrame:
    """The seed itself, then the path guesses of its origin."""
    base = U.origin(F.col("url"))
    guesses = F.transform(F.array(*[F.lit(p) for p in paths]), lambda p: F.concat(base, p))
    pages = F.array_distinct(F.concat(F.array("url"), guesses))
    return _exploded(seeds, pages, "page_url", "page_ord")


def candidate_endpoints(captures: DataFrame, quoted_paths: int | None = None) -> DataFrame:
    """Builder endpoints, inventory paths quoted in the page (the first ``quoted_paths``,
    where that is given), then guesses."""
    base = U.origin(F.col("dealer_url"))
    own = F.coalesce(
        *[
            F.when(F.col("builder") == name, F.array(*[F.lit(p) for p in paths]))
            for name, paths in V.BUILDER_API_PATHS.items()
        ],
        F.array().cast("array<string>"),
    )
    quoted = F.regexp_extract_all("body", F.lit("(?i)" + V.QUOTED_API_PATH), F.lit(1))
    quoted = F.array_distinct(F.filter(quoted, lambda p: ~p.rlike(V.ASSET_PATH)))
    if quoted_paths is not None:
        quoted = F.slice(quoted, 1, quoted_paths)
    guesses = F.array(*[F.lit(p) for p in V.API_PATHS])
    urls = F.transform(F.concat(own, quoted, guesses), lambda p: F.concat(base, p))
    rows = captures.select("dealer_url", F.array_distinct(urls).alias("_urls"))
    return rows.select("dealer_url", F.posexplode("_urls").alias("endpoint_ord", "endpoint_url"))


def page_links(captures: DataFrame) -> DataFrame:
    """``dealer_url, page_url, links``: the links of each page in order, as structs of ``pos``,
    ``href`` (absolute) and ``text``."""
    tags = F.regexp_extract_all("body", F.lit(r"(?is)<a\b([^>]*)>(.*?)</a\s*>"), F.lit(0))

    def link(tag: Column, pos: Column) -> Column:
        href = F.regexp_extract(tag, r"""(?is)^<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", 0)
        value = F.regexp_replace(href, r"""(?is)^.*?\bhref\s*=\s*["']?|["']$""", "")
        label = F.trim(X.spaced(F.regexp_replace(F.regexp_replace(tag, r"(?is)^<a\b[^>]*>", ""), r"<[^>]*>", "")))
        raw = F.when(href != "", value)
        return F.struct(pos.cast("int").alias("pos"), X.bind(raw, lambda r: F.coalesce(
            U.resolve(r, F.col("_base")), r)).alias("href"), label.alias("text"))

    rows = captures.select("dealer_url", "page_url", "body", U.origin(F.col("page_url")).alias("_base"))
    linked = settle(rows, ["dealer_url", "page_url"], {
        "links": F.filter(F.transform(tags, link), lambda l: l["href"].isNotNull())
    })
    return linked.withColumn("links", F.coalesce("links", F.array().cast("array<struct<pos:int,href:string,text:string>>")))


def anchors(captures: DataFrame) -> DataFrame:
    """``pos, href, text`` of every link, in page order; href is absolute."""
    return page_links(captures).select("dealer_url", "page_url", F.explode("links").alias("_l")).select(
        "dealer_url", "page_url", "_l.pos", "_l.href", "_l.text"
    )


def _best(pages: DataFrame, score: Callable[[Column], Column], least: int) -> DataFrame:
    """The best-scored link of each page; of equal scores the first. Chosen inside the row."""
    scored = F.transform("links", lambda l: F.struct(
        score(l).alias("score"), (-l["pos"]).alias("place"), l["href"].alias("href")
    ))
    best = F.array_max(F.filter(scored, lambda s: s["score"] >= least))
    return settle(pages, ["dealer_url", "page_url"], {"_b": best}).filter("_b is not null").select(
        "dealer_url", "page_url", "_b.href", "_b.score"
    )


def best_inventory_link(pages: DataFrame) -> DataFrame:
    """Same-origin link scored by inventory words: text counts 2, href 1; needs 2.

    ``pages`` is ``page_links``, here and below.
    """
    words = F.array(*[F.struct(F.lit(w).alias("text"), F.lit(w.replace(" ", "-")).alias("href")) for w in V.LINK_WORDS])

    def score(link: Column) -> Column:
        low = F.struct(F.lower(link["text"]).alias("text"), F.lower(link["href"]).alias("href"))
        points = X.bind(low, lambda l: F.aggregate(words, F.lit(0), lambda acc, w: (
            acc + F.when(F.contains(l["text"], w["text"]), 2).otherwise(0) + F.when(F.contains(l["href"], w["href"]), 1).otherwise(0)
        )))
        return F.when(F.startswith(link["href"], F.col("_base")), points)

    return _best(pages.withColumn("_base", U.origin(F.col("page_url"))), score, 2)


def best_wide_link(pages: DataFrame) -> DataFrame:
    def score(link: Column) -> Column:
        points = F.when(link["href"].rlike("(?i)" + V.WIDE_LINK_HREF), 2).otherwise(0) + F.when(
            F.lower(link["text"]).rlike(V.WIDE_LINK_TEXT), 1
        ).otherwise(0)
        return F.when(link["href"].startswith("http"), points)

    return _best(pages, score, 1)


def first_link_by_text(pages: DataFrame, platform: str) -> DataFrame:
    """The first link of a page whose text starts like an inventory link."""
    return _best(pages, lambda l: F.when(l["text"].rlike("(?i)" + V.ANCHOR_TEXT[platform]), 1), 1).drop("score")


def pagination_frontier(listings: DataFrame, platform: str, last: int) -> DataFrame:
    """Listing pages 1 to ``last`` of a platform."""
    pages = listings.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(last))))
    url = F.col("url")
    if platform == "dws":
        more = F.concat(url, F.lit("?page_no="), F.col("page").cast("string"))
    elif platform == "dealercom":
        more = F.concat(url, F.lit("?start="), ((F.col("page") - 1) * 24).cast("string"))
    else:
        more = U.join_query(url, "page", F.col("page"))
    return pages.withColumn("page_url", F.when(F.col("page") == 1, url).otherwise(more))
