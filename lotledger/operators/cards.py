"""Listing cards in page markup, one Spark job per publishing platform.

A page is cut into card segments by a lookahead split at the card's opening tag; the
segments are exploded once and every field is a regex on the segment, inside generated
code. "Inside the card element" becomes "inside the segment": from the card's opening tag
to the next card's, or to the page footer. A card nested in another therefore ends its
parent's segment, and text after the last card up to the footer counts to that card.
Generic and wide cards, whose elements nest freely, go by true containment (``elements``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as V
from ..functions import markers as M
from ..functions import text as X
from ..functions import urls as U
from ..schemas import VEHICLE_COLUMNS, VEHICLE_TYPES
from ..session import work_folder
from ..sources.captures import json_responses
from . import elements as E
from . import jsonmine as JM
from . import normalize as N
from .keyed import dealt, first_by, join_on_hot_keys
from .rows import explode_rows, settle

PAGE_KEYS = ["capture_id", "run_id", "dealer_url", "page_ord"]


# --- segments and pieces -----------------------------------------------------------

def attr(markup: Column, name: str) -> Column:
    """Value of an attribute, NULL where it is missing or empty."""
    return X.first_match(markup, rf"""(?is)\s{name}\s*=\s*["']([^"']*)["']""")


def class_tag(pattern: str) -> str:
    """Opening tag with a class attribute that matches ``pattern``."""
    return rf"""<[a-zA-Z][a-zA-Z0-9]*\b[^>]*\bclass\s*=\s*["'][^"'>]*{pattern}[^"'>]*["']"""


def _anchor_href(seg: Column, part: str) -> Column:
    """href of the first link whose href matches ``part``."""
    return X.first_match(seg, rf"""(?is)<a\b[^>]*\bhref\s*=\s*["']([^"']*(?:{part})[^"']*)["']""")


def _image(seg: Column) -> Column:
    tag = F.regexp_extract(seg, r"(?is)<img\b[^>]*>", 0)
    return F.coalesce(attr(tag, "src"), attr(tag, "data-src"))


def _group(text: Column, pattern: str) -> Column:
    return X.first_match(text, pattern)


# --- platform cards ---------------------------------------------------------------

# A platform is told by three functions: the pieces of a page (structs of id, seg, tag, text,
# price), a few values read from a piece (title, href, words), and the card's fields. All
# platforms fill the same structs, so a page of any platform is cut in one pass by its label.

_PIECE = "array<struct<id:string,seg:string,tag:string,text:string,price:string>>"
_VALUES = "struct<title:string,href:string,words:array<string>>"


def _pieces(opening: str) -> Column:
    """The segments of a page from each opening tag to the next or the footer."""
    parts = F.filter(F.split("body", f"(?={opening})"), lambda s: s.rlike("^" + opening))
    none = F.lit(None).cast("string")
    return F.transform(parts, lambda part: X.bind(F.regexp_replace(part, V.PLATFORM_PAGE_END, ""), lambda seg: F.struct(
        none.alias("id"), seg.alias("seg"), F.regexp_extract(seg, "^<[^>]*>", 0).alias("tag"),
        X.visible_text(seg).alias("text"), none.alias("price"),
    ))).cast(_PIECE)


def _values(title: Column | None = None, href: Column | None = None, words: Column | None = None) -> Column:
    given = {"title": title, "href": href, "words": words}
    return F.struct(*[
        (F.lit(None) if c is None else c).alias(n) for n, c in given.items()
    ]).cast(_VALUES)


def _dws_values() -> Column:
    href = X.first_match(F.col("seg"), r"""(?is)<a\b[^>]*\bhref\s*=\s*["']([^"']*)["']""")
    return X.bind(href, lambda h: _values(
        X.visible_text(F.regexp_extract("seg", r"(?is)^<([a-z0-9]+)\b[^>]*>.*?</\1\s*>", 0)),
        h, F.filter(F.split(h, "/"), lambda s: s != ""),
    ))


def _dws_fields() -> dict[str, Column]:
    def from_href(i: int) -> Column:
        return F.replace(F.get("words", i), F.lit("-"), F.lit(" "))

    def field(name: str) -> Column:
        inner = F.regexp_extract(
            "seg", rf"(?is)dws-vehicle-field-{name}(?![\w-])[^>]*>(.*?)(?:</(?:div|li|td|p)\b|<[^>]*dws-vehicle-field-|$)", 1
        )
        # only the first word counts as the label; a missing element is NULL, not empty
        value = F.trim(F.regexp_replace(X.visible_text(inner), V.DWS_LABEL, ""))
        return F.when(F.col("seg").rlike(rf"dws-vehicle-field-{name}(?![\w-])"), value)

    return {
        "vin": field("vin"),
        "stock_number": F.coalesce(F.nullif(field("stock-number"), F.lit("")), F.get("words", 3)),
        "make": from_href(1), "model": from_href(2),
        "year": _group(F.col("title"), V.PLATFORM_YEAR),
        "mileage": field("mileage"), "drivetrain": field("drivetrain"),
        "transmission": field("transmission"), "engine": field("engine"), "doors": field("door"),
        "price": _group(F.col("text"), V.DWS_PRICE),
        "condition": F.lit("used"), "url": F.col("href"), "image_url": _image(F.col("seg")),
    }


def _dealersync_values() -> Column:
    def of(title: Column) -> Column:
        parts = rf"(?s)^(.*?){V.PLATFORM_YEAR}(.*)$"
        rest = F.concat(F.regexp_extract(title, parts, 1), F.regexp_extract(title, parts, 3))
        return _values(title, words=F.split(F.trim(F.when(title.rlike(V.PLATFORM_YEAR), rest).otherwise(title)), r"\s+"))

    return X.bind(F.coalesce(attr(F.col("tag"), "data-vehicle-title"), F.lit("")), of)


def _dealersync_fields() -> dict[str, Column]:
    text = F.col("text")
    return {
        "vin": attr(F.col("tag"), "data-vin"),
        "stock_number": attr(F.col("tag"), "data-stock-no"),
        "make": F.get("words", 0), "model": F.get("words", 1),
        "trim": F.nullif(F.array_join(F.slice("words", 3, 1000), " "), F.lit("")),
        "year": _group(F.col("title"), V.PLATFORM_YEAR),
        "price": _group(text, V.PLATFORM_PRICE),
        "mileage": F.coalesce(_group(text, V.DEALERSYNC_MILES), _group(text, V.PLATFORM_MILES)),
        "location": attr(F.col("tag"), "data-city"), "condition": F.lit("used"),
        "url": _anchor_href(F.col("seg"), V.DEALERSYNC_LINK), "image_url": _image(F.col("seg")),
    }


def _dealr_values() -> Column:
    def of(href: Column) -> Column:
        slug = F.get(F.filter(F.split(href, "/"), lambda s: s.rlike(V.DEALR_SLUG)), 0)
        return _values(href=href, words=F.split(F.coalesce(slug, F.lit("")), "-"))

    return X.bind(_anchor_href(F.col("seg"), V.DEALR_LINK), of)


def _dealr_fields() -> dict[str, Column]:
    text = F.col("text")

    def labelled(label: str, stop: str) -> Column:
        return F.trim(_group(text, rf"(?i){label}\s+(.+?)\s+(?={stop})"))

    slug_year = F.when(F.get("words", 0).rlike(V.SLUG_YEAR), F.get("words", 0))
    return {
        "vin": attr(F.col("seg"), "data-cg-vin"),
        "stock_number": _group(text, V.DEALR_STOCK),
        "make": F.nullif(F.get("words", 1), F.lit("")), "model": F.nullif(F.get("words", 2), F.lit("")),
        "trim": F.nullif(F.array_join(F.slice("words", 4, 1000), " "), F.lit("")),
        "year": F.coalesce(slug_year, _group(text, V.PLATFORM_YEAR)),
        "mileage": _group(text, V.DEALR_MILES),
        "drivetrain": _group(text, V.LABELLED_DRIVETRAIN),
        "exterior_color": labelled("Exterior", V.DEALR_EXTERIOR_STOP),
        "interior_color": labelled("Interior", V.DEALR_INTERIOR_STOP),
        "engine": labelled("Engine", V.DEALR_ENGINE_STOP),
        "price": _group(text, V.PLATFORM_PRICE), "condition": F.lit("used"),
        "url": F.col("href"), "image_url": _image(F.col("seg")),
    }


def _overfuel_values() -> Column:
    def of(href: Column) -> Column:
        parts = F.split(F.coalesce(F.element_at(F.split(href, "/"), -1), F.lit("")), "-")
        return X.bind(parts, lambda p: _values(href=href, words=F.when(
            F.element_at(p, -1).rlike("(?i)" + V.VIN_PATTERN), F.slice(p, F.lit(1), F.size(p) - 1)
        ).otherwise(p)))

    return X.bind(_anchor_href(F.col("seg"), "/inventory/"), of)


def _overfuel_fields() -> dict[str, Column]:
    text = F.col("text")
    named = V.OVERFUEL_PRICE
    return {
        "vin": attr(F.col("tag"), "data-vin"),
        "stock_number": _group(text, V.OVERFUEL_STOCK),
        "make": F.coalesce(
            F.nullif(F.get("words", 1), F.lit("")),
            _group(attr(F.col("tag"), "class"), V.OVERFUEL_MAKE),
        ),
        "model": F.nullif(F.get("words", 2), F.lit("")),
        "trim": F.nullif(F.array_join(F.slice("words", 4, 1000), " "), F.lit("")),
        "year": F.when(F.get("words", 0).rlike(V.SLUG_YEAR), F.get("words", 0)),
        "mileage": _group(text, V.OVERFUEL_MILES),
        "price": F.coalesce(_group(text, named), _group(text, V.CARD_PRICE)),
        "condition": F.lit("used"), "url": F.col("href"), "image_url": _image(F.col("seg")),
    }


def _carsforsale_pieces() -> Column:
    """One piece per listing id: the text between its links and the next listing's.

    ``price`` is the JSON-LD price at the piece's own index on the page.
    """
    opening = r"""<a\b[^>]*\bhref\s*=\s*["'][^"'>]*/details/"""
    parts = F.filter(F.split("body", f"(?={opening})"), lambda s: s.rlike("^" + opening))
    parts = F.transform(parts, lambda s: F.struct(
        F.regexp_extract(F.regexp_extract(s, "^<a[^>]*>", 0), V.CARSFORSALE_LINK, 4).alias("id"),
        F.regexp_replace(s, V.PLATFORM_PAGE_END, "").alias("seg"),
    ))
    # a link to something else than a listing belongs to no card
    parts = F.filter(parts, lambda p: p["id"] != "")
    prices = F.flatten(F.transform(
        F.filter(JM.page_scripts(F.col("body")), JM.is_ld),
        lambda s: X.bind(F.try_parse_json(X.trimmed(s["text"])), _ld_prices),
    ))

    def whole(listing: Column, at: Column, ps: Column, shown: Column) -> Column:
        mine = F.transform(F.filter(ps, lambda p: p["id"] == listing), lambda p: p["seg"])
        return X.bind(F.array_join(mine, " "), lambda seg: F.struct(
            listing.alias("id"), seg.alias("seg"), F.lit("").alias("tag"), X.visible_text(seg).alias("text"),
            F.get(shown, at).alias("price"),
        ))

    return X.bind(F.struct(parts.alias("parts"), prices.alias("prices")), lambda both: F.transform(
        F.array_distinct(F.transform(both["parts"], lambda p: p["id"])),
        lambda listing, at: whole(listing, at, both["parts"], both["prices"]),
    )).cast(_PIECE)


def _carsforsale_values() -> Column:
    title = X.visible_text(F.regexp_extract(
        "seg", r"""(?is)<(h[1-4]|[a-z0-9]+(?=[^>]*\bclass\s*=\s*["'][^"'>]*title))\b[^>]*>.*?</\1\s*>""", 0
    ))
    return X.bind(_anchor_href(F.col("seg"), "/details/"), lambda href: _values(
        title, href, F.array(*[X.first_match(href, V.CARSFORSALE_LINK, i) for i in (1, 2, 3)])
    ))


def _carsforsale_fields() -> dict[str, Column]:
    y, mk, md = (F.get("words", i) for i in range(3))
    bare = F.regexp_replace(
        F.col("title"), F.concat(F.lit(r"(?i)^\s*"), y, F.lit(r"\s+"), mk, F.lit(r"\s+")), F.lit("")
    )
    model = F.concat(F.lit("(?i)^(.*?)"), F.replace(md, F.lit("-"), F.lit("[ -]")))
    trim = F.trim(F.regexp_replace(bare, model, F.lit("$1")))
    text = F.col("text")
    return {
        "listing_id": F.col("id"), "year": y,
        "make": F.replace(mk, F.lit("-"), F.lit(" ")),
        "model": F.replace(md, F.lit("-"), F.lit(" ")),
        "trim": F.nullif(trim, F.lit("")),
        "price": F.coalesce(_group(text, V.PLATFORM_PRICE), "piece_price"),
        "mileage": _group(text, V.PLATFORM_MILES),
        "transmission": _group(
            text, V.CARSFORSALE_TRANSMISSION
        ),
        "drivetrain": _group(text, V.LABELLED_DRIVETRAIN),
        "condition": F.lit("used"), "url": F.col("href"), "image_url": _image(F.col("seg")),
    }


MARKUP = {
    "dws": (lambda: _pieces(class_tag(V.DWS_CARD)), _dws_values, _dws_fields),
    "dealersync": (lambda: _pieces(V.PLATFORM_DATA_VIN), _dealersync_values, _dealersync_fields),
    "dealr": (
        lambda: _pieces(class_tag(V.DEALR_CARD)), _dealr_values, _dealr_fields,
    ),
    "overfuel": (lambda: _pieces(V.PLATFORM_DATA_VIN), _overfuel_values, _overfuel_fields),
    "carsforsale": (_carsforsale_pieces, _carsforsale_values, _carsforsale_fields),
}


def _by_platform(names: list[str], of: Callable[[str], Column]) -> Column:
    return F.coalesce(*[F.when(F.col("extractor") == name, of(name)) for name in names])


def platform_fields(names: list[str]) -> list[str]:
    """All card fields of these platforms."""
    return list(dict.fromkeys(f for name in names for f in MARKUP[name][2]()))


def marked_cards(captures: DataFrame, names: list[str]) -> DataFrame:
    """Cards of pages whose column ``extractor`` is one of ``names``, with all their fields.

    The captures are read once, each page is cut by its own platform's markup, and every value
    is read from a card once.
    """
    pages = captures.filter(F.col("extractor").isin(names))
    keep = [*PAGE_KEYS, "extractor"]
    rows = explode_rows(pages, keep, _by_platform(names, lambda n: MARKUP[n][0]()), "card_ord", "_c").select(
        *keep, "card_ord", "_c.id", "_c.seg", "_c.tag", "_c.text", F.col("_c.price").alias("piece_price")
    )
    rows = settle(rows, rows.columns, {"_v": _by_platform(names, lambda n: MARKUP[n][1]())})
    rows = rows.select("*", "_v.title", "_v.href", "_v.words")
    every = platform_fields(names)

    def card(name: str) -> Column:
        own = MARKUP[name][2]()
        return F.struct(*[own.get(f, F.lit(None)).cast("string").alias(f) for f in every])

    return settle(rows, [*keep, "card_ord"], {"_f": _by_platform(names, card)}).select(
        *keep, "card_ord", *[F.col("_f")[f].alias(f) for f in every]
    )


def _cards_of(captures: DataFrame, name: str) -> DataFrame:
    return marked_cards(captures.withColumn("extractor", F.lit(name)), [name]).drop("extractor")


def dws_cards(captures: DataFrame) -> DataFrame:
    return _cards_of(captures, "dws")


def dealersync_cards(captures: DataFrame) -> DataFrame:
    return _cards_of(captures, "dealersync")


def dealr_cards(captures: DataFrame) -> DataFrame:
    return _cards_of(captures, "dealr")


def overfuel_cards(captures: DataFrame) -> DataFrame:
    return _cards_of(captures, "overfuel")


def carsforsale_cards(captures: DataFrame) -> DataFrame:
    """One card per listing id; without a price it takes the JSON-LD price at its index."""
    return _cards_of(captures, "carsforsale")


def _ld_prices(doc: Column) -> Column:
    graph = F.coalesce(
        F.try_variant_get(doc, "$['@graph']", "array<variant>"), F.array().cast("array<variant>")
    )
    items = F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.concat(F.array(doc), graph))
    typed = F.filter(items, lambda it: F.coalesce(
        F.try_variant_get(it, "$['@type']", "variant").cast("string").rlike("(?i)vehicle|car"), F.lit(False)
    ))
    prices = F.transform(typed, lambda it: F.try_variant_get(it, "$.offers.price", "string"))
    return F.coalesce(
        F.filter(prices, lambda p: p.isNotNull() & ~p.isin("", "0")), F.array().cast("array<string>")
    )


def detail_fields(details: DataFrame) -> DataFrame:
    """``page_url, d_vin, d_stock, d_mileage`` of detail pages."""
    df = details.withColumn("text", X.visible_text(F.col("body")))
    vin = F.coalesce(
        _group(F.col("text"), V.DETAIL_VIN),
        _group(F.col("body"), r"""(?i)vehicleIdentificationNumber["\s:]+([A-HJ-NPR-Z0-9]{17})"""),
    )
    return df.select(
        "page_url", F.upper(vin).alias("d_vin"),
        _group(F.col("text"), V.DETAIL_STOCK).alias("d_stock"),
        _group(F.col("text"), V.PLATFORM_MILES).alias("d_mileage"),
    )


def enrich_from_details(cards: DataFrame, details: DataFrame) -> DataFrame:
    """VIN and stock from the listing's detail page, mileage only where missing."""
    found = first_by(detail_fields(details), ["page_url"], [F.col("d_vin").asc_nulls_last()])
    target = F.when(F.col("url").startswith("http"), F.col("url")).otherwise(
        F.concat(U.origin(F.col("dealer_url")), F.col("url"))
    )
    base = cards
    for name in ("vin", "stock_number"):
        if name not in base.columns:
            base = base.withColumn(name, F.lit(None).cast("string"))
    joined = base.withColumn("page_url", target).join(found, "page_url", "left")
    return joined.withColumns({
        "vin": F.coalesce("d_vin", "vin"), "stock_number": F.coalesce("d_stock", "stock_number"),
        "mileage": F.coalesce("mileage", "d_mileage"),
    }).drop("page_url", "d_vin", "d_stock", "d_mileage")


# --- generic cards ---------------------------------------------------------------

def generic_cards(
    captures: DataFrame, most: int | None = None, chars: tuple[int, int] | None = V.CARD_TEXT_CHARS
) -> DataFrame:
    """Elements that look like a vehicle card; first per key of a page, in page order.

    An element of another's class "vehicle" ends its parents' being cards. ``chars`` bounds
    the text of a card, so that lists are none; at most ``most`` of a page, where given.
    """
    df = E.page_cards(captures, [*PAGE_KEYS, "page_url"], E.generic, chars, most)
    return df.withColumn("url", U.resolve(F.col("url"), U.origin(F.col("page_url")))).drop("page_url")


def merge_fill(cards: DataFrame, keys: list[str], fields: list[str], order: list[str]) -> DataFrame:
    """One row per key; every field is its first non-NULL value in order."""
    place = F.struct(*order)
    folded = cards.groupBy(*keys).agg(
        F.min(place).alias("_at"),
        *[F.expr(f"min_by({f}, struct({', '.join(order)})) FILTER (WHERE {f} IS NOT NULL)").alias(f) for f in fields],
    )
    return folded.select(*keys, *[F.col("_at")[c].alias(c) for c in order], *fields)


def wide_cards(
    captures: DataFrame, most: int | None = None, chars: tuple[int, int] | None = V.CARD_TEXT_CHARS
) -> DataFrame:
    """More elements, VIN sanity, cards of one key fill each other's gaps; then the elements
    around VINs in text that no card holds. ``most`` and ``chars`` as in ``generic_cards``."""
    return _wide_columns(E.page_cards(captures, [*PAGE_KEYS, "page_url"], E.wide, chars, most))


def anchored_vins(captures: DataFrame) -> DataFrame:
    """The vehicles around VINs in a page's text, whatever cards it has."""
    return _wide_columns(E.page_cards(captures, [*PAGE_KEYS, "page_url"], E.anchored, None, None))


def _wide_columns(df: DataFrame) -> DataFrame:
    return df.select(
        *PAGE_KEYS, "card_ord", "vin", "year", "make", "model", "price", "mileage", F.lit("used").alias("condition"),
        U.resolve(F.col("url"), U.origin(F.col("page_url"))).alias("url"), F.col("image").alias("image_url"),
    )


# --- listing rules across pages -------------------------------------------------

LISTING_KEY = {
    "dws": ["stock_number", "vin", "url"],
    "dealr": ["vin", "stock_number", "url"],
    "overfuel": ["vin", "url"],
    "carsforsale": ["listing_id"],
}


def listing_key(platform: str) -> Column:
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in LISTING_KEY[platform]])


def merge_layouts(cards: DataFrame) -> DataFrame:
    """dws: the same vehicle in two layouts becomes one, later cards fill the gaps."""
    fields = [c for c in cards.columns if c not in (*PAGE_KEYS, "card_ord")]
    keyed = cards.withColumn("_key", listing_key("dws")).filter("_key is not null")
    return merge_fill(
        keyed, ["run_id", "dealer_url", "_key"], fields, ["page_ord", "card_ord"]
    ).drop("_key")


def first_listings(cards: DataFrame, platform: str) -> DataFrame:
    keyed = cards.withColumn("_key", listing_key(platform)).filter("_key is not null")
    return first_by(
        keyed, ["run_id", "dealer_url", "_key"], [F.col("page_ord"), F.col("card_ord")]
    ).drop("_key")


_SERIES = ["run_id", "dealer_url", "extractor"]


def page_yields(cards: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Per dealer, ``extractor`` and listing page: its ``cards`` and ``new_keys``, the keys it
    is the first to show. ``cards`` carries ``_key``.

    ``pages`` lists the captured pages, so that a page without cards counts too.
    """
    totals = cards.groupBy(*_SERIES, "page_ord").agg(F.count("*").alias("cards"))
    if pages is not None:
        every = pages.select(*_SERIES, "page_ord").distinct()
        totals = every.join(totals, [*_SERIES, "page_ord"], "left").na.fill(0, ["cards"])
    fresh = (
        cards.filter("_key is not null")
        .groupBy(*_SERIES, "_key").agg(F.min("page_ord").alias("page_ord"))
        .groupBy(*_SERIES, "page_ord").agg(F.count("*").alias("new_keys"))
    )
    return totals.join(fresh, [*_SERIES, "page_ord"], "left").na.fill(0, ["new_keys"])


def last_pages(yields: DataFrame) -> DataFrame:
    """Per dealer and extractor the page pagination stops at: the first without new keys or,
    where the platform has a page size, the first short one. No such page, no row."""
    short = F.coalesce(*[
        F.when(F.col("extractor") == name, F.col("cards") < size) for name, size in V.SHORT_PAGE.items()
    ], F.lit(False))
    # The first page of an answered listing never ends it: its answer may come late.
    dry = (F.col("new_keys") == 0) & ((F.col("extractor") != "dealercom") | (F.col("page_ord") > 0))
    ends = yields.filter((dry | short) & F.col("extractor").isin(*LISTING_KEY, "dealercom"))
    return ends.groupBy(*_SERIES).agg(F.min("page_ord").alias("_last"))


def cut_pages(cards: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Rows (with ``_key``) up to the page pagination stops at. ``cards`` is read more than
    once: it should be a written table."""
    last = last_pages(page_yields(cards, pages))
    joined = join_on_hot_keys(cards, last, _SERIES, ["page_ord", "_key"], "left")
    return joined.filter(F.col("_last").isNull() | (F.col("page_ord") <= F.col("_last"))).drop("_last")


def _tagged(df: DataFrame | None, platform: str) -> DataFrame | None:
    return None if df is None else df.withColumn("extractor", F.lit(platform))


def page_yield(cards: DataFrame, platform: str, pages: DataFrame | None = None) -> DataFrame:
    """``page_yields`` of the cards of one platform."""
    keyed = cards.withColumn("_key", listing_key(platform))
    return page_yields(_tagged(keyed, platform), _tagged(pages, platform)).drop("extractor")


def cut_pagination(cards: DataFrame, platform: str, pages: DataFrame | None = None) -> DataFrame:
    """Cards of one platform up to the page pagination stops at; they are written once."""
    keyed = _written(_tagged(cards.withColumn("_key", listing_key(platform)), platform), "cards")
    return cut_pages(keyed, _tagged(pages, platform)).drop("_key", "extractor")


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table of the shared folder: parsed once, however often read."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_announced_total(pages: DataFrame) -> DataFrame:
    """Cars Commerce pages ``(run_id, dealer_url, page_ord, new_keys, total)`` up to the
    one that reaches the announced total. A dealer has at most 15 pages."""
    before = Window.partitionBy("run_id", "dealer_url").orderBy("page_ord").rowsBetween(
        Window.unboundedPreceding, -1
    )
    seen = F.coalesce(F.sum("new_keys").over(before), F.lit(0))
    dry = F.coalesce(F.max((F.col("new_keys") == 0).cast("int")).over(before), F.lit(0))
    total = F.coalesce(F.max("total").over(before), F.lit(0))
    return pages.withColumns({"_seen": seen, "_dry": dry, "_total": total}).filter(
        (F.col("_dry") == 0) & ((F.col("_total") == 0) | (F.col("_seen") < F.col("_total")))
    ).drop("_seen", "_dry", "_total")


def extractor_for(label: Column) -> Column:
    """Platform label to extractor: exact, then lower case."""
    return F.coalesce(
        M.label_lookup(V.EXTRACTOR_BY_LABEL, label),
        M.label_lookup(V.EXTRACTOR_BY_LABEL, F.lower(label)),
    )


# --- to vehicles ----------------------------------------------------------------

def cards_to_vehicles(cards: DataFrame, run_year: int = 2024, raw: Column | None = None) -> DataFrame:
    """Card columns to the 23 vehicle columns.

    The alias table knows ``image`` but not ``image_url``, so only cards that carry
    ``image`` keep their picture. ``raw``: the card as JSON, all its columns by default.
    """
    keep = [c for c in (*PAGE_KEYS, "extractor", "card_ord") if c in cards.columns]
    fields = [c for c in cards.columns if c not in keep]
    values: dict[str, Column] = {}
    for name in VEHICLE_COLUMNS:
        source = "image" if name == "image_url" else name
        value = F.col(source) if source in fields else F.lit(None).cast("string")
        if VEHICLE_TYPES[name] == "int":
            values[name] = X.to_int(value)
        elif VEHICLE_TYPES[name] == "double":
            values[name] = X.to_float(value)
        else:
            values[name] = X.trimmed(value)
    values["raw_json"] = _card_json(fields) if raw is None else raw
    typed = cards.select(
        *keep, U.origin(F.col("dealer_url")).alias("origin"),
        *[values[c].alias(c) for c in VEHICLE_COLUMNS],
    )
    return N.finish_fields(typed, "origin", run_year)


def _card_json(fields: list[str]) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def markup_vehicles(routed: DataFrame, run_year: int) -> DataFrame:
    """Vehicles of all platforms whose listings stand in the page's markup.

    The captures are read once and their cards written once; pagination, layouts and detail
    pages work on the written cards.
    """
    names = list(MARKUP)
    detail = (F.col("extractor") == "carsforsale") & F.coalesce(F.col("page_url").rlike(V.CARSFORSALE_LINK), F.lit(False))
    listing = routed.filter(~detail)
    key = _by_platform(list(LISTING_KEY), listing_key)
    cards = _written(marked_cards(listing, names).withColumn("_key", key), "platform-cards")
    cut = cut_pages(cards, listing.filter(F.col("extractor").isin(names)))
    fields = platform_fields(names)
    layouts = merge_fill(
        cut.filter("extractor = 'dws' and _key is not null"), [*_SERIES, "_key"], fields, ["page_ord", "card_ord"]
    )
    listed = cut.filter(F.col("extractor").isin(*LISTING_KEY) & (F.col("extractor") != "dws") & F.col("_key").isNotNull())
    first = first_by(listed, [*_SERIES, "_key"], [F.col("page_ord"), F.col("card_ord")])
    columns = [*_SERIES, "page_ord", "card_ord", *fields]
    plain = cards.filter(~F.col("extractor").isin(*LISTING_KEY))
    enriched = enrich_from_details(first.filter("extractor = 'carsforsale'"), routed.filter(detail))
    every = reduce(DataFrame.unionByName, [part.select(columns) for part in (
        layouts, plain, enriched, first.filter("extractor <> 'carsforsale'"),
    )])
    own = {n: [f for f in fields if f in MARKUP[n][2]() or n == "carsforsale" and f in ("vin", "stock_number")] for n in names}
    return cards_to_vehicles(every, run_year, _by_platform(names, lambda n: _card_json(own[n])))


def _announced(responses: DataFrame, run_year: int) -> DataFrame:
    """Cars Commerce answers up to the page that reaches the announced total."""
    owner = ["run_id", "dealer_url"]
    rows = _written(JM.cars_commerce_rows(responses), "answered-cards")
    fresh = (
        rows.groupBy(*owner, "vin").agg(F.min("page_ord").alias("page_ord"))
        .groupBy(*owner, "page_ord").agg(F.count("*").alias("new_keys"))
    )
    pages = responses.select(*owner, "page_ord").distinct().join(fresh, [*owner, "page_ord"], "left")
    kept = cut_announced_total(
        pages.na.fill(0, ["new_keys"]).join(JM.announced_totals(responses), owner, "left")
    ).select(*owner, "page_ord")
    return cards_to_vehicles(JM.last_listings(rows.join(kept, [*owner, "page_ord"], "left_semi")), run_year)


def _answered(responses: DataFrame, run_year: int, depth: int | None) -> DataFrame:
    """Dealer.com answers up to the first later page that shows no new record."""
    rows = _written(_tagged(JM.dealercom_rows(responses, depth), "dealercom"), "answered-records")
    cut = cut_pages(rows, _tagged(responses, "dealercom")).drop("extractor")
    records = dealt(JM.first_records(cut), [*_SERIES[:2], "page_ord", "ord"]).withColumnRenamed("ord", "card_ord")
    return N.normalize_vehicles(records.withColumn("origin", U.origin(F.col("dealer_url"))), run_year=run_year)


def platform_vehicles(captures: DataFrame, run_year: int = 2024, depth: int | None = None) -> DataFrame:
    """Route captures by ``platform`` label and run every extractor.

    Returns deduped vehicles with ``platform``. Vehicle arrays of answers are sought down to
    ``depth``, at any depth without a number.
    """
    routed = captures.withColumn("extractor", extractor_for(F.col("platform")))
    # Two labels of one extractor are one platform: the smallest label names it.
    labels = routed.groupBy(*_SERIES).agg(F.min("platform").alias("platform"))
    answers = lambda name: json_responses(routed.filter(F.col("extractor") == name))
    found = {
        None: markup_vehicles(routed, run_year),
        "dealerinspire": _announced(answers("dealerinspire"), run_year),
        "dealercom": _answered(answers("dealercom"), run_year, depth),
    }
    columns = [*_SERIES, "page_ord", "card_ord", *VEHICLE_COLUMNS]
    every = reduce(DataFrame.unionByName, [
        (df if name is None else df.withColumn("extractor", F.lit(name))).select(columns) for name, df in found.items()
    ])
    unique = N.dedupe_vehicles(every, _SERIES, ["page_ord", "card_ord"])
    return join_on_hot_keys(unique, labels, _SERIES, ["page_ord", "card_ord"])


def merge_wide_path(embedded: DataFrame, cards: DataFrame) -> DataFrame:
    """Embedded vehicles of each page first, cards last; first per VIN, else per
    year, make and model."""
    both = embedded.withColumn("_late", F.lit(0)).unionByName(cards.withColumn("_late", F.lit(1)))
    return _first_per(both, X.null_safe_key(*[F.col(c) for c in ("year", "make", "model")]),
                      [F.col("_late"), F.col("page_ord"), F.col("card_ord")]).drop("_late")


def _first_per(df: DataFrame, fallback: Column, order: list[Column], strict_vin: bool = False) -> DataFrame:
    vin = F.nullif(F.col("vin"), F.lit(""))
    if strict_vin:
        vin = F.when(vin.rlike("[0-9]") & vin.rlike("(?i)[A-HJ-NPR-Z]"), vin)
    named = (F.coalesce(F.col("year").cast("string"), F.lit("0")) != "0") & (
        F.coalesce(F.col("make"), F.lit("")) != ""
    )
    keyed = df.withColumn("_key", F.coalesce(vin, F.when(named, fallback))).filter("_key is not null")
    return first_by(keyed, ["run_id", "dealer_url", "_key"], order).drop("_key")


def merge_rendered(responses: DataFrame, cards: DataFrame) -> DataFrame:
    """Rendered captures: JSON records and wide cards per ``base_ord`` and page.

    First per strict VIN, else year|make|model|url; then only what was seen up to the
    first base that contributes a new key. Of one page the responses come before the cards.
    """
    both = responses.withColumn("_late", F.lit(0)).unionByName(cards.withColumn("_late", F.lit(1)))
    fallback = X.null_safe_key(*[F.col(c) for c in ("year", "make", "model", "url")])
    unique = _first_per(
        both, fallback,
        [F.col("base_ord"), F.col("page_ord"), F.col("_late"), F.col("card_ord")], strict_vin=True,
    )
    used = unique.groupBy("run_id", "dealer_url").agg(F.min("base_ord").alias("_base"))
    kept = join_on_hot_keys(unique, used, ["run_id", "dealer_url"], ["page_ord", "card_ord", "vin"])
    return kept.filter(F.col("base_ord") <= F.col("_base")).drop("_base", "_late")
