"""Vehicle cards by element containment.

Which element holds which is not a regular language, so a page's markup is scanned once, in an
Arrow step: the elements in document order, each with the range of its descendants and of its
text nodes. "Inside the card", "a parent that holds cards" and "the ancestors of this text"
are then comparisons of ranges. Cards of a page are folded where the page lies.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Container, Iterator
from itertools import accumulate
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V

# Executors get these functions with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(V)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
_BLANKS = re.compile(r"[\s﻿]+")
_VIN = re.compile(V.VIN_IN_TEXT, re.A)
_NAMED = re.compile(V.YEAR_MAKE_MODEL, re.A)
_PRICE = re.compile(V.CARD_PRICE, re.A)
_MILES = re.compile(V.CARD_MILES, re.A)
_ONE_LETTER = re.compile(r"(.)\1{6}")


class Page:
    """The elements of a page in document order, and its text nodes.

    ``end[i]`` is the number after the last descendant of element i, ``texts[first[i]:last[i]]``
    its text nodes, ``parent[i]`` the element around it (-1: none), ``over[k]`` the element
    around text node k. Text of scripts and styles is text, comments are not. End tags that
    HTML lets out (li, td, tr, p, ...) are implied; one without its start tag is skipped.
    """

    def __init__(self, body: str):
        self.tag: list[str] = []
        self.attributes: list[dict[str, str]] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.texts: list[str] = []
        self.over: list[int] = []
        self._open: list[int] = []
        # Pages repeat their markup: attributes and texts that read the same are read once.
        self._attributes: dict[str, dict[str, str]] = {"": {}}
        self._texts: dict[str, str] = {}
        at = 0
        while match := _TOKEN.search(body, at):
            start, end = match.span()
            if start > at:
                self._text(body[at: start])
            at = end
            close, name, attributes = match.groups()
            if name is None:
                continue
            name = name.lower()
            if close:
                if self._open and self.tag[self._open[-1]] == name:
                    self._pop()
                else:
                    self._close((name,), ())
                continue
            self._start(name, attributes)
            if name in V.RAW_TEXT_TAGS:
                stop = re.compile(f"</{name}", re.I).search(body, at)
                self._raw(body[at: stop.start() if stop else len(body)])
                at = stop.start() if stop else len(body)
        self._text(body[at:])
        while self._open:
            self._pop()
        # Characters but blanks before each text node: what a range holds at least.
        solid = {t: len(_BLANKS.sub("", t)) for t in set(self.texts)}
        self.solid = [0, *accumulate(solid[t] for t in self.texts)]

    def _start(self, name: str, attributes: str) -> None:
        for closed, scope in V.IMPLIED_END_TAGS.get(name, ()):
            self._close(closed, scope)
        found = self._attributes.get(attributes)
        if found is None:
            found = self._attributes[attributes] = {}
            for key, *values in _ATTRIBUTE.findall(attributes):
                value = next((v for v in values if v), "")
                found.setdefault(key.lower(), html.unescape(value) if "&" in value else value)
        i, texts = len(self.tag), len(self.texts)
        self.tag.append(name)
        self.attributes.append(found)
        self.parent.append(self._open[-1] if self._open else -1)
        self.end.append(i + 1)
        self.first.append(texts)
        self.last.append(texts)
        if name not in V.VOID_TAGS and not (attributes.endswith("/") and name in V.FOREIGN_TAGS):
            self._open.append(i)

    def _pop(self) -> None:
        i = self._open.pop()
        self.end[i], self.last[i] = len(self.tag), len(self.texts)

    def _close(self, names: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """Close the innermost open element of ``names`` that no element of ``scope`` hides."""
        for depth in range(len(self._open) - 1, -1, -1):
            tag = self.tag[self._open[depth]]
            if tag in names:
                while len(self._open) > depth:
                    self._pop()
                return
            if tag in scope:
                return

    def _text(self, text: str) -> None:
        if "&" in text:
            said = self._texts.get(text)
            if said is None:
                said = self._texts[text] = html.unescape(text)
            text = said
        self._raw(text)

    def _raw(self, text: str) -> None:
        if text:
            self.texts.append(text)
            self.over.append(self._open[-1] if self._open else -1)

    def text(self, i: int) -> str:
        """Text of an element (of the page for -1), white space collapsed; a tag between two
        texts reads as a blank."""
        texts = self.texts if i < 0 else self.texts[self.first[i]: self.last[i]]
        return _BLANKS.sub(" ", " ".join(texts))

    def first_within(self, i: int, tag: str, attribute: str | None = None) -> dict[str, str]:
        """Attributes of the first descendant of this tag (that has the attribute)."""
        for j in range(i + 1, self.end[i]):
            if self.tag[j] == tag and (attribute is None or attribute in self.attributes[j]):
                return self.attributes[j]
        return {}


def is_candidate(page: Page, i: int, classes: tuple[str, ...], tags: tuple[str, ...], tag_classes: dict[str, str]) -> bool:
    """Has the element a class that contains one of ``classes``, VIN data, or one of ``tags``?"""
    attributes = page.attributes[i]
    kind = attributes.get("class", "").lower()
    return (
        any(c in kind for c in classes) or "data-vin" in attributes or "data-vehicle" in attributes
        or page.tag[i] in tags or (page.tag[i] in tag_classes and tag_classes[page.tag[i]] in kind)
    )


def holds_nested(page: Page, word: str) -> list[bool]:
    """Per element: does it hold an element of class ``word`` that lies in another one?"""
    has = {id(a): word in a.get("class", "").lower() for a in page.attributes}
    named = [has[id(a)] for a in page.attributes]
    inside = []  # an ancestor has the class
    for i, up in enumerate(page.parent):
        inside.append(up >= 0 and (named[up] or inside[up]))
    nested = [0, *accumulate(int(n and s) for n, s in zip(named, inside))]
    return [nested[page.end[i]] > nested[i + 1] for i in range(len(named))]


def fields(text: str, vin: str | None) -> dict[str, str | None]:
    named, price, miles = _NAMED.search(text), _PRICE.search(text), _MILES.search(text)
    return {
        "vin": vin, "year": named and named[1], "make": named and named[2], "model": named and named[3],
        "price": price and price[1], "mileage": miles and miles[1],
    }


def candidates(
    page: Page, rule: dict, chars: tuple[int, int] | None, without: list[bool] | None = None
) -> Iterator[tuple[int, str, str | None]]:
    """(element, text, VIN) of the elements that may be a card: of a fitting length of text,
    with a VIN or a year, make and model. Elements marked in ``without`` are left out."""
    fits: dict[tuple[str, int], bool] = {}  # equal tags and attributes fit or do not: told once
    for i in range(len(page.tag)):
        kind = page.tag[i], id(page.attributes[i])
        fit = fits.get(kind)
        if fit is None:
            fit = fits[kind] = is_candidate(page, i, **rule)
        if not fit or without is not None and without[i]:
            continue
        if chars is not None and page.solid[page.last[i]] - page.solid[page.first[i]] > chars[1]:
            continue
        text = page.text(i).strip()
        if chars is not None and not chars[0] <= len(text) <= chars[1]:
            continue
        in_text = _VIN.search(text)
        vin = page.attributes[i].get("data-vin") or (in_text and in_text[0])
        if vin or _NAMED.search(text):
            yield i, text, vin


def generic(body: str, base: str, chars: tuple[int, int] | None, most: int | None) -> list[dict]:
    page = Page(body)
    seen, out = set(), []
    for i, text, vin in candidates(page, V.GENERIC_CARDS, chars, holds_nested(page, "vehicle")):
        image = page.first_within(i, "img")
        card = {**fields(text, vin), "url": page.first_within(i, "a", "href").get("href"),
                "image": image.get("src") or image.get("data-src")}
        key = vin or named_key(card, base)
        if key not in seen:
            seen.add(key)
            out.append(card)
            if most is not None and len(out) >= most:
                break
    return out


def named_key(card: dict, base: str) -> tuple:
    return card["year"], card["make"], card["model"], urljoin(base, card["url"]) if card["url"] is not None else None


def sane_vin(vin: str) -> bool:
    """A digit, a letter, and no character seven times in a row."""
    return any(c.isdigit() for c in vin) and any(c in V.VIN_LETTERS for c in vin) and not _ONE_LETTER.search(vin)


def loose_vins(page: Page, known: Container) -> Iterator[tuple[str, int]]:
    """VINs in text that are not ``known`` yet, each with the element around it.

    From the text's parent up to six steps, to the first element that names year, make and
    model; without one the last element reached counts. Shown text comes before that of
    scripts, and scripts count in the page's body only.
    """
    body = page.tag.index("body") if "body" in page.tag else None
    inner = range(page.first[body], page.last[body]) if body is not None else range(len(page.texts))
    raw = [page.over[k] >= 0 and page.tag[page.over[k]] in V.RAW_TEXT_TAGS for k in range(len(page.texts))]
    scripts = [k for k in inner if raw[k]] if body is not None else []
    names: dict[int, bool] = {}  # does the element name a vehicle? Each is read once.
    for k in [*(k for k in inner if not raw[k]), *scripts]:
        match = _VIN.search(page.texts[k])
        if not match or not sane_vin(match[0]) or match[0] in known:
            continue
        i = page.over[k]
        for _ in range(V.CARD_ANCESTORS):
            if i < 0 or page.parent[i] < 0:
                break
            if i not in names:
                names[i] = _NAMED.search(page.text(i)) is not None
            if names[i]:
                break
            i = page.parent[i]
        yield match[0], i


def around(page: Page, loose: Iterator[tuple[str, int]]) -> Iterator[tuple[str, dict]]:
    """The card of each VIN: the fields of the element around it, read once per element."""
    read: dict[int, dict] = {}
    for vin, i in loose:
        if i not in read:
            text = page.text(i)
            link = page.first_within(i, "a", "href") if i >= 0 else {}
            image = page.first_within(i, "img") if i >= 0 else {}
            read[i] = {**fields(text, None), "url": link.get("href"), "image": image.get("src")}
        yield vin, {**read[i], "vin": vin}


def wide(body: str, base: str, chars: tuple[int, int] | None, most: int | None) -> list[dict]:
    page = Page(body)
    cards: dict[object, dict] = {}
    for i, text, vin in candidates(page, V.WIDE_CARDS, chars):
        image = page.first_within(i, "img")
        card = {**fields(text, vin if vin and sane_vin(vin) else None),
                "url": page.first_within(i, "a", "href").get("href"), "image": image.get("src") or image.get("data-src")}
        key = card["vin"] or (named_key(card, base) if card["year"] and card["make"] else None)
        if key is not None:
            known = cards.setdefault(key, card)
            known.update({f: v for f, v in card.items() if known[f] is None})
    for vin, card in around(page, loose_vins(page, cards.keys())):
        cards[vin] = card
    found = list(cards.values())
    return found if most is None else found[:most]


def anchored(body: str, base: str, chars: tuple[int, int] | None, most: int | None) -> list[dict]:
    """The cards around VINs in text alone."""
    page, cards = Page(body), {}
    for vin, card in around(page, loose_vins(page, cards)):
        cards[vin] = card
    return list(cards.values())


CARD = pa.struct([(c, pa.string()) for c in ("vin", "year", "make", "model", "price", "mileage", "url", "image")])
CARD_SQL = "array<struct<vin: string, year: string, make: string, model: string, price: string, mileage: string, url: string, image: string>>"


def page_cards(captures: DataFrame, keep: list[str], rule, chars: tuple[int, int] | None, most: int | None) -> DataFrame:
    """``keep..., card_ord`` and the card's fields: one row per card of ``rule`` (``generic``,
    ``wide`` or ``anchored``). Pages without markup give no rows."""

    def run(bodies: pa.Array, bases: pa.Array) -> pa.Array:
        return pa.array([
            rule(body.as_py() or "", base.as_py() or "", chars, most) for body, base in zip(bodies, bases)
        ], pa.list_(CARD))

    found = F.arrow_udf(run, CARD_SQL).asNondeterministic()  # never copied or moved by the optimizer
    rows = captures.select(*keep, F.posexplode(found("body", "page_url")).alias("card_ord", "_card"))
    return rows.select(*keep, "card_ord", *[F.col("_card")[f.name].alias(f.name) for f in CARD])
