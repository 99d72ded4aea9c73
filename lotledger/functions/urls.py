"""URL expressions: validity, origin, domain, cleaning, resolving."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .text import bind, first_match

_AUTHORITY = r"^\s*(?i:https?):[/\\]*(?:[^/?#\\@\s]*@)?"
_HOST = r"([^\s#/:<>?@\[\\\]^|%]+)"


def is_web_url(url: Column) -> Column:
    """Absolute http(s) URL with a usable host and port."""
    return F.coalesce(
        url.rlike(_AUTHORITY + _HOST + r"(?::[0-9]{0,5})?(?:[/\\?#].*)?\s*$"),
        F.lit(False),
    )


def host(url: Column) -> Column:
    return F.lower(first_match(url, _AUTHORITY + _HOST))


def domain(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def origin(url: Column) -> Column:
    """scheme://host[:port]; the scheme's own port is left out."""
    scheme = F.lower(first_match(url, r"^\s*((?i)https?):"))
    port = first_match(url, _AUTHORITY + r"[^\s#/:?\\]+:([0-9]+)")
    own = F.when(scheme == "https", "443").otherwise("80")
    return F.concat(
        scheme,
        F.lit("://"),
        host(url),
        F.when(port.isNotNull() & (port != own), F.concat(F.lit(":"), port)).otherwise(""),
    )


def clean_url(raw: Column) -> Column:
    """Strip up to two schemes and all white space; refuse e-mails, facebook and
    dotless names; canonical https form without trailing slashes."""
    bare = F.regexp_replace(F.trim(raw), r"(?i)^https?://", "")
    bare = F.regexp_replace(bare, r"(?i)^https?://", "")
    bare = F.regexp_replace(bare, r"(?U)[\s﻿]+", "")
    keep = (
        (bare != "")
        & ~bare.contains("@")
        & ~F.lower(bare).contains("facebook.com")
        & bare.contains(".")
    )
    return F.when(keep, F.concat(F.lit("https://"), F.regexp_replace(bare, "/+$", "")))


def _squash_dots(path: Column) -> Column:
    """Apply '.' and '..' segments of a path that starts with '/'."""

    def walk(stack: Column, part: Column) -> Column:
        return (
            F.when(part == ".", stack)
            .when(
                part == "..",
                F.when(F.size(stack) > 1, F.slice(stack, F.lit(1), F.size(stack) - 1)).otherwise(stack),
            )
            .otherwise(F.array_append(stack, part))
        )

    def squashed(p: Column) -> Column:
        closed = F.when(p.rlike(r"/\.{1,2}$"), F.concat(p, F.lit("/"))).otherwise(p)
        parts = F.split(F.substring(closed, F.lit(2), F.length(closed)), "/")
        start = F.array(F.lit("")).cast("array<string>")
        return F.array_join(F.aggregate(parts, start, walk), "/")

    return F.when(path.contains("/."), squashed(path)).otherwise(path)


# Characters a URL spells as percent codes, besides blanks, control characters and all beyond ASCII.
_IN_PATH, _IN_QUERY, _IN_FRAGMENT = '"<>`{}', "\"<>'", '"<>`'


def _escaped(text: Column, also: str) -> Column:
    """UTF-8 percent codes for what a URL part cannot hold as it is."""
    unsafe = r"[^!-~" + "]|[" + re.escape(also) + "]"

    def code(char: Column) -> Column:
        return F.when(char.rlike(unsafe), F.regexp_replace(F.hex(F.encode(char, "UTF-8")), "(..)", "%$1")).otherwise(char)

    return F.when(text.rlike(unsafe), F.array_join(F.transform(F.split(text, ""), code), "")).otherwise(text)


# Parameters of the ASCII form of host labels: fixed values of the encoding.
_BASE, _LEAST, _MOST, _SKEW, _DAMP, _FIRST_BIAS, _FIRST_CODE = 36, 1, 26, 38, 700, 72, 128
_DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"
# A number of more digits than this does not come up in a label of 63 characters.
_ROUNDS = 10


def _number(value: Column, bias: Column) -> Column:
    """A number in digits whose weights depend on their place and the bias."""
    def step(acc: Column, k: Column) -> Column:
        return bind(F.greatest(F.lit(_LEAST), F.least(F.lit(_MOST), k - bias)).cast("bigint"), lambda t: F.when(
            acc["done"], acc
        ).otherwise(F.struct(
            F.floor((acc["q"] - t) / (_BASE - t)).cast("bigint").alias("q"),
            F.concat(acc["text"], F.substring(F.lit(_DIGITS), F.when(acc["q"] < t, acc["q"]).otherwise(
                t + F.pmod(acc["q"] - t, _BASE - t)).cast("int") + 1, F.lit(1))).alias("text"),
            (acc["q"] < t).alias("done"),
        )))

    start = F.struct(value.cast("bigint").alias("q"), F.lit("").alias("text"), F.lit(False).alias("done"))
    weights = F.sequence(F.lit(_BASE), F.lit(_BASE * _ROUNDS), F.lit(_BASE))
    return F.aggregate(weights, start.cast("struct<q:bigint,text:string,done:boolean>"), step, lambda acc: acc["text"])


def _next_bias(delta: Column, points: Column, first: Column) -> Column:
    scaled = F.floor(delta / F.when(first, _DAMP).otherwise(2))
    limit = (_BASE - _LEAST) * _MOST // 2

    def step(acc: Column, _: Column) -> Column:
        return F.when(acc["d"] > limit, F.struct(
            F.floor(acc["d"] / (_BASE - _LEAST)).cast("bigint").alias("d"), (acc["k"] + _BASE).alias("k")
        )).otherwise(acc)

    start = bind(scaled, lambda d: F.struct((d + F.floor(d / points)).cast("bigint").alias("d"), F.lit(0).cast("bigint").alias("k")))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_ROUNDS)), start.cast("struct<d:bigint,k:bigint>"), step,
        lambda acc: acc["k"] + F.floor(_BASE * acc["d"] / (acc["d"] + _SKEW)).cast("bigint"),
    )


def ascii_label(label: Column) -> Column:
    """A host label beyond ASCII in its ASCII form, without the ``xn--`` before it.

    The label's ASCII characters come first; then, code point by code point in rising order,
    the distance to each place where one has to be put in.
    """
    shape = "struct<n:bigint,delta:bigint,bias:bigint,h:bigint,text:string>"

    def encoded(codes: Column) -> Column:
        plain = F.filter(codes, lambda c: c < _FIRST_CODE)
        plain_text = F.array_join(F.transform(plain, lambda c: F.char(c)), "")
        known = F.size(plain).cast("bigint")

        def place(acc: Column, code: Column) -> Column:
            put = F.struct(
                acc["n"].alias("n"), F.lit(0).cast("bigint").alias("delta"),
                _next_bias(acc["delta"], acc["h"] + 1, acc["h"] == known).alias("bias"),
                (acc["h"] + 1).alias("h"), F.concat(acc["text"], _number(acc["delta"], acc["bias"])).alias("text"),
            )
            more = F.struct(acc["n"], (acc["delta"] + 1).alias("delta"), acc["bias"], acc["h"], acc["text"])
            return F.when(code < acc["n"], more.cast(shape)).when(code == acc["n"], put.cast(shape)).otherwise(acc)

        def point(acc: Column, code: Column) -> Column:
            ready = F.struct(
                code.alias("n"), (acc["delta"] + (code - acc["n"]) * (acc["h"] + 1)).alias("delta"),
                acc["bias"], acc["h"], acc["text"],
            ).cast(shape)
            after = F.aggregate(codes, ready, place)
            return bind(after, lambda a: F.struct(
                (a["n"] + 1).alias("n"), (a["delta"] + 1).alias("delta"), a["bias"], a["h"], a["text"]
            ).cast(shape))

        start = F.struct(
            F.lit(_FIRST_CODE).alias("n"), F.lit(0).alias("delta"), F.lit(_FIRST_BIAS).alias("bias"), known.alias("h"),
            F.when(known > 0, F.concat(plain_text, F.lit("-"))).otherwise("").alias("text"),
        ).cast(shape)
        beyond = F.array_sort(F.array_distinct(F.filter(codes, lambda c: c >= _FIRST_CODE)))
        return F.aggregate(beyond, start, point, lambda acc: acc["text"])

    return bind(F.transform(F.split(label, ""), lambda c: F.ascii(c).cast("bigint")), encoded)


def _ascii_host(origin_: Column) -> Column:
    """The origin with host labels beyond ASCII in their ASCII form."""
    scheme = F.regexp_extract(origin_, "^([a-z]+://)", 1)
    name = F.regexp_extract(origin_, "^[a-z]+://([^:]*)", 1)
    labels = F.transform(F.split(F.lower(name), r"\."), lambda x: F.when(
        x.rlike(r"[^\x00-\x7F]"), F.concat(F.lit("xn--"), ascii_label(x))
    ).otherwise(x))
    port = F.regexp_extract(origin_, "^[a-z]+://[^:]*(:.*)$", 1)
    return F.when(origin_.rlike(r"[^\x00-\x7F]"), F.concat(scheme, F.array_join(labels, "."), port)).otherwise(origin_)


def resolve(url: Column, base: Column) -> Column:
    """``url`` made absolute against an origin.

    Path, query and fragment are percent-encoded as UTF-8, host labels beyond ASCII get their
    ASCII form. A web URL without a usable host cannot be resolved: NULL, so the caller
    keeps its text.
    """
    scheme = first_match(base, r"^([A-Za-z]+:)")

    def made_absolute(u: Column) -> Column:
        return (
            F.when(u.startswith("/") & ~u.startswith("//"), F.concat(base, u))
            .when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), u)
            .when(u.startswith("//"), F.concat(scheme, u))
            .otherwise(F.concat(base, F.lit("/"), u))
        )

    def web(full: Column) -> Column:
        tail = F.regexp_extract(full, _AUTHORITY + r"[^/?#\\\s]*(.*)$", 1)
        return F.concat(bind(origin(full), _ascii_host), bind(tail, tidy))

    def tidy(tail: Column) -> Column:
        path = F.regexp_extract(tail, r"^([^?#]*)", 1)
        query = F.regexp_extract(tail, r"^[^?#]*(\?[^#]*)", 1)
        fragment = F.regexp_extract(tail, r"^[^#]*(#.*)$", 1)
        rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
        return F.concat(
            _escaped(bind(rooted, _squash_dots), _IN_PATH), _escaped(query, _IN_QUERY), _escaped(fragment, _IN_FRAGMENT)
        )

    def finished(full: Column) -> Column:
        plain = full.rlike(r"^https?://[a-z0-9.-]+/[A-Za-z0-9_/=&?,;+%#-]*$")
        return (
            F.when(plain, full)  # already in canonical form
            .when(~full.rlike(r"^(?i)https?:"), full)
            .when(is_web_url(full), web(full))
        )

    return bind(bind(F.trim(url), made_absolute), finished)


def join_query(url: Column, name: str, value: Column) -> Column:
    """Append ``name=value`` with '?' or '&'."""
    sep = F.when(url.contains("?"), "&").otherwise("?")
    return F.concat(url, sep, F.lit(f"{name}="), value.cast("string"))
