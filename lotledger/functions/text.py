"""Text and number coercions on columns (all JVM expressions)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F



def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), 0)


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The regex group of the first match, NULL where there is none or it is empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


# white space a script trims: ASCII blanks, no-break and Unicode spaces, line and
# paragraph separators, byte-order mark
SCRIPT_BLANKS = (
    "\t\n\x0b\x0c\r \xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def trimmed(text: Column) -> Column:
    """Trim Unicode white space; empty becomes NULL."""
    return F.nullif(F.btrim(text, F.lit(SCRIPT_BLANKS)), F.lit(""))


def spaced(text: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(text, r"(?U)[\s﻿]+", " ")


def visible_text(markup: Column) -> Column:
    """Tags out, a few entities decoded, spaces collapsed, trimmed."""
    bare = F.regexp_replace(markup, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&#36;", "$"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.trim(spaced(bare))


def at_most(text: Column, limit: int | None) -> Column:
    """The first ``limit`` characters; the whole text without a limit."""
    return text if limit is None else F.left(text, F.lit(limit))


def to_int(text: Column) -> Column:
    """Keep digits and '-', read the leading integer: '12.5' is 125.

    Beyond 32 bits the result is NULL.
    """
    kept = F.regexp_replace(text, "[^0-9-]", "")
    return first_match(kept, "^(-?[0-9]+)").try_cast("int")


def to_float(text: Column) -> Column:
    """Keep digits, '.' and '-', read the leading number: '1.2.3' is 1.2."""
    kept = F.regexp_replace(text, "[^0-9.-]", "")
    return first_match(kept, r"^(-?(?:[0-9]+\.?[0-9]*|\.[0-9]+))").try_cast("double")


def vin_rule(text: Column) -> Column:
    """11 characters or more stay, upper case; shorter ones are no VIN."""
    return F.when(F.length(text) >= 11, F.upper(text))


def year_rule(year: Column, run_year: int) -> Column:
    """Outside 1950..run year + 2 is NULL, but 0 stays 0."""
    return F.when((year == 0) | year.between(1950, run_year + 2), year)


def condition_rule(text: Column) -> Column:
    low = F.lower(text)
    return (
        F.when(low.contains("cert"), "certified")
        .when(low.contains("new") | low.contains("nuevo"), "new")
        .when(low.contains("used") | low.contains("usado") | low.contains("pre"), "used")
        .otherwise(text)
    )


def rounded_share(part: Column, whole: Column) -> Column:
    """Whole percent, halves up."""
    return F.floor(F.lit(100.0) * part / whole + 0.5).cast("bigint")


def null_safe_key(*columns: Column) -> Column:
    """The columns as one '|'-joined text, NULL spelled out."""
    return F.concat_ws(
        "|", *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns]
    )
