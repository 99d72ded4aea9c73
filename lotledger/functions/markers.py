"""Marker tests on page text.

Most markers are plain words. Those are looked up with ``contains`` on text that was
lowered once, which is far cheaper than a case-insensitive regex at every position;
only true patterns go to the regex engine.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def _as_literal(pattern: str) -> str | None:
    plain = pattern.replace(r"\.", "\0")
    if re.search(r"[\\^$*+?{}()\[\].]", plain):
        return None
    return plain.replace("\0", ".")


def has_any(low: Column, alternatives: str) -> Column:
    """Does the lowered text hold one of the '|'-separated alternatives?"""
    tests = []
    for alternative in alternatives.split("|"):
        word = _as_literal(alternative)
        tests.append(
            low.contains(word.lower()) if word is not None else low.rlike(alternative.lower())
        )
    found = tests[0]
    for test in tests[1:]:
        found = found | test
    return F.coalesce(found, F.lit(False))


def first_label(low: Column, signatures: list[tuple[str, str]]) -> Column:
    """The label of the first signature that hits, else NULL."""
    return F.coalesce(*[F.when(has_any(low, p), F.lit(name)) for p, name in signatures])


def literal_map(mapping: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*pairs)


def label_lookup(mapping: dict[str, str], key: Column) -> Column:
    """Look a label up in a fixed table of a few rows (no join needed)."""
    return F.try_element_at(literal_map(mapping), key)
