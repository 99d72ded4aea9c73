"""Row helpers that keep costly expressions from being evaluated twice.

Catalyst pushes a filter below the projection that computes its columns, and infers a
``size(array) > 0`` filter below an explode; both copy the expression. Parsing a page is
far too costly to copy, so parsed values pass through a generator, which filters do not
cross.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def explode_rows(df: DataFrame, keep: list[str], items: Column, place: str, name: str) -> DataFrame:
    """``keep..., place, name``: one row per array element, its index and itself."""
    return df.select(*keep, F.posexplode_outer(items).alias(place, name)).filter(
        F.col(place).isNotNull()
    )


def settle(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """``keep...`` plus columns that are computed exactly once per row."""
    one = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.explode_outer(F.array(one)).alias("_settled")).select(
        *keep, *[F.col("_settled")[n].alias(n) for n in columns]
    )
