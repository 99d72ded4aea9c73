"""Connected components of an edge table by rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import forget, settled


# Up to so many edges, a few megabytes, a round is the work of one task and needs no shuffle.
FEW_EDGES = 200_000


def _pull(edges: DataFrame, keep: str) -> DataFrame:
    """Hang the neighbours of each node below the smallest node of its neighbourhood.

    ``edges`` is (a, b). A minimum per node is a partial aggregation; the join is on the
    node, and a node with very many neighbours is split by the adaptive skew join.
    """
    low = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return edges.join(low, "a").filter(keep)


def star_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for every node of an edge, the component being its smallest node.

    ``edges``: columns ``a`` and ``b`` of one orderable type; direction, repeats and loops
    do not matter, rows with a null end are skipped. No edges give no rows. Each round
    links the larger neighbours of a node to the smallest (large star), then the smaller
    ones (small star), until every component is a star; that takes a logarithmic number of
    rounds. A round over at most ``FEW_EDGES`` edges runs in one task. Each round is a written
    table, so a lost executor costs one round at most.
    """
    both = edges.filter("a is not null and b is not null and a <> b")
    now = settled(
        both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        name,
    )
    state = lambda t: t.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).first()
    seen = state(now)
    while True:
        facing = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if seen[0] <= FEW_EDGES:
            facing = facing.coalesce(1)
        large = _pull(facing, "b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(
                F.struct(F.col("a"), F.col("m").alias("b")),
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            )).alias("e"))
            .select("e.*").filter("a <> b").distinct()
        )
        after = settled(small, name)
        before, seen = seen, state(after)
        forget(now)
        now = after
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
