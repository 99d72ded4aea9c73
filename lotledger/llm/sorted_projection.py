"""Near-duplicate vectors by sorted random-projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import settled
from .components import star_components
from .permutation_index import one_per_id, units

BITS = 62
BLOCK = 512
PIECE = 4096


def lot_bits(count: int, window: int) -> int:
    """First bits of a code that would part ``count`` evenly spread rows into lots of half a window."""
    return min(BITS, max(1, math.ceil(math.log2(max(2.0, 2.0 * count / window)))))


def passes_needed(count: int, window: int, cosine: float, miss: float) -> int:
    """Passes after which a pair at the threshold is missed with chance ``miss``.

    A pass finds a pair if the two agree in the first ``lot_bits``: lots of up to ``window``
    rows lie in the window, larger ones are compared by ``crowded_pairs``. One bit agrees
    with chance 1 - angle / pi.
    """
    found = (1.0 - math.acos(cosine) / math.pi) ** lot_bits(count, window)
    return max(8, math.ceil(math.log(miss) / math.log(1.0 - found)))


def hash_codes(unit: np.ndarray, seed: int) -> np.ndarray:
    """``BITS`` sign bits of random projections as one number; its order is lexicographic."""
    planes = np.random.default_rng(seed).normal(size=(unit.shape[1], BITS))
    return ((unit @ planes) >= 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def sorted_codes(vectors: DataFrame, passes: int, seed: int) -> DataFrame:
    """``lot, code, node, place`` of ``vectors`` (node, vec): every pass in order, numbered from 0.

    A lot is one pass over vectors of one length.
    """

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, part in batch.groupby(batch["vec"].map(len)):
                unit = units(np.array(part["vec"].tolist(), dtype=float))
                for p in range(passes):
                    yield pd.DataFrame({
                        "lot": width * passes + p, "code": hash_codes(unit, seed + p), "node": part["node"],
                    })

    made = settled(
        vectors.select("node", "vec").mapInPandas(coded, "lot int, code long, node long")
        .repartitionByRange("lot", "code", "node").sortWithinPartitions("lot", "code", "node")
        .withColumn("number", F.monotonically_increasing_id()), "projection-codes",
    )
    # The upper bits of a number are its partition's; one row per partition is collected.
    of = F.shiftright("number", 33)
    sizes = made.groupBy(of.alias("of")).agg(F.count("*").alias("n")).orderBy("of").collect()
    before, total = [], 0
    for r in sizes:
        before.append((r["of"], total))
        total += r["n"]
    starts = made.sparkSession.createDataFrame(before, "of long, before long")
    return made.withColumn("of", of).join(F.broadcast(starts), "of").select(
        "lot", "code", "node", (F.col("before") + F.col("number").bitwiseAND((1 << 33) - 1)).alias("place")
    )


def window_pairs(codes: DataFrame, vectors: DataFrame, window: int, cosine: float) -> DataFrame:
    """Verified pairs (a, b), a < b, within ``window`` rows of each other in any pass.

    The sorted rows are cut into pieces of ``PIECE``; the last ``window`` rows of a piece
    are copied to the next one, so no pair is lost between two.
    """

    def pairs(part: pd.DataFrame, old: int) -> pd.DataFrame:
        """Close pairs within the window, the later of which is not among the ``old`` first rows."""
        unit = np.frombuffer(b"".join(part["unit"])).reshape(len(part), -1)
        node, a, b = part["node"].to_numpy(), [], []
        for step in range(1, min(window, len(part) - 1) + 1):
            first = max(0, old - step)
            left, right = unit[first: len(part) - step], unit[first + step:]
            at = np.flatnonzero(np.einsum("ij,ij->i", left, right) >= cosine) + first
            a.append(node[at])
            b.append(node[at + step])
        a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (a, b))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for batch in batches:
            for at, part in batch.groupby(["piece", "lot"], sort=True):
                part = part[["piece", "lot", "node"]].assign(unit=[u.tobytes() for u in units(np.array(part["vec"].tolist(), dtype=float))])
                old = 0
                if tail is not None and (tail["piece"].iloc[0], tail["lot"].iloc[0]) == at:
                    old, part = len(tail), pd.concat([tail, part], ignore_index=True)
                tail = part.iloc[-window:]
                yield pairs(part, old)

    length = max(PIECE, window)
    own = F.floor(F.col("place") / length).cast("long")
    last = F.col("place") % length >= length - window
    dealt = codes.withColumn("piece", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own))))
    rows = dealt.join(vectors.select("node", "vec"), "node").select("piece", "lot", "place", "node", "vec")
    return rows.repartition("piece").sortWithinPartitions("piece", "place").mapInPandas(
        compare, "a long, b long"
    ).distinct()


def crowded_pairs(
    codes: DataFrame, vectors: DataFrame, named: DataFrame, bits: int, window: int, cosine: float
) -> DataFrame | None:
    """Links (a, b) between components among vectors that agree in ``bits`` first bits, in lots
    of more than ``window`` rows; None without such a lot.

    The rows of a lot are cut into blocks of about ``BLOCK``: a component of more rows has
    blocks of its own, the others share some. A task gets two blocks, unless both are of
    one component, and returns one link for each two components.
    """
    key = ["lot", "prefix"]
    owned = codes.withColumn("prefix", F.shiftrightunsigned("code", BITS - bits)).join(
        named, "node", "left"
    ).select(*key, "node", F.coalesce("component", "node").alias("component"))
    mixed = owned.groupBy(*key).agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    ).filter(f"n > {window} and low <> high").select(*key)
    rows = settled(owned.join(mixed, key), "projection-crowded")
    if rows.isEmpty():
        return None
    cells = rows.groupBy(*key, "component").agg(F.count("*").alias("size"))
    shared = cells.filter(f"size <= {BLOCK}").groupBy(*key).agg(F.sum("size").alias("together"))
    large = F.col("size") > BLOCK
    cells = cells.join(shared, key, "left").select(
        *key, "component", F.when(large, F.col("component")).alias("own"),
        F.ceil(F.when(large, F.col("size")).otherwise(F.col("together")) / BLOCK).cast("int").alias("blocks"),
    )
    part = F.pmod(F.when(F.col("own").isNull(), F.xxhash64("component")).otherwise(F.xxhash64("node")), F.col("blocks"))
    placed = settled(
        rows.join(cells, [*key, "component"]).withColumn("no", F.xxhash64(F.col("own").isNull(), "own", part))
        .select(*key, "node", "component", "own", "no"), "projection-blocks",
    )
    blocks = placed.select(*key, "own", "no").distinct()
    other = blocks.select(*key, F.col("own").alias("own_j"), F.col("no").alias("j"))
    both = blocks.withColumnRenamed("no", "i").join(other, key).filter(
        "i <= j and (own is null or own_j is null or own <> own_j)"
    ).select(*key, "i", "j")
    dealt = placed.join(both.withColumn("no", F.explode(F.array_distinct(F.array("i", "j")))), [*key, "no"])
    full = dealt.join(vectors.select("node", "vec"), "node").select(*key, "i", "j", "no", "node", "component", "vec")

    def close(part: pd.DataFrame) -> pd.DataFrame:
        unit = units(np.array(part["vec"].tolist(), dtype=float))
        node, of, no = (part[c].to_numpy() for c in ("node", "component", "no"))
        left, right = np.flatnonzero(no == part["i"].iloc[0]), np.flatnonzero(no == part["j"].iloc[0])
        apart = of[left][:, None] != of[right][None, :]
        x, y = np.nonzero(apart & (unit[left] @ unit[right].T >= cosine))
        ends = np.sort(np.stack([of[left[x]], of[right[y]]], axis=1), axis=1)
        one = np.unique(ends, axis=0, return_index=True)[1]
        a, b = node[left[x[one]]], node[right[y[one]]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return full.groupBy(*key, "i", "j").applyInPandas(close, "a long, b long")


def count_links(members: DataFrame, cosine: float) -> DataFrame:
    """``node, links``: how many vectors of its component each vector links with.

    ``members``: component, node, vec, copies. A component is cut into blocks of about
    ``BLOCK`` by hash; a task gets two blocks and returns sums per vector, never pairs.
    Components of one block are put together in lots. A vector counts with its copies.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size")).withColumn(
        "blocks", F.ceil(F.col("size") / BLOCK).cast("int")
    )
    total = sizes.filter("blocks = 1").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    lots = max(1, -(-int(total) // (4 * BLOCK)))
    dealt = members.join(sizes, "component").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    small = dealt.filter("blocks = 1").withColumn("lot", F.pmod(F.xxhash64("component"), F.lit(lots)))

    def linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x @ y.T) >= cosine

    def unit_rows(rows: pd.DataFrame) -> np.ndarray:
        return units(np.array(rows["vec"].tolist(), dtype=float).reshape(len(rows), -1))

    def lot(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in rows.groupby("component"):
            unit, copies = unit_rows(part), part["copies"].to_numpy()
            close = linked(unit, unit)
            np.fill_diagonal(close, False)
            out.append(pd.DataFrame({"node": part["node"], "links": close @ copies}))
        return pd.concat(out)

    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        left, right = rows[rows["block"] == i], rows[rows["block"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "links": []})
        close = linked(unit_rows(left), unit_rows(right))
        if i == j:
            np.fill_diagonal(close, False)
            return pd.DataFrame({"node": left["node"], "links": close @ left["copies"].to_numpy()})
        return pd.concat([
            pd.DataFrame({"node": left["node"], "links": close @ right["copies"].to_numpy()}),
            pd.DataFrame({"node": right["node"], "links": close.T @ left["copies"].to_numpy()}),
        ])

    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    large = (
        dealt.filter("blocks > 1").withColumn("other", other)
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    )
    shape = "node long, links long"
    return (
        small.groupBy("lot").applyInPandas(lot, shape)
        .unionAll(large.groupBy("component", "i", "j").applyInPandas(pair, shape))
        .groupBy("node").agg(F.sum("links").alias("links"))
    )


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.9, window: int = 32, miss: float = 0.005, seed: int = 29,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Equal vectors are one class, represented by the smallest id. Classes are sorted by
    concatenated random-projection hashes in several passes, neighbours within ``window``
    are verified by cosine, and the pairs of all passes are united to components. Lots of
    equal first bits that are larger than the window are then compared across components.
    The number of passes follows from the number of classes so that a pair at the threshold
    is missed with chance ``miss``, however crowded its lots are. Links are then counted within components over all pairs,
    window or not.

    Null, empty, zero and non-finite vectors have no links and are their own component.
    Vectors of different length do not link. An id is one vector: of rows that repeat an
    id the smallest array counts, and all get its result. A null id has a null component
    and is kept. Empty input gives no rows.
    """
    ids = one_per_id(vectors, vec_id, embedding)
    owned = settled(ids, "projection-vectors")
    classes = settled(
        owned.groupBy("vec").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")),
        "projection-classes",
    )
    count = classes.count()
    codes = sorted_codes(classes, passes_needed(count, window, cosine, miss), seed)
    pairs = settled(window_pairs(codes, classes, window, cosine), "projection-pairs")
    named = settled(star_components(pairs, "projection-components"), "projection-named")
    more = crowded_pairs(codes, classes, named, lot_bits(count, window), window, cosine)
    if more is not None:
        named = settled(star_components(pairs.unionAll(more), "projection-components"), "projection-named")
    links = count_links(classes.join(named, "node").select("component", "node", "vec", "copies"), cosine)
    known = settled(
        classes.join(named, "node", "left").join(links, "node", "left").select(
            "vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
            F.coalesce("component", "node").alias("c"),
        ), "projection-known",
    )
    by_id = owned.join(known, "vec").select(F.col("vec_id").alias("id"), "n", "c")
    rows = vectors.select(F.col(vec_id).alias("vec_id"))
    return rows.join(by_id, F.col("vec_id") == F.col("id"), "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
