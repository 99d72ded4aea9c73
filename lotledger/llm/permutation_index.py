"""Nearest neighbours by cosine through an index of ordered pivots."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settled, shared_folder

BLOCK = 4096


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def one_per_id(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, vec`` of usable vectors; of rows that repeat an id the smallest array counts."""
    return (
        vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec"))
        .filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
        .groupBy("vec_id").agg(F.min("vec").alias("vec"))
    )


def scaled(vec: np.ndarray) -> np.ndarray:
    """Rows brought to a largest component of 0.5 to 1 by powers of two: no cosine changes, not
    in its last bit, and no square overflows."""
    return np.ldexp(vec, -np.frexp(np.abs(vec).max(axis=1, keepdims=True))[1])


def units(vec: np.ndarray) -> np.ndarray:
    vec = scaled(vec)
    return vec / np.linalg.norm(vec, axis=1, keepdims=True)


def ordered_pivots(unit: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Per vector its ``length`` nearest pivots, nearest first, ties to the smaller number."""
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :length]


@dataclass(frozen=True)
class Pivots:
    vectors: np.ndarray
    length: int


def choose_pivots(vectors: DataFrame, count: int, length: int, seed: int) -> Pivots:
    """``count`` vectors drawn by hash of the id; all, where there are fewer."""
    rows = vectors.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(count).collect()
    found = np.array([r["vec"] for r in rows], dtype=float).reshape(len(rows), -1)
    if len(rows):
        found = units(found)
    return Pivots(found, min(length, len(rows)))


def build_index(vectors: DataFrame, pivots: Pivots, blocks: int) -> DataFrame:
    """Every vector, in blocks of at most ``BLOCK``, each with its inverted files.

    A row is one block: ids, vectors, and per pivot the posting list of (vector, place of
    the pivot in the vector's order), stored one after another with ``starts``. A vector is
    posted under its ``length`` nearest pivots.
    """
    n_pivots = len(pivots.vectors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.iloc[at: at + BLOCK]
                vec = scaled(np.array(part["vec"].tolist(), dtype=float))
                order = ordered_pivots(units(vec), pivots.vectors, pivots.length)
                pivot = order.ravel()
                sort = np.argsort(pivot, kind="stable")
                starts = np.searchsorted(pivot[sort], np.arange(n_pivots + 1))
                yield pd.DataFrame({
                    "ids": [part["vec_id"].to_numpy(np.int64).tobytes()], "vecs": [vec.tobytes()],
                    "starts": [starts.astype(np.int64).tobytes()],
                    "members": [(sort // pivots.length).astype(np.int32).tobytes()],
                    "places": [(sort % pivots.length).astype(np.int32).tobytes()],
                })

    dealt = vectors.select("vec_id", "vec").repartition(blocks, F.xxhash64("vec_id"))
    return dealt.mapInPandas(run, "ids binary, vecs binary, starts binary, members binary, places binary")


def search_blocks(
    index: DataFrame, ids: np.ndarray, vecs: np.ndarray, pivots: Pivots, k: int, share: float
) -> DataFrame:
    """Per task the ``k`` nearest of each query among its blocks: query_id, vec_id, score.

    In a block, the posting lists of a query's pivots are added up. A vector sharing pivot
    p gains ``length - max(place in query, place in vector)``: twice the gain is what the
    footrule distance of the two orders (a missing pivot stands at place ``length``) falls
    below its largest value. The ``share`` of the block with the smallest footrule
    distance is reranked by the exact cosine.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        near_one = scaled(vecs)
        norms = np.linalg.norm(near_one, axis=1)
        orders = ordered_pivots(near_one / norms[:, None], pivots.vectors, pivots.length)
        best: list[list[tuple[float, int]]] = [[] for _ in ids]
        for batch in batches:
            for row in batch.itertuples(index=False):
                own = np.frombuffer(row.ids, dtype=np.int64)
                mat = np.frombuffer(row.vecs).reshape(len(own), -1)
                own_norms = np.linalg.norm(mat, axis=1)
                starts = np.frombuffer(row.starts, dtype=np.int64)
                members = np.frombuffer(row.members, dtype=np.int32)
                places = np.frombuffer(row.places, dtype=np.int32)
                take = min(len(own), int(np.ceil(share * len(own))) + k + 1)
                for q in range(len(ids)):
                    gain = np.zeros(len(own), dtype=np.int64)
                    for place, pivot in enumerate(orders[q]):
                        a, b = starts[pivot], starts[pivot + 1]
                        gain[members[a:b]] += pivots.length - np.maximum(places[a:b], place)
                    near = np.argpartition(-gain, take - 1)[:take] if take < len(own) else np.arange(len(own))
                    near = near[own[near] != ids[q]]
                    score = (mat[near] @ near_one[q]) / (own_norms[near] * norms[q])
                    top = np.lexsort((own[near], -score))[:k]
                    best[q] = sorted(best[q] + [(-float(score[i]), int(own[near[i]])) for i in top])[:k]
        rows = [(int(ids[q]), v, -s) for q, found in enumerate(best) for s, v in found]
        yield pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return index.mapInPandas(run, "query_id long, vec_id long, score double")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
    pivots: int = 256, length: int = 64, share: float = 0.2, chunk: int = 4096, seed: int = 23,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every query row.

    ``is_query``: a condition on the id column, as ``vec_id``. Every usable vector is
    indexed and is a candidate of every query but itself. Pivots are a sample of at most
    ``pivots`` vectors. The candidates that are reranked are a fixed share of all vectors,
    the same at every size, chosen per block of the index; blocks are dealt by hash.

    Queries are taken in chunks of about ``chunk``, each sent to the tasks that hold the
    index; the written index is read again for the next chunk. Only the ``k`` best of a
    task per query are shuffled.

    Null, zero, empty or non-finite vectors, and null ids, take no part. Vectors of different
    length have no cosine: each length has an index of its own and is searched by itself.
    Rows that repeat an id are one vector, the smallest array. Ties go to the smaller id.
    Fewer than ``k`` candidates give fewer rows; no vectors give none.
    """
    spark = vectors.sparkSession
    clean = settled(one_per_id(vectors, vec_id, embedding), "ann-vectors")
    widths = clean.groupBy(F.size("vec").alias("d")).agg(
        F.count("*").alias("n"), F.count_if(is_query).alias("queries")
    ).filter("queries > 0").orderBy("d").collect()
    folder, found = shared_folder(spark, "ann-found"), None
    for width in widths:
        own = clean.filter(F.size("vec") == width["d"])
        chosen = choose_pivots(own, pivots, length, seed)
        index = settled(build_index(own, chosen, -(-width["n"] // BLOCK)), "ann-index")
        rounds = max(1, -(-width["queries"] // chunk))
        for i in range(rounds):
            part = own.filter(is_query).filter(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(rounds)) == i)
            part = part.orderBy("vec_id").collect()
            if part:
                ids = np.array([r["vec_id"] for r in part], dtype=np.int64)
                vecs = np.array([r["vec"] for r in part], dtype=float)
                hits = search_blocks(index, ids, vecs, chosen, k, share)
                hits.write.mode("append").parquet(folder)
                found = spark.read.schema(hits.schema).parquet(folder)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
