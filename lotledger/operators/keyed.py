"""Keyed helpers shared by the operators, written for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key.

    Filtering ``row_number() = 1`` lets Spark cut every key to one row per map task
    before the shuffle, so a key that holds a third of all rows ships one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top_per_group(
    df: DataFrame, keys: list[str], order: list[str], k: int, salts: int = 64
) -> DataFrame:
    """The first ``k`` rows per group, exactly.

    The group is ranked in ``salts`` slices first; only ``salts * k`` rows of a group,
    however large it is, meet in the final ranking.
    """
    sliced = df.withColumn(
        "_slice", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(salts))
    )
    cols = [F.col(c) for c in order]
    for group in ([*keys, "_slice"], keys):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*cols))
        sliced = sliced.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")
    return sliced.drop("_slice")


# The driver builds what it broadcasts: some 10 MB of short keys.
BROADCAST_KEYS = 100_000


def sized(keys: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """A table of short keys, marked for broadcast if it has at most ``most`` rows.

    Beyond that the join shuffles both sides. ``keys`` should be cheap to count.
    """
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys


def beside(keys: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """A table of short keys to be joined to a wide one: broadcast if it has at most ``most``
    rows, else hashed where the wide rows lie.

    The wide side is never sorted, and if it is bucketed by the keys it is not moved.
    """
    few = sized(keys, most)
    return few if few is not keys else keys.hint("shuffle_hash")


def dealt(rows: DataFrame, keys: list[str], per_core: int = 4) -> DataFrame:
    """Rows of few bytes but much work, hashed to ``per_core`` parts of every core.

    Spark sizes the parts of a shuffle by bytes: a million short records would be few parts,
    and be parsed by as few tasks. A number of parts that is asked for stays as it is.
    """
    return rows.repartition(per_core * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def join_on_hot_keys(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "inner",
    salts: int = 32,
) -> DataFrame:
    """Join rows to a per-key table where a key may hold a third of the rows.

    The big side is salted by ``spread`` (columns that vary inside a key), the per-key
    table is repeated once per salt: a hot key is read by ``salts`` tasks. The per-key
    table must hold one row per key.
    """
    salted = big.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts)).cast("int")
    )
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
