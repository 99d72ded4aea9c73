"""Mixing sources to target weights by fitting word budgets from counts by exact length."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import by_size, free_name, settled, word_count

SLICES = 256


def water_filled(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Targets: the total shared by weight, none above ``most`` times its size.

    What a source cannot take is shared again by weight among the others, until none is
    above. Sources without words get 0.
    """
    target = [0.0] * len(sizes)
    free = {i for i, s in enumerate(sizes) if s > 0}
    left = float(sum(sizes))
    while free:
        unit = left / sum(weights[i] for i in free)
        full = {i for i in free if unit * weights[i] > most * sizes[i]}
        if not full:
            for i in free:
                target[i] = unit * weights[i]
            break
        for i in full:
            target[i] = float(most * sizes[i])
            left -= target[i]
        free -= full
    return target


def fill_budget(lengths: np.ndarray, available: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest below ``budget``.

    Bounded knapsack over reachable sums: counts are split into binary lots, each lot is
    used once, and the first lot that reaches a sum is kept for the way back.
    """
    taken = np.zeros(len(lengths), dtype=np.int64)
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    first = np.full(budget + 1, -1, dtype=np.int64)
    lots: list[tuple[int, int]] = []
    for i, (length, n) in enumerate(zip(lengths.tolist(), available.tolist())):
        n, lot = min(n, budget // length), 1
        while n > 0 and not reached[budget]:
            lot = min(lot, n)
            step = length * lot
            new = np.flatnonzero(reached[: budget + 1 - step] & ~reached[step:]) + step
            first[new] = len(lots)
            reached[new] = True
            lots.append((i, lot))
            n, lot = n - lot, lot * 2
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, lot = lots[first[at]]
        taken[i] += lot
        at -= int(lengths[i]) * lot
    return taken


def fit_lengths(
    lengths: np.ndarray, counts: np.ndarray, target: float, most: int, window: int, seed: int
) -> tuple[int, np.ndarray]:
    """(copies every document gets, further documents per length) for one source.

    Whole passes first. Of the rest all but ``window`` words are shared out: every length
    gives its proportional part, single documents in seeded order bring the remainder down
    to ``window`` words, and the knapsack fills it. One more short document is taken if that
    ends nearer to the target.
    """
    extra = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if total == 0:
        return 0, extra
    copies = min(most, int(target // total))
    rest = int(round(target - copies * total))
    if copies == most or rest <= 0:
        return copies, extra
    word = np.flatnonzero(lengths > 0)
    extra[word] = [int(c) * max(0, rest - window) // total for c in counts[word]]
    rest -= int((lengths * extra).sum())
    order = np.random.default_rng(seed).permutation(word)
    moved = True
    while rest > window and moved:
        moved = False
        for i in order:
            if rest <= window:
                break
            if lengths[i] <= rest and extra[i] < counts[i]:
                extra[i] += 1
                rest -= int(lengths[i])
                moved = True
    if 0 < rest <= window:
        open_ = order[(lengths[order] <= rest) & (extra[order] < counts[order])]
        if len(open_):
            got = fill_budget(lengths[open_], (counts - extra)[open_], rest)
            extra[open_] += got
            rest -= int((lengths[open_] * got).sum())
    open_ = word[extra[word] < counts[word]]
    if rest > 0 and len(open_):
        short = open_[np.argmin(lengths[open_])]
        if lengths[short] - rest < rest:
            extra[short] += 1
    return copies, extra


def source_targets(sizes: DataFrame, weights: list[float], most: float) -> DataFrame:
    """``source, source_size, target``. Sources by code point, null last, take the weights in turn.

    One row per source passes through the driver, as the weights do that a user sets.
    """
    rows = sizes.collect()
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    size = [int(r["source_size"]) for r in rows]
    target = water_filled(size, [float(weights[i % len(weights)]) for i in range(len(rows))], most)
    return sizes.sparkSession.createDataFrame(
        [(r["source"], s, t) for r, s, t in zip(rows, size, target)],
        "source string, source_size long, target double",
    )


def decide(docs: DataFrame, weights: list[float], **options) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every row of ``docs``.

    ``docs``: doc_id, text, source; other columns are not read. Size is the number of words,
    0 for a null or empty text; such documents take part with 0 words. ``copies`` is how
    often the mix takes the document, 0 to ``most``. Null is a source of its own. Rows that
    repeat an id are documents of their own; which of several equal ones is taken is open,
    how many is not. Empty input gives no rows.

    Documents are counted by (source, exact length); one source's counts, never its
    documents, meet in a task. Which documents of a length are taken goes by a seeded hash
    of the id: hash slices are counted, and only the slice in which the last one falls is
    ranked, so a length shared by a third of all rows is cut in ``SLICES``. For a null id the
    text is hashed in its place. ``options`` are those of ``decided_rows``.
    """
    return decided_rows(docs, weights, **options).drop("row")


def decided_rows(
    docs: DataFrame, weights: list[float], most: int = 3, window: int = 16384, seed: int = 17
) -> DataFrame:
    """The columns of ``decide`` and ``row``, the hash of the row's text."""
    sized = settled(
        docs.select(
            "doc_id", F.xxhash64("text").alias("row"), "source", word_count(F.col("text")).alias("size")
        ).withColumn(
            "draw", F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "row")).otherwise(F.xxhash64(F.lit(seed), "doc_id"))
        ), "mix-sizes",
    )
    counts = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(sizes, weights, most)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", ignore_index=True)
        base, extra = fit_lengths(
            group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64),
            float(group["target"].iloc[0]), most, window, seed,
        )
        return pd.DataFrame({
            "source": group["source"], "size": group["size"], "n": group["n"],
            "source_size": group["source_size"], "target": group["target"],
            "base": base, "extra": extra,
        })

    counted = counts.alias("c").join(
        targets.alias("t"), F.expr("c.source <=> t.source")
    ).select("c.source", "c.size", "c.n", "t.source_size", "t.target")
    fitted = settled(
        counted.groupBy("source").applyInPandas(
            fit, "source string, size long, n long, source_size long, target double, base long, extra long"
        ), "mix-fit",
    ).withColumnRenamed("source", "of").withColumnRenamed("size", "length")
    all_ = settled(
        sized.join(fitted, F.expr("source <=> of and size = length")).drop("of", "length")
        .withColumn("slice", F.pmod("draw", F.lit(SLICES)).cast("int")), "mix-drawn",
    )
    # Slices of the lengths of which some, but not all, get one more copy.
    some = all_.filter("extra > 0 and extra < n")
    slices = some.groupBy("source", "size", "slice").agg(F.count("*").alias("here"))
    before = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0))).select(
        F.col("source").alias("of"), F.col("size").alias("length"), F.col("slice").alias("cut"), "here", "before")
    drawn = some.join(slices, F.expr("source <=> of and size = length and slice = cut")).drop("of", "length", "cut")
    cols = ["doc_id", "row", "source", "size", "source_size", "target"]
    within = drawn.filter("before < extra and before + here > extra")
    place = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("draw", "doc_id", "row"))
    return (
        all_.filter("extra = 0 or extra = n")
        .select(*cols, (F.col("base") + F.when(F.col("extra") > 0, 1).otherwise(0)).alias("copies"))
        .unionAll(drawn.filter("before >= extra or before + here <= extra").select(
            *cols, (F.col("base") + F.when(F.col("before") < F.col("extra"), 1).otherwise(0)).alias("copies")))
        .unionAll(within.withColumn("place", place).select(
            *cols, (F.col("base") + F.when(F.col("place") <= F.col("extra") - F.col("before"), 1).otherwise(0)).alias("copies")))
    )


def mixed(docs: DataFrame, weights: list[float], **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; all columns are kept.

    Every row has its own number of copies, also with a null id or an id that stands on
    different texts. Rows that repeat id, source and text share the copies they got.
    """
    id_, row, of = (free_name(docs, f"mix_{c}") for c in ("id", "row", "source"))
    rows, low, more, n = (free_name(docs, f"mix_{c}") for c in ("rows", "low", "more", "copies"))
    taken = settled(
        decided_rows(docs, weights, **options)
        .groupBy(F.col("doc_id").alias(id_), F.col("row").alias(row), F.col("source").alias(of)).agg(
            F.count("*").alias(rows), F.min("copies").alias(low), F.sum("copies").alias(more)
        ).withColumn(more, F.col(more) - F.col(rows) * F.col(low)), "mix-taken",
    ).filter(F.col(low) + F.col(more) > 0)
    both = docs.join(
        by_size(taken), F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(row))
        & F.col("source").eqNullSafe(F.col(of)),
    )
    if taken.filter(F.col(rows) > 1).isEmpty():
        counted = both.withColumn(n, F.col(low))
    else:
        # Copies of equal rows differ by one at most: the first ``more`` of them get it.
        place = F.row_number().over(Window.partitionBy(id_, row, of).orderBy(F.to_json(F.struct(*docs.columns))))
        counted = both.withColumn(n, F.col(low) + F.when(place <= F.col(more), 1).otherwise(0)).filter(F.col(n) > 0)
    return counted.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n).cast("long")))).select(*docs.columns)
