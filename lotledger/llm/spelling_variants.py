"""Spelling variants: words one edit apart, found by products of letter-count matrices.

One inserted, deleted or replaced letter changes the letter counts of a word by a squared
distance of at most two. The letters are dealt to five parts; such a change touches at most
two of them, so two near words agree in all counts of some three parts. Words are blocked by
these; within a block, lengths are compared with themselves and the next one by a Gram
matrix of the letter counts, and what lies within the distance is verified letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import forget, lower_ascii, settled

RUN = "[A-Za-zÀ-ÿ]+"
PARTS = 5
DROPPED = list(combinations(range(PARTS), 2))  # parts a block does not look at
SLICE = 4096  # words of a block in one slice
TILE = 512


def word_counts(docs: DataFrame, shortest: int = 5, fewest: int = 3) -> DataFrame:
    """``word, n``: the words of ``docs`` (doc_id, text) and how often each occurs.

    A word is a maximal run of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased.
    Where 97 divides the crc32 of ``<doc_id>:<word>``, the letter at crc32 mod length is
    left out. Words of at least ``shortest`` code points and ``fewest`` occurrences stay.
    Null text has no words, a null id counts as an empty one; every row counts by itself.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.char_length("run") >= shortest)  # a shorter run cannot give a word
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    word = F.when(
        F.col("h") % 97 == 0,
        F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run"))),
    ).otherwise(F.col("run"))
    return (
        runs.withColumn("h", h).select(word.alias("word")).filter(F.char_length("word") >= shortest)
        .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= fewest)
    )


def letter_parts(words: DataFrame) -> list[str]:
    """The letters in use, dealt to five parts of about equal weight.

    At most the 90 letters of the alphabet reach the driver.
    """
    counts = (
        words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
        .filter("letter <> ''").collect()
    )
    parts, weights = [""] * PARTS, [0] * PARTS
    for row in sorted(counts, key=lambda r: (-r["count"], r["letter"])):
        least = weights.index(min(weights))
        parts[least] += row["letter"]
        weights[least] += row["count"]
    return parts


def blocks(words: DataFrame, parts: list[str]) -> DataFrame:
    """``dropped, kept, i, j, own, word, n``: each word in the ten blocks it belongs to.

    A block is the letters of the kept parts, sorted. A block of more than ``SLICE`` words
    is dealt to slices, and each pair of slices (i, j) is a task's work of its own.

    The sizes are joined by a merge, whatever Spark takes a side for: it sizes the ten rows
    of a word as one and would send them all through the driver.
    """
    whole = "".join(parts)
    sides = []
    for number, pair in enumerate(DROPPED):
        kept = F.translate("word", "".join(parts[p] for p in pair), "") if whole else F.col("word")
        letters = F.array_join(F.array_sort(F.split(kept, "")), "")
        sides.append(F.struct(F.lit(number).alias("dropped"), letters.alias("kept")))
    dealt = words.select("word", "n", F.explode(F.array(*sides)).alias("b")).select("b.dropped", "b.kept", "word", "n")
    sizes = dealt.groupBy("dropped", "kept").agg(F.count("*").alias("members")).filter("members > 1")
    large = F.ceil(F.col("members") / SLICE).cast("int")
    own = F.pmod(F.xxhash64("word"), F.col("slices")).cast("int")
    return (
        dealt.hint("merge").join(sizes.select("dropped", "kept", large.alias("slices")), ["dropped", "kept"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .select("dropped", "kept", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "word", "n")
    )


def one_edit(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For pairs of words, the second as long or one longer: is it one edit apart?

    Words of up to 64 letters are laid side by side, 20,000 pairs at once, longer ones are
    compared pair by pair.
    """
    out = np.zeros(len(a), dtype=bool)
    sizes = np.array([len(x) for x in b])
    short, long = np.flatnonzero(sizes <= 64), np.flatnonzero(sizes > 64)
    for rows in [*(short[k: k + 20_000] for k in range(0, len(short), 20_000)), *long[:, None]]:
        out[rows] = _one_edit([a[i] for i in rows], [b[i] for i in rows])
    return out


def _one_edit(a: list[bytes], b: list[bytes]) -> np.ndarray:
    width = max(map(len, b)) + 1
    left = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in a), dtype=np.uint8).reshape(len(a), width)
    right = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in b), dtype=np.uint8).reshape(len(b), width)
    level = np.array([len(x) == len(y) for x, y in zip(a, b)])
    same = left == right
    # One letter more: what agrees from the front and, one place on, from the back covers the word.
    front = np.logical_and.accumulate(same[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((left[:, :-1] == right[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return np.where(level, (~same).sum(axis=1) == 1, front + back >= width - 1)


def _near_in_group(
    words: list[bytes], own: np.ndarray, cross: bool, counts: np.ndarray, of_part: np.ndarray, dropped: tuple[int, int],
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows one edit apart that are this block's to report.

    A pair whose change touches one part lies in several blocks: the one that drops it
    together with the first other part reports it.
    """
    sizes = counts.sum(axis=1)
    order = np.argsort(sizes, kind="stable")
    found_a, found_b = [], []
    norms = (counts * counts).sum(axis=1)
    starts = list(range(0, len(order), TILE))
    for s in starts:
        x = order[s: s + TILE]
        for t in range(s, len(order), TILE):
            y = order[t: t + TILE]
            if sizes[y[0]] > sizes[x[-1]] + 1:
                break
            square = norms[x][:, None] + norms[y][None, :] - 2 * (counts[x] @ counts[y].T)
            step = sizes[y][None, :] - sizes[x][:, None]
            ok = ((square == 2) & (step == 0)) | ((square == 1) & (step == 1))
            if s == t:
                # Within a tile: equal lengths once, the shorter word on the left.
                ok &= (step > 0) | (np.arange(len(x))[:, None] < np.arange(len(y))[None, :])
            if cross:
                ok &= own[x][:, None] != own[y][None, :]
            i, j = np.nonzero(ok)
            found_a.append(x[i])
            found_b.append(y[j])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    first, second = dropped
    differ = counts[a] != counts[b]
    in_first = differ[:, of_part == first].any(axis=1)
    in_second = differ[:, of_part == second].any(axis=1)
    partner = lambda p: 1 if p == 0 else 0
    mine = (in_first & in_second) | (in_first & (second == partner(first))) | (in_second & (first == partner(second)))
    a, b = a[mine], b[mine]
    ok = one_edit([words[i] for i in a], [words[i] for i in b])
    return a[ok], b[ok]


def near_words(words: DataFrame, parts: list[str]) -> DataFrame:
    """``word, links, best``: per block the near words of a word, counted, and the best of them.

    ``best`` is a struct of minus the count and the word, so the smallest is the most
    frequent, then the first in code-point order.
    """
    part_of = {ord(c): p for p, letters in enumerate(parts) for c in letters}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(waiting)
            ends = group_ends(table)
            if len(ends):
                yield from links(table.slice(0, ends[-1]), ends[:-1])
                table = table.slice(ends[-1])
            waiting = [table]
        if waiting:
            yield from links(waiting[0], np.zeros(0, dtype=np.int64))

    def group_ends(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows - 1, dtype=bool)
        for name in ("dropped", "kept", "i", "j"):
            column = table.column(name).combine_chunks().dictionary_encode().indices.to_numpy()
            change |= column[1:] != column[:-1]
        return np.flatnonzero(change) + 1

    def links(table: pa.Table, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = table.column("word").to_pylist()
        words_here = [w.encode("latin-1") for w in names]
        n, own, dropped, low, high = (table.column(c).to_numpy() for c in ("n", "own", "dropped", "i", "j"))
        rows_a, rows_b = [], []
        for start, end in zip(np.append(0, ends), np.append(ends, len(names))):
            if end - start < 2:
                continue
            group = words_here[start:end]
            letters = np.frombuffer(b"".join(group), dtype=np.uint8)
            used, column = np.unique(letters, return_inverse=True)
            # Kept parts are equal in the whole block: only their length counts.
            at = np.repeat(np.arange(len(group)), [len(w) for w in group]) * len(used) + column
            counts = np.bincount(at, minlength=len(group) * len(used)).reshape(len(group), len(used))
            small = counts.max() < 256 and counts.sum(axis=1).max() < 2048  # squares stay exact in 32 bits
            a, b = _near_in_group(
                group, own[start:end], low[start] != high[start],
                counts.astype(np.float32 if small else np.float64),
                np.array([part_of[int(u)] for u in used]), DROPPED[dropped[start]],
            )
            rows_a += [a + start, b + start]
            rows_b += [b + start, a + start]
        if not rows_a:
            return
        yield from summed(names, n, np.concatenate(rows_a), np.concatenate(rows_b))

    def summed(names: list[str], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(a):
            return
        rank = np.empty(len(names), dtype=np.int64)  # code-point order
        rank[np.array(sorted(range(len(names)), key=names.__getitem__))] = np.arange(len(names))
        order = np.lexsort((rank[b], -n[b], a))
        a, b = a[order], b[order]
        first = np.append(True, a[1:] != a[:-1])
        starts = np.flatnonzero(first)
        links_of = np.diff(np.append(starts, len(a)))
        best = pa.StructArray.from_arrays(
            [pa.array(-n[b[starts]]), pa.array([names[i] for i in b[starts]])], ["less", "word"]
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in a[starts]]), pa.array(links_of.astype(np.int64)), best], ["word", "links", "best"]
        )

    dealt = blocks(words, parts)
    keys = ["dropped", "kept", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        run, "word string, links long, best struct<less: long, word: string>"
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of rows (word, form): forms followed to the last.

    Each round replaces a form by the form's form, so chains of any length end after a
    logarithmic number of rounds; each round is a written table. Packed files say little of
    the rows' size in memory, so no side is broadcast.
    """
    now = settled(forms.select("word", F.col("form").alias("root")).filter("root is not null"), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(onward.hint("merge"), "root", "left")
        after = settled(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = after.filter("moved").limit(1).count()
        forget(now)
        now = after.drop("moved")
        if not moved:
            return now


def variants(docs: DataFrame, shortest: int = 5, fewest: int = 3) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``docs`` (see ``word_counts``).

    Two words are near if one code point inserted, deleted or replaced makes one the other.
    ``n_near`` counts the near words of a word; ``form`` is the most frequent of them (the
    first in code-point order among equals) if it occurs at least twice as often, else
    null, and ``form_n`` its count. ``root`` follows forms to the last one, the word itself
    if it has none. Rows are found exactly, whatever the sizes of blocks; no documents or
    no words give no rows; other columns of ``docs`` are not read.
    """
    words = settled(word_counts(docs, shortest, fewest), "words")
    near = near_words(words, letter_parts(words)).groupBy("word").agg(
        F.sum("links").alias("n_near"), F.min("best").alias("best")
    )
    joined = words.join(near.hint("merge"), "word", "left")
    strong = -F.col("best.less") >= 2 * F.col("n")
    formed = settled(joined.select(
        "word", F.when(strong, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.less")).alias("form_n"),
    ), "forms")
    return formed.join(roots(formed).hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
