"""How quality filters interact: posting lists of failing documents, merged in every order.

Per part and range of ids, each filter has the sorted list of the rows that fail it. The
union of the lists of a set of filters is what these remove together, whatever their order;
the difference of one more list to that union is what a filter removes after them. Unions
and differences are galloping merges; their sizes are summed over the ranges.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, settled

RANGE = 1 << 16  # rows of a part in one range of ids


def word_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, doc_id, A, B, C, D, E, good, toxic`` per row of ``docs`` (doc_id, text, source).

    E: a row of smaller id has the same text. A null id is neither smaller nor larger.
    ``good`` and ``toxic``: some row of ``labels`` with this id has quality 1, toxic 1.
    Texts are compared by their SHA-256; they are read once and are not shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    one = settled(docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("digest"),
        *[c.alias(k) for k, c in word_filters(F.col("text")).items()],
    ), "filters")
    # Few texts have copies; a text that is a third of all rows is one row of this table.
    least = one.filter("doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")
    ).filter("least < most").select("digest", "least")
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max((F.col("quality") == 1)).alias("good"), F.max((F.col("toxic") == 1)).alias("toxic")
    )
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(32).cast("long"))
    copies = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(31).cast("long"))))
    return (
        one.withColumn("salt", salt).join(copies, ["digest", "salt"], "left")
        .join(marks, F.col("doc_id") == F.col("label_id"), "left")
        .select(
            "part", "doc_id", "A", "B", "C", "D",
            F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False)).alias("E"),
            F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
    )


def posting_lists(rows: DataFrame, lists: list[str]) -> DataFrame:
    """``part, first_id, rows`` and one sorted array of row places per name of ``lists``.

    ``rows``: part, doc_id and a boolean per list. Rows are sorted by part and id and cut to
    ranges of at most 65,536 rows of one part; a place is a row's number within its range,
    so repeated and null ids (first) stay apart. A part of any size is many ranges.
    """
    schema = ", ".join(["part string, first_id long, rows long", *[f"`{c}` array<int>" for c in lists]])

    def row(part: str, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        places = [np.flatnonzero(table.column(c).to_numpy()).astype(np.int32) for c in lists]
        return pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([table.column("doc_id")[0].as_py()], pa.int64()),
             pa.array([table.num_rows], pa.int64()), *[pa.array([p], pa.list_(pa.int32())) for p in places]],
            ["part", "first_id", "rows", *lists],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size = None, [], 0
        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy()
            cuts = np.flatnonzero(np.diff(code)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if end == start:
                    continue
                at = start
                while at < end:
                    if size and (names[code[start]] != part or size == RANGE):
                        yield row(part, held)
                        held, size = [], 0
                    part = names[code[start]]
                    take = min(end - at, RANGE - size)
                    held.append(batch.slice(at, take))
                    size += take
                    at += take
        if size:
            yield row(part, held)

    sorted_rows = rows.select("part", "doc_id", *lists).repartitionByRange("part", "doc_id")
    return sorted_rows.sortWithinPartitions("part", "doc_id").mapInArrow(run, schema)


def gallop(values: np.ndarray, at: int, target: int) -> int:
    """The first place from ``at`` on whose value is not below ``target``: doubling steps, then bisection."""
    step, low = 1, at
    while at < len(values) and values[at] < target:
        low, at, step = at + 1, at + step, 2 * step
    return low + int(np.searchsorted(values[low: min(at + 1, len(values))], target))


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The values of ``a`` that are not in ``b``; both sorted without repeats."""
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        end = gallop(a, i, b[j])  # a run of a below the next of b stays whole
        out.append(a[i:end])
        i = end
        if i < len(a):
            j = gallop(b, j, a[i])
            # Equal runs are skipped at once.
            both = min(len(a) - i, len(b) - j)
            same = a[i: i + both] == b[j: j + both]
            equal = both if same.all() else int(same.argmin())
            i, j = i + equal, j + equal
    out.append(a[i:])
    return np.concatenate(out)


def union(lists: list[np.ndarray]) -> np.ndarray:
    """All values of sorted lists, once each, by a merge of all lists at the same time.

    The list with the smallest head gives its run up to the smallest head of the others.
    """
    out, at = [], [0] * len(lists)
    while True:
        heads = sorted((int(x[i]), k) for k, (x, i) in enumerate(zip(lists, at)) if i < len(x))
        if not heads:
            return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)
        low, k = heads[0]
        if len(heads) == 1:
            out.append(lists[k][at[k]:])
            at[k] = len(lists[k])
        elif heads[1][0] == low:
            out.append(lists[k][at[k]: at[k] + 1])
            for value, other in heads:
                if value == low:
                    at[other] += 1
        else:
            end = gallop(lists[k], at[k], heads[1][0])
            out.append(lists[k][at[k]: end])
            at[k] = end


def set_sizes(postings: DataFrame, filters: list[str], marks: list[str]) -> DataFrame:
    """``part, name, before, after, removed`` and a count per mark, summed over the ranges.

    ``before`` is a set of filters that ran (their letters in order), ``name`` one that did
    not; ``removed`` rows fail it and none of ``before``. ``after`` counts rows the union
    of ``before`` and ``name`` leaves.
    """
    schema = pa.schema([
        ("part", pa.string()), ("name", pa.string()), ("before", pa.string()), ("failing", pa.int64()),
        ("removed", pa.int64()), ("kept", pa.int64()), *[(m, pa.int64()) for m in marks],
    ])

    def sizes(part: str, rows: int, lists: dict[str, np.ndarray]) -> Iterator[tuple]:
        unions = {"": np.zeros(0, dtype=np.int32)}
        for k in range(1, len(filters) + 1):
            for chosen in combinations(filters, k):
                unions["".join(chosen)] = union([lists[f] for f in chosen])
        for before, gone in unions.items():
            for name in filters:
                if name not in before:
                    removed = difference(lists[name], gone)
                    together = "".join(f for f in filters if f in before or f == name)
                    marked = [len(m) - len(difference(m, removed)) for m in (lists[m] for m in marks)]
                    yield part, name, before, len(lists[name]), len(removed), rows - len(unions[together]), *marked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                lists = {c: batch.column(c)[r].values.to_numpy() for c in [*filters, *marks]}
                rows = list(sizes(batch.column("part")[r].as_py(), batch.column("rows")[r].as_py(), lists))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema.names
                )

    counted = ["failing", "removed", "kept", *marks]
    made = postings.select("part", "rows", *filters, *marks).mapInArrow(
        run, "part string, name string, before string, " + ", ".join(f"`{c}` long" for c in counted)
    )
    return made.groupBy("part", "name", "before").agg(*[F.sum(c).alias(c) for c in counted])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The effect of filters A to E on every part in all 120 orders, one row per step.

    ``part`` (source; null: empty), ``filter_order``, ``step`` (1 to 5), ``kept`` after the
    step, ``removed`` by it, ``redundant`` (fail its filter, removed earlier),
    ``unique_fails`` (fail its filter only), ``good_lost`` and ``toxic_lost`` (removed by
    it, labelled quality 1, toxic 1), ``shapley`` (removed by its filter in all 120 orders).

    Null and empty texts fail A only (and E as copies of each other); repeated rows count
    each; rows with null id are never copies; a part with no failing row has rows of zeros;
    no documents give no rows; other columns are not read.
    """
    filters, marks = list("ABCDE"), ["good", "toxic"]
    postings = settled(posting_lists(judged(docs, labels), [*filters, *marks]), "postings")
    sizes = settled(set_sizes(postings, filters, marks), "set-sizes")
    # The filter after ``before`` runs in |before|! orders of those, times the orders of the rest.
    weight = F.element_at(F.array(*[F.lit(factorial(k) * factorial(len(filters) - 1 - k)) for k in range(len(filters))]), F.length("before") + 1)
    alone = F.when(F.length("before") == len(filters) - 1, F.col("removed"))
    per_filter = sizes.groupBy("part", "name").agg(
        F.sum(weight * F.col("removed")).cast("long").alias("shapley"), F.max(alone).alias("unique_fails")
    )
    spark = docs.sparkSession
    steps = spark.createDataFrame([
        ("".join(order), k + 1, order[k], "".join(sorted(order[:k])))
        for order in permutations(filters) for k in range(len(filters))
    ], "filter_order string, step int, name string, before string")
    # Both sides of these joins are small by nature: 80 rows a part, 600 steps.
    return (
        sizes.join(per_filter, ["part", "name"]).join(F.broadcast(steps), ["name", "before"])
        .select(
            "part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
            "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
        )
    )
