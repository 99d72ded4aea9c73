"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of seven bytes decides where a chunk ends: a place is a boundary at block size
2^k if its hash ends in k ones. A text takes the smallest block size at which it has at most
64 boundaries; its fingerprint is that size and the signatures, one letter per chunk, at it
and at its next doublings. Two fingerprints are compared by the edit distance of their
signatures at the smallest sizes both have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import free_name, settled

WINDOW = 7
MOST = 64  # boundaries of a signature; one more letter stands for what follows the last
SIZES = 3  # block sizes of a fingerprint, each twice the one before
BLOCK = 1 << 16  # bytes hashed at once
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def place_hashes(data: np.ndarray) -> np.ndarray:
    """One 64-bit hash per byte from ``WINDOW - 1`` on, of that byte and those before it."""
    wide = data.astype(np.uint64)
    size = len(data) - WINDOW + 1
    h = np.zeros(size, dtype=np.uint64)
    for k in range(WINDOW):
        h *= _STEP
        h += wide[k: k + size]
    h ^= h >> np.uint64(29)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return h


class Chunks:
    """Boundaries of a text that is read block by block.

    A level with more than ``MOST`` boundaries cannot be chosen any more, however the text
    goes on, so its boundaries are forgotten: memory is bounded by the block.
    """

    def __init__(self) -> None:
        self.level = 0
        self.total = np.uint64(0)  # sum of the hashes of all places so far
        self.levels = np.zeros(0, dtype=np.uint8)
        self.sums = np.zeros(0, dtype=np.uint64)  # the total at each boundary

    def add(self, data: np.ndarray) -> None:
        h = place_hashes(data)
        sums = np.cumsum(h, dtype=np.uint64) + self.total
        self.total = sums[-1]
        mask = np.uint64((1 << self.level) - 1)
        at = np.flatnonzero((h & mask) == mask)
        ends = ~h[at]
        low = ends & -ends
        levels = np.where(low == 0, 64, np.bitwise_count(low - np.uint64(1))).astype(np.uint8)
        self.levels = np.concatenate([self.levels, levels])
        self.sums = np.concatenate([self.sums, sums[at]])
        while len(self.levels) > MOST:
            self.level += 1
            kept = self.levels >= self.level
            self.levels, self.sums = self.levels[kept], self.sums[kept]

    def signature(self, level: int) -> bytes:
        sums = self.sums[self.levels >= level]
        if not len(sums) or sums[-1] != self.total:
            sums = np.append(sums, self.total)
        parts = np.diff(sums, prepend=np.uint64(0))
        parts *= _MIX
        return LETTERS[(parts >> np.uint64(58)).astype(np.int64)].tobytes()


def fingerprint(data: bytes) -> str:
    """``size:signature:signature at twice the size:...`` of the bytes of a text; ``1:`` for none."""
    if not data:
        return "1:"
    chunks, whole = Chunks(), np.frombuffer(bytes(WINDOW - 1) + data, dtype=np.uint8)
    for at in range(0, len(data), BLOCK):
        chunks.add(whole[at: at + BLOCK + WINDOW - 1])
    k = chunks.level
    return ":".join([str(1 << k), *(chunks.signature(k + i).decode() for i in range(SIZES))])


def edit_distances(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Edit distance (insert, delete, replace) of each pair of strings of at most 65 bytes.

    All pairs advance together, one column of their tables a step; a column is kept as its
    vertical differences.
    """
    if not a:
        return np.zeros(0, dtype=np.int64)
    size_a = np.array([len(x) for x in a])
    size_b = np.array([len(x) for x in b])
    rows, cols = int(size_a.max()), int(size_b.max())
    left = np.zeros((len(a), rows), dtype=np.uint8)
    right = np.zeros((len(b), cols), dtype=np.uint8)
    for table, words in ((left, a), (right, b)):
        for i, word in enumerate(words):
            table[i, : len(word)] = np.frombuffer(word, dtype=np.uint8)
    line = np.broadcast_to(np.arange(rows + 1, dtype=np.int16), (len(a), rows + 1)).copy()
    places = np.arange(rows + 1, dtype=np.int16)
    out = np.where(size_b == 0, size_a, 0)
    for j in range(cols):
        best = np.minimum(line[:, 1:] + 1, line[:, :-1] + (left != right[:, j: j + 1]))
        line = np.concatenate([np.full((len(a), 1), j + 1, dtype=np.int16), best.astype(np.int16)], axis=1)
        # An insertion costs one per place: the running minimum of what lies to the left.
        line = np.minimum.accumulate(line - places, axis=1) + places
        done = size_b == j + 1
        out[done] = line[done, size_a[done]]
    return out


def likenesses(a: list[str], b: list[str]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints.

    1 for equal ones; else 1 - edit distance / longer length of the signatures of a block
    size they share (the better of the two smallest), 0 without one or if the signatures
    have no run of three letters (or a whole shorter one) in common.
    """
    out = np.zeros(len(a))
    at, left, right = [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        if x == y:
            out[i] = 1.0
            continue
        of_x, of_y = by_size(x), by_size(y)
        for size in sorted(of_x.keys() & of_y.keys())[:2]:
            if shares_run(of_x[size], of_y[size]):
                at.append(i)
                left.append(of_x[size].encode())
                right.append(of_y[size].encode())
    if at:
        longest = np.array([max(len(x), len(y)) for x, y in zip(left, right)])
        np.maximum.at(out, at, 1.0 - edit_distances(left, right) / longest)
    return out


def by_size(mark: str) -> dict[int, str]:
    size, *signatures = mark.split(":")
    return {int(size) << i: s for i, s in enumerate(signatures) if s}


def shares_run(a: str, b: str, size: int = 3) -> bool:
    size = min(size, len(a), len(b))
    runs = {a[i: i + size] for i in range(len(a) - size + 1)}
    return any(b[i: i + size] in runs for i in range(len(b) - size + 1))


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` (rounded down) replaced by the beginning of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def judged(keys: list, texts: list[str], prints: list[str], nexts: list[str], next_prints: list[str]) -> dict:
    """The columns of ``with_neighbours`` for texts and those that follow them."""
    changed = [edited(t, f) for t, f in zip(texts, nexts)]
    raw = [c.encode() for c in changed]
    marks = [fingerprint(r) for r in raw]
    return {
        "doc_id": keys, "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(r).hexdigest() for r in raw],
        "fingerprint": prints, "edited_fingerprint": marks,
        "near_edited": likenesses(prints, marks), "near_next": likenesses(prints, next_prints),
    }


COLUMNS = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
SQL_COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
# A text at the edge of a sorted part, kept with the part's number until its neighbour is known.
EDGE = pa.schema([("edge", pa.string()), ("part", pa.int64()), ("text", pa.string())])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``fingerprint`` (null text: the one of empty text).

    Where ``docs`` has such a column already, the new one has underscores before its name.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield values.map(lambda v: fingerprint((v or "").encode()))

    mark = F.pandas_udf(run, "string", F.PandasUDFType.SCALAR_ITER)
    return docs.withColumn(free_name(docs, "fingerprint"), mark(F.col(text)))


def with_neighbours(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    One row per row of ``docs`` (doc_id, text): its fingerprint, that of its text with the
    last floor(n_chars / 4) code points replaced by as many from the beginning of the next
    document's, and the likeness of its fingerprint to both the edited text's and the next
    document's. The next one is that of the following ``doc_id``, the first after the last.

    Null text counts as empty. Rows of one id follow each other by text, null ids come
    first; equal rows are alike. A single row is its own next. No rows give no rows; other
    columns of ``docs`` are not read.

    Rows are sorted by range, each task goes through its part once. The first and last
    text of every part are kept aside and joined by the number of the part.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    digest = F.xxhash64("text")
    sorted_rows = (
        rows.withColumn("digest", digest).repartitionByRange("doc_id", "digest")
        .sortWithinPartitions("doc_id", "digest", "text").select("doc_id", "text")
    )
    made = settled(sorted_rows.mapInArrow(_within_part, SQL_COLUMNS + ", edge string, part long, text string"), "fingerprints")
    inner = made.filter("edge is null").select(*COLUMNS.names)

    # One row per part that has rows: the part that follows, around the end.
    firsts = made.filter("edge = 'first'")
    order = Window.orderBy("part")
    parts = firsts.select("part").withColumn("after", F.lead("part").over(order))
    after = parts.withColumn("after", F.coalesce("after", F.first("part").over(order)))
    heads = firsts.select(F.col("part").alias("after"), F.col("text").alias("next_text"))
    outer = (
        made.filter("edge = 'last'").select("doc_id", "part", "text")
        .join(after, "part").join(heads, "after").select("doc_id", "text", "next_text")
    )
    return inner.unionByName(outer.mapInArrow(_pairs, SQL_COLUMNS))


def _within_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: all but the last of the part are judged, the first and last go on as edges."""
    part = TaskContext.get().partitionId()
    before: tuple | None = None  # id, text and fingerprint of the row that waits for its next
    nothing = lambda schema, n: [pa.nulls(n, f.type) for f in schema]
    names = [*COLUMNS.names, *EDGE.names]

    def edge(kind: str, key, text: str) -> pa.RecordBatch:
        full = [pa.array([key], pa.int64()), *nothing(list(COLUMNS)[1:], 1)]
        return pa.RecordBatch.from_arrays([*full, pa.array([kind]), pa.array([part]), pa.array([text])], names)

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            piece = batch.slice(at, 500)
            keys, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
            prints = [fingerprint(t.encode()) for t in texts]
            if before is None:
                yield edge("first", keys[0], texts[0])
            else:
                keys, texts, prints = [before[0], *keys], [before[1], *texts], [before[2], *prints]
            before = keys[-1], texts[-1], prints[-1]
            if len(keys) > 1:
                made = judged(keys[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
                full = [pa.array(made[f.name], f.type) for f in COLUMNS]
                yield pa.RecordBatch.from_arrays([*full, *nothing(EDGE, len(keys) - 1)], names)
    if before is not None:
        yield edge("last", before[0], before[1])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts, nexts = (c.to_pylist() for c in batch.columns)
        prints = [fingerprint(t.encode()) for t in texts]
        made = judged(keys, texts, prints, nexts, [fingerprint(t.encode()) for t in nexts])
        yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in COLUMNS], COLUMNS.names)
