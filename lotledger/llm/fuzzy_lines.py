"""Near-duplicate lines by MinHash over character shingles.

Lines are cut, folded, posted, grouped and taken out by DataFrame operations. Signatures and
the exact comparison of lines that share a bucket run over arrays in the tasks: a hash per
window by native functions alone costs more than the whole job may.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import by_size, free_name, settled
from .components import star_components

SHINGLE = 8
ROWS, BANDS = 3, 8
PLACES = 1 << 31
LAST = (1 << 63) - 1
# Lines of a bucket, and their bytes, that one task compares with each other.
SLICE, SLICE_BYTES = 2048, 1 << 20
# Bands whose buckets are compared first; the others only where they still join components.
FIRST_BANDS = 2
CHUNK = 1 << 18  # bytes of lines that become arrays at once
# Up to so many documents' dropped line numbers may be broadcast; more are joined by shuffle.
BROADCAST_DOCS = 200_000


def seat_of(key: Column, place: Column) -> Column:
    return (key.cast("decimal(20,0)") * F.lit(PLACES) + place).cast("decimal(31,0)")


def row_keys(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the key of each row as column ``name``.

    Where every row has an id of its own, that is doc_id, or the largest long for a null
    id. Else the rows' distinct (doc_id, hash of the text) are numbered in this order, null
    ids last: only rows that repeat both an id and a text share a key.
    """
    id_ = F.col("doc_id").cast("long")
    alone = F.coalesce(id_, F.lit(LAST))
    if docs.groupBy(alone.alias("id")).count().filter("count > 1").isEmpty():
        return docs.withColumn(name, alone)
    of, hash_ = free_name(docs, "line_id"), free_name(docs, "line_hash")
    known = docs.withColumn(of, id_).withColumn(hash_, F.xxhash64("text"))
    order = [F.col("of").asc_nulls_last(), F.col("hash")]
    pairs = known.select(F.col(of).alias("of"), F.col(hash_).alias("hash")).distinct()
    numbered = settled(
        pairs.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("of", "hash", F.monotonically_increasing_id().alias("number")), "line-rows",
    ).select(*[F.col(c).alias(f"{name}_{c}") for c in ("of", "hash", "number")])
    return known.join(
        by_size(numbered), F.col(of).eqNullSafe(F.col(f"{name}_of")) & (F.col(hash_) == F.col(f"{name}_hash"))
    ).select(*docs.columns, F.col(f"{name}_number").alias(name))


def lines_of(docs: DataFrame, key: str) -> DataFrame:
    """``key, place, line, seat``: the lines with text, stripped of blanks at both ends.

    ``key`` names the column of ``row_keys``. ``seat`` orders all lines by document, then
    place in it.
    """
    return docs.select(F.col(key).alias("key"), F.posexplode(F.split("text", "\n")).alias("place", "line")).select(
        "key", "place", F.btrim("line", F.lit(" \t\r")).alias("line"),
        seat_of(F.col("key"), F.col("place")).alias("seat"),
    ).filter("line <> ''")


def line_keys(line: Column) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), F.reverse(line)).alias("h2")]


def window_words(raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every window of ``SHINGLE`` bytes as one number, and the line it belongs to.

    A line of fewer bytes has no window: it resembles no other line.
    """
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset: raw.offset + len(raw) + 1].astype(np.int64)
    sizes = np.diff(offsets)
    counts = np.maximum(sizes - (SHINGLE - 1), 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    data = memoryview(raw.buffers()[2])[low:high]
    words = np.empty(high - low - SHINGLE + 1, dtype=np.uint64)
    for shift in range(min(SHINGLE, len(words))):
        part = words[shift::SHINGLE]
        part[:] = np.frombuffer(data, dtype="<u8", offset=shift, count=len(part))
    line = np.repeat(np.arange(len(raw)), counts)
    first = np.cumsum(counts) - counts
    return words[np.arange(total) - first[line] + (offsets[:-1] - low)[line]], line


def mixed(words: np.ndarray) -> np.ndarray:
    h = words * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def band_keys(raw: pa.Array) -> list[list[int]]:
    """The buckets of each line, by band; a band without any window is left out.

    One permutation: the windows' hashes are dealt to ``ROWS * BANDS`` classes, and the
    smallest of each class is kept.
    """
    words, line = window_words(raw)
    classes = ROWS * BANDS
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.full(len(raw) * classes, none)
    h = mixed(words)
    np.minimum.at(least, line * classes + ((h >> np.uint64(1)) % np.uint64(classes)).astype(np.int64), h)
    least = least.reshape(len(raw), BANDS, ROWS)
    keys = np.full((len(raw), BANDS), 0, dtype=np.uint64)
    for k in range(ROWS):
        keys = mixed(keys ^ least[:, :, k])
    keys = (keys & ~np.uint64(BANDS - 1)) | np.arange(BANDS, dtype=np.uint64)  # a key tells its band
    there = (least != none).any(axis=2)
    return [row[on].tolist() for row, on in zip(keys.view(np.int64), there)]


def slices(raw: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of lines of about ``CHUNK`` bytes, at least one line each."""
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset: raw.offset + len(raw) + 1]
    at = 0
    while at < len(raw):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        yield at, end
        at = end


def signatures(lines: DataFrame) -> DataFrame:
    """One row per distinct line: h1, h2, seat (its first), n (times it stands), bands.

    Equal lines are folded before they are shuffled.
    """
    distinct = lines.select(*line_keys(F.col("line")), "line", "seat").groupBy("h1", "h2").agg(
        F.max("line").alias("line"), F.min("seat").alias("seat"), F.count("*").alias("n")
    ).select("h1", "h2", F.col("seat").cast("string").alias("seat"), "n", F.col("line").cast("binary").alias("raw"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in slices(batch.column(4)):
                part = batch.slice(at, end - at)
                keys = pa.array(band_keys(part.column(4)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns[:4], keys], ["h1", "h2", "seat", "n", "bands"])

    return distinct.mapInArrow(sign, "h1 long, h2 long, seat string, n long, bands array<long>").withColumn(
        "seat", F.col("seat").cast("decimal(31,0)")
    )


def bands(signed: DataFrame) -> DataFrame:
    """``band, line``: the buckets of each line."""
    return signed.select("line", F.explode("bands").alias("band"))


class Bucket:
    """Lines of one bucket as sets of window numbers, small integers of the bucket's own."""

    def __init__(self, raw: pa.Array, component: np.ndarray):
        words, line = window_words(raw)
        order = np.lexsort((words, line))
        words, line = words[order], line[order]
        fresh = np.append(True, (words[1:] != words[:-1]) | (line[1:] != line[:-1])) if len(words) else np.zeros(0, bool)
        words, self.line = words[fresh], line[fresh]
        values, self.token = np.unique(words, return_inverse=True)
        self.sizes = np.bincount(self.line, minlength=len(raw))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flags = np.zeros(len(values), dtype=bool)
        self.root = np.unique(component, return_inverse=True)[1]
        self.links: list[tuple[int, int]] = []
        self.tried: set[tuple[int, int]] = set()

    def tokens(self, i: int) -> np.ndarray:
        return self.token[self.starts[i]: self.starts[i] + self.sizes[i]]

    def common(self, head: int, others: np.ndarray) -> np.ndarray:
        """How many windows of ``head`` each of the others has."""
        own = self.tokens(head)
        self.flags[own] = True
        counts = self.sizes[others]
        ends = np.cumsum(counts)
        at = np.arange(int(ends[-1])) - np.repeat(ends - counts, counts) + np.repeat(self.starts[others], counts)
        found = np.add.reduceat(self.flags[self.token[at]].astype(np.int64), ends - counts)
        self.flags[own] = False
        return found

    def compare(self, head: int, others: np.ndarray, num: int, den: int) -> None:
        """Link ``head`` to those of ``others`` in other components that reach the similarity."""
        others = others[self.root[others] != self.root[head]]
        small, large = np.minimum(self.sizes[others], self.sizes[head]), np.maximum(self.sizes[others], self.sizes[head])
        others = others[(small > 0) & (den * small >= num * large)]
        others = np.array([o for o in others.tolist() if (head, o) not in self.tried], dtype=np.int64)
        if not len(others):
            return
        both = self.common(head, others)
        self.tried.update((head, o) for o in others.tolist())
        for o in others[den * both >= num * (self.sizes[others] + self.sizes[head] - both)].tolist():
            if self.root[o] != self.root[head]:
                self.links.append((head, o))
                self.root[self.root == self.root[o]] = self.root[head]

    def prefixes(self, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """(token, line) of the rarest windows of each line, by token.

        Two lines that reach the similarity share one of their n - ceil(n num / den) + 1
        rarest windows, in any order all lines agree on.
        """
        rarity = np.bincount(self.token)[self.token]
        order = np.lexsort((self.token, rarity, self.line))
        token, line = self.token[order], self.line[order]
        place = np.arange(len(line)) - self.starts[line]
        kept = place < (self.sizes - -(-num * self.sizes // den) + 1)[line]
        token, line = token[kept], line[kept]
        by = np.argsort(token, kind="stable")
        return token[by], line[by]

    def find(self, num: int, den: int) -> list[tuple[int, int]]:
        """Links that join all lines of the bucket that some chain of links joins."""
        if len(self.sizes) == 2:
            self.compare(0, np.array([1]), num, den)
            return self.links
        token, line = self.prefixes(num, den)
        cuts = np.flatnonzero(np.diff(token)) + 1
        for start, end in zip(np.append(0, cuts).tolist(), np.append(cuts, len(token)).tolist()):
            group = line[start:end]
            while len(group) > 1 and (self.root[group] != self.root[group[0]]).any():
                self.compare(int(group[0]), group[1:], num, den)
                group = group[1:]
        return self.links


def ratio(similarity: float) -> tuple[int, int]:
    """The threshold in whole numbers, as given to three digits."""
    return round(1000 * similarity), 1000


def bucket_links(rows: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join what is similar within buckets; ``rows``: band, slices, line,
    component, raw.

    A bucket of several slices is dealt to them; a task has two at a time. Lines go through a
    task bucket by bucket; what it returns is at most one link per line.
    """
    num, den = ratio(similarity)
    cut = rows.withColumn(
        "own", F.pmod(F.xxhash64("line"), F.col("slices")).cast("int")
    )
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select(
        "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "line", "component", "raw"
    )
    keys = ["band", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(pa.Table.from_batches([batch]))
            key = np.stack([batch.column(k).to_numpy() for k in range(3)])
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            before = waiting[0].slice(0, 1)
            if len(waiting) > 1 and any(before.column(k)[0] != batch.column(k)[0] for k in range(3)):
                change = np.append(0, change)
            if not len(change):
                continue
            held = sum(t.num_rows for t in waiting[:-1])
            table = pa.concat_tables(waiting).combine_chunks()
            ends = change + held
            yield from found(table.slice(0, ends[-1]), ends[:-1])
            waiting = [table.slice(ends[-1])]
        if waiting:
            yield from found(pa.concat_tables(waiting).combine_chunks(), np.zeros(0, dtype=np.int64))

    def found(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        line, component = table.column("line").to_numpy(), table.column("component").to_numpy()
        raw = table.column("raw").chunk(0)
        a, b = [], []
        for start, end in zip(np.append(0, cuts).tolist(), np.append(cuts, len(line)).tolist()):
            if end - start > 1:
                links = Bucket(raw.slice(start, end - start), component[start:end]).find(num, den)
                a += [line[start + x] for x, _ in links]
                b += [line[start + y] for _, y in links]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys, "line").mapInArrow(run, "a long, b long").distinct()


def leader_links(rows: DataFrame, similarity: float) -> DataFrame:
    """Links (leader, line) of crowded buckets; ``rows``: band, leader, line, raw.

    A bucket's leader goes to each of its slices of about ``SLICE`` lines and comes first;
    the others stream past it.
    """
    num, den = ratio(similarity)
    part = F.pmod(F.xxhash64("line"), F.ceil(F.col("members") / SLICE)).cast("int")
    heads = rows.filter("line = leader").select(
        "band", F.explode(F.sequence(F.lit(0), F.ceil(F.col("members") / SLICE).cast("int") - 1)).alias("part"),
        F.lit(0).alias("late"), "line", "raw",
    )
    dealt = heads.unionAll(rows.filter("line <> leader").select("band", part.alias("part"), F.lit(1).alias("late"), "line", "raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            a, b = [], []
            late = batch.column(2).to_numpy()
            heads_at = np.flatnonzero(late == 0)
            for start, end in zip(np.append(0, heads_at).tolist(), np.append(heads_at, len(late)).tolist()):
                if end == start:
                    continue
                if late[start] == 0:
                    head, own = batch.column(3)[start].as_py(), np.unique(window_words(batch.column(4).slice(start, 1))[0])
                    start += 1
                lines, raw = batch.column(3).to_numpy()[start:end], batch.column(4).slice(start, end - start)
                for low, high in slices(raw):
                    words, line = window_words(raw.slice(low, high - low))
                    order = np.lexsort((words, line))
                    words, line = words[order], line[order]
                    fresh = np.append(True, (words[1:] != words[:-1]) | (line[1:] != line[:-1])) if len(words) else np.zeros(0, bool)
                    words, line = words[fresh], line[fresh]
                    sizes = np.bincount(line, minlength=high - low)
                    both = np.bincount(line, np.isin(words, own), minlength=high - low).astype(np.int64)
                    ok = (sizes > 0) & (den * both >= num * (sizes + len(own) - both))
                    b += lines[low:high][ok].tolist()
                    a += [head] * int(ok.sum())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.repartition("band", "part").sortWithinPartitions("band", "part", "late").mapInArrow(
        run, "a long, b long"
    ).distinct()


def texts_of(docs: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``line, raw, size`` of the wanted lines (line, seat), read where each first stands.

    The seats of one document are put together first, so documents are not repeated.
    """
    place = F.expr(f"cast(pmod(seat, {PLACES}) as int)")
    seats = wanted.select("line", place.alias("place"), F.expr(
        f"cast((seat - pmod(seat, {PLACES})) div {PLACES} as bigint)").alias("key"))
    small = settled(seats, "line-wanted")
    lists = small.groupBy("key").agg(F.collect_list(F.struct("place", "line")).alias("wanted"))
    fits = lists.count() <= BROADCAST_DOCS
    keyed = docs.select(F.col(key).alias("key"), "text")
    found = keyed.join(F.broadcast(lists) if fits else lists, "key").select(
        F.split("text", "\n").alias("lines"), F.explode("wanted").alias("w")
    ).select(
        F.col("w.line").alias("line"),
        F.btrim(F.get("lines", F.col("w.place")), F.lit(" \t\r")).cast("binary").alias("raw"),
    ).filter("raw is not null")
    # Rows that repeat an id and a text would repeat the line.
    return found.groupBy("line").agg(F.max("raw").alias("raw")).withColumn("size", F.octet_length("raw"))


def grouped(posted: DataFrame, named: DataFrame | None) -> DataFrame:
    if named is None:
        return posted.withColumn("component", F.col("line"))
    return posted.join(named.withColumnRenamed("node", "line"), "line", "left").select(
        "band", "line", F.coalesce("component", "line").alias("component")
    )


def open_buckets(now: DataFrame, turn: int) -> DataFrame:
    """The rows of buckets with more than one component, their leader and their number."""
    flip = F.xxhash64(F.lit(turn))
    mixed = now.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"),
        F.min(F.col("line").bitwiseXOR(flip)).bitwiseXOR(flip).alias("leader"),
    ).filter("low <> high").select("band", "leader", "members")
    return now.join(mixed, "band")


def link_lines(docs: DataFrame, key: str, posted: DataFrame, signed: DataFrame, similarity: float) -> DataFrame | None:
    """``node, component`` of the linked lines; None without a link.

    Only buckets of several lines, not all in one component, are looked at. Crowded ones
    (over ``SLICE`` lines) are compared with a leader in rounds first, while a quarter of their
    lines link, so that a large group of copies becomes one component. Then the lines of
    each bucket are compared with each other: first the buckets of two bands, then those
    of the other bands that components still share.
    """
    shared = posted.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    posted = settled(posted.join(shared, "band", "left_semi"), "line-posted")
    wanted = posted.select("line").distinct().join(signed.select("line", "seat"), "line")
    texts = settled(texts_of(docs, key, wanted), "line-texts")
    edges = named = None

    def open_now(some: DataFrame, turn: int) -> DataFrame:
        return settled(open_buckets(grouped(some, named), turn), "line-mixed")

    def linked(found: DataFrame) -> int:
        nonlocal edges, named
        found = settled(found, "line-links")
        many = found.count()
        if many:
            edges = found if edges is None else settled(edges.unionAll(found), "line-edges")
            named = settled(star_components(edges, "line-rounds"), "line-named")
        return many

    turn = 0
    while True:
        crowded = open_now(posted, turn).filter(f"members > {SLICE}")
        asked = crowded.filter("line <> leader").count()
        if asked == 0:
            break
        turn += 1
        if linked(leader_links(crowded.join(texts, "line").select("band", "members", "leader", "line", "raw"), similarity)) < asked / 4:
            break
    band = F.pmod(F.col("band"), F.lit(BANDS))
    for some in (posted.filter(band < FIRST_BANDS), posted.filter(band >= FIRST_BANDS)):
        rows = open_now(some, turn)
        sizes = rows.join(texts.select("line", "size"), "line").groupBy("band").agg(
            F.ceil(F.greatest(F.count("*") / SLICE, F.sum("size") / SLICE_BYTES)).cast("int").alias("slices")
        )
        full = rows.join(sizes, "band").join(texts, "line").select("band", "slices", "line", "component", "raw")
        linked(bucket_links(full, similarity))
    return named


def dedup_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` with repeated lines taken out of ``text``.

    Returns all columns of ``docs``; ``text`` without the dropped lines, in order. Columns
    ``n_lines`` (lines with text) and ``n_dropped`` follow; where ``docs`` has such
    columns, the new ones get an underscore before their name.

    Lines are what stands between line feeds, compared without blanks, tabs and carriage
    returns at both ends. Two lines link when the Jaccard similarity of their sets of 8-byte
    windows is ``similarity`` or more; equal lines always do. Of each component the first
    line by (doc_id, place) stays, wherever it stands. Lines without text are never dropped.
    Candidates come from 8 bands of 3 one-permutation MinHash values: a pair at 0.8 is found
    with a chance of 99.7 %, more similar ones more surely.

    A null text stays null, a text of which all lines go becomes empty. Each row is a
    document of its own, also with a null id (these come last) or an id that stands on
    different texts (by hash of the text). Only rows that repeat both id and text are the
    same document and stay alike. Lines shorter than 8 bytes are one window. Empty input
    gives no rows.
    """
    own, columns = free_name(docs, "line_row"), docs.columns
    docs = row_keys(docs, own)
    lines = lines_of(docs, own)
    signed = settled(
        signatures(lines).withColumn("line", F.monotonically_increasing_id()), "line-signatures"
    )
    named = link_lines(docs, own, bands(signed), signed, similarity)
    firsts = signed.select("line", "h1", "h2", "seat", "n")
    if named is None:
        keepers = firsts.withColumn("keep", F.col("seat")).filter("n > 1")
    else:
        known = firsts.join(named.withColumnRenamed("node", "line"), "line", "left")
        best = known.filter("component is not null").groupBy("component").agg(F.min("seat").alias("keep"))
        keepers = known.join(best, "component", "left").withColumn(
            "keep", F.coalesce("keep", "seat")
        ).filter("n > 1 or keep <> seat")
    dropped = lines.select("key", "place", "seat", *line_keys(F.col("line"))).join(
        keepers.select("h1", "h2", "keep"), ["h1", "h2"]
    ).filter("seat <> keep")
    lists = settled(
        dropped.groupBy("key").agg(F.collect_set("place").alias("places")), "line-dropped"
    )
    key, out = free_name(docs, "line_key"), free_name(docs, "line_places")
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    fits = lists.count() <= BROADCAST_DOCS
    lists = lists.select(F.col("key").alias(key), F.col("places").alias(out))
    joined = docs.join(F.broadcast(lists) if fits else lists, F.col(own) == F.col(key), "left")
    parts = F.split("text", "\n")
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col(out), i)), "\n")
    return joined.select(
        *[
            F.when(F.col(out).isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(c)
            for c in columns
        ],
        F.coalesce(F.size(F.filter(parts, lambda x: F.btrim(x, F.lit(" \t\r")) != "")), F.lit(0)).alias(n_lines),
        F.coalesce(F.size(F.col(out)), F.lit(0)).alias(n_dropped),
    )
