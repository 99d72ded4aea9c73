"""Joining documents by the Jaccard similarity of their word shingles, by signature trees.

The similarity is ``num / den`` or more, five words a shingle. The join is exact. Sets are
routed to blocks by their rarest shingles, so that linked sets share a block; a block's
sets form signature trees, whose nodes hold OR-combined bitmaps and size ranges, and a
dual traversal gives the pairs that are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, by_size, forget, free_name, settled
from .components import star_components

WORDS = 5
NUM, DEN = 4, 5
SKETCH_BITS = 18
SLICES = 64
SIGNATURE, WIDEST = 1024, 1 << 15  # bits of a narrow and of the widest bitmap
FAN = 8
BLOCK = 1024
LINKED, WIDE = 512, 4096  # sets of a component in a slice, shingles in a matrix
CROWD = FAN
LISTED = 16  # crowded blocks a set knows by name
PIECE = 1 << 20
KEPT_WORDS = 100_000
MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Distinct shingle hashes of a text given as bytes; word hashes are kept while few."""

    def __init__(self) -> None:
        self.seen: dict[bytes, int] = {}

    def words(self, text: bytes) -> np.ndarray:
        seen, parts, at = self.seen, [], 0
        while at < len(text):
            # A piece ends before a blank, so no word is cut.
            end = at + PIECE
            while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
                end += 1
            out = []
            for word in text[at:end].lower().split():
                h = seen.get(word)
                if h is None:
                    if len(seen) > KEPT_WORDS:
                        seen.clear()
                    h = seen[word] = xxhash.xxh64_intdigest(word)
                out.append(h)
            parts.append(np.array(out, dtype=np.uint64))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles; fewer words than five are one shingle."""
        words = self.words(text) if text else np.zeros(0, dtype=np.uint64)
        if not len(words):
            return words
        width = min(WORDS, len(words))
        n = len(words) - width + 1
        out = np.full(n, width, dtype=np.uint64)
        for k in range(width):
            out = (out ^ words[k: k + n]) * MIX
            out ^= out >> np.uint64(29)
        return np.unique(out)


def fingerprint(shingles: np.ndarray) -> int:
    """One number for a set, as a signed long."""
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def prefix_length(n: int) -> int:
    """Two sets that link share one of so many first shingles of each, in any common order."""
    return n - -(-NUM * n // DEN) + 1


def signature(shingles: np.ndarray, widest: int = SIGNATURE) -> np.ndarray:
    """A bitmap of four bits or more a shingle, within ``SIGNATURE`` and ``widest`` bits."""
    size = min(widest, max(SIGNATURE, 1 << (4 * len(shingles) - 1).bit_length()))
    bits = np.zeros(size, dtype=bool)
    bits[(shingles >> np.uint64(40)) % np.uint64(size)] = True
    return np.packbits(bits)


def folded(bitmaps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps of ``size`` bits or more as rows of exactly so many, in 64-bit words.

    A place of a wide bitmap is the place in a narrower one times a power of two apart, so
    folding a bitmap over itself gives the narrow bitmap of the same set.
    """
    out = np.empty((len(bitmaps), size // 64), dtype=np.uint64)
    for i, raw in enumerate(bitmaps):
        words = np.frombuffer(raw, dtype=np.uint64).reshape(-1, size // 64)
        out[i] = words[0] if len(words) == 1 else np.bitwise_or.reduce(words, axis=0)
    return out


def wide_enough(n: np.ndarray, bitmaps: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs (x, y) of sets their whole bitmaps leave room for a link."""
    sizes = np.array([8 * len(b) for b in bitmaps])
    ok = np.ones(len(x), dtype=bool)
    narrow = np.minimum(sizes[x], sizes[y])
    for size in np.unique(narrow[narrow > SIGNATURE]).tolist():
        here = np.flatnonzero(narrow == size)
        for at in range(0, len(here), 4096):
            part = here[at: at + 4096]
            used, place = np.unique(np.concatenate([x[part], y[part]]), return_inverse=True)
            bits = folded([bitmaps[i] for i in used.tolist()], size)
            slack = n[used] - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
            node = (n[used], n[used], slack, bits, np.full(len(used), -1))
            ok[part] = may_link(node, place[: len(part)], node, place[len(part):])
    return ok


def shingle_counts(docs: DataFrame) -> np.ndarray:
    """How many shingles of all texts fall into each of 2^18 slots.

    Counted over all documents. Each task returns its counts in ``SLICES`` rows, which are
    added up slice by slice; what reaches the driver is the sum, of fixed size.
    """
    width = (1 << SKETCH_BITS) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total = Shingler(), np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                s = shingler.shingles(text.as_buffer().to_pybytes() if text.is_valid else None)
                np.add.at(total, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        yield rows(total)

    def rows(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "slice": pa.array(range(SLICES), pa.int32()),
            "counts": pa.array([total[i * width: (i + 1) * width].tobytes() for i in range(SLICES)], pa.binary()),
        })

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, dtype=np.int64)
        for part in table.column("counts"):
            total += np.frombuffer(part.as_py(), dtype=np.int64)
        return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    shape = "slice int, counts binary"
    summed = docs.select(F.col("text").cast("binary")).mapInArrow(count, shape).groupBy("slice").applyInArrow(add, shape)
    out = np.zeros((SLICES, width), dtype=np.int64)
    for r in summed.collect():
        out[r["slice"]] = np.frombuffer(bytes(r["counts"]), dtype=np.int64)
    return out.ravel()


def shingle_sets(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """``doc_id, row, n, fp, prefix, bits`` per row: hash of the text, size, fingerprint, rarest
    shingles, signature.

    The common order is by slot count, then hash: a shingle of a passage that many
    documents share comes last, so it is in the prefix of few. Rows without a shingle have
    n 0 and nulls.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n, fp, prefix, bits = [], [], [], []
                for text in part.column(2):
                    s = shingler.shingles(text.as_buffer().to_pybytes() if text.is_valid else None)
                    n.append(len(s))
                    if not len(s):
                        fp.append(None), prefix.append(None), bits.append(None)
                        continue
                    rare = np.argsort(counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                    fp.append(fingerprint(s))
                    prefix.append(s[rare[: prefix_length(len(s))]].view(np.int64))
                    bits.append(signature(s).tobytes())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.int64()),
                    pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                ], ["doc_id", "row", "n", "fp", "prefix", "bits"])

    return docs.select("doc_id", F.xxhash64("text").alias("row"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, row long, n long, fp long, prefix array<long>, bits binary"
    )


def shared_postings(sets: DataFrame) -> DataFrame:
    """``token, fp``: the postings of the tokens that more than one set has in its prefix.

    Postings are dealt by token, in slices by set where the token's slot is crowded would
    not be exact; instead they are sorted and streamed, so no posting list is held.
    """
    postings = sets.select(F.explode("prefix").alias("token"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row of a batch waits: the next one may continue its list.
        last_token = last_fp = None
        emitted = False
        for batch in batches:
            token = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy()
            if not len(token):
                continue
            if last_token is not None:
                token, fp = np.append(last_token, token), np.append(last_fp, fp)
            same = token[1:] == token[:-1]
            keep = np.append(same, False)
            keep[1:] |= same
            if emitted:
                keep[0] = False
            last_token, last_fp = token[-1], fp[-1]
            emitted = bool(keep[-1])
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(fp[keep])], ["token", "fp"])

    dealt = postings.repartition("token").sortWithinPartitions("token")
    return dealt.mapInArrow(run, "token long, fp long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link; ``texts``: fp, text.

    A head's text is sent once to each slice of its partners, not once per pair; a slice
    has about 512 partners, and is streamed.
    """
    slices = pairs.groupBy("a").agg(F.ceil(F.count("*") / 512).cast("int").alias("slices"))
    dealt = pairs.join(slices, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int").alias("slice"), "b"
    )
    heads = slices.select("a", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    rows = heads.join(texts, F.col("a") == F.col("fp")).select(
        "a", "slice", F.lit(None).cast("long").alias("b"), "text"
    ).unionAll(dealt.join(texts, F.col("b") == F.col("fp")).select("a", "slice", "b", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, head = Shingler(), None
        for batch in batches:
            a, b = [], []
            for x, y, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                s = shingler.shingles(text.as_buffer().to_pybytes())
                if y is None:
                    head = s
                    continue
                both = len(np.intersect1d(head, s, assume_unique=True))
                if DEN * both >= NUM * (len(head) + len(s) - both):
                    a.append(x), b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.repartition("a", "slice").sortWithinPartitions(
        "a", "slice", F.col("b").asc_nulls_first()
    ).mapInArrow(run, "a long, b long")


class Tree:
    """A signature tree over sets sorted by size; level 0 holds the sets themselves."""

    def __init__(self, n: np.ndarray, bits: np.ndarray, group: np.ndarray):
        slack = n - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(n, n, slack, bits, group)]
        while len(self.levels[-1][0]) > 1:
            low, high, slack, bits, group = self.levels[-1]
            starts = np.arange(0, len(low), FAN)
            same = np.minimum.reduceat(group, starts) == np.maximum.reduceat(group, starts)
            self.levels.append((
                np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts),
                np.maximum.reduceat(slack, starts), np.bitwise_or.reduceat(bits, starts, axis=0),
                # A node of several components, or holding one, has no group: -1.
                np.where(same, group[starts], -1),
            ))


def may_link(x: tuple, i: np.ndarray, y: tuple, j: np.ndarray) -> np.ndarray:
    """Whether nodes i of x and j of y can hold linked sets of different components.

    Shared shingles set common bits: a set of n shingles and p bits has at most
    n - p + (bits in common) shingles in common with anything below the other node.
    """
    low_x, high_x, slack_x, bits_x, group_x = x
    low_y, high_y, slack_y, bits_y, group_y = y
    common = np.bitwise_count(bits_x[i] & bits_y[j]).sum(axis=1).astype(np.int64)
    most = np.minimum(np.minimum(high_x[i], high_y[j]), np.minimum(slack_x[i], slack_y[j]) + common)
    need = NUM * (low_x[i] + low_y[j])
    fits = (NUM * low_x[i] <= DEN * high_y[j]) & (NUM * low_y[j] <= DEN * high_x[i])
    return fits & ((NUM + DEN) * most >= need) & ((group_x[i] != group_y[j]) | (group_x[i] == -1))


def traverse(x: Tree, y: Tree, itself: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that survive the dual traversal from both roots."""
    top = max(len(x.levels), len(y.levels)) - 1
    at = lambda t, level: t.levels[min(level, len(t.levels) - 1)]
    i = j = np.zeros(1, dtype=np.int64)
    for level in range(top, -1, -1):
        if not len(i):
            return i, j
        a, b = at(x, level), at(y, level)
        kept_i, kept_j = [], []
        for s in range(0, len(i), 1 << 14):
            ok = may_link(a, i[s: s + (1 << 14)], b, j[s: s + (1 << 14)])
            kept_i.append(i[s: s + (1 << 14)][ok]), kept_j.append(j[s: s + (1 << 14)][ok])
        i, j = np.concatenate(kept_i), np.concatenate(kept_j)
        if level == 0:
            break
        i, j = spread(i, x, level), spread(j, y, level)
        i, j = np.repeat(i, FAN, axis=1).ravel(), np.tile(j, (1, FAN)).ravel()
        ok = (i < len(at(x, level - 1)[0])) & (j < len(at(y, level - 1)[0]))
        if itself:
            ok &= i <= j
        i, j = i[ok], j[ok]
    ok = i < j if itself else np.ones(len(i), dtype=bool)
    return i[ok], j[ok]


def spread(nodes: np.ndarray, tree: Tree, level: int) -> np.ndarray:
    """Children of each node, FAN per row; a tree below its own height stays at its root."""
    if level >= len(tree.levels):
        return np.where(np.arange(FAN) == 0, nodes[:, None], np.iinfo(np.int64).max)
    return nodes[:, None] * FAN + np.arange(FAN)


def signed_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures leave room for a link."""
    side = lambda x: sets.select(F.col("fp").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            nodes = []
            for n, bits in (("n_a", "bits_a"), ("n_b", "bits_b")):
                n = batch.column(n).to_numpy()
                bits = folded(batch.column(bits).to_pylist(), SIGNATURE)
                slack = n - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
                nodes.append((n, n, slack, bits, np.full(count, -1)))
            ok = may_link(nodes[0], np.arange(count), nodes[1], np.arange(count))
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column(c).to_numpy()[ok]) for c in ("a", "b")], ["a", "b"]
            )

    return rows.mapInArrow(run, "a long, b long")


def wide_bitmaps(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``fp, n, bits`` of the wanted sets (fp), with bitmaps that grow with the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            sets = [shingler.shingles(text.as_buffer().to_pybytes()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([signature(s, WIDEST).tobytes() for s in sets], pa.binary()),
            ], ["fp", "n", "bits"])

    return texts.join(wanted, "fp", "left_semi").select("fp", "text").mapInArrow(run, "fp long, n long, bits binary")


def tree_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) that may link across components; ``members``: token, members (of the block), fp, n, bits, component.

    A block is the sets of one token. Blocks of over ``BLOCK`` sets are cut into slices; a
    task gets two slices, builds a tree on each and traverses both. Blocks of up to ``FAN``
    sets are one leaf node; all leaf nodes of a batch are looked through at once. A pair is
    given by the largest block of both: sets bring the names of their ``LISTED`` largest.
    """
    large = members.filter(f"members > {CROWD}").groupBy("fp").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("members", "token")), asc=False), 1, LISTED)["token"].alias("large")
    )
    members = members.join(large, "fp", "left").withColumn("large", F.coalesce("large", F.array().cast("array<long>")))
    slices = F.ceil(F.col("members") / BLOCK).cast("int")
    cut = members.withColumn("slices", slices).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select(
        "token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "fp", "n", "bits", "component", "large",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        made, many = [], 0  # pairs come up in many blocks: each is given once per half million
        for batch in batches:
            if many > 500_000:
                yield distinct(made)
                made, many = [], 0
            if not batch.num_rows:
                continue
            waiting.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(waiting)
            key = np.stack([table.column(c).to_numpy() for c in ("token", "i", "j")])
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(change):
                made.append(pairs_of(table.slice(0, change[-1]), change[:-1]))
                many += len(made[-1])
                table = table.slice(change[-1])
            waiting = [table]
        if waiting:
            made.append(pairs_of(waiting[0], np.zeros(0, dtype=np.int64)))
        if made:
            yield distinct(made)

    def distinct(made: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(made), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def pairs_of(table: pa.Table, change: np.ndarray) -> np.ndarray:
        fp, n, own, group = (table.column(c).to_numpy() for c in ("fp", "n", "own", "component"))
        i_, j_ = table.column("i").to_numpy(), table.column("j").to_numpy()
        bitmaps = table.column("bits").to_pylist()
        bits = folded(bitmaps, SIGNATURE)
        starts, ends = np.append(0, change).astype(np.int64), np.append(change, len(fp)).astype(np.int64)
        leaf = (ends - starts <= FAN) & (i_[starts] == j_[starts])
        slack = n - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        level, found = (n, n, slack, bits, group), []
        for size in range(2, FAN + 1):
            x, y = np.triu_indices(size, 1)
            first = starts[leaf & (ends - starts == size)][:, None]
            x, y = (first + x).ravel(), (first + y).ravel()
            ok = may_link(level, x, level, y)
            found.append(np.stack([x[ok], y[ok]], axis=1))
        for start, end in zip(starts[~leaf], ends[~leaf]):
            rows = np.arange(start, end)
            itself = i_[start] == j_[start]
            sides = [rows] if itself else [rows[own[rows] == i_[start]], rows[own[rows] == j_[start]]]
            sides = [s[np.argsort(n[s], kind="stable")] for s in sides]
            if not all(len(s) for s in sides):
                continue
            trees = [Tree(n[s], bits[s], group[s]) for s in sides]
            x, y = traverse(trees[0], trees[-1], itself)
            found.append(np.stack([sides[0][x], sides[-1][y]], axis=1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
        pairs = pairs[own_pairs(table, pairs)]
        pairs = fp[pairs[wide_enough(n, bitmaps, pairs[:, 0], pairs[:, 1])]]
        return np.unique(np.sort(pairs, axis=1), axis=0)

    def own_pairs(table: pa.Table, pairs: np.ndarray) -> np.ndarray:
        large = table.column("large").combine_chunks()
        size = np.diff(large.offsets.to_numpy())
        listed = np.zeros((len(large), LISTED), dtype=np.int64)
        known = np.arange(LISTED) < size[:, None]
        listed[known] = large.flatten().to_numpy()
        token, ok = table.column("token").to_numpy(), np.ones(len(pairs), dtype=bool)
        for at in range(0, len(pairs), 4096):
            x, y = pairs[at: at + 4096].T
            # Of the first set's blocks, in order: which the second one knows, and which is this one.
            both = ((listed[x][:, :, None] == listed[y][:, None, :]) & known[y][:, None, :]).any(axis=2) & known[x]
            here = (listed[x] == token[x][:, None]) & known[x]
            first = np.where(both.any(axis=1), both.argmax(axis=1), LISTED)
            ok[at: at + 4096] = first >= np.where(here.any(axis=1), here.argmax(axis=1), LISTED)
        return ok

    return dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(
        run, "a long, b long"
    ).distinct()


def grouped(postings: DataFrame, named: DataFrame | None) -> DataFrame:
    """Postings with the component of each set; a set without links is its own."""
    if named is None:
        return postings.withColumn("component", F.col("fp"))
    return postings.join(named.withColumnRenamed("node", "fp"), "fp", "left").select(
        "token", "fp", F.coalesce("component", "fp").alias("component")
    )


def apart_pairs(pairs: DataFrame, named: DataFrame | None) -> DataFrame:
    """``pair, low, high``: the pairs whose ends lie in different components, and these."""
    ends = pairs.select(F.struct("a", "b").alias("pair"), F.col("a").alias("of_a"), F.col("b").alias("of_b"))
    for end in ("of_a", "of_b") if named is not None else ():
        own = named.select(F.col("node").alias(end), "component")
        ends = ends.join(own, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    return ends.filter("of_a <> of_b").select(
        "pair", F.least("of_a", "of_b").alias("low"), F.greatest("of_a", "of_b").alias("high")
    )


def open_blocks(blocks: DataFrame, turn: int) -> DataFrame:
    """The postings of blocks with more than one component, their leader and their number."""
    flip = F.xxhash64(F.lit(turn))
    mixed = blocks.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"),
        F.min(F.col("fp").bitwiseXOR(flip)).bitwiseXOR(flip).alias("leader"),
    ).filter("low <> high").select("token", "leader", "members")
    return blocks.join(mixed, "token")


def uncovered_blocks(mixed: DataFrame) -> DataFrame:
    """The postings of ``mixed`` (token, fp, members) without blocks that another one covers.

    Sets that resemble each other share most of their tokens, so most blocks repeat each other.
    Of blocks with the same members one stays. Every set names its largest block; a block whose
    sets all name the same other one lies within it and goes. The named one stays, as a set
    that names it would not name the block that covers it: no pair of a block is lost.
    """
    alike = mixed.groupBy("token").agg(
        F.max("members").alias("members"), F.bit_xor(F.xxhash64("fp")).alias("seal"),
        F.sum(F.hash("fp").cast("long")).alias("sum"),
    ).groupBy("members", "seal", "sum").agg(F.min("token").alias("token")).select("token")
    once = settled(mixed.join(alike, "token", "left_semi"), "jaccard-blocks")
    named = once.groupBy("fp").agg(F.max(F.struct("members", "token")).alias("named"))
    covered = once.select("token", "fp").join(named, "fp").groupBy("token").agg(
        F.min("named").alias("low"), F.max("named").alias("high")
    ).filter("low = high and low.token <> token")
    return once.join(covered.select("token"), "token", "left_anti")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` has in common with each of ``right``.

    A product of incidence matrices over the shingles that stand in both lists, a few
    thousand columns at a time.
    """
    sizes = [len(s) for s in (*left, *right)]
    values, token = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    first = row < len(left)
    both = (np.bincount(token[first], minlength=len(values)) > 0) & (np.bincount(token[~first], minlength=len(values)) > 0)
    column = np.cumsum(both) - 1
    kept = both[token]
    row, column = row[kept], column[token[kept]]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for at in range(0, int(both.sum()), WIDE):
        here = (column >= at) & (column < at + WIDE)
        matrix = np.zeros((len(sizes), min(WIDE, int(both.sum()) - at)), dtype=np.float32)
        matrix[row[here], column[here] - at] = 1.0
        out += matrix[: len(left)] @ matrix[len(left):].T  # sums below 2^24 are exact
    return out.astype(np.int64)


def link_counts(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``fp, links``: with how many documents each set links; ``members``: fp, component, copies.

    All links lie within components. A component is dealt to slices of about ``LINKED`` sets;
    a task gets two slices at a time, counts what they have in common and returns a sum
    per set, never pairs. A set counts with its copies, itself left out.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size")).filter("size > 1").select(
        "component", F.ceil(F.col("size") / LINKED).cast("int").alias("slices")
    )
    cut = members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp", "copies"
    ).join(texts, "fp").select("component", "i", "j", "own", "fp", "copies", "text")
    keys = ["component", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, key, held = Shingler(), None, []
        for batch in batches:
            part = [batch.column(c).to_numpy() for c in range(6)]
            fp, links = [], []
            for r, text in enumerate(batch.column(6)):
                now = part[0][r], part[1][r], part[2][r]
                if now != key:
                    counted(key, held, fp, links)
                    key, held = now, []
                held.append((part[3][r], part[4][r], part[5][r], shingler.shingles(text.as_buffer().to_pybytes())))
            yield pa.RecordBatch.from_arrays([pa.array(fp, pa.int64()), pa.array(links, pa.int64())], ["fp", "links"])
        fp, links = [], []
        counted(key, held, fp, links)
        yield pa.RecordBatch.from_arrays([pa.array(fp, pa.int64()), pa.array(links, pa.int64())], ["fp", "links"])

    def counted(key: tuple | None, held: list[tuple], fp: list[int], links: list[int]) -> None:
        if not held:
            return
        itself = key[1] == key[2]
        left = [h for h in held if h[0] == key[1]]
        right = left if itself else [h for h in held if h[0] == key[2]]
        if not left or not right:
            return
        n, m = (np.array([len(h[3]) for h in side]) for side in (left, right))
        both = common_counts([h[3] for h in left], [h[3] for h in right])
        ok = DEN * both >= NUM * (n[:, None] + m[None, :] - both)
        if itself:
            np.fill_diagonal(ok, False)
        for side, sums in ((left, ok @ np.array([h[2] for h in right])), (right, ok.T @ np.array([h[2] for h in left]))):
            fp += [int(h[1]) for h in side]
            links += sums.tolist()
            if itself:
                break

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "fp long, links long").groupBy(
        "fp"
    ).agg(F.sum("links").alias("links"))


def similar_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII white space, A-Z lower-cased; a document's set are
    its distinct shingles of five words, or its whole word sequence if shorter. Documents
    link when the Jaccard similarity is 0.8 or more. ``component_id`` is the smallest
    doc_id reachable by links, ``n_links`` the number of other rows linked directly, copies
    counted one by one. Null, empty and blank texts have no shingle, link with
    nothing and are their own component. Repeated rows and exact copies are one set and
    share its component; a null doc_id names no component unless all its ids are null.
    Other columns are not read. Empty input gives no rows. Sets and shingles are told apart
    by 64-bit hashes.

    1. Equal sets become one, by fingerprint. 2. Sets are posted under the rarest fifth of
    their shingles; sets that link meet under one of them. 3. In rounds, the sets of a block
    that are not yet in one component choose the block leader they share most postings
    with, and the pair is verified: groups of copies, however large, become one component
    with one pair per set and round; after the first round, only blocks of over ``CROWD`` sets
    take part, and rounds end when fewer than a quarter of their pairs link, or when one brings
    less than a tenth of the best round's links. 4. Blocks that lie within another one go, and
    signature trees give all pairs left across components, which are verified. Blocks within
    one component are done and never expanded.
    """
    sets, classes, texts = set_components(docs)
    copies = sets.filter("n > 0").groupBy("fp").agg(F.count("*").alias("copies"))
    if "component" not in classes.columns:
        known = classes.join(copies, "fp").select("fp", F.col("first").alias("smallest"), (F.col("copies") - 1).alias("links"))
    else:
        ids = classes.groupBy("component").agg(F.min("first").alias("smallest"), F.count("*").alias("members"))
        named = settled(classes.join(ids, "component").join(copies, "fp"), "jaccard-classes")
        links = link_counts(named.filter("members > 1").select("fp", "component", "copies"), texts)
        known = named.join(links.withColumnRenamed("links", "linked"), "fp", "left").select(
            "fp", "smallest", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links")
        )
    return sets.select("doc_id", "n", "fp").join(known, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def set_components(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' sets; ``fp, first`` per set, with ``component`` if any two sets link; and
    ``fp, text`` of the sets that share a posting."""
    counts = shingle_counts(docs)
    sets = settled(shingle_sets(docs, counts), "jaccard-sets")
    firsts = settled(
        sets.filter("n > 0").groupBy("fp").agg(F.min("doc_id").alias("first")), "jaccard-firsts"
    )
    # One row per set; rows that repeat an id and a set are equal and do no harm.
    small = by_size(firsts)
    one = sets.join(
        small.select(F.col("fp").alias("f"), "first"), F.expr("fp = f and doc_id <=> first"), "left_semi"
    )
    if small is firsts:
        one = settled(one, "jaccard-one")
    postings = settled(shared_postings(one), "jaccard-postings")
    repeated = not sets.groupBy("doc_id", "row").count().filter("count > 1").isEmpty()
    texts = settled(texts_of(docs, one, postings, repeated), "jaccard-texts")

    edges = named = None
    turn = most = 0
    while True:
        mixed = settled(open_blocks(grouped(postings, named), turn), "jaccard-open")
        # After the first round only crowded blocks are worth a round of their own.
        tried = mixed.filter("fp <> leader") if turn == 0 else mixed.filter(f"fp <> leader and members > {CROWD}")
        votes = tried.groupBy("fp", "leader", "component").agg(F.count("*").alias("votes"))
        if named is not None:
            own = named.select(F.col("node").alias("leader"), F.col("component").alias("of_leader"))
            votes = votes.join(own, "leader", "left").filter(
                F.col("component") != F.coalesce("of_leader", "leader")
            )
        best = F.row_number().over(Window.partitionBy("fp").orderBy(F.desc("votes"), "leader"))
        chosen = settled(signed_pairs(votes.withColumn("place", best).filter("place = 1").select(
            F.col("leader").alias("a"), F.col("fp").alias("b")
        ), one), "jaccard-chosen")
        asked = chosen.count()
        if asked == 0:
            break
        found = settled(verified(chosen, texts), "jaccard-links")
        forget(chosen)
        linked = found.count()
        if linked:
            edges = found if edges is None else settled(edges.unionAll(found), "jaccard-edges")
            named = settled(star_components(edges, "jaccard-rounds"), "jaccard-named")
        turn += 1
        # The trees do it as well: a round has to bring links worth its jobs.
        most = max(most, linked)
        last = linked < asked / 4 or linked < most / 10
        if last and not linked:
            break
        forget(mixed)  # what is still open is smaller, and written anew
        if last:
            mixed = settled(open_blocks(grouped(postings, named), turn), "jaccard-open")
            break
    mixed = uncovered_blocks(mixed)
    wide = settled(wide_bitmaps(texts, mixed.select("fp").distinct()), "jaccard-wide")
    rest = mixed.select("token", "members", "fp", "component").join(wide, "fp")
    pairs = settled(tree_pairs(rest), "jaccard-pairs")
    forget(wide)
    # One pair speaks for its two components first; the others are verified only if their
    # components are still apart.
    spoken = None
    for _ in range(2):
        apart = apart_pairs(pairs, named)
        if spoken is None:
            spoken = settled(apart.groupBy("low", "high").agg(F.min("pair").alias("pair")).select("pair.*"), "jaccard-spoken")
            asked_now = spoken
        else:
            asked_now = apart.select("pair.*").join(spoken, ["a", "b"], "left_anti")
        last = settled(verified(settled(asked_now, "jaccard-asked"), texts), "jaccard-last")
        if not last.isEmpty():
            edges = last if edges is None else settled(edges.unionAll(last), "jaccard-edges")
            named = settled(star_components(edges, "jaccard-last-round"), "jaccard-named")
    classes = firsts.select("fp", "first") if named is None else firsts.join(
        named.withColumnRenamed("node", "fp"), "fp", "left"
    ).select("fp", "first", F.coalesce("component", "fp").alias("component"))
    return sets, classes, texts


def texts_of(docs: DataFrame, one: DataFrame, postings: DataFrame, repeated: bool) -> DataFrame:
    """``fp, text`` of the sets that share a posting, from one document of each.

    A document is known by its id and the hash of its text.
    """
    rows = one.groupBy("fp", F.col("doc_id").alias("id")).agg(F.min("row").alias("row"))
    need = settled(postings.select("fp").distinct().join(rows, "fp").select("fp", "id", "row"), "jaccard-need")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("hash")).join(
        by_size(need), F.expr("doc_id <=> id and hash = row")
    ).select("fp", "text")
    return texts.groupBy("fp").agg(F.max("text").alias("text")) if repeated else texts


def keep_first(docs: DataFrame) -> DataFrame:
    """The first row of each component, by doc_id (null last), then hash of the text; columns as they were.

    Rows are judged one by one: of an id that stands on different texts, or of rows with a
    null id, each goes only with its own component. Of rows that repeat both id and text one
    stays. Documents without a shingle stay; with a null id, each of them.
    """
    sets, classes, _ = set_components(docs)
    rows = sets.select("doc_id", "row", "n", "fp")
    known = rows.filter("n > 0")
    if "component" in classes.columns:
        known = known.join(classes.select("fp", "component"), "fp")
    else:
        known = known.withColumn("component", F.col("fp"))
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")
    first = known.groupBy("component").agg(F.min(place).alias("first"))
    id_, row, rank = free_name(docs, "similar_id"), free_name(docs, "similar_row"), free_name(docs, "similar_rank")
    gone = settled(
        known.join(first, "component").filter(
            ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row")))
        ).select(F.col("doc_id").alias(id_), F.col("row").alias(row)).distinct(), "jaccard-gone",
    )
    kept = docs.join(
        by_size(gone), F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(row)), "left_anti"
    )
    again = rows.filter("n > 0 or doc_id is not null").groupBy("doc_id", "row").count().filter("count > 1")
    if again.isEmpty():
        return kept
    # Rows that repeat id and text may differ elsewhere: the choice goes by all they hold.
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.to_json(F.struct(*docs.columns)))
    blank = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    return kept.filter(~blank).withColumn(rank, F.row_number().over(same)).filter(F.col(rank) == 1).select(
        *docs.columns
    ).unionAll(kept.filter(blank))
