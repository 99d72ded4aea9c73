"""Piece encoding with the N best segmentations, and decoding, for a SentencePiece vocabulary."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import free_name

MARK = "▁"
UNITS = re.compile(r" *[^ ]+| +$")
CACHE = 500_000  # units a task keeps, some 40 MB
CHARS = 1 << 19  # characters of texts that become arrays at once, but for one longer text
PAD = np.uint32(0xFFFFFFFF)
SEED = 0xCBF29CE484222325
MULTIPLIER = 0x9E3779B97F4A7C15

Segmentation = tuple[float, tuple[int, ...]]


@dataclass(frozen=True)
class Vocabulary:
    """What segmentation needs of a model: bounded by the vocabulary, it travels with the job.

    ``pieces``: text (a blank for the word mark) to (id, score). ``bytes_of``: the bytes an
    id stands for. ``byte_ids``: the fallback id of each byte value. ``unknown``: score of a
    character that only bytes can spell.
    """

    pieces: dict[str, tuple[int, float]]
    longest: int
    bytes_of: tuple[bytes, ...]
    byte_ids: tuple[int, ...]
    unknown: float


def load_vocabulary(model_file: str) -> Vocabulary:
    """Read a model with byte fallback, identity normalisation and a leading word mark."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    pieces, bytes_of, byte_ids = {}, [], [0] * 256
    for i in range(size):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(text[3:5], 16)
            byte_ids[value] = i
            bytes_of.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            bytes_of.append(b"")
        else:
            text = text.replace(MARK, " ")
            if " " in text.lstrip(" "):
                raise ValueError("pieces that go beyond a word are not supported")
            pieces[text] = (i, model.get_score(i))
            bytes_of.append(text.encode())
    usual = min(s for _, s in pieces.values() if s > -1e8)
    return Vocabulary(
        pieces, max(map(len, pieces)), tuple(bytes_of), tuple(byte_ids), usual - 10.0
    )


def lattice_nbest(unit: str, v: Vocabulary, n: int) -> list[Segmentation]:
    """The ``n`` best segmentations of one unit, best first.

    Forward Viterbi gives the best score from the start to every place; searching backward
    from the end, that score is the exact rest of a partial path, so A* takes up nothing
    but prefixes of the answers.
    """
    size, pieces = len(unit), v.pieces
    best = [0.0] + [float("-inf")] * size
    ending: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
    for start in range(size):
        here = best[start]
        for end in range(start + 1, min(size, start + v.longest) + 1):
            found = pieces.get(unit[start:end])
            if found is not None:
                ids, score = (found[0],), found[1]
            elif end == start + 1:
                ids, score = tuple(v.byte_ids[b] for b in unit[start].encode()), v.unknown
            else:
                continue
            ending[end].append((start, score, ids))
            if here + score > best[end]:
                best[end] = here + score
    agenda = [(-best[size], 0, size, 0.0, None)]
    made, out = 1, []
    while agenda and len(out) < n:
        _, _, at, score, path = heapq.heappop(agenda)
        if at == 0:
            ids: list[int] = []
            while path is not None:
                ids.extend(path[0])
                path = path[1]
            out.append((score, tuple(ids)))
            continue
        for start, arc, got in ending[at]:
            heapq.heappush(agenda, (-(best[start] + arc + score), made, start, arc + score, (got, path)))
            made += 1
    return out


class Encoder:
    """N-best encoding of whole texts. A unit is a run of blanks and the word after it.

    No piece goes beyond a unit, so the lattice of a text is the chain of its units'
    lattices. A segmentation that leaves the best one in some unit is among the ``n`` best
    only if that unit has one of the ``n - 1`` smallest gaps between its best and its
    second; only those units are searched with A*. Best segmentations and gaps are made
    for all new units of a batch at once, by forward and backward Viterbi over arrays.
    """

    #: Longer units, and those of a length that few others have, are done one by one.
    WIDE, FEW = 48, 16

    def __init__(self, vocabulary: Vocabulary, n: int):
        self.vocabulary, self.n = vocabulary, n
        self.cache: dict[str, tuple[float, float, tuple[int, ...]]] = {}
        self.lists: dict[str, list[Segmentation]] = {}
        self.known = Known(self)
        names = list(vocabulary.pieces)
        keys = np.array([self._key(name) for name in names], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ids_of = np.array([vocabulary.pieces[names[i]][0] for i in order], dtype=np.int64)
        self.scores = np.array([vocabulary.pieces[names[i]][1] for i in order])
        # By the first 20 bits of a hash: whether a piece may have it (1), whether a longer
        # piece may begin so (2), and where the pieces' hashes of this beginning are.
        self.says = np.zeros(1 << 20, dtype=np.uint8)
        slots = (self.keys >> np.uint64(44)).astype(np.int64)
        self.says[slots] |= 1
        heads = {name[:k] for name in names for k in range(1, len(name))}
        self.says[(np.array([self._key(head) for head in heads], dtype=np.uint64) >> np.uint64(44)).astype(np.int64)] |= 2
        self.first = np.searchsorted(slots, np.arange(1 << 20)).astype(np.int32)
        self.most = int(np.bincount(slots).max())
        self.keys = np.append(self.keys, np.zeros(self.most, dtype=np.uint64))
        # The bytes of every id, one after another.
        self.spelling = np.frombuffer(b"".join(vocabulary.bytes_of), dtype=np.uint8)
        self.spelling_sizes = np.array(list(map(len, vocabulary.bytes_of)), dtype=np.int64)
        self.spelling_starts = np.cumsum(self.spelling_sizes) - self.spelling_sizes

    @staticmethod
    def _key(name: str) -> int:
        h = SEED
        for c in name:
            h = ((h ^ ord(c)) * MULTIPLIER) & 0xFFFFFFFFFFFFFFFF
        return h

    def prepare(self, units: set[str]) -> None:
        """Put all units into the cache."""
        if len(self.cache) + len(units) > CACHE:
            self.cache.clear()
        names = [u for u in units if u not in self.cache]
        if not names:
            return
        sizes = np.fromiter(map(len, names), dtype=np.int64, count=len(names))
        codes = np.frombuffer("".join(names).encode("utf-32-le"), dtype=np.uint32)
        best, gaps, used, flat = self.segmented(codes, np.cumsum(sizes) - sizes, sizes)
        ends, ids = np.cumsum(used).tolist(), flat.tolist()
        for name, score, gap, n, end in zip(names, best.tolist(), gaps.tolist(), used.tolist(), ends):
            self.cache[name] = score, gap, tuple(ids[end - n: end])

    def segmented(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Best score, gap and number of ids per unit, and all ids in the units' order.

        A unit is ``size`` code points from its start. Units of about one length go through
        the arrays together, the shorter ones padded.
        """
        best, gaps, used = np.zeros(len(sizes)), np.zeros(len(sizes)), np.zeros(len(sizes), dtype=np.int64)
        made: list[tuple[np.ndarray, np.ndarray]] = []  # places of units, and their ids one after another
        alone = (sizes > self.WIDE) | (np.bincount(sizes)[sizes] < self.FEW)
        for i in np.flatnonzero(alone).tolist():
            unit = codes[starts[i]: starts[i] + sizes[i]].tobytes().decode("utf-32-le")
            found = lattice_nbest(unit, self.vocabulary, 2)
            best[i], used[i] = found[0][0], len(found[0][1])
            gaps[i] = found[0][0] - found[1][0] if len(found) > 1 else np.inf
            made.append((np.array([i]), np.array(found[0][1], dtype=np.int64)))
        many = np.flatnonzero(~alone)
        many = many[np.argsort(sizes[many], kind="stable")]
        for at in range(0, len(many), 4096):
            part = many[at: at + 4096]
            best[part], gaps[part], used[part], ids = self._viterbi(codes, starts[part], sizes[part])
            made.append((part, ids))
        flat, ends = np.zeros(int(used.sum()), dtype=np.int64), np.cumsum(used)
        for part, ids in made:
            within = np.arange(len(ids)) - np.repeat(np.cumsum(used[part]) - used[part], used[part])
            flat[np.repeat(ends[part] - used[part], used[part]) + within] = ids
        return best, gaps, used, flat

    def _viterbi(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """``segmented`` for units in ascending order of their sizes."""
        many, size = len(sizes), int(sizes[-1])
        place = np.arange(size)[:, None]
        # Behind a unit's end stands what no text holds, so no piece goes on there.
        codes = np.where(place < sizes, text[np.minimum(starts + place, len(text) - 1)], PAD).astype(np.uint64)
        forward = np.full((size + 1, many), -np.inf)
        forward[0] = 0.0
        last = np.zeros((size + 1, many), dtype=np.int8)
        arcs, every = [], np.arange(many)
        for start in range(size):
            # The units of which a piece may still begin at this place, and their hashes.
            here = every[np.searchsorted(sizes, start, "right"):]
            alive, h = here, np.full(len(here), SEED, dtype=np.uint64)
            for end in range(start + 1, min(size, start + self.vocabulary.longest) + 1):
                h = (h ^ codes[end - 1][alive]) * np.uint64(MULTIPLIER)
                slot = (h >> np.uint64(44)).view(np.int64)
                says = self.says[slot]
                near = np.flatnonzero(says & 1)
                mine, place = h[near], self.first[slot[near]]
                ok = self.keys[place] == mine
                for _ in range(1, self.most):  # few slots hold more than one piece
                    place += ~ok
                    ok = self.keys[place] == mine
                at, place = alive[near[ok]], place[ok]
                piece, score = self.ids_of[place], self.scores[place]
                more = np.flatnonzero(says & 2)
                alive, h = alive[more], h[more]
                if end == start + 1 and len(at) < len(here):
                    other = np.delete(here, at - here[0])
                    at = np.append(at, other)
                    piece = np.append(piece, np.full(len(other), -1))
                    score = np.append(score, np.full(len(other), self.vocabulary.unknown))
                if len(at):
                    arcs.append((start, end, at, piece, score))
                    through = forward[start][at] + score
                    better = through > forward[end][at]
                    forward[end, at[better]] = through[better]
                    last[end, at[better]] = end - start
                if not len(alive):
                    break
        backward = np.full((size + 1, many), -np.inf)
        backward[sizes, every] = 0.0
        for start, end, at, _, score in reversed(arcs):
            backward[start, at] = np.maximum(backward[start, at], score + backward[end, at])
        # Where the best path begins a piece, and how long it is.
        step = np.zeros((size + 1, many), dtype=np.int8)
        here = sizes.copy()
        while (here > 0).any():
            length = np.where(here > 0, last[here, every], 0)
            here = here - length
            step[here, every] = np.where(length > 0, length, step[here, every])
        best, second = forward[sizes, every], np.full(many, -np.inf)
        taken = np.full((many, size), -2, dtype=np.int64)
        for start, end, at, piece, score in arcs:
            on = step[start, at] == end - start
            taken[at[on], start] = piece[on]
            off = at[~on]
            second[off] = np.maximum(second[off], forward[start, off] + score[~on] + backward[end, off])
        # A place holds one id, or those of the bytes that spell its character.
        unit, spot = np.nonzero(taken != -2)
        flat = taken[unit, spot]
        odd = np.flatnonzero(flat == -1)
        wide = np.ones(len(flat), dtype=np.int64)
        spelled = [
            [self.vocabulary.byte_ids[b] for b in chr(c).encode()] for c in codes[spot[odd], unit[odd]].tolist()
        ]
        wide[odd] = list(map(len, spelled))
        ids = np.repeat(flat, wide)
        ids[ids == -1] = list(chain.from_iterable(spelled))
        return best, best - second, np.bincount(unit, weights=wide, minlength=many).astype(np.int64), ids

    def unit_nbest(self, unit: str) -> list[Segmentation]:
        found = self.lists.get(unit)
        if found is None:
            if len(self.lists) > CACHE // 4:
                self.lists.clear()
            found = self.lists[unit] = lattice_nbest(unit, self.vocabulary, self.n)
        return found

    def nbest(self, units: list[str]) -> tuple[list[tuple[int, ...]], list[tuple[float, dict[int, tuple[int, ...]]]]]:
        """Best ids per prepared unit, and the ``n`` best choices as (score, {unit: other ids})."""
        made = list(map(self.cache.__getitem__, units))
        scores, gaps, ids = zip(*made) if made else ((), (), ())
        ids, top, gaps = list(ids), sum(scores), np.array(gaps)
        few = min(self.n - 1, len(gaps))
        near = np.partition(gaps, few - 1)[few - 1] if few else -1.0
        below = np.flatnonzero(gaps < near)
        level = np.flatnonzero(gaps == near)[: few - len(below)] if np.isfinite(near) else below[:0]
        places = sorted(below.tolist() + level.tolist())
        lists = [self.unit_nbest(units[i]) for i in places]
        for i, segs in zip(places, lists):
            ids[i] = segs[0][1]
        choices, agenda, count = [], [(-top, 0, 0, {})], 1
        while agenda and len(choices) < self.n:
            score, _, k, taken = heapq.heappop(agenda)
            if k == len(places):
                choices.append((-score, taken))
                continue
            for rank, (s, other) in enumerate(lists[k]):
                more = {**taken, places[k]: other} if rank else taken
                heapq.heappush(agenda, (score + lists[k][0][0] - s, count, k + 1, more))
                count += 1
        return ids, choices

    def choices(self, top: float, lists: list[list[Segmentation]]) -> list[tuple[float, list[int]]]:
        """The ``n`` best choices of a rank per list, as (score of the text, ranks).

        ``top`` is the score with the first of every list.
        """
        found, agenda, count = [], [(-top, 0, [])], 1
        while agenda and len(found) < self.n:
            score, _, ranks = heapq.heappop(agenda)
            if len(ranks) == len(lists):
                found.append((-score, ranks))
                continue
            here = lists[len(ranks)]
            for rank, (s, _) in enumerate(here):
                heapq.heappush(agenda, (score + here[0][0] - s, count, [*ranks, rank]))
                count += 1
        return found


_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xD1B54A32D192ED03)


class Units:
    """Units of many texts: blank-led words, a blank being put before every text.

    ``number`` per unit tells equal units, ``key`` and ``shown`` are the hash and one place of
    each distinct one, ``bounds`` where each text's units begin. A unit begins where a run
    of blanks does. Units are told apart by length and a 64-bit hash made of two, taken from
    sums over all texts at once, so that only new ones ever become strings.
    """

    def __init__(self, texts: list[str]):
        self.whole = "".join(" " + t for t in texts)
        codes = self.codes = np.frombuffer(self.whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        first = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=first[1:])
        blank = codes == 32
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[first[:-1]] = True  # also where the text before ends in a blank
        self.starts = np.flatnonzero(begins)
        self.sizes = np.diff(np.append(self.starts, len(codes)))
        # A code times a power of its place in the unit: a hash does not depend on where it stands.
        within = np.arange(len(codes)) - np.repeat(self.starts, self.sizes)
        wide, longest = codes.astype(np.uint64) + np.uint64(1), int(self.sizes.max())
        a, b = (
            np.add.reduceat(wide * np.cumprod(np.full(longest, odd, dtype=np.uint64), dtype=np.uint64)[within], self.starts)
            for odd in (_ODD, _ODD2)
        )
        b ^= b >> np.uint64(32)
        key = a ^ (b * _ODD) ^ (self.sizes.astype(np.uint64) * _ODD2)
        self.key, self.shown, self.number = np.unique(key, return_index=True, return_inverse=True)
        self.bounds = np.searchsorted(self.starts, first)

    def text(self, place: int) -> str:
        start = int(self.starts[place])
        return self.whole[start: start + int(self.sizes[place])]


def pieces_of(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``starts``, one after another."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Known:
    """Best segmentations of the units met so far, as columns that grow.

    ``keys`` are the units' hashes in ascending order, ``place`` the row of each.
    """

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.clear()

    def clear(self) -> None:
        self.keys, self.place = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.columns = {
            "score": np.zeros(1024), "gap": np.zeros(1024), "begin": np.zeros(1024, dtype=np.int64),
            "size": np.zeros(1024, dtype=np.int64), "exact": np.zeros(1024, dtype=bool),
        }
        self.pool, self.used = np.zeros(4096, dtype=np.int32), 0

    @staticmethod
    def _grown(column: np.ndarray, size: int) -> np.ndarray:
        return column if size <= len(column) else np.concatenate([column, np.zeros(max(size, len(column)), column.dtype)])

    def rows(self, units: Units) -> np.ndarray:
        """The row of each distinct unit; new ones are segmented."""
        if len(self.keys) + len(units.key) > CACHE:
            self.clear()
        at = np.searchsorted(self.keys, units.key)
        rows = np.full(len(units.key), -1, dtype=np.int64)
        there = np.flatnonzero(at < len(self.keys))
        there = there[self.keys[at[there]] == units.key[there]]
        rows[there] = self.place[at[there]]
        new = np.flatnonzero(rows < 0)
        if len(new):
            first = len(self.keys)
            self.add(units.codes, units.starts[units.shown[new]], units.sizes[units.shown[new]])
            rows[new] = np.arange(first, first + len(new))
            self.keys = np.insert(self.keys, at[new], units.key[new])
            self.place = np.insert(self.place, at[new], rows[new])
        return rows

    def add(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        """Rows for the units of ``lengths`` code points from ``starts``, in this order."""
        first, end = len(self.keys), len(self.keys) + len(starts)
        scores, gaps, sizes, ids = self.encoder.segmented(codes, starts, lengths)
        self.columns = {n: self._grown(c, end) for n, c in self.columns.items()}
        ends, total = np.cumsum(sizes), len(ids)
        self.pool = self._grown(self.pool, self.used + total)
        self.pool[self.used: self.used + total] = ids
        # What the ids spell, against the units' own bytes.
        e = self.encoder
        spelled = pieces_of(e.spelling, e.spelling_starts[ids], e.spelling_sizes[ids])
        whole = pieces_of(codes, starts, lengths)
        wide = 1 + (whole >= 0x80).astype(np.int64) + (whole >= 0x800) + (whole >= 0x10000)
        own = np.frombuffer(whole.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        got, want = np.add.reduceat(e.spelling_sizes[ids], ends - sizes), np.add.reduceat(wide, np.cumsum(lengths) - lengths)
        exact = got == want
        if exact.all():
            exact = np.logical_and.reduceat(spelled == own, np.cumsum(want) - want)
        else:
            a, b = np.cumsum(got) - got, np.cumsum(want) - want
            for i in np.flatnonzero(exact).tolist():
                exact[i] = (spelled[a[i]: a[i] + got[i]] == own[b[i]: b[i] + want[i]]).all()
        for name, values in (("score", scores), ("gap", gaps), ("begin", self.used + ends - sizes), ("size", sizes), ("exact", exact)):
            self.columns[name][first:end] = values
        self.used += total


def decode_ids(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of ids; the blank before the first word is not part of it."""
    raw = b"".join(map(vocabulary.bytes_of.__getitem__, ids))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encode(
    docs: DataFrame, vocabulary: Vocabulary, n: int = 4, text: str = "text",
    keep: list[str] | None = None, all_ids: bool = False,
) -> DataFrame:
    """``keep...`` (default doc_id) and ids, nbest_scores, nbest_pieces, nbest_changes,
    round_trip per row.

    ``ids`` is the best segmentation of the whole text, ``nbest_scores`` and
    ``nbest_pieces`` the scores and lengths of the ``n`` best (fewer where the text has
    fewer), best first. ``nbest_changes`` says what each of them changes: ``length`` ids from
    ``at`` on become others; with ``all_ids`` a column nbest_ids has them put in. ``round_trip`` says that the ids'
    bytes are the text's. Scores are sums of the vocabulary's piece scores.

    Null text gives nulls, empty text no ids and one segmentation of score 0. A word mark
    in the text is spelled in bytes, so the round trip is exact for any text. Ties are
    broken by the order of search, equal texts give equal rows. Rows are encoded one by
    one where they lie; a very long word costs time in proportion to its length.
    """
    keep = ["doc_id"] if keep is None else keep
    source = free_name(docs, "encoded_text")
    rows = docs.select(*keep, docs[text].alias(source))
    change = pa.struct([("at", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])
    types = pa.schema([
        ("ids", pa.list_(pa.int32())), ("nbest_scores", pa.list_(pa.float64())),
        ("nbest_pieces", pa.list_(pa.int32())), ("nbest_changes", pa.list_(pa.list_(change))),
        ("round_trip", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, n)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, chars = [], 0
                while at + len(texts) < batch.num_rows and len(texts) < 1000 and chars < CHARS:
                    texts.append(batch.column(len(keep))[at + len(texts)].as_py())
                    chars += len(texts[-1] or "")
                part = batch.slice(at, len(texts))
                at += len(texts)
                made = encode_texts(encoder, texts, types)
                names = [*keep, *types.names]
                if all_ids:
                    names.append("nbest_ids")
                    made.append(pa.array([
                        None if x is None else nbest_ids(x, c) for x, c in zip(made[0].to_pylist(), made[3].to_pylist())
                    ], pa.list_(pa.list_(pa.int32()))))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *made], names)

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
        + ["ids array<int>", "nbest_scores array<double>", "nbest_pieces array<int>",
           "nbest_changes array<array<struct<at: int, length: int, ids: array<int>>>>", "round_trip boolean"]
        + (["nbest_ids array<array<int>>"] if all_ids else [])
    )
    return rows.mapInArrow(run, schema)


def encode_texts(encoder: Encoder, texts: list[str | None], types: pa.Schema) -> list[pa.Array]:
    """The columns of ``encode`` for some texts.

    Each distinct unit is looked up once; ids, sums and offsets of the texts are put together
    from the units' numbers as arrays. Only the few units of a text that can vary are looked
    at one by one.
    """
    there = [t for t in texts if t]
    results: list = [None if t is None else ([0.0], [0], [[]], True) for t in texts]
    offsets = np.zeros(len(texts) + 1, dtype=np.int32)
    flat = np.zeros(0, dtype=np.int32)
    if there:
        units, known, few = Units(there), encoder.known, encoder.n - 1
        rows = known.rows(units)[units.number]
        gaps, bounds = known.columns["gap"][rows], units.bounds
        varying: list[np.ndarray] = []
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            own = gaps[begin:end]
            if few and len(own) > few:
                near = np.partition(own, few - 1)[few - 1]
                below = np.flatnonzero(own < near)
                level = np.flatnonzero(own == near)[: few - len(below)] if np.isfinite(near) else below[:0]
                places = np.sort(np.concatenate([below, level]))
            else:
                places = np.flatnonzero(np.isfinite(own))[: few]
            varying.append(places + begin)
        lists = {p: encoder.unit_nbest(units.text(p)) for p in np.concatenate(varying).tolist()}
        begins, lengths = known.columns["begin"][rows], known.columns["size"][rows]
        # Where a unit can vary it shows the first of its own list, which may tie with the
        # path over arrays: then these ids stand behind the pool, for this place only.
        pool, behind = known.pool, []
        for p, segs in lists.items():
            first = segs[0][1]
            if len(first) != lengths[p] or (pool[begins[p]: begins[p] + lengths[p]] != first).any():
                begins[p], lengths[p] = len(pool) + len(behind), len(first)
                behind += first
        pool = np.append(pool, np.array(behind, dtype=np.int32)) if behind else pool
        ends = np.cumsum(lengths)
        unit_at = ends - lengths
        flat = pieces_of(pool, begins, lengths)
        sums = np.add.reduceat(known.columns["score"][rows], bounds[:-1])
        exact = np.logical_and.reduceat(known.columns["exact"][rows], bounds[:-1])
        text_ends = ends[bounds[1:] - 1]
        row = -1
        for i, text in enumerate(texts):
            offsets[i + 1] = offsets[i]
            if not text:
                continue
            row += 1
            first = int(unit_at[bounds[row]])
            total = int(text_ends[row]) - first
            offsets[i + 1] += total
            places = varying[row].tolist()
            own = [lists[p] for p in places]
            best = encoder.choices(float(sums[row]), own)
            changes = [[
                {"at": int(unit_at[p]) - first, "length": int(lengths[p]), "ids": segs[r][1]}
                for p, segs, r in zip(places, own, ranks) if r
            ] for _, ranks in best]
            pieces = [total + sum(len(c["ids"]) - c["length"] for c in change) for change in changes]
            results[i] = [s for s, _ in best], pieces, changes, bool(exact[row])
    none = np.array([t is None for t in texts])
    listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat), mask=pa.array(none) if none.any() else None)
    columns = list(zip(*(r if r is not None else (None,) * 4 for r in results))) if texts else [[]] * 4
    return [listed, *[pa.array(list(c), f.type) for c, f in zip(columns, list(types)[1:])]]


def nbest_ids(ids: list[int], changes: list[list]) -> list[list[int]]:
    """The segmentations themselves: ``ids`` with the changes of each of the n best."""
    out = []
    for change in changes:
        made = list(ids)
        for c in sorted(change, key=lambda c: -c["at"]):
            made[c["at"]: c["at"] + c["length"]] = c["ids"]
        out.append(made)
    return out


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep...`` (default doc_id) and ``text``: the inverse of ``encode``; null ids give null."""
    keep = ["doc_id"] if keep is None else keep
    rows = encoded.select(*keep, encoded[ids].alias(free_name(encoded, "decoded_ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if x is None else decode_ids(x, vocabulary)
                for x in batch.column(len(keep)).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, "text"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["text string"])
    return rows.mapInArrow(run, schema)
