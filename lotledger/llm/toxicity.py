"""Toxicity of a text: a convolutional classifier over hashed words, trained in numpy."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from .common import by_size, forget, settled

BITS = 20
WIDTHS = (1, 2, 3)
FILTERS = 16
SIZE = 16
CHUNK = 1 << 14
# Every ASCII character that is neither letter nor digit separates words.
SPACES = bytes(
    b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
PREFIXES = (6, 8)
PARTS = 1 + len(PREFIXES)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(SPACES).split()


def part_hashes(word: bytes) -> tuple[int, ...]:
    """Hashes of the word and of its beginnings, where it goes beyond them; -1 for none."""
    letters = word.decode("utf-8", "replace")
    return crc32(word) >> (32 - BITS), *(
        crc32(f"{k}:{letters[:k]}".encode()) >> (32 - BITS) if len(letters) > k else -1 for k in PREFIXES
    )


def word_hashes(text: str) -> np.ndarray:
    """One row of part hashes per word, in order."""
    seen: dict[bytes, tuple[int, ...]] = {}
    out = []
    for word in words_of(text):
        h = seen.get(word)
        if h is None:
            h = seen[word] = part_hashes(word)
        out.append(h)
    return np.array(out, dtype=np.int32).reshape(-1, PARTS)


@dataclass(frozen=True)
class ToxicityModel:
    """``known``: the sorted part hashes learned; any other part of a word is the zero vector."""

    known: np.ndarray
    table: np.ndarray
    filters: tuple[np.ndarray, ...]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float]
    threshold: float


def _rows(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Rows of the table per part of a word; 0 for parts that training has not seen."""
    if not len(known):
        return np.zeros(hashes.shape, dtype=np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + 1, 0)


class Scorer:
    """Scores texts with a model; a word's products with the filters are made once and kept.

    At most ``ROOM`` words are kept; when they are full, all are made anew.
    """

    ROOM = 1 << 16

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.flat = np.concatenate([f[k] for f in model.filters for k in range(len(f))], axis=1)
        self.made = np.zeros((self.ROOM + 1, self.flat.shape[1]), dtype=np.float32)
        self.place: dict[bytes, int] = {}

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Places of at most half of ``ROOM`` words; place 0 is the zero vector."""
        if len(self.place) + len(words) > self.ROOM:
            self.place.clear()
        place, new = self.place, []
        out = np.empty(len(words), dtype=np.int64)
        for i, word in enumerate(words):
            at = place.get(word)
            if at is None:
                at = place[word] = len(place) + 1
                new.append(word)
            out[i] = at
        if new:
            parts = _rows(np.array([part_hashes(w) for w in new], dtype=np.int32), self.model.known)
            first = len(place) - len(new) + 1
            self.made[first: first + len(new)] = self.model.table[parts].sum(axis=1) @ self.flat
        return out

    def pooled(self, words: list[bytes]) -> np.ndarray:
        """Largest activation per filter over all words, in chunks that overlap."""
        best = np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32)
        reach = max(WIDTHS) - 1
        for at in range(0, len(words), CHUNK):
            rows = self.rows(words[at: at + CHUNK + reach])
            n = min(CHUNK, len(words) - at)
            made = self.made[np.concatenate([rows, np.zeros(n + reach - len(rows), dtype=np.int64)])]
            col = 0
            for j, width in enumerate(WIDTHS):
                act = made[:n, col: col + FILTERS]
                for k in range(1, width):
                    col += FILTERS
                    act = act + made[k: k + n, col: col + FILTERS]
                col += FILTERS
                c = slice(j * FILTERS, (j + 1) * FILTERS)
                best[c] = np.maximum(best[c], act.max(axis=0) + self.model.bias[c])
        return best

    def score(self, text: str | None) -> float:
        logit = float(self.pooled(words_of(text) if text else []) @ self.model.out) + self.model.out_bias
        return float(1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30))))


def known_parts(texts: list[np.ndarray], least_share: float) -> np.ndarray:
    """The parts of words in at least three texts and at least ``least_share`` of them, sorted."""
    if not texts:
        return np.zeros(0, dtype=np.int32)
    parts, n = np.unique(np.concatenate([np.unique(t) for t in texts]), return_counts=True)
    return parts[(n >= max(3, least_share * len(texts))) & (parts >= 0)]


def first_weights(known: np.ndarray, share: float, rng: np.random.Generator) -> list[np.ndarray]:
    """Table, bias, output weights and filters, their sums of squared gradients, output bias.

    ``share`` is the share of the texts that are toxic.
    """
    table = np.zeros((len(known) + 1, SIZE), dtype=np.float32)
    filters = [rng.normal(0, 0.5, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    bias = np.full(len(WIDTHS) * FILTERS, 0.01, dtype=np.float32)
    out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
    rate_of = float(np.clip(share, 0.01, 0.99))
    parts = [table, bias, out, *filters]
    return [*parts, *[np.full_like(p, 1e-2) for p in parts], np.array(np.log(rate_of / (1 - rate_of)))]


def descend(
    weights: list[np.ndarray], rows: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator,
    rate: float = 0.05, hidden: float = 0.5, shares: tuple[float, float] = (1.0, 1.0),
) -> None:
    """One pass of Adagrad over texts, one at a time and in place.

    A text's gradient reaches only the windows that won the pooling; ``rows`` are its rows of
    the table. A share ``hidden`` of its words is hidden at random, so that no single word
    decides. ``shares`` weigh the clean and the toxic texts.
    """
    k0 = 3 + len(WIDTHS)
    table, bias, out, *filters = weights[:k0]
    g_table, g_bias, g_out, *g_filters = weights[k0: 2 * k0]
    out_bias = weights[-1]
    for i in rng.permutation(len(rows)):
        n = len(rows[i])
        if n == 0:
            continue
        r = np.where(rng.random((n, 1)) < hidden, 0, rows[i])
        pooled, winners = np.zeros_like(out), np.zeros(len(out), dtype=np.int64)
        emb = table[np.concatenate([r, np.zeros((max(WIDTHS) - 1, PARTS), dtype=r.dtype)])].sum(axis=1)
        for j, w in enumerate(WIDTHS):
            act = sum(emb[k: k + n] @ filters[j][k] for k in range(w))
            c = slice(j * FILTERS, (j + 1) * FILTERS)
            winners[c] = act.argmax(axis=0)
            pooled[c] = act.max(axis=0) + bias[c]
        live = pooled > 0
        pooled = np.where(live, pooled, 0)
        chance = 1.0 / (1.0 + np.exp(-np.clip(pooled @ out + float(out_bias), -30, 30)))
        err = np.float32((chance - labels[i]) * shares[int(labels[i] > 0)])
        back = err * out * live
        g = err * pooled
        g_out += g * g
        out -= rate * g / np.sqrt(g_out)
        out_bias -= 0.01 * float(err)
        g_bias += back * back
        bias -= rate * back / np.sqrt(g_bias)
        for j, w in enumerate(WIDTHS):
            b, win = back[j * FILTERS: (j + 1) * FILTERS], winners[j * FILTERS: (j + 1) * FILTERS]
            for k in range(w):
                at = win + k
                words = np.where(at[:, None] < n, r[np.minimum(at, n - 1)], 0)
                d_filter = emb[at].T * b
                d_words = b[:, None] * filters[j][k].T
                g_filters[j][k] += d_filter * d_filter
                filters[j][k] -= rate * d_filter / np.sqrt(g_filters[j][k])
                for p in words.T:
                    seen = p > 0
                    np.add.at(g_table, p[seen], d_words[seen] ** 2)
                    np.add.at(table, p[seen], -rate * d_words[seen] / np.sqrt(g_table[p[seen]]))


def parts_of(known: np.ndarray, weights: list[np.ndarray]):
    """The first six fields of a model."""
    table, bias, out, *filters = weights[: 3 + len(WIDTHS)]
    return known, table, tuple(filters), bias, out, float(weights[-1])


def fit_cnn(
    texts: list[np.ndarray], labels: np.ndarray, steps: int = 12_000, rate: float = 0.05,
    least_share: float = 0.0025, hidden: float = 0.5, seed: int = 3,
):
    """Embeddings, filters and output weights by Adagrad, one text at a time.

    Words in fewer texts than ``least_share`` of them, or than three, would be learned by
    heart; they, like any word that training never saw, stay the zero vector and say
    nothing. ``steps`` texts are visited, in passes.
    """
    rng = np.random.default_rng(seed)
    known = known_parts(texts, least_share)
    rows = [_rows(t, known) for t in texts]
    weights = first_weights(known, labels.mean() if len(labels) else 0.5, rng)
    for _ in range(max(1, round(steps / max(1, len(rows))))):
        descend(weights, rows, labels, rng, rate, hidden)
    return parts_of(known, weights)


def score_hashes(hashes: np.ndarray, model: ToxicityModel) -> float:
    """The score of one text given by its part hashes."""
    emb = np.concatenate([
        model.table[_rows(hashes, model.known)].sum(axis=1), np.zeros((max(WIDTHS) - 1, SIZE), dtype=np.float32)
    ])
    n, best = len(hashes), np.zeros_like(model.out)
    if n:
        for j, f in enumerate(model.filters):
            c = slice(j * FILTERS, (j + 1) * FILTERS)
            act = sum(emb[k: k + n] @ f[k] for k in range(len(f)))
            best[c] = np.maximum(0, act.max(axis=0) + model.bias[c])
    logit = float(best @ model.out) + model.out_bias
    return float(1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30))))


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold with the best F1, in the middle of its gap; 0.5 where one class is missing."""
    bins = pd.DataFrame({"low": scores, "high": scores, "n": 1, "hit": labels})
    return best_of_bins(bins) if len(scores) else 0.5


def best_of_bins(bins: pd.DataFrame) -> float:
    """``best_threshold`` of scores counted in bins: each bin's lowest and highest score, its
    number of texts ``n`` and of toxic ones ``hit``."""
    n, y = bins["n"].sum(), bins["hit"].sum()
    if y == 0 or y == n:
        return 0.5
    bins = bins.sort_values("low", ascending=False, kind="stable")
    low, high = bins["low"].to_numpy(), bins["high"].to_numpy()
    f1 = 2 * bins["hit"].cumsum().to_numpy() / (bins["n"].cumsum().to_numpy() + y)
    k = int(np.argmax(f1))
    return float((low[k] + (high[k + 1] if k + 1 < len(low) else 0.0)) / 2)


BINS = 10_000
ROUNDS = 8


def _packed(weights: list[np.ndarray], n: int) -> pd.DataFrame:
    return pd.DataFrame({"n": [n], "weights": [pickle.dumps(weights)]})


def changed_rows(weights: list[np.ndarray], own: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per array, which rows ``own`` has other than ``weights``, and those rows.

    A task changes the table only where its own texts' words are, so with few texts a task
    little of the table is written.
    """
    out = []
    for w, o in zip(weights, own):
        w, o = np.atleast_1d(w), np.atleast_1d(o)
        other = np.flatnonzero((w != o).reshape(len(w), -1).any(axis=1)).astype(np.int32)
        out.append((other, o[other]))
    return out


def add_changed(total: list[np.ndarray], weights: list[np.ndarray], made: list[tuple[np.ndarray, np.ndarray]], share: float) -> None:
    """Add to ``total``, in place, a share of ``weights`` with the rows of ``changed_rows`` put in."""
    for t, w, (at, rows) in zip(total, weights, made):
        whole = np.atleast_1d(w).copy()
        whole[at] = rows
        t += whole.reshape(w.shape) * share


def _trained(rows: DataFrame, known: np.ndarray, weights: list[np.ndarray], shares: tuple[float, float], seed: int) -> list[np.ndarray]:
    """The weights after one pass over ``rows``: every task goes on from ``weights`` with its
    own rows, and the mean of the tasks counts, by their number of rows. A task writes the
    rows of the weights that it changed; one task takes the mean, a task's rows at a time;
    the driver gets the mean alone."""
    total = rows.count()
    if not total:
        return weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, n = [w.copy() for w in weights], 0
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            texts = [_rows(np.asarray(w, dtype=np.int32).reshape(-1, PARTS), known) for w in batch["words"]]
            descend(own, texts, batch["toxic"].to_numpy(dtype=np.float32), rng, shares=shares)
            n += len(texts)
        if n:
            yield _packed(changed_rows(weights, own), n)

    def averaged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mean = [np.zeros(w.shape, dtype=np.float64) for w in weights]
        for batch in batches:
            for n, packed in zip(batch["n"], batch["weights"]):
                add_changed(mean, weights, pickle.loads(packed), int(n) / total)
        yield _packed([m.astype(w.dtype) for m, w in zip(mean, weights)], total)

    spark = rows.sparkSession
    dealt = rows.repartition(spark.sparkContext.defaultParallelism, "draw").sortWithinPartitions("draw", "doc_id", "words")
    made = dealt.mapInPandas(run, "n long, weights binary")
    mean = made.repartition(1).sortWithinPartitions("n", "weights").mapInPandas(averaged, "n long, weights binary")
    return pickle.loads(mean.collect()[0]["weights"])


def train(
    docs: DataFrame, labels: DataFrame, first_per_class: int = 1500, seed: int = 5,
    least_per_language: int = 30, steps: int = 12_000, least_share: float = 0.0025,
) -> ToxicityModel:
    """Learn from all of ``docs`` (doc_id, text, lang) that ``labels`` (doc_id, toxic) marks.

    Where an id is labelled more than once, the largest counts. A quarter of the rows, by
    hash, is kept from the fit and sets the thresholds: one over all, and one per language
    with at least ``least_per_language`` such rows. The words known are counted over all
    rows of the fit. Training starts in one task with about ``first_per_class`` rows of each
    class, visited in passes until ``steps`` are done; all other rows follow once each, in
    rounds: the tasks of a round go on from the same weights and their mean is taken. There
    the more frequent class weighs less, so that both weigh the same. ``lang`` serves
    thresholds only, never a score. No label or no text gives a model that scores one half
    or the share of the one class.
    """
    marked = settled(labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    ).filter("toxic in (0, 1)"), "toxic-labels")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "draw": batch["draw"], "doc_id": batch["doc_id"], "toxic": batch["toxic"], "lang": batch["lang"],
                "words": [word_hashes(t).ravel() for t in batch["text"]],
            })

    drawn = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30))
    rows = settled(
        docs.select("doc_id", "text", "lang").filter("text is not null").join(by_size(marked), "doc_id")
        .select(drawn.alias("draw"), "doc_id", "toxic", "lang", "text")
        .mapInPandas(hashed, "draw long, doc_id long, toxic int, lang string, words array<int>"), "toxic-rows"
    )
    held = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(4)) == 3
    fit = rows.filter(~held)
    counts = {r["toxic"]: r["n"] for r in fit.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    known = np.array(sorted(r["part"] for r in (
        fit.select(F.explode(F.array_distinct("words")).alias("part")).filter("part >= 0")
        .groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") >= max(3, least_share * n)).collect()
    )), dtype=np.int32)

    share = lambda c: int((1 << 30) * min(1.0, first_per_class / counts.get(c, 1)))
    first = F.col("draw") <= F.when(F.col("toxic") == 1, share(1)).otherwise(share(0))

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, toxic = [], []
        for batch in batches:
            texts += [_rows(np.asarray(w, dtype=np.int32).reshape(-1, PARTS), known) for w in batch["words"]]
            toxic += batch["toxic"].tolist()
        marks, rng = np.array(toxic, dtype=np.float32), np.random.default_rng(3)
        weights = first_weights(known, marks.mean() if toxic else 0.5, rng)
        for _ in range(max(1, round(steps / max(1, len(texts))))):
            descend(weights, texts, marks, rng)
        yield _packed(weights, len(texts))

    made = fit.filter(first).repartition(1).sortWithinPartitions("draw", "doc_id", "words").mapInPandas(
        start, "n long, weights binary").collect()
    weights = pickle.loads(made[0]["weights"]) if made else first_weights(known, 0.5, np.random.default_rng(3))
    least = min(counts.values(), default=0)
    shares = tuple(least / counts[c] if c in counts else 1.0 for c in (0, 1))
    rest = fit.filter(~first)
    if not rest.isEmpty():
        place = F.pmod(F.xxhash64(F.lit(seed + 2), "doc_id"), F.lit(ROUNDS))
        for r in range(ROUNDS):
            weights = _trained(rest.filter(place == r), known, weights, shares, seed + r)
    parts = parts_of(known, weights)
    model = ToxicityModel(*parts, {}, 0.5)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "toxic": batch["toxic"], "score": [
                score_hashes(np.asarray(w, dtype=np.int32).reshape(-1, PARTS), model) for w in batch["words"]
            ]})

    bins = pd.DataFrame(
        [r.asDict() for r in rows.filter(held).mapInPandas(scored, "lang string, toxic int, score double")
         .groupBy("lang", F.floor(F.col("score") * BINS).alias("bin"))
         .agg(F.min("score").alias("low"), F.max("score").alias("high"), F.count("*").alias("n"), F.sum("toxic").alias("hit"))
         .collect()], columns=["lang", "bin", "low", "high", "n", "hit"],
    )
    forget(rows)
    forget(marked)
    thresholds = {
        lang: best_of_bins(own) for lang, own in bins.groupby("lang") if own["n"].sum() >= least_per_language
    }
    every = bins.groupby("bin").agg({"low": "min", "high": "max", "n": "sum", "hit": "sum"})
    return ToxicityModel(*parts, thresholds, best_of_bins(every))


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score from 0 to 1 of whole texts; null, empty and wordless texts get the model's base score."""

    @pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return run(text)


def is_toxic(score: Column, lang: Column, model: ToxicityModel) -> Column:
    """Whether the score reaches the threshold of the language, or the general one."""
    own = F.lit(None).cast("double")
    if model.thresholds:
        own = F.create_map(*[F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair])[lang]
    return score >= F.coalesce(own, F.lit(model.threshold))
