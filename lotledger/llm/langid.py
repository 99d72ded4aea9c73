"""Language of a text: sparse multinomial logistic regression on character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from .common import bounded_batches, free_name

BITS = 15
BUCKETS = 1 << BITS
ORDERS = 3
PIECE = 1 << 20
# Odd multipliers, one per order, for hashing windows of code points.
MIX = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter; made once per process."""
    if not _LETTERS:
        _LETTERS.append(
            np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        )
    return _LETTERS[0]


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts per bucket of the 1- to 3-grams of lower-cased letters; None without a letter.

    Everything that is no letter counts as one blank. Long texts are read in pieces that
    overlap by two characters, so memory does not grow with the text.
    """
    counts, letters = None, _letters()
    for at in range(0, len(text), PIECE):
        part = text[max(0, at - ORDERS + 1): at + PIECE].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        known = letters[codes]
        if counts is None:
            counts = np.zeros(BUCKETS, dtype=np.int64)
        # Blanks after blanks are dropped.
        stay = known.copy()
        stay[1:] |= known[:-1]
        codes = np.where(known, codes, np.uint32(32))[stay]
        rolling = np.zeros(len(codes), dtype=np.uint32)
        for order in range(ORDERS):
            if len(codes) <= order:
                break
            rolling = rolling[: len(codes) - order] * np.uint32(31) + codes[order:] * np.uint32(MIX[order])
            bucket = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS)
            # In later pieces, windows that the piece before has counted are left out.
            skip = 0 if at == 0 else max(0, ORDERS - 1 - order)
            counts += np.bincount(bucket[skip:], minlength=BUCKETS)
        if at == 0 and len(text) <= PIECE and not known.any():
            return None
    if counts is None or (len(text) > PIECE and not any(c.isalpha() for c in text)):
        return None
    return counts


@dataclass(frozen=True)
class SparseWeights:
    """The weights that are not 0, by bucket: ``starts`` into ``classes`` and ``values``."""

    starts: np.ndarray
    classes: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of(cls, dense: np.ndarray) -> SparseWeights:
        row, at = np.nonzero(dense)
        starts = np.searchsorted(row, np.arange(len(dense) + 1))
        return cls(starts, at.astype(np.int32), dense[row, at], dense.shape[1])

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """``x`` times the rows ``at``."""
        first, n = self.starts[at], self.starts[at + 1] - self.starts[at]
        place = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        return np.bincount(self.classes[place], np.repeat(x, n) * self.values[place], self.width)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: SparseWeights
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text) if text is not None else None
        if counts is None or not self.languages:
            return "und", 0.0
        at = np.flatnonzero(counts)
        p = softmax((self.weights.logits(at, _scaled(counts[at], self.idf[at])) + self.bias) / self.temperature)
        k = int(np.argmax(p))
        return self.languages[k], float(p[k])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _scaled(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with logarithmic counts and unit length."""
    x = (1.0 + np.log(counts)) * idf
    size = np.sqrt(x @ x)
    return x / size if size else x


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 3,
    alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by follow-the-regularised-leader with elastic-net penalties.

    ``rows``: (buckets, values, class). Per coordinate the leader's weight is 0 while its
    summed gradient is below ``l1``; else it is shrunk by ``l1`` and ``l2``.
    """
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros_like(z)

    def leader(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        step = (beta + np.sqrt(ns)) / alpha + l2
        return -np.sign(zs) * np.maximum(np.abs(zs) - l1, 0.0) / step

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, label = rows[i]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = leader(z[at], n[at])
            p = softmax(x @ w)
            p[label] -= 1.0
            g = np.outer(x, p)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = leader(z, n)
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest log loss, on a grid in the logarithm from 1/20 to 20."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20.0), 121))
    own = np.arange(len(labels))
    loss = [-np.log(np.maximum(softmax(logits / t)[own, labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    sample_per_language: int = 500, seed: int = 11,
) -> LanguageModel:
    """Learn from rows with a non-null ``lang``; ``key`` is only hashed, to draw the sample.

    Document frequencies are counted over all labelled rows with a letter. The classifier is
    fitted on about ``sample_per_language`` rows of each language, drawn by hash;
    every language that labels a row is learned. A quarter of the drawn rows, never used in
    the fit, sets the temperature. What reaches the driver is bounded by the rows per language,
    the number of languages and the number of buckets; weights of 0 are not shipped.
    No labelled row gives a model without languages, which answers ``und``.
    """
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).filter("text is not null and lang is not null")
    found = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = tuple(sorted(r["lang"] for r in found))
    if not languages:
        return LanguageModel((), np.zeros(0), SparseWeights.of(np.zeros((0, 0))), np.zeros(0), 1.0)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = 0, np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for value in batch["text"]:
                counts = ngram_counts(value)
                if counts is not None:
                    total += 1
                    seen += counts > 0
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(seen[at], total)})

    counted = rows.select("text").mapInPandas(frequencies, "bucket long, n long")
    total, df = 0, np.zeros(BUCKETS)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r["bucket"] < 0:
            total = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0

    drawn = F.pmod(F.xxhash64(F.lit(seed), "key", "text"), F.lit(1 << 30))
    share = labelled.sparkSession.createDataFrame(
        [(r["lang"], int((1 << 30) * min(1.0, sample_per_language / r["n"]))) for r in found], "lang string, share long"
    )

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for value, lang_, draw in zip(batch["text"], batch["lang"], batch["draw"]):
                counts = ngram_counts(value)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    kept.append((lang_, draw, at.astype(np.int32), counts[at].astype(np.int32)))
            yield pd.DataFrame(kept, columns=["lang", "draw", "at", "counts"])

    sample = (
        rows.withColumn("draw", drawn).join(F.broadcast(share), "lang").filter("draw <= share")
        .select("key", "text", "lang", "draw")
        .orderBy("draw", "lang").limit(2 * sample_per_language * len(languages))
        .mapInPandas(sparse, "lang string, draw long, at array<int>, counts array<int>").collect()
    )
    sample.sort(key=lambda r: (r["draw"], r["lang"], r["at"]))
    examples, place = [], {name: i for i, name in enumerate(languages)}
    for r in sample:
        at = np.array(r["at"], dtype=np.int64)
        x = _scaled(np.array(r["counts"], dtype=float), idf[at])
        examples.append((at, x, place[r["lang"]]))
    kept = [e for i, e in enumerate(examples) if i % 4 != 3]
    held = [e for i, e in enumerate(examples) if i % 4 == 3]
    weights, bias = fit_ftrl(kept, len(languages))
    logits = np.array([x @ weights[at] + bias for at, x, _ in held]).reshape(len(held), len(languages))
    temperature = fit_temperature(logits, np.array([c for _, _, c in held], dtype=np.int64))
    return LanguageModel(languages, idf, SparseWeights.of(weights), bias, temperature)


def predicted(text: Column, model: LanguageModel) -> Column:
    """struct(lang, score) of a text column.

    ``und`` with score 0 for a null text, one without a letter, or a model that has learned
    nothing; else a learned language and its calibrated probability. Whole texts, row by
    row: repeated rows agree.
    """

    @pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score"])

    return run(text)


def keep_known(docs: DataFrame, model: LanguageModel, least: float = 0.3) -> DataFrame:
    """The rows whose language is known with a score of ``least`` or more; columns as they were."""
    name = free_name(docs, "langid")
    return docs.withColumn(name, predicted(F.col("text"), model)).filter(
        (F.col(name)["lang"] != "und") & (F.col(name)["score"] >= least)
    ).select(*docs.columns)
