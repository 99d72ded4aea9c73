"""Scores of the trained classifiers, recomputed in plain Python from their dense weights."""

import math

import pytest
from pyspark.sql import functions as F

from lotledger.llm import langid, toxicity
from lotledger.llm.common import id_remainder
from lotledger.llm.queries import QUERIES, language_model

SF = "/root/testdata/sf0.001"
WORD = 1 << 32


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(25).collect()
    odd = ["", "12 34 !!", None, "ß", "Ein Wort", "a", "x y  z" * 40, "été \U0001f600 où"]
    return [(r["doc_id"], r["text"]) for r in rows] + [(-1 - k, t) for k, t in enumerate(odd)]


def plain_language(text, model):
    shown = [c if c.isalpha() else " " for c in text.lower()]
    kept = [c for k, c in enumerate(shown) if c != " " or (k and shown[k - 1] != " ")]
    if not any(c != " " for c in kept):
        return "und", 0.0
    codes, counts = [ord(c) for c in kept], {}
    for start in range(len(codes)):
        h = 0
        for order in range(min(3, len(codes) - start)):
            h = (h * 31 + codes[start + order] * langid.MIX[order]) % WORD
            bucket = ((h ^ h >> 15) * 0x2C1B3C6D % WORD) >> (32 - langid.BITS)
            counts[bucket] = counts.get(bucket, 0) + 1
    x = {b: (1 + math.log(n)) * float(model.idf[b]) for b, n in counts.items()}
    size = math.sqrt(sum(v * v for v in x.values())) or 1.0
    w = model.weights
    logits = [float(b) for b in model.bias]
    for b, v in x.items():
        for k in range(int(w.starts[b]), int(w.starts[b + 1])):
            logits[int(w.classes[k])] += v / size * float(w.values[k])
    top = max(logits)
    e = [math.exp((v - top) / model.temperature) for v in logits]
    best = max(range(len(e)), key=e.__getitem__)
    return model.languages[best], e[best] / sum(e)


def test_language_scores(spark, texts):
    model = language_model(spark.read.parquet(f"{SF}/documents.parquet"))
    for _, text in texts:
        want = plain_language(text, model) if text else ("und", 0.0)
        got = model.predict(text)
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-9
    said = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in QUERIES["op1_language_id"](spark, SF).collect()}
    for i, text in texts:
        if i >= 0:
            lang, score = plain_language(text, model)
            assert said[i][0] == lang and abs(said[i][1] - score) < 1e-9


def plain_toxicity(text, model):
    known = {int(h): k + 1 for k, h in enumerate(model.known)}
    rows = [
        [sum(float(model.table[known.get(p, 0)][d]) for p in toxicity.part_hashes(w)) for d in range(toxicity.SIZE)]
        for w in toxicity.words_of(text or "")
    ]
    logit = float(model.out_bias)
    for j, (width, filters) in enumerate(zip(toxicity.WIDTHS, model.filters)):
        for f in range(toxicity.FILTERS):
            best = 0.0
            for i in range(len(rows)):
                act = sum(
                    rows[i + k][d] * float(filters[k][d][f])
                    for k in range(width) if i + k < len(rows) for d in range(toxicity.SIZE)
                )
                best = max(best, act + float(model.bias[j * toxicity.FILTERS + f]))
            logit += best * float(model.out[j * toxicity.FILTERS + f])
    return 1 / (1 + math.exp(-min(30, max(-30, logit))))


def test_toxicity_scores(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(id_remainder(F.col("doc_id"), 4) != 2)
    model = toxicity.train(docs, labels)
    scorer = toxicity.Scorer(model)
    short = [(i, t) for i, t in texts if len(t or "") < 700]
    assert len(short) > 8
    for _, text in short:
        assert abs(scorer.score(text) - plain_toxicity(text, model)) < 1e-4
    said = {r["doc_id"]: r["score"] for r in QUERIES["op6_toxicity"](spark, SF).collect()}
    for i, text in short:
        if i >= 0:
            assert abs(said[i] - plain_toxicity(text, model)) < 1e-4
