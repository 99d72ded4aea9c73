"""What a task of a training round writes."""

import pickle

import numpy as np

from lotledger.llm import toxicity


def test_a_round_writes_the_changed_rows_only():
    rng = np.random.default_rng(1)
    known = np.arange(20_000, dtype=np.int32)
    weights = toxicity.first_weights(known, 0.3, rng)
    texts = [rng.integers(1, 20_001, (40, toxicity.PARTS)) for _ in range(6)]
    owns = []
    for texts_of_task in (texts[:2], texts[2:]):
        own = [w.copy() for w in weights]
        toxicity.descend(own, texts_of_task, np.array([0, 1, 0, 1][: len(texts_of_task)], dtype=np.float32), rng)
        owns.append(own)
    mean = [np.zeros(w.shape, dtype=np.float64) for w in weights]
    for own, share in zip(owns, (1 / 3, 2 / 3)):
        made = pickle.dumps(toxicity.changed_rows(weights, own))
        assert len(made) < len(pickle.dumps(weights)) / 10
        toxicity.add_changed(mean, weights, pickle.loads(made), share)
    for m, a, b in zip(mean, *owns):
        assert np.allclose(m, a / 3 + b * 2 / 3, rtol=1e-6, atol=1e-9)


def test_a_round_gives_the_mean_of_its_tasks(spark):
    """Whole weights, as they are after one pass over the rows of each task."""
    rng = np.random.default_rng(2)
    known = np.arange(500, dtype=np.int32)
    weights = toxicity.first_weights(known, 0.5, rng)
    rows = [(d, d, d % 2, rng.integers(0, 500, 30 * toxicity.PARTS).tolist()) for d in range(40)]
    df = spark.createDataFrame(rows, "draw long, doc_id long, toxic int, words array<int>")
    got = toxicity._trained(df, known, weights, (1.0, 1.0), 7)
    n = spark.sparkContext.defaultParallelism
    tasks = [
        sorted(r["draw"] for r in part)
        for part in df.repartition(n, "draw").select("draw").rdd.glom().collect()
    ]
    want = [np.zeros(w.shape, dtype=np.float64) for w in weights]
    for p, draws in enumerate(tasks):
        if not draws:
            continue
        own = [w.copy() for w in weights]
        texts = [toxicity._rows(np.array(rows[d][3], dtype=np.int32).reshape(-1, toxicity.PARTS), known) for d in draws]
        toxicity.descend(own, texts, np.array([d % 2 for d in draws], dtype=np.float32), np.random.default_rng([7, p]))
        for w, o in zip(want, own):
            w += o * (len(draws) / len(rows))
    for a, b in zip(got, want):
        assert np.allclose(a, b, rtol=1e-5, atol=1e-6)
