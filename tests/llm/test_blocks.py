"""Blocks of `op2` that repeat each other."""

import itertools
import random

import numpy as np
import pytest

from lotledger.llm import jaccard_join


def shingles(text):
    words = text.split()
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)}


def test_blocks_that_repeat_each_other_are_compared_once(spark, monkeypatch):
    # Texts of one long passage, 0.75 alike, have the same tokens; ten have a copy with a new last word.
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(60):
        words = base + [f"own{i}x{k}" for k in range(24)]
        rows.append((i, " ".join(words)))
        if i < 10:
            rows.append((100 + i, " ".join(words[:-1] + ["new"])))
    got = {}
    whole = jaccard_join.tree_pairs

    def seen(members):
        got["postings"], got["blocks"] = members.count(), members.select("token").distinct().count()
        got["pairs"] = whole(members)
        return got["pairs"]

    monkeypatch.setattr(jaccard_join, "tree_pairs", seen)
    out = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    sets = [shingles(t) for _, t in rows]
    links = {
        rows[i][0]: sum(5 * len(s & t) >= 4 * len(s | t) for j, t in enumerate(sets) if j != i) for i, s in enumerate(sets)
    }
    assert {r["doc_id"]: r["n_links"] for r in out.collect()} == links
    assert got["postings"] < 4 * len(rows)


def test_covered_blocks_lose_no_pair(spark):
    rng = random.Random(5)
    blocks = {t: set(rng.sample(range(30), rng.randint(2, 12))) for t in range(40)}
    for t in range(40, 80):  # the same again, and parts of them
        same = sorted(blocks[t - 40])
        blocks[t] = set(same) if t % 2 else set(same[: max(2, len(same) // 2)])
    rows = [(t, f, len(b)) for t, b in blocks.items() for f in b]
    kept = {}
    for r in jaccard_join.uncovered_blocks(spark.createDataFrame(rows, "token long, fp long, members long")).collect():
        kept.setdefault(r["token"], set()).add(r["fp"])
    pairs = lambda bs: {p for b in bs.values() for p in itertools.combinations(sorted(b), 2)}
    assert pairs(kept) == pairs(blocks)
    assert all(kept[t] == blocks[t] for t in kept) and len(kept) <= 60
    assert len({frozenset(b) for b in kept.values()}) == len(kept)


@pytest.mark.parametrize("listed", [1, 3, 16])
def test_named_blocks_lose_no_pair(spark, monkeypatch, listed):
    monkeypatch.setattr(jaccard_join, "LISTED", listed)
    rng = random.Random(7)
    blocks = {t: rng.sample(range(40), rng.choice([2, 3, 9, 15, 30])) for t in range(30)}
    bits = {f: jaccard_join.signature(np.arange(f % 3, 50, dtype=np.uint64) << np.uint64(40)).tobytes() for f in range(40)}
    rows = [(t, len(b), f, 50 - f % 3, bits[f], f) for t, b in blocks.items() for f in b]
    df = spark.createDataFrame(rows, "token long, members long, fp long, n long, bits binary, component long")
    found = {tuple(r) for r in jaccard_join.tree_pairs(df).collect()}
    assert found == {p for b in blocks.values() for p in itertools.combinations(sorted(b), 2)}
