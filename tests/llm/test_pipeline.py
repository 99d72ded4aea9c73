"""Each stage of the pipeline on its own input, against what brute force keeps."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotledger.llm import nbest_pieces
from lotledger.llm.budget_mix import water_filled
from odd_rows import ODD, documents
from test_documents import SPACE, best_gap, brute_components, brute_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(folder)
        out.append((docs, spark.read.parquet(folder)))
        docs = out[-1][1]
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(outputs):
    for before, after in outputs[:-1]:
        assert after.columns == before.columns


def test_language_stage_keeps_clean_documents(outputs):
    before, after = outputs[0]
    kept = {i for i, _ in texts(after)}
    assert all(i in kept or not any(c.isalpha() for c in t) for i, t in texts(before))


def test_line_stage(outputs):
    before, after = outputs[1]
    want = brute_lines(texts(before))
    was = dict(texts(before))
    left = {i: t for i, t in want.items() if t == was[i] or any(x.strip(" \t\r") for x in t.split("\n"))}
    assert dict(texts(after)) == left
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_similar_stage(outputs):
    before, after = outputs[2]
    want = {i for i, _, c in brute_components(texts(before)) if i == c}
    assert sorted(texts(after)) == sorted((i, t) for i, t in texts(before) if i in want)


def test_mix_stage(outputs):
    before, after = outputs[3]
    words, own = collections.Counter(), collections.defaultdict(list)
    for r in before.collect():
        own[r["source"]].append(len(SPACE.findall(r["text"])))
    for r in after.collect():
        words[r["source"]] += len(SPACE.findall(r["text"]))
    names = sorted(own)
    targets = water_filled([sum(own[s]) for s in names], [(1, 2, 3)[k % 3] for k in range(len(names))], 3)
    for s, target in zip(names, targets):
        assert abs(words[s] - target) <= best_gap(own[s], target) + 1
    assert set(texts(after)) <= set(texts(before))


def test_piece_stage(outputs, vocabulary):
    before, after = outputs[4]
    got = collections.Counter((r["doc_id"], nbest_pieces.decode_ids(r["ids"], vocabulary)) for r in after.collect())
    assert got == collections.Counter(texts(before))


def test_stages_stand_odd_rows_and_no_rows(spark, tmp_path):
    for k, rows in enumerate((ODD, [])):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            folder = str(tmp_path / f"{k}-{name}")
            out = stage(spark, docs, SF)
            out.withColumns({c: F.col(c).cast("string") for c, t in out.dtypes if t == "void"}).write.parquet(folder)
            docs = spark.read.parquet(folder)
        assert docs.count() >= (0 if not rows else 1)


def test_line_stage_tells_rows_without_id_apart(spark):
    again = "the very same line stands here again"
    rows = [(None, "\n".join([again] * 3 + ["clean line of A"]), "en", "a"), (None, "clean and short B", "en", "a")]
    left = corpus_pipeline.line_dedup(spark, documents(spark, rows), SF)
    assert sorted(r["text"] for r in left.collect()) == ["clean and short B", f"{again}\nclean line of A"]
