"""The training-data pipeline over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the docs of the next one. All but the last return the columns of
``documents``; decisions of a stage take effect in its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotledger.llm import budget_mix, fuzzy_lines, jaccard_join, langid, nbest_pieces
from lotledger.llm.common import settled
from lotledger.llm.queries import PIECE_MODEL, language_model


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language the model knows, go."""
    return langid.keep_known(docs, language_model(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and similar lines the first stays; ``n_chars`` follows the text.

    A document that loses its last line is a copy of others and goes.
    """
    lean = fuzzy_lines.dedup_lines(docs)
    lines, dropped = lean.columns[-2:]
    return lean.filter(f"{dropped} = 0 or {dropped} < {lines}").withColumn(
        "n_chars", F.char_length("text").cast("long")
    ).select(*docs.columns)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays."""
    return jaccard_join.keep_first(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources by weights 1, 2, 3 takes them."""
    return budget_mix.mixed(docs, [1, 2, 3])


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the whole texts, with the scores of the four best segmentations."""
    vocabulary = nbest_pieces.load_vocabulary(PIECE_MODEL)
    return nbest_pieces.encode(docs, vocabulary, n=4, keep=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", known_language),
    ("line_dedup", line_dedup),
    ("jaccard_join", one_of_similar),
    ("source_mix", source_mix),
    ("piece_ids", piece_ids),
]

# The language model, MinHash and the knapsack are beyond SQL; the tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
