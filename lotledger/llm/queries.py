"""The queries of the training-data operators and the SQL that says the same.

Each query reads its whole table through the operator, with production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import budget_mix, filter_audit, fuzzy_lines, jaccard_join, langid, link_trust, nbest_pieces, permutation_index, piecewise_hash, sorted_projection, spelling_variants, sql, toxicity, warc_derivatives
from .common import id_remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _query(name: str, oracle: str | None = None):
    def add(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run

    return add


@_query("op10_warc_derivatives", sql.WARC)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    responses = warc_derivatives.responses_of_pages(pages, "2024-01-01T00:00:00Z")
    return warc_derivatives.derivatives(responses, ["page_id"])


# (verdict, host, path): fixed values of the query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@_query("op7_link_trust", sql.LINK_TRUST)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "rule_verdict string, rule_host string, rule_path string")
    return link_trust.judge_pages(_table(spark, sf, "pages"), rules)


@_query("op8_budget_mix")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    mix = budget_mix.decide(_table(spark, sf, "documents"), [1, 2, 3])
    return mix.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "source", "copies",
    )


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def language_model(docs: DataFrame):
    """Learned from the rows whose crc32 of the id is not 0 mod 5."""
    return langid.train(docs.filter(id_remainder(F.col("doc_id"), 5) != 0))


@_query("op1_language_id")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    said = langid.predicted(F.col("text"), language_model(docs))
    return docs.select(
        "doc_id", F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        said.alias("said"),
    ).select("doc_id", "held_out", F.col("said.lang").alias("lang_pred"), F.col("said.score").alias("score"))


@_query("op4_nbest_pieces")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return nbest_pieces.encode(_table(spark, sf, "documents"), nbest_pieces.load_vocabulary(PIECE_MODEL), n=4)


@_query("op6_toxicity")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    labels = _table(spark, sf, "labels").filter(id_remainder(F.col("doc_id"), 4) != 2)
    model = toxicity.train(docs, labels)
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), "lang",
        toxicity.toxicity_score(F.col("text"), model).alias("score"),
    )
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        toxicity.is_toxic(F.col("score"), F.col("lang"), model).alias("flagged"),
    )


@_query("op3_permutation_index")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return permutation_index.nearest(_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@_query("op9_sorted_projection", sql.NEAR_VECTORS)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return sorted_projection.near_duplicates(_table(spark, sf, "embeddings"))


@_query("op2_jaccard_join")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.similar_documents(_table(spark, sf, "documents"))


@_query("op5_fuzzy_lines")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return fuzzy_lines.dedup_lines(docs)


@_query("op11_piecewise_hash")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return piecewise_hash.with_neighbours(_table(spark, sf, "documents"))


@_query("op12_spelling_variants")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants.variants(_table(spark, sf, "documents"))


@_query("op13_filter_audit", sql.FILTER_AUDIT)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))
