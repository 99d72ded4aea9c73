"""Captured pages and JSON responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..operators.keyed import beside
from ..schemas import CAPTURE_SCHEMA


def read_captures(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(CAPTURE_SCHEMA).parquet(path)


def dealer_part(url: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(parts)).cast("int")


def write_by_dealer(captures: DataFrame, path: str, parts: int = 256) -> None:
    """Write captures in folders by dealer, for jobs that read a few dealers at a time.

    Rows of a folder may come from many tasks, so a dealer with a third of all pages is
    many files.
    """
    captures.withColumn("dealer_part", dealer_part(F.col("dealer_url"), parts)).write.partitionBy(
        "dealer_part"
    ).parquet(path)


def of_dealers(spark: SparkSession, path: str, dealers: DataFrame, parts: int = 256) -> DataFrame:
    """The captures of ``run_id, dealer_url`` rows: only their folders are read.

    At most ``parts`` numbers reach the driver.
    """
    keys = dealers.select("run_id", "dealer_url").distinct()
    numbers = [r[0] for r in keys.select(dealer_part(F.col("dealer_url"), parts)).distinct().collect()]
    rows = spark.read.parquet(path).filter(F.col("dealer_part").isin(numbers)).drop("dealer_part")
    return rows.join(beside(keys), ["run_id", "dealer_url"], "left_semi")


def stored_by_owner(captures: DataFrame, path: str, name: str, buckets: int = 200) -> DataFrame:
    """Captures as a table ``name`` at ``path``, bucketed by run and dealer.

    Joins with keys bucketed alike move no body. All pages of a dealer are one bucket; where
    one dealer holds a large share of them, ``write_by_dealer`` spreads it over files.
    """
    captures.write.bucketBy(buckets, "run_id", "dealer_url").option("path", path).saveAsTable(name)
    return captures.sparkSession.table(name)


def captures_from_pages(pages: DataFrame, run_id: str = "run-0") -> DataFrame:
    """``page_id, url, html`` as captures of status 200, one page per dealer URL."""
    return pages.select(
        F.col("page_id").alias("capture_id"), F.lit(run_id).alias("run_id"),
        F.col("url").alias("dealer_url"), F.col("url").alias("page_url"),
        F.lit(0).alias("page_ord"), F.lit(200).alias("status"),
        F.lit("text/html").alias("content_type"), F.col("html").alias("body"),
        F.lit(None).cast("string").alias("error"), F.lit(1).alias("attempt"),
        F.lit(None).cast("string").alias("cname"),
        F.lit(None).cast("timestamp").alias("captured_at"),
    )


def html_pages(captures: DataFrame) -> DataFrame:
    """Pages that answered."""
    return captures.filter(
        (F.col("status") < 400) & F.col("error").isNull() & ~F.lower("content_type").contains("json")
    )


def json_responses(captures: DataFrame, chars: tuple[int, int] | None = None) -> DataFrame:
    """JSON responses whose body parses as JSON, of any size or of ``chars`` characters."""
    fits = F.lit(True) if chars is None else F.length("body").between(*chars)
    return captures.filter(
        (F.col("status") < 400)
        & F.lower("content_type").contains("json")
        & ~F.col("page_url").rlike(V.ASSET_URL)
        & fits
        & F.try_parse_json("body").isNotNull()
    )
