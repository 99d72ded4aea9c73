"""Seed lists and platform maps as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``ord, line`` of a text file or folder.

    ``ord`` grows with file, then place in the file: path, start of the split, and the
    number Spark gives the rows of a split. It is used for order only, never as a key.
    """
    return spark.read.text(path).select(
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"),
        F.col("value").alias("line"),
    )


def seeds_from_lines(lines: DataFrame) -> DataFrame:
    """``url[,platform]`` lines: trimmed, blanks and '#' comments dropped."""
    line = F.trim("line")
    parts = F.split(line, ",")
    return (
        lines.filter((line != "") & ~line.startswith("#"))
        .select(
            "ord",
            F.trim(parts[0]).alias("url"),
            F.nullif(F.trim(F.get(parts, 1)), F.lit("")).alias("platform"),
        )
    )


def seeds_from_json(docs: DataFrame) -> DataFrame:
    """Inline seeds: each ``item`` is a JSON string or a ``{url, platform}`` object."""
    value = F.try_parse_json("item")
    is_text = F.schema_of_variant(value) == "STRING"
    text = value.cast("string")
    parts = F.split(text, ",")
    url = F.when(is_text, F.trim(parts[0])).otherwise(F.try_variant_get(value, "$.url", "string"))
    platform = F.when(is_text, F.trim(F.get(parts, 1))).otherwise(
        F.try_variant_get(value, "$.platform", "string")
    )
    return docs.select("ord", url.alias("url"), F.nullif(platform, F.lit("")).alias("platform"))


def platform_map_from_lines(lines: DataFrame, header: str = "always") -> DataFrame:
    """``url,platform,via,cname`` rows.

    ``header='always'``: the first line is dropped whatever it says;
    ``header='if_named'``: it is data unless it reads ``url,platform...``.
    """
    named = F.col("line").rlike(r"(?i)^url,platform")
    lines = lines.filter(F.trim("line") != "")
    if header == "always":
        first = lines.agg(F.min("ord").alias("_first"))  # one row
        rows = lines.join(F.broadcast(first), lines["ord"] != first["_first"]).drop("_first")
    else:
        rows = lines.filter(~named)
    parts = F.split("line", ",")
    names = ["url", "platform", "via", "cname"]
    return rows.select(
        "ord", *[F.nullif(F.trim(F.get(parts, i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    )
