"""Metadata and plain-text conversion records made from captured responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# Fixed order: what is removed, what breaks a line, what is dropped.
HIDDEN = r"(?is)<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</(script|style|noscript|template)\s*>"
BREAKS = r"(?i)<(/?(p|div|section|article|header|footer|nav|main|ul|ol|li|table|tr|h[1-6]|title|blockquote|pre)\b[^>]*|br\b[^>]*|hr\b[^>]*)>"
TAG = r"<[/!?a-zA-Z][^>]*>"
# Named character references in the order they are resolved; &amp; last.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]


def sha1_label(block: Column) -> Column:
    """``sha1:`` and the digest in base 32, as WARC tools write it."""
    hexed = F.upper(F.sha1(block.cast("binary")))
    parts = [
        F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), BASE32_HEX, BASE32))


def record_urn(*parts: Column) -> Column:
    """A record id that depends on the given values only, so reruns agree."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def plain_text(html: Column) -> Column:
    """Visible text: one line per block element, blanks collapsed, empty lines left out."""
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(text, r"\s+", " ")
    text = F.regexp_replace(text, BREAKS, "\n")
    text = F.regexp_replace(text, TAG, "")
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    text = F.regexp_replace(text, r"[ \t\r]+", " ")
    return F.trim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def responses_of_pages(pages: DataFrame, date: str) -> DataFrame:
    """Pages (page_id, url, html) as response records.

    A null ``html`` is an empty payload, a null ``url`` stays null. Repeated rows give
    repeated records with the same id. Other columns are not read.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(CRLF + CRLF),
    )
    return pages.select(
        "page_id",
        record_urn(F.lit("response"), F.col("page_id"), F.col("url")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.concat(head, body).alias("block"),
    )


def derivatives(responses: DataFrame, keep: list[str]) -> DataFrame:
    """Two records per response: ``metadata`` and ``conversion``.

    ``responses``: record_id, target_uri, date, block (status line, headers, blank line,
    payload), and the columns named in ``keep``, which are carried along. Returns ``keep``
    and record_type, record_id, refers_to, target_uri, date, content_type, content_length,
    block_digest, source_block_digest, source_payload_digest, block, record.

    ``refers_to`` is the response's record id, unchanged. The metadata block
    (application/warc-fields) holds the digests of the source's block and payload and every
    source header line as it stood. The conversion block is the payload's plain text.
    ``record`` is the whole record, headers and block, as it stands in a file.

    A null block counts as empty; a block without blank line has headers only. A null
    target has no WARC-Target-URI line. Empty input gives no rows. Row by row: no shuffle,
    so hot hosts, repeated rows and very long pages need nothing special.
    """
    cut = F.instr(F.col("block"), CRLF + CRLF)
    src = responses.select(
        *keep, "record_id", "target_uri", "date", F.coalesce("block", F.lit("")).alias("block")
    )
    # Behind a generator, so that digests and text are computed once per page.
    source = src.select(
        *keep, F.col("record_id").alias("refers_to"), "target_uri", "date",
        F.explode(F.array(F.struct(
            F.when(cut > 0, F.expr("substring(block, 1, instr(block, '\r\n\r\n') - 1)"))
            .otherwise(F.col("block")).alias("head"),
            F.when(cut > 0, F.expr("substring(block, instr(block, '\r\n\r\n') + 4)"))
            .otherwise(F.lit("")).alias("payload"),
            sha1_label(F.col("block")).alias("block_digest"),
        ))).alias("s"),
    )
    payload_digest = sha1_label(F.col("s.payload"))
    lines = F.filter(F.split(F.col("s.head"), CRLF), lambda x: x != "")
    fields = F.concat(
        F.array(
            F.concat(F.lit("source-block-digest: "), F.col("s.block_digest")),
            F.concat(F.lit("source-payload-digest: "), payload_digest),
        ),
        F.transform(lines, lambda x: F.concat(F.lit("source-http: "), x)),
    )
    made = source.select(
        *keep, "refers_to", "target_uri", "date",
        F.col("s.block_digest").alias("source_block_digest"),
        payload_digest.alias("source_payload_digest"),
        F.explode(F.array(
            F.struct(
                F.lit("metadata").alias("record_type"),
                F.lit("application/warc-fields").alias("content_type"),
                F.concat(F.array_join(fields, CRLF), F.lit(CRLF)).alias("block"),
            ),
            F.struct(
                F.lit("conversion").alias("record_type"),
                F.lit("text/plain; charset=utf-8").alias("content_type"),
                plain_text(F.col("s.payload")).alias("block"),
            ),
        )).alias("d"),
    ).select(
        *keep, "d.record_type",
        record_urn(F.col("d.record_type"), F.col("refers_to")).alias("record_id"),
        "refers_to", "target_uri", "date", "d.content_type",
        F.octet_length("d.block").cast("long").alias("content_length"),
        sha1_label(F.col("d.block")).alias("block_digest"),
        "source_block_digest", "source_payload_digest", "d.block",
    )
    header = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), F.col("record_id")),
        F.concat(F.lit("WARC-Refers-To: "), F.col("refers_to")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("target_uri")),
        F.concat(F.lit("WARC-Date: "), F.col("date")),
        F.concat(F.lit("WARC-Block-Digest: "), F.col("block_digest")),
        F.concat(F.lit("Content-Type: "), F.col("content_type")),
        F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string")),
    ]
    return made.withColumn("record", F.concat(
        F.concat_ws(CRLF, *header), F.lit(CRLF + CRLF), F.col("block"), F.lit(CRLF + CRLF)
    ))
