"""WARC derivatives: metadata and plain-text conversion records of responses.

``responses`` wraps stored pages as response records; ``derive`` turns each response
into two linked records, as built-in column expressions only. Both refer to the
response by ``WARC-Refers-To`` and keep its target, date and payload digest; the
metadata record keeps the source's HTTP header fields, title and outlinks, and names
the conversion in ``WARC-Concurrent-To``. Ids are made from the source id, so a rerun
gives the same records. Digests are labelled SHA-256.

Defined cases: a null page is an empty one; a null address is ``urn:page:`` and the
id; equal pages with equal ids give equal records; text behind an unclosed script or
style is dropped; an empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"

# Named character references, the ampersand last.
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&hellip;", "…"),
    ("&laquo;", "«"),
    ("&raquo;", "»"),
    ("&euro;", "€"),
    ("&amp;", "&"),
)
BLOCK_TAGS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
)
COMMENT = "(?s)<!--.*?-->"
HIDDEN = "(?is)<(script|style|noscript|template)[^>]*>.*?</(script|style|noscript|template)[^>]*>"
UNCLOSED = "(?is)<(script|style)[^>]*>.*"
BLOCK = f"(?i)</?({BLOCK_TAGS})([ \\t\\r\\n/][^>]*)?>"
TAG = "</?[A-Za-z!?][^>]*>"
TITLE = "(?is)<title[^>]*>(.*?)</title"
LINK = "(?i)<a[ \\t\\r\\n][^>]*?href[ \\t]*=[ \\t]*[\"']([^\"'<>]*)"
NUMBER = "^(x[0-9a-f]{1,6}|[0-9]{1,7});"


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """A URN made from the parts, which are joined by blanks."""
    h = F.md5(F.concat_ws(" ", *parts).cast("binary"))
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _character(piece: Column) -> Column:
    """A piece that followed ``&#``, its number and semicolon replaced by the character."""
    number = F.regexp_extract(F.lower(piece), NUMBER, 1)
    value = F.when(
        F.startswith(number, F.lit("x")), F.conv(F.substring(number, 2, 6), 16, 10).cast("int")
    ).otherwise(F.expr("try_cast(NULL AS INT)"))
    value = F.coalesce(value, number.try_cast("int"))
    bad = (value == 0) | (value > 0x10FFFF) | value.between(0xD800, 0xDFFF)
    made = F.decode(F.unhex(F.lpad(F.hex(value), 8, "0")), "UTF-32")
    tail = F.substr(piece, F.length(number) + 2)
    return F.when(number == "", F.concat(F.lit("&#"), piece)).otherwise(
        F.concat(F.when(bad, F.lit("\ufffd")).otherwise(made), tail)
    )


def unescape(text: Column) -> Column:
    """Character references as characters: numbers first, then names."""
    pieces = F.split(text, "&#")
    numbered = F.concat(
        F.get(pieces, F.lit(0)),
        F.array_join(F.transform(F.slice(pieces, 2, 1 << 30), _character), ""),
    )
    text = F.when(F.contains(text, F.lit("&#")), numbered).otherwise(text)
    for name, character in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(character))
    return text


def _lines(text: Column) -> Column:
    """White space collapsed: one blank inside lines, one line feed between them."""
    text = F.regexp_replace(text, "[ \\t\\r\\f\\x0b]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, " *\\n[ \\n]*", "\n"), "^\\n|\\n$", ""))


def plain_text(html: Column) -> Column:
    for pattern, made in ((COMMENT, " "), (HIDDEN, " "), (UNCLOSED, " "), (BLOCK, "\n"), (TAG, "")):
        html = F.regexp_replace(html, pattern, made)
    return _lines(unescape(html))


def responses(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """Stored pages as response records, a row each."""
    body = F.coalesce(F.col(html), F.lit(""))
    target = F.coalesce(
        F.when(F.col(url) != "", F.col(url)), F.concat(F.lit("urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    )
    page = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).alias("page_id"), target.alias("target_uri"), body.alias("body"), page.alias("page"))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("body").cast("string"),
        F.lit(CRLF * 2),
    )
    return rows.select(
        "page_id",
        record_id(F.lit("response"), F.col("page"), F.col("target_uri"), digest(F.col("body"))).alias("record_id"),
        "target_uri",
        F.lit(date).alias("date"),
        head.alias("http_head"),
        "body",
        digest(F.col("body")).alias("payload_digest"),
    )


def _header(kind: str, content_type: str, concurrent: Column | None) -> Column:
    fields = [
        ("WARC-Type", F.lit(kind)),
        ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Refers-To", F.col("refers_to")),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Date", F.col("date")),
        ("WARC-Payload-Digest", F.col("payload_digest")),
        ("WARC-Block-Digest", F.col("block_digest")),
        ("Content-Type", F.lit(content_type)),
        ("Content-Length", F.col("content_length").cast("string")),
    ]
    if concurrent is not None:
        fields.insert(3, ("WARC-Concurrent-To", concurrent))
    parts = [F.lit(f"WARC/1.1{CRLF}")]
    for name, value in fields:
        parts += [F.lit(f"{name}: "), value, F.lit(CRLF)]
    return F.concat(*parts, F.lit(CRLF))


def _title(body: Column) -> Column:
    return F.regexp_replace(_lines(unescape(F.regexp_extract(body, TITLE, 1))), "\\n", " ")


def derive(source: DataFrame) -> DataFrame:
    """Two rows a response: page_id, record_type, record_id, refers_to, target_uri,
    date, payload_digest, block_digest, content_length, header and block."""
    links = F.transform(
        F.regexp_extract_all("body", F.lit(LINK), F.lit(1)),
        lambda x: F.concat(F.lit("outlink: "), x, F.lit(CRLF)),
    )
    metadata = F.concat(
        F.regexp_replace("http_head", "\\r\\n\\r\\n$", CRLF),
        F.lit("title: "),
        _title(F.col("body")),
        F.lit(CRLF),
        F.array_join(links, ""),
    )
    common = ["page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest"]

    def made(kind: str) -> Column:
        return record_id(F.lit(kind), F.col("record_id")).alias("record_id")

    conversion = source.select(*common, made("conversion"), plain_text(F.col("body")).alias("block"))
    described = source.select(
        *common, made("metadata"), metadata.alias("block"), record_id(F.lit("conversion"), F.col("record_id")).alias("concurrent")
    )
    out = []
    for kind, content_type, rows in (
        ("metadata", "application/warc-fields", described),
        ("conversion", "text/plain; charset=utf-8", conversion),
    ):
        measured = rows.withColumns(
            {
                "record_type": F.lit(kind),
                "block_digest": digest(F.col("block")),
                "content_length": F.octet_length("block").cast("long"),
            }
        )
        concurrent = F.col("concurrent") if kind == "metadata" else None
        out.append(
            measured.withColumn("header", _header(kind, content_type, concurrent)).select(
                "page_id",
                "record_type",
                "record_id",
                "refers_to",
                "target_uri",
                "date",
                "payload_digest",
                "block_digest",
                "content_length",
                "header",
                "block",
            )
        )
    return out[0].unionByName(out[1])


def write_warc(records: DataFrame, path: str) -> None:
    """Gzipped WARC files: every record is header, block and two line ends."""
    lines = records.select(F.concat("header", "block").alias("value"))
    lines.write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)
