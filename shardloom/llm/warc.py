"""Derivatives of web responses: linked metadata records and plain-text conversion records.

``derive`` takes response records and gives two records for each: ``metadata`` (a JSON envelope of
the source's WARC headers, HTTP headers, title and links) and ``conversion`` (plain text).  Both
refer to the response by ``WARC-Refers-To``, name each other by ``WARC-Concurrent-To``, repeat its
target, date and payload digest, and have digests of their own blocks.  ``record_text`` lays a
record out as WARC 1.1.

All of it is expressions on the row at hand: no shuffle, memory of one page at a time.

Defined results: a null or empty payload gives an empty text and no title or links; a null target
is left out of the headers; a null id still gives records, with ids made of what is there; very long
pages are converted whole; repeated rows give repeated records; links come in the order of the page,
ties do not arise; an empty table gives none; unknown columns of the input are ignored.  Character
references other than ``ENTITIES`` stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import Query, read

#: Named character references that are decoded, & last; elements whose content is no
#: text; elements that end a line.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}
NO_TEXT = ("script", "style", "noscript", "template", "head")
LINE_ENDS = "p|div|br|li|ul|ol|tr|table|h1|h2|h3|h4|h5|h6|section|article|header|footer|nav|pre|blockquote"

CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"


def sha256_label(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def record_id(*parts: Column) -> Column:
    """A ``urn:uuid`` that depends on ``parts`` only; nulls count as empty."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(part.cast("string"), F.lit("")) for part in parts]))
    pieces = [h.substr(start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def plain_text(html: Column) -> Column:
    """Text of an HTML page: a line for each block, white space collapsed.

    Only names ignore case, as to compare every character without case takes most of the time.
    """
    text = F.coalesce(html, F.lit(""))
    text = F.regexp_replace(text, r"(?s)<!--.*?(?:-->|\z)", "")
    for name in NO_TEXT:
        text = F.regexp_replace(text, rf"(?s)<(?i:{name})(?:\s[^>]*)?>.*?(?:</(?i:{name})\s*>|\z)", "")
    text = F.regexp_replace(text, rf"</?(?i:{LINE_ENDS})(?:\s[^>]*)?/?>", "\n")
    text = F.regexp_replace(text, r"<[/!?a-zA-Z][^>]*+>", "")
    for entity, character in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    for blank in "\t\r\f":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    # Patterns begin with a plain character and do not match single blanks; the rest is plain replacement.
    text = F.regexp_replace(text, r"  +", " ")
    text = F.replace(F.regexp_replace(text, r"\n[ \n]+", "\n"), F.lit(" \n"), F.lit("\n"))
    return F.btrim(text, F.lit(" \n"))


def title_of(html: Column) -> Column:
    found = F.regexp_extract(F.coalesce(html, F.lit("")), r"(?s)<(?i:title)(?:\s[^>]*)?>(.*?)</(?i:title)\s*>", 1)
    return F.regexp_replace(F.regexp_replace(found, r"[ \t\r\n\f]+", " "), r"^ | \z", "")


#: Fixed value: an href attribute; its value in quotes of either kind, or bare.
HREF = r"""\s(?i:href)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def links_of(html: Column) -> Column:
    """Values of href attributes, in order."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(HREF), F.lit(1))

    def bare(value: Column) -> Column:
        quoted = value.startswith('"') | value.startswith("'")
        return F.when(quoted, F.substring(value, F.lit(2), F.char_length(value) - 2)).otherwise(value)

    return F.transform(found, bare)


def responses_from_pages(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of fetched pages: ``(page_id, record_id, target_uri, date, http_headers,
    payload, warc_headers)``.  Digests of block and payload are among the headers."""
    payload = F.coalesce("html", F.lit(""))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(CRLF),
    )
    block = F.concat("http_headers", F.lit(CRLF), "payload")
    return pages.select(
        "page_id",
        record_id(F.lit("response"), F.col("page_id"), F.col("url")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        http.alias("http_headers"),
        payload.alias("payload"),
    ).select(
        "*",
        F.create_map(
            F.lit("WARC-Type"), F.lit("response"),
            F.lit("WARC-Record-ID"), F.col("record_id"),
            F.lit("WARC-Target-URI"), F.coalesce("target_uri", F.lit("")),
            F.lit("WARC-Date"), F.col("date"),
            F.lit("WARC-Block-Digest"), sha256_label(block),
            F.lit("WARC-Payload-Digest"), sha256_label(F.col("payload")),
            F.lit("Content-Type"), F.lit("application/http; msgtype=response"),
            F.lit("Content-Length"), F.octet_length(block).cast("string"),
        ).alias("warc_headers"),
    )


def derive(responses: DataFrame, *keys: str) -> DataFrame:
    """Two records for each response, with the columns ``keys`` of the input in front.

    ``(warc_type, record_id, refers_to, concurrent_to, target_uri, date, content_type,
    content_length, block_digest, payload_digest, block)``.
    """
    metadata_id = record_id(F.lit("metadata"), F.col("record_id"))
    conversion_id = record_id(F.lit("conversion"), F.col("record_id"))
    envelope = F.to_json(
        F.struct(
            F.col("warc_headers").alias("source_headers"),
            F.split(F.regexp_replace("http_headers", r"(?:\r\n)+\z", ""), CRLF).alias("http_headers"),
            title_of(F.col("payload")).alias("title"),
            links_of(F.col("payload")).alias("links"),
        ),
        {"ignoreNullFields": "false"},
    )

    def record(kind: str, own: Column, other: Column, mime: str, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("warc_type"),
            own.alias("record_id"),
            other.alias("concurrent_to"),
            F.lit(mime).alias("content_type"),
            block.alias("block"),
        )

    records = F.array(
        record("metadata", metadata_id, conversion_id, "application/json", envelope),
        record("conversion", conversion_id, metadata_id, "text/plain; charset=utf-8",
               plain_text(F.col("payload"))),
    )
    return responses.select(
        *keys,
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "date",
        F.element_at("warc_headers", "WARC-Payload-Digest").alias("payload_digest"),
        F.explode(records).alias("r"),
    ).select(
        *keys,
        "r.warc_type",
        "r.record_id",
        "refers_to",
        "r.concurrent_to",
        "target_uri",
        "date",
        "r.content_type",
        F.octet_length("r.block").cast("bigint").alias("content_length"),
        sha256_label(F.col("r.block")).alias("block_digest"),
        "payload_digest",
        "r.block",
    )


def record_text(records: DataFrame) -> DataFrame:
    """``records`` with ``record``: the whole record as WARC 1.1 text."""
    headers = {
        "WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Date": "date",
        "WARC-Target-URI": "target_uri", "WARC-Refers-To": "refers_to",
        "WARC-Concurrent-To": "concurrent_to", "WARC-Block-Digest": "block_digest",
        "WARC-Payload-Digest": "payload_digest", "Content-Type": "content_type",
        "Content-Length": "content_length",
    }
    lines = [
        F.concat(F.lit(f"{name}: "), F.col(column).cast("string")) for name, column in headers.items()
    ]
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines)
    return records.withColumn(
        "record", F.concat(head, F.lit(CRLF * 2), F.col("block"), F.lit(CRLF * 2))
    )


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(responses_from_pages(read(spark, sf_dir, "pages")), "page_id")


def _oracle() -> str:
    def uuid(*parts: str) -> str:
        text = " || '|' || ".join(f"coalesce(CAST({part} AS VARCHAR), '')" for part in parts)
        cuts = " || '-' || ".join(f"substr(h, {s}, {n})" for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        return f"(SELECT '<urn:uuid:' || {cuts} || '>' FROM (SELECT md5({text}) AS h))"

    text = "payload"
    text = f"regexp_replace({text}, '(?s)<!--.*?(?:-->|\\z)', '', 'g')"
    for name in NO_TEXT:
        text = f"regexp_replace({text}, '(?is)<{name}(?:\\s[^>]*)?>.*?(?:</{name}\\s*>|\\z)', '', 'g')"
    text = f"regexp_replace({text}, '(?i)</?(?:{LINE_ENDS})(?:\\s[^>]*)?/?>', chr(10), 'g')"
    text = f"regexp_replace({text}, '<[/!?a-zA-Z][^>]*>', '', 'g')"
    for entity, character in ENTITIES.items():
        text = f"replace({text}, '{entity}', '{character.replace(chr(39), chr(39) * 2)}')"
    text = f"regexp_replace({text}, '[ \\t\\r\\f]+', ' ', 'g')"
    text = f"regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g')"
    text = f"regexp_replace({text}, '^[ \\n]+|[ \\n]+\\z', '', 'g')"
    title = "regexp_extract(payload, '(?is)<title(?:\\s[^>]*)?>(.*?)</title\\s*>', 1)"
    title = f"regexp_replace(regexp_replace({title}, '[ \\t\\r\\n\\f]+', ' ', 'g'), '^ | \\z', '', 'g')"
    crlf = "chr(13) || chr(10)"
    href = HREF.replace("'", "''")
    return f"""
WITH responses AS (
  SELECT page_id, url AS target_uri, coalesce(html, '') AS payload,
    {uuid("'response'", "page_id", "url")} AS refers_to,
    'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf}
      || 'Content-Length: ' || strlen(coalesce(html, '')) || {crlf} AS http
  FROM pages
), blocks AS (
  SELECT *, http || {crlf} || payload AS block, 'sha256:' || sha256(payload) AS payload_digest,
    {uuid("'metadata'", "refers_to")} AS metadata_id,
    {uuid("'conversion'", "refers_to")} AS conversion_id
  FROM responses
), records AS (
  SELECT page_id, 'metadata' AS warc_type, metadata_id AS record_id, refers_to,
    conversion_id AS concurrent_to, target_uri, 'application/json' AS content_type, payload_digest,
    CAST(to_json({{
      source_headers: {{'WARC-Type': 'response', 'WARC-Record-ID': refers_to,
        'WARC-Target-URI': coalesce(target_uri, ''), 'WARC-Date': '{DATE}',
        'WARC-Block-Digest': 'sha256:' || sha256(block), 'WARC-Payload-Digest': payload_digest,
        'Content-Type': 'application/http; msgtype=response',
        'Content-Length': CAST(strlen(block) AS VARCHAR)}},
      http_headers: string_split(rtrim(http, {crlf}), {crlf}),
      title: {title},
      links: list_transform(regexp_extract_all(payload, '{href}', 1), lambda x:
        CASE WHEN x[1] IN ('"', chr(39)) THEN x[2:len(x) - 1] ELSE x END)}}) AS VARCHAR) AS block
  FROM blocks
  UNION ALL
  SELECT page_id, 'conversion', conversion_id, refers_to, metadata_id, target_uri,
    'text/plain; charset=utf-8', payload_digest, {text}
  FROM blocks
)
SELECT page_id, warc_type, record_id, refers_to, concurrent_to, target_uri, '{DATE}' AS date,
  content_type, CAST(strlen(block) AS BIGINT) AS content_length,
  'sha256:' || sha256(block) AS block_digest, payload_digest, block
FROM records
"""


QUERIES: dict[str, Query] = {"op10_warc_derivatives": op10_warc_derivatives}
ORACLES = {"op10_warc_derivatives": _oracle()}
