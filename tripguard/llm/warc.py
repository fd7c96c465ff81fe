"""WARC archives of web captures, written and read by Spark's text source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.llm.common import shared_folder, shuffles_removed, table, written

VERSION = "WARC/1.1"
CRLF = "\r\n"
# Where a record ends and the next begins: from the last line feed of the one to
# the first carriage return of the other. Its first byte does not occur in it
# again, so a reader that falls back to the start on a mismatch misses none.
BETWEEN = "\n" + VERSION + "\r"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORDS_PER_FILE = 50_000
# What a nested record tells of itself.
RECORD_FIELDS = ["type", "record_id", "refers_to", "uri", "date", "digest", "length", "block"]


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 20 bits at a time, four digits each."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)
    ]
    return F.translate(F.concat(*parts), HEX_DIGITS, BASE32_DIGITS)


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` and ``key``, which no other row has: the id, and a UUID where rows repeat it.

    Rows that repeat an id are written with their UUID once, so that it is the
    same wherever it is read, also when a task runs again.
    """
    rows = rows.withColumn("key", F.coalesce(F.col("id").cast("string"), F.lit("null")))
    again = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "warc-ids")
    if again.isEmpty():
        return rows
    repeated = rows.join(again, "key", "left_semi").withColumn("key", F.concat("key", F.lit("#"), F.uuid()))
    columns = ["id", "url", "payload", "key"]
    repeated = written(repeated.select(*columns), "warc-repeated")
    return rows.join(again, "key", "left_anti").select(*columns).union(repeated)


def captures(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """``(key, url, payload, digest, bytes, refers_to)``, one row per page.

    Of payloads that are equal, by SHA-1 and length, rows of the largest id are
    responses and ``refers_to`` has the key of one in the others; digests alone
    are grouped. Payloads under ``least_bytes`` are never revisits.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    )
    rows = _keyed(rows).withColumns(
        {
            "digest": base32_sha1(F.col("payload")),
            "bytes": F.octet_length("payload").cast("bigint"),
        }
    )
    first = (
        rows.select("id", "key", "digest", "bytes")
        .groupBy(F.col("digest").alias("g"), F.col("bytes").alias("b"))
        .agg(F.max(F.struct("id", "key")).alias("top"), F.count(F.lit(1)).alias("n"))
        .filter(f"n > 1 and b >= {int(least_bytes)}")
    )
    joined = rows.join(first, (F.col("digest") == F.col("g")) & (F.col("bytes") == F.col("b")), "left")
    return joined.select(
        "key", "url", "payload", "digest", "bytes",
        F.when(F.col("g").isNotNull() & ~F.col("id").eqNullSafe(F.col("top.id")), F.col("top.key")).alias("refers_to"),
    )


def _record(fields: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its version line: named fields that are not null, then the block."""
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)) for name, value in fields]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF))
    return F.concat(*[F.coalesce(line, F.lit("")) for line in lines], length, F.lit(CRLF), block)


def _one_line(value: Column) -> Column:
    """Text that may stand in a header field."""
    return F.regexp_replace(value, r"[\r\n]+", " ")


def records(rows: DataFrame, when: str) -> DataFrame:
    """``(part, record)``: request, response or revisit, and metadata of each capture.

    A payload that holds the bytes between two records goes in base64, under a
    Content-Transfer-Encoding header, so that files can be split anywhere.
    """
    key = F.col("key")
    name = lambda kind: F.concat(F.lit(f"<urn:capture:{kind}:"), key, F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    url = F.when(F.col("url").isNotNull(), _one_line(F.col("url")))
    coded = F.contains(F.col("payload"), F.lit(BETWEEN)) | F.col("payload").startswith(VERSION + "\r")
    body = F.when(revisit, "").when(coded, F.base64(F.encode("payload", "UTF-8"))).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF),
        F.when(coded & ~revisit, F.lit("Content-Transfer-Encoding: base64" + CRLF)).otherwise(F.lit("")),
        F.lit(CRLF),
    )
    common = [("WARC-Date", F.lit(when)), ("WARC-Target-URI", url)]
    response = _record(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise(F.lit("response"))),
            ("WARC-Record-ID", name("response")),
            *common,
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:capture:response:"), F.col("refers_to"), F.lit(">")))),
            ("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        ],
        F.concat(head, body),
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", name("request")),
            ("WARC-Concurrent-To", name("response")),
            *common,
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(" HTTP/1.1" + CRLF + CRLF)),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", name("metadata")),
            ("WARC-Concurrent-To", name("response")),
            *common,
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(F.lit("captureId: "), key, F.lit(CRLF + "payloadBytes: "), F.col("bytes").cast("string"), F.lit(CRLF)),
    )
    return rows.select(F.explode(F.array(request, response, metadata)).alias("record"))


def write_archive(
    pages: DataFrame,
    path: str,
    when: str = "2024-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    compression: str = "none",
) -> None:
    """Write three WARC records per row below ``path``.

    Spark's text writer does it, with its commit protocol, on any file system it
    knows: a value is a record that begins with its version line, and ends with
    the first line feed of the two line ends that close it.
    """
    rows = records(captures(pages, id_col, url_col, payload_col, least_bytes), when)
    lines = rows.select(F.concat(F.lit(VERSION + CRLF), "record", F.lit(CRLF + "\r")).alias("value"))
    with shuffles_removed(pages.sparkSession):
        lines.write.option("compression", compression).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _after(text: Column, head: Column) -> Column:
    """What follows ``head`` and an empty line in ``text``; null if there is no empty line."""
    there = F.octet_length(text) > F.octet_length(head)
    return F.when(there, F.substr(text, F.char_length(head) + 2 * len(CRLF) + 1))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(type, record_id, concurrent_to, refers_to, uri, date, digest, length, block)``, a row per record.

    Records are split where one ends and the next begins, so large files are
    read in parallel. A record whose block is not as long as it says, because
    the archive is cut off or was not made by ``write_archive``, stops the read.
    """
    raw = spark.read.option("lineSep", BETWEEN).text(path)
    # Only the head, which is short, meets regular expressions.
    head = F.substring_index("value", CRLF + CRLF, 1)
    # The first record of a file still has its version line, the others a line feed.
    fields = F.regexp_replace(head, rf"\A(?:{VERSION}\r)?\n", "")
    split = raw.select(
        F.concat(F.lit(CRLF), fields, F.lit(CRLF)).alias("head"), _after(F.col("value"), head).alias("rest")
    )

    def field(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?i)\r\n{name}: *([^\r\n]*)\r\n", 1)
        return F.when(found != "", found)

    length = field("Content-Length").cast("bigint")
    have = F.octet_length("rest")
    # Two line ends close a record; the last line feed of them is in the
    # separator, but for the last record of a file.
    ends = F.when(F.col("rest").endswith(CRLF + CRLF) & (have == length + 4), 4).when(
        F.col("rest").endswith(CRLF + "\r") & (have == length + 3), 3
    )
    block = F.when(ends.isNotNull(), F.substr(F.col("rest"), F.lit(1), F.char_length("rest") - ends))
    broken = F.raise_error(F.concat(F.lit("record with a block of another length: "), F.coalesce(field("WARC-Record-ID"), F.lit("?"))))
    return split.select(
        field("WARC-Type").alias("type"),
        field("WARC-Record-ID").alias("record_id"),
        field("WARC-Concurrent-To").alias("concurrent_to"),
        field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Target-URI").alias("uri"),
        field("WARC-Date").alias("date"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        length.alias("length"),
        F.coalesce(block, broken.cast("string")).alias("block"),
    )


def _http_payload(block: Column) -> Column:
    """The payload of an HTTP message, decoded as its header says."""
    head = F.substring_index(block, CRLF + CRLF, 1)
    payload = _after(block, head)
    coded = head.contains("Content-Transfer-Encoding: base64")
    return F.when(coded, F.decode(F.unbase64(payload), "UTF-8")).otherwise(payload)


def transactions(found: DataFrame) -> DataFrame:
    """One nested row per capture: response, request and metadata, joined by concurrent-to.

    The row is led by the response or revisit record; requests and metadata
    name it in WARC-Concurrent-To. Either may be missing and is null then; a
    second request or metadata record of one capture makes a second row.
    Requests without a response give no row. An empty archive gives no rows.

    ``payload_digest`` and ``payload_bytes`` are taken from the payload of a
    response where it is read; who needs no more than them moves no payload.
    """
    def of(kinds: list[str], name: str) -> DataFrame:
        rows = found.filter(F.col("type").isin(kinds))
        return rows.select(*[F.col(c).alias(f"{name}_{c}") for c in [*RECORD_FIELDS, "concurrent_to"]])

    def nested(name: str) -> Column:
        return F.struct(*[F.col(f"{name}_{c}").alias(c) for c in RECORD_FIELDS])

    payload = F.when(F.col("response_type") == "response", _http_payload(F.col("response_block")))
    response = of(["response", "revisit"], "response").withColumn("payload", payload)
    response = response.withColumns(
        {
            "payload_digest": base32_sha1(F.col("payload")),
            "payload_bytes": F.octet_length("payload").cast("bigint"),
        }
    )
    request, metadata = of(["request"], "request"), of(["metadata"], "metadata")
    # Records are nested after the joins, so that unused fields are not in them.
    joined = response.join(request, F.col("response_record_id") == F.col("request_concurrent_to"), "left").join(
        metadata, F.col("response_record_id") == F.col("metadata_concurrent_to"), "left"
    )
    return joined.select(
        nested("response").alias("response"),
        *[F.when(F.col(f"{n}_type").isNotNull(), nested(n)).alias(n) for n in ("request", "metadata")],
        "payload",
        "payload_digest",
        "payload_bytes",
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write an archive of all pages, read it back, and tell what each capture is."""
    path = shared_folder(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path, compression="gzip")
    rows = transactions(read_records(spark, path))
    page = lambda c: F.regexp_extract(c, r":(-?\d+)(?:#[0-9a-f-]+)?>$", 1)
    told = F.regexp_extract("metadata.block", r"payloadBytes: (\d+)", 1).cast("bigint")
    # A response's payload speaks for itself; a revisit has none, only its records.
    digest = F.coalesce("payload_digest", "response.digest")
    size = F.coalesce("payload_bytes", told)
    number = lambda c: F.when(c != "", c).cast("bigint")
    return rows.select(
        number(page(F.col("response.record_id"))).alias("page_id"),
        size.alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        number(page(F.coalesce(F.col("response.refers_to"), F.lit("")))).alias("refers_to"),
    )


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, strlen(h) AS n, upper(sha1(h)) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
      (('0x' || substr(x, 1 + 5 * CAST(i // 4 AS INT), 5))::BIGINT >> (15 - 5 * (CAST(i AS INT) % 4))) & 31), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM g
"""
