"""Content-addressed web archive: payload bytes once, record headers apart, records by joins.

An archive is a folder with two tables. ``payloads`` has the bytes of each distinct payload once,
under its SHA-256 digest. ``headers`` has, for each record, its WARC header block and HTTP header block
byte for byte and the digest of its payload. A record is put together again by joining the two, and can
be written out as a WARC/1.1 file. The first page with a payload is its response record; the others are
revisit records, whose block has the HTTP header alone but whose payload is found all the same.

A payload that a large part of all records shares is dealt over shards by record, with a copy of the
payload for each ``RECORDS_PER_SHARD`` records, so no task gets all records of one payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.llm.common import by_id

RECORDS_PER_SHARD = 1000
# Fixed value: the alphabet of base 32 (RFC 4648).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 160 bits are 32 letters, so there is no padding."""
    digest = F.sha1(payload)
    letters = []
    for at in range(1, 41, 5):  # five hexadecimal digits are four letters
        bits = F.conv(F.substring(digest, at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            index = F.shiftright(bits, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(BASE32), index, F.lit(1)))
    return F.concat(*letters)


def _fields(*pairs: tuple[str, Column]) -> Column:
    """A header block: ``name: value`` lines; those with a NULL value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in pairs]
    return F.concat_ws("", *lines)


def _one_line(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x1F\x7F]", " ")


def _record_uri(key: Column) -> Column:
    h = F.md5(F.concat(F.lit("record "), F.coalesce(key.cast("string"), F.lit(""))))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                  revisit_from: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as an archive under ``path``.

    Of records with equal payloads of at least ``revisit_from`` bytes the one with the smallest page_id
    is the response and the others are revisits to it; all records with smaller payloads are responses.
    NULL html is an empty payload and a NULL url an empty target. NULL ids come last and rows repeated
    with the smallest id are all responses. Control characters in a url become spaces in the header;
    the ``headers`` table keeps the url itself too. Other columns of ``pages`` are not read. An empty
    table gives an empty archive.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    records = (pages.select("page_id", "url", payload.alias("payload"))
               .withColumn("sha256", F.unhex(F.sha2("payload", 256))))
    narrow = records.select("page_id", "url", "sha256", base32_sha1(F.col("payload")).alias("sha1"),
                            F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    groups = records.groupBy("sha256").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    groups = groups.withColumn(
        "shards", F.ceil(F.col("copies") / RECORDS_PER_SHARD).cast("int"))
    first = F.col("page_id").eqNullSafe(F.col("first_id"))
    again = ~first & (F.col("payload_bytes") >= revisit_from)
    headers = narrow.join(groups, "sha256").withColumn("again", again)
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF), _fields(
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.col("payload_bytes").cast("string"))), F.lit(CRLF))
    headers = headers.withColumn("http_header", http)
    block = F.octet_length("http_header") + F.when(F.col("again"), 0).otherwise(
        F.col("payload_bytes"))
    warc = F.concat(F.lit("WARC/1.1" + CRLF), _fields(
        ("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        ("WARC-Record-ID", _record_uri(F.col("page_id"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", _one_line(F.coalesce("url", F.lit("")))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        ("WARC-Refers-To", F.when(F.col("again"), _record_uri(F.col("first_id")))),
        ("WARC-Profile", F.when(F.col("again"), REVISIT_PROFILE)),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", block.cast("string"))), F.lit(CRLF))
    (headers.select(
        "page_id", "url", "sha256", warc.alias("warc_header"), "http_header",
        F.when(F.col("again"), F.col("first_id")).alias("refers_to"),
        F.pmod(F.xxhash64("page_id", "url"), "shards").cast("int").alias("shard"))
     .write.option("compression", "zstd").parquet(f"{path}/headers"))
    # By id and digest no key is common. Dealt so, the rows that stay are joined and, where one is
    # repeated, reduced to one where they are: payloads travel once.
    owner = [F.coalesce("id", F.lit(0)).alias("owner"), F.col("id").isNull().alias("none"), "sha256"]
    firsts = groups.withColumnRenamed("first_id", "id").select(*owner, "copies", "shards")
    stored = (records.withColumnRenamed("page_id", "id").select(*owner, "payload")
              .join(firsts, ["owner", "none", "sha256"]).dropDuplicates(["owner", "none", "sha256"])
              .select("sha256", "payload", "copies", "shards"))
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records put together again: page_id, url, warc_header, http_header, payload, refers_to.

    A payload whose bytes don't have the digest it is stored under fails the read.
    """
    checked = F.when(F.unhex(F.sha2("payload", 256)) == F.col("sha256"), F.col("payload")).otherwise(
        F.raise_error(F.lit("a stored payload differs from its digest")))
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "sha256", checked.alias("payload"),
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    headers = spark.read.parquet(f"{path}/headers")
    return headers.join(payloads, ["sha256", "shard"]).select(
        "page_id", "url", "warc_header", "http_header", "payload", "refers_to")


def header_field(block: Column, name: str) -> Column:
    return F.regexp_extract(block, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def parsed(records: DataFrame) -> DataFrame:
    """What the record headers say, checked against the payload that was put together."""
    digest = base32_sha1(F.col("payload"))
    said = F.regexp_replace(header_field(F.col("warc_header"), "WARC-Payload-Digest"), "^sha1:", "")
    size = F.octet_length("payload").cast("bigint")
    right = (digest == said) & (
        header_field(F.col("http_header"), "Content-Length") == size.cast("string"))
    return records.select(
        "page_id", size.alias("payload_bytes"),
        F.when(right, said).otherwise(F.raise_error(F.lit("a record differs from its payload")))
        .alias("payload_digest"),
        header_field(F.col("warc_header"), "WARC-Type").alias("record_type"), "refers_to")


def warc_records(records: DataFrame) -> DataFrame:
    """``record``: the bytes of each WARC record, with the two line ends that close it."""
    revisit = header_field(F.col("warc_header"), "WARC-Type") == "revisit"
    return records.select("page_id", F.concat(
        F.encode("warc_header", "UTF-8"), F.encode("http_header", "UTF-8"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")),
        F.lit(b"\r\n\r\n")).alias("record"))


def export_warc(records: DataFrame, path: str) -> None:
    """WARC files, one a task: the records' text with the closing line ends as separator.

    Payloads are UTF-8 text, so the text writer keeps their bytes.
    """
    text = F.decode(F.col("record"), "UTF-8")
    (warc_records(records).select(F.expr("substring(record, 1, octet_length(record) - 4)")
                                  .alias("record")).select(text.alias("value"))
     .write.option("lineSep", CRLF + CRLF).text(path))
