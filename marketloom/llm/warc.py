"""A content-addressed web archive: payload bytes once per digest, exact record headers apart, records rebuilt by a join.

``write_archive`` makes a WARC/1.1 record of every page: warcinfo-free response records, and revisit records (profile
identical-payload-digest) for payloads of at least ``REVISIT_BYTES`` that an earlier page has. It stores two tables:

* ``payloads``: (digest, payload), one row per SHA-256. Rows are grouped by digest and payload, so whole payloads are
  compared; a digest with two payloads fails the write.
* ``headers``: (header), the exact bytes of every record up to its payload: WARC header, empty line, HTTP header, empty line.

``read_archive`` parses the header bytes and joins them with the payloads by digest, after checking each stored payload's
digest once; a header without a stored payload is an error. ``export_warc`` writes the records as plain WARC files, ``read_warc`` reads such files.

Of equal payloads the record with the smallest page_id is the response, the others refer to it. Defined results: a missing html is
an empty payload; a missing page_id is larger than any other and written as an empty one; of rows that repeat both
page_id and payload one is the response and the others revisit it; a missing url has no target line, and line breaks in
one are percent-encoded; an empty table gives an empty archive. Other columns of the pages are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import durable, scratch_path

REVISIT_BYTES = 100
#: The tables have no time of capture.
CAPTURED = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _header(date: str) -> Column:
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(CRLF + CRLF),
    )
    revisit = F.col("type") == "revisit"
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        _field("WARC-Type", F.col("type")),
        _field("WARC-Record-ID", _urn(F.col("page_id"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", uri),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("digest")))),
        F.when(revisit, F.concat(_field("WARC-Refers-To", _urn(F.col("first"))), _field("WARC-Profile", F.lit(_PROFILE)))).otherwise(""),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", block.cast("string")),
        F.lit(CRLF),
        http,
    ).cast("binary")


def write_archive(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, date: str = CAPTURED) -> None:
    """Writes ``path``/headers and ``path``/payloads from pages (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))

    unique = rows.groupBy("digest", "payload").agg(F.count(F.lit(1)).alias("n")).select("digest", "payload")
    unique.write.parquet(f"{path}/payloads")
    stored = pages.sparkSession.read.parquet(f"{path}/payloads")
    if not stored.groupBy("digest").count().where("count > 1").isEmpty():
        raise ValueError("two payloads have one digest")

    narrow = rows.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"))
    # Stored numbers tell rows apart that repeat a page.
    narrow = durable(narrow.withColumn("row", F.monotonically_increasing_id()), "records")
    least = F.min(F.struct(F.col("page_id").isNull().alias("missing"), "page_id", "url", "row")).alias("least")
    shared = narrow.where(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(least, F.count(F.lit(1)).alias("n")).where("n > 1")
    # Stored, so that each side of the join has an exchange of its own and AQE can split a payload that very many pages have.
    shared = durable(shared.select("digest", F.col("least.page_id").alias("first"), F.col("least.row").alias("first_row")), "shared")
    joined = narrow.join(shared, "digest", "left")
    response = F.col("first_row").isNull() | (F.col("row") == F.col("first_row"))
    typed = joined.withColumn("type", F.when(response, "response").otherwise("revisit"))
    typed.select(_header(date).alias("header")).write.parquet(f"{path}/headers")


def _parsed(header: Column, name: str) -> Column:
    found = F.regexp_extract(header.cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes, header, payload): every record's page, whole.

    Payloads are checked once each, before the join; the bytes are counted in the payload of the rebuilt record.
    """
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    header = F.col("header")
    page = lambda name: F.regexp_extract(_parsed(header, name), r"^<urn:page:(.*)>$", 1)
    number = lambda text: F.when(text != "", text).cast("long")
    records = headers.select(
        number(page("WARC-Record-ID")).alias("page_id"),
        _parsed(header, "WARC-Target-URI").alias("url"),
        _parsed(header, "WARC-Type").alias("record_type"),
        number(page("WARC-Refers-To")).alias("refers_to"),
        F.regexp_extract(_parsed(header, "WARC-Payload-Digest"), "^sha256:([0-9a-f]{64})$", 1).alias("payload_digest"),
        header,
    )
    found = F.lower(F.hex("digest"))
    good = F.sha2("payload", 256) == found
    checked = payloads.select(
        F.when(good, found).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), found))).alias("payload_digest"),
        "payload",
    )
    joined = records.join(checked, "payload_digest", "left")
    lost = F.raise_error(F.concat(F.lit("no payload for "), F.col("payload_digest")))
    rebuilt = joined.withColumn("payload", F.coalesce(F.col("payload"), lost.cast("binary")))
    columns = ["page_id", "url", "record_type", "refers_to", "payload_digest"]
    return rebuilt.select(*columns, F.octet_length("payload").cast("long").alias("payload_bytes"), "header", "payload")


def record_bytes() -> Column:
    """The record of a ``read_archive`` row as it stands in a WARC file, without the two line breaks that end it."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    return F.concat("header", body)


def export_warc(spark: SparkSession, path: str, out: str, compression: str = "gzip") -> None:
    """The archive's records as WARC files below ``out``."""
    rows = read_archive(spark, path).select(record_bytes().cast("string").alias("value"))
    rows.write.text(out, compression=compression, lineSep=CRLF + CRLF)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload) of every record of the WARC files at ``path``; a file is read by one task, so keep files small."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                data = bytes(content)
                if name.endswith(".gz"):
                    out, rest = b"", data
                    while rest:  # one member after the other
                        unzip = zlib.decompressobj(31)
                        out += unzip.decompress(rest) + unzip.flush()
                        rest = unzip.unused_data
                    data = out
                headers, payloads, at = [], [], 0
                while at < len(data):
                    body = data.index(b"\r\n\r\n", at) + 4
                    fields = dict(x.split(b": ", 1) for x in data[at : body - 4].split(b"\r\n")[1:])
                    end = body + int(fields[b"Content-Length"])
                    split = data.index(b"\r\n\r\n", body) + 4
                    headers.append(data[at:split])
                    payloads.append(data[split:end])
                    at = end + 4
                yield pd.DataFrame({"header": headers, "payload": payloads})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(parse, "header binary, payload binary")


def archived(pages: DataFrame) -> DataFrame:
    """``pages`` written to a new archive in the shared folder and read back."""
    path = scratch_path(pages.sparkSession, "archive")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)
