import hashlib
import tempfile

import pytest
from pyspark.sql import functions as F

from marketloom.llm.warc import archived, export_warc, read_archive, read_warc, record_bytes, write_archive

PAGES = "page_id long, url string, html string, digest string, payload string, bytes long, header string, type string"
BIG, BIGGER = "<p>" + "ü" * 100 + "</p>", "<b>" + "y" * 300_000 + "</b>\r\n\r\nWARC/1.1\r\n"
ROWS = [
    (5, "http://a/5", BIG),
    (2, "http://a/2", BIG),
    (9, None, BIG),
    (3, "http://a/3", "small"),
    (4, "http://a/4\r\nWARC-Type: revisit", "small"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "http://a/8", BIGGER),
    (10, "http://a/8", BIGGER),
    (2, "http://a/2", BIG),
    (None, "http://a/x", BIG),
]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "d", "p", 1, "h", "t") for r in rows], PAGES)


def plain(rows):
    out, first, seen = [], {}, set()
    for page, _, html in rows:
        if len((html or "").encode()) >= 100 and page is not None:
            first[html] = min(page, first.get(html, page))
    for page, _, html in rows:
        raw = (html or "").encode()
        again = len(raw) >= 100 and not (page == first[html] and html not in seen)
        if not again and len(raw) >= 100:
            seen.add(html)
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_records(spark):
    out = archived(pages_of(spark, ROWS))
    assert found(out) == plain(ROWS)
    html = sorted(((r.page_id, bytes(r.payload).decode()) for r in out.collect()), key=str)
    assert html == sorted(((p, h or "") for p, _, h in ROWS), key=str)


def test_payloads_are_stored_once(spark):
    path = tempfile.mkdtemp(prefix="marketloom-test-") + "/archive"
    write_archive(pages_of(spark, ROWS), path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({r[2] or "" for r in ROWS})
    assert spark.read.parquet(f"{path}/headers").count() == len(ROWS)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_warc_files_round_trip(spark, compression):
    folder = tempfile.mkdtemp(prefix="marketloom-test-")
    write_archive(pages_of(spark, ROWS), f"{folder}/archive")
    export_warc(spark, f"{folder}/archive", f"{folder}/warc", compression)
    back = sorted((bytes(r.header), bytes(r.payload)) for r in read_warc(spark, f"{folder}/warc").collect())
    rows = read_archive(spark, f"{folder}/archive")
    want = sorted((bytes(r.header), bytes(r.payload) if r.record_type == "response" else b"") for r in rows.collect())
    assert back == want
    assert sorted(bytes(r[0]) for r in rows.select(record_bytes()).collect()) == sorted(a + b for a, b in want)
    for header, payload in want:
        fields = dict(x.split(b": ", 1) for x in header.split(b"\r\n\r\n")[0].split(b"\r\n")[1:])
        assert int(fields[b"Content-Length"]) == len(header.split(b"\r\n\r\n", 1)[1]) + len(payload)


def test_damage_is_noticed(spark):
    folder = tempfile.mkdtemp(prefix="marketloom-test-")
    write_archive(pages_of(spark, ROWS), f"{folder}/a")
    bad = spark.read.parquet(f"{folder}/a/payloads").withColumn("payload", F.concat("payload", F.lit("!").cast("binary")))
    bad.write.parquet(f"{folder}/b/payloads")
    spark.read.parquet(f"{folder}/a/headers").write.parquet(f"{folder}/b/headers")
    with pytest.raises(Exception, match="damaged payload"):
        read_archive(spark, f"{folder}/b").collect()


def test_a_lost_payload_is_an_error(spark):
    folder = tempfile.mkdtemp(prefix="marketloom-test-")
    write_archive(pages_of(spark, ROWS), f"{folder}/a")
    spark.read.parquet(f"{folder}/a/payloads").where(F.octet_length("payload") != 5).write.parquet(f"{folder}/b/payloads")
    spark.read.parquet(f"{folder}/a/headers").write.parquet(f"{folder}/b/headers")
    with pytest.raises(Exception, match="no payload for"):
        read_archive(spark, f"{folder}/b").collect()


def test_records_of_one_payload_meet_in_no_window(spark):
    path = tempfile.mkdtemp(prefix="marketloom-test-") + "/archive"
    rows = [(i, f"http://a/{i}", BIG) for i in range(3000)] + [(3000 + i, None, f"{i}" * 200) for i in range(300)]
    write_archive(pages_of(spark, rows), path)
    out = read_archive(spark, path)
    assert found(out) == plain(rows)
    assert "Window" not in out._jdf.queryExecution().toString()


def test_empty(spark):
    assert archived(pages_of(spark, [])).collect() == []
