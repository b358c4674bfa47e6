"""The archive of small tables against records made by hand, and foreign archives."""

import base64
import gzip
import hashlib

import pytest

from tallyframe.llm import warc
from tallyframe.llm.queries import op5_warc

LONG = "<p>" + "long enough to be kept once " * 5 + "</p>"


def test_records(spark, tmp_path):
    rows = [(5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, None, LONG), (1, "http://a\n/1", "short"), (2, "http://a/2", "short"), (4, "u", None), (6, "u", ""), (7, "u", "é" * 60), (8, "u", "é" * 60), (10, "u", "WARC/1.1\r\n\r\nhttp" * 9)]
    rows += [(20, "v", LONG * 9000)]
    spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in op5_warc(spark, str(tmp_path)).collect()}
    want = {}
    for page, _, html in rows:
        data = (html or "").encode()
        first = min(p for p, _, h in rows if (h or "").encode() == data)
        again = len(data) >= 100 and first != page
        want[page] = (len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None)
    assert got == want
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/archive")
    read = warc.read(spark, f"{tmp_path}/archive")
    assert {r["page_id"]: r["payload"] for r in read.where("record_type = 'response'").collect()} == {p: h or "" for p, _, h in rows if want[p][2] == "response"}
    assert [(r["page_id"], r["target_uri"]) for r in read.where("page_id = 1").collect()] == [(1, "http://a%0A/1")]
    assert read.where("record_type = 'revisit'").count() == 3


def test_shuffled_join_gives_the_same(spark):
    pages = spark.createDataFrame([(k, "u", LONG if k % 2 else f"{k}") for k in range(9)] + [(None, "u", LONG)], "page_id long, url string, html string")
    small, large = (sorted(map(str, warc.deduplicated(pages, most_broadcast=n).collect())) for n in (0, 10))
    assert small == large


def test_empty_table(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/archive")
    assert warc.read(spark, f"{tmp_path}/archive").count() == 0


def test_foreign_archives(spark, tmp_path):
    def record(kind, block, *more):
        head = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", *more, f"Content-Length: {len(block)}"])
        return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nX: \xff\r\n\r\nbody"
    records = [
        record("warcinfo", b"software: x"),
        record("response", http, f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(b'body').digest()).decode()}"),
        record("response", http),
        record("response", b"no head at all"),
        record("response", http, "WARC-Payload-Digest: blake9:xyz"),
        record("revisit", b""),
    ]
    (tmp_path / "a").mkdir()
    (tmp_path / "a/plain.warc").write_bytes(b"".join(records))
    (tmp_path / "a/packed.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    got = [(r["record_type"], r["payload"]) for r in warc.read(spark, f"{tmp_path}/a").collect()]
    assert sorted(got, key=str) == sorted([("warcinfo", None), *[("response", "body")] * 3, ("response", "no head at all"), ("revisit", None)] * 2, key=str)
    (tmp_path / "b").mkdir()
    (tmp_path / "b/bad.warc").write_bytes(record("response", http, "WARC-Payload-Digest: sha256:" + "0" * 64))
    with pytest.raises(Exception, match="another digest"):
        warc.read(spark, f"{tmp_path}/b").collect()
