"""WARC archives: a writer of plain Spark text files and a Python data source that reads them.

Writing: a record is a string whose two closing line breaks are the text sink's line separator, so the files go through
Spark's committer to any store that it can write, and a lost task's file never becomes visible. Payloads that occur more
than once (equal SHA-256 and at least ``least_bytes`` long) are written by the smallest page_id; the others are revisit
records that refer to it and keep the payload's length in their HTTP header.

Reading (format "tally_warc"): whole files are dealt to partitions of about equal bytes. Filters on record_type, page_id,
target_uri and payload_digest are pushed down: a record's headers are parsed first, and a block that a filter excludes, or
whose payload isn't wanted (option payload = "false"), is skipped by its length without being decoded.

Foreign archives: members compressed with gzip (*.gz) are read in sequence; payloads are verified where their digest is one
of DIGESTS and left alone where it is absent or another; a block without an HTTP head is all payload; digests other than
SHA-256 keep the name of their algorithm. A store is one that pyarrow or Spark knows (s3a:// is read as s3://).

Defined results: a null html is an empty payload; a null url leaves out WARC-Target-URI; line breaks in a url are escaped;
rows with the same page_id and payload are each a response if that id is the smallest; a null page_id has an id of its
digest and url, reads back as null and is a revisit if another row has an id; an empty table writes no records. Extra columns
are not archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith
from pyspark.sql.types import StructType

from tallyframe.llm.work import Workspace

RECORD_SEPARATOR = "\r\n\r\n"
SCHEMA = "page_id long, record_type string, target_uri string, date string, refers_to long, payload_bytes long, payload_digest string, payload string"


def _record(date: str) -> Column:
    kind = F.col("record_type")
    html = F.coalesce(F.col("html"), F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(RECORD_SEPARATOR)
    )
    block = F.when(kind == "response", F.concat(http, html)).otherwise(http)

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    named = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", kind),
        header("WARC-Record-ID", F.coalesce(named(F.col("page_id")), F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat_ws(" ", "payload_digest", "url"), 256), F.lit(">")))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", uri),
        header("WARC-Profile", F.when(kind == "revisit", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        header("WARC-Refers-To", named(F.col("refers_to"))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def deduplicated(pages: DataFrame, least_bytes: int = 100, most_broadcast: int = 500_000) -> DataFrame:
    """``pages`` with payload_bytes, payload_digest, record_type and refers_to.

    A payload of a third of all rows is summed map-side. Only payloads that occur twice are joined back: up to
    ``most_broadcast`` of them (about 100 bytes each) by a broadcast, so that no payload moves, and more by a shuffle, which
    can split a frequent payload.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select("page_id", "url", "html", F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html, 256).alias("payload_digest"))
    seen = pages.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    seen = Workspace(pages.sparkSession, "warc").save(seen.where("n > 1").drop("n"), "repeated")
    repeated = seen.limit(most_broadcast + 1).count()
    out = pages.join(F.broadcast(seen) if repeated <= most_broadcast else seen, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("first"))}).drop("first")


def write(pages: DataFrame, path: str, *, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 100, records_per_file: int = 20_000) -> None:
    """Archives ``pages`` (page_id, url, html) as WARC files under ``path``."""
    records = deduplicated(pages, least_bytes).select(_record(date).alias("value"))
    records.write.option("lineSep", RECORD_SEPARATOR).option("maxRecordsPerFile", records_per_file).mode("overwrite").text(path)


class _Part(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


#: Names of payload digests that are verified; SHA-1 and MD5 may be written in base 32.
DIGESTS = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "sha512": hashlib.sha512, "md5": hashlib.md5}


def _intact(payload: bytes, digest: str | None) -> bool:
    """Whether the payload has this digest ("algorithm:value"); unknown algorithms pass."""
    name, _, value = (digest or "").partition(":")
    algorithm = DIGESTS.get(name.lower().replace("-", ""))
    if algorithm is None:
        return True
    found = algorithm(payload)
    return value.lower() == found.hexdigest() or value.upper().rstrip("=") == base64.b32encode(found.digest()).decode().rstrip("=")


def _headers(data: bytes, at: int) -> tuple[dict[str, str], int]:
    """Named fields from ``at`` to the empty line, and where what follows begins; no fields where there is no such line."""
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return {}, at
    fields = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return fields, end + 4


class _Input:
    """A forward reader that skips without reading where it can."""

    def __init__(self, file, chunk: int = 1 << 20):
        self.file, self.chunk = file, chunk
        self.start, self.data = 0, b""

    def need(self, at: int, n: int) -> bytes:
        """At least n bytes from ``at`` on, fewer at the end of the file."""
        if not (self.start <= at and at + n <= self.start + len(self.data)):
            self.file.seek(at)
            self.start, self.data = at, self.file.read(max(n, self.chunk))
        return self.data[at - self.start :]

    def headers(self, at: int, most: int | None = None) -> bytes:
        """Bytes from ``at`` on that reach beyond an empty line, if there is one in ``most`` bytes."""
        n = 4096
        while True:
            data = self.need(at, n if most is None else min(n, most))
            data = data if most is None else data[:most]
            if b"\r\n\r\n" in data or len(data) < n:
                return data
            n *= 4


def _page(name: str | None) -> int | None:
    return int(name[len("<urn:page:") : -1]) if name and name.startswith("<urn:page:") else None


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "true").lower() == "true"
        self.split = int(options.get("split_bytes", 16 << 20))
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))
            if name in ("record_type", "page_id", "target_uri", "payload_digest") and isinstance(f, (EqualTo, In, StringStartsWith)):
                self.wanted.append((name, type(f).__name__, f.value))
            else:
                yield f

    def _store(self):
        if "://" not in self.path and not self.path.startswith("file:"):
            return pa.fs.LocalFileSystem(), self.path
        if re.match("s3[an]://", self.path):
            return pa.fs.FileSystem.from_uri(re.sub("^s3[an]", "s3", self.path))
        return pa.fs.FileSystem.from_uri(self.path if "://" in self.path else "file://" + self.path[5:])

    def partitions(self) -> list[InputPartition]:
        store, root = self._store()
        files = [f for f in store.get_file_info(pa.fs.FileSelector(root, recursive=True)) if f.is_file and not f.base_name.startswith(("_", ".")) and f.size]
        parts, now, size = [], [], 0
        for f in sorted(files, key=lambda f: f.path):
            if now and size + f.size > self.split:
                parts.append(_Part(now))
                now, size = [], 0
            now.append(f.path)
            size += f.size
        return [*parts, _Part(now)]

    def _excluded(self, row: dict) -> bool:
        for name, kind, value in self.wanted:
            have = row[name]
            if have is None or (kind == "EqualTo" and have != value) or (kind == "In" and have not in value) or (kind == "StringStartsWith" and not have.startswith(value)):
                return True
        return False

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        columns = (c.split() for c in SCHEMA.split(", "))
        schema = pa.schema([(name, pa.int64() if kind == "long" else pa.string()) for name, kind in columns])
        store, _ = self._store()
        rows, size = [], 0
        for path in partition.files:
            with store.open_input_file(path) as file:
                for row in self._records(_Input(gzip.GzipFile(fileobj=file) if path.endswith(".gz") else file)):
                    rows.append(row)
                    size += len(row["payload"] or "") + 200
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    def _records(self, source: _Input) -> Iterator[dict]:
        at = 0
        while source.need(at, 1):
            fields, begin = _headers(source.headers(at), 0)
            if "content-length" not in fields or "warc-type" not in fields:
                raise ValueError(f"no record at byte {at}")
            begin += at
            length = int(fields["content-length"])
            at = begin + length + len(RECORD_SEPARATOR)
            digest = fields.get("warc-payload-digest") or None
            row = {
                "page_id": _page(fields.get("warc-record-id")),
                "record_type": fields["warc-type"],
                "target_uri": fields.get("warc-target-uri"),
                "date": fields.get("warc-date"),
                "refers_to": _page(fields.get("warc-refers-to")),
                "payload_digest": digest and digest.removeprefix("sha256:"),
                "payload_bytes": None,
                "payload": None,
            }
            if self._excluded(row):
                continue
            if row["record_type"] not in ("response", "revisit"):
                yield row
                continue
            whole = row["record_type"] == "response" and (self.payload or self.verify)
            block = source.need(begin, length)[:length] if whole else source.headers(begin, length)
            if whole and len(block) < length:
                raise ValueError(f"record {fields.get('warc-record-id')} ends before its length")
            http, body = _headers(block, 0) if block.startswith(b"HTTP/") else ({}, 0)
            told = http.get("content-length", "")
            row["payload_bytes"] = int(told) if told.isdigit() else length - body
            if whole:
                payload = block[body:]
                row["payload_bytes"] = len(payload)
                if self.verify and not _intact(payload, digest):
                    raise ValueError(f"record {fields.get('warc-record-id')} has another digest than its payload")
                row["payload"] = payload.decode("utf-8", "replace") if self.payload else None
            yield row


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tally_warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(dict(self.options))


def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Records under ``path``; options: payload and verify ("true" or "false"), split_bytes.

    Lets the session push filters down to Python sources.
    """
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("tally_warc").options(**options).load(path)
