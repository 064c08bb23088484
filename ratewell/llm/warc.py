"""Web archives: pages to ARC files, ARC files to WARC files, and WARC files to rows.

Archives are written with Spark's text writer, one row per archive file of about
``FILE_BYTES``, so a lost task writes its files again and a failed job leaves none; gzip is
its codec.  They are read as whole binary files and cut by the lengths that the
records declare, never by looking for separators, so payloads may hold any bytes.

The converter reads ARC version 1 and version 2 records (five and ten header fields; an
archive's version block tells which) and makes WARC 1.1 identifiers, timestamps, types
and digests of them.  Of records with equal payloads, the one with the smallest
key is a response and the others are revisits that refer to it.  Only digests and keys
are grouped; a digest with very many records is one row after map-side sums, and the rows that
look it up are split by Spark.

Defined cases: a null payload is the empty one; a null URL becomes ``urn:page:<key>``;
characters that would end a header field are percent-encoded; a null key makes a response that
nothing refers to; rows that repeat a key and payload are alike (all responses or all
revisits); an empty table gives archives without records, or no archives.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import folder, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Archives are closed at about so many bytes; a larger record has one for itself.
FILE_BYTES = 1 << 23
#: Bytes of results that a task hands over at a time.
BATCH_BYTES = 1 << 22

# Header layouts of ARC versions and of WARC 1.1 records.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "file", "length"),
}
ARC_TITLES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY_FIELD = "X-Page-Key"
BLANK_IP = "0.0.0.0"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def safe(text: str) -> str:
    """A URL without characters that end a header field or line."""
    return quote(text, safe="".join(map(chr, range(0x21, 0x7F))))


def store(rows: DataFrame, purpose: str) -> str:
    """Write rows with one binary column, each as an archive file; the folder's path."""
    path = folder(rows.sparkSession, purpose)
    chosen = rows.select(F.col(rows.columns[0]).cast("string").alias("value"))
    chosen.write.option("maxRecordsPerFile", 1).option("compression", "gzip").option("lineSep", "\n").text(path)
    return path


def load(spark: SparkSession, path: str) -> DataFrame:
    """Archive files as (path, content)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _packed(records: Iterator[bytes], head) -> Iterator[pa.RecordBatch]:
    """Archives of the records, each beginning with what `head` gives for its number."""
    parts, size, number = [], 0, 0
    for record in records:
        if parts and size + len(record) > FILE_BYTES:
            yield _archive(parts)
            parts, size, number = [], 0, number + 1
        if not parts:
            parts, size = [head(number)], 0
        parts.append(record)
        size += len(record)
    if parts:
        yield _archive(parts)


def _archive(parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["archive"])


class Reader:
    """Bytes of a gzip or plain file, unpacked as far as they are asked for; members may follow one another."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.zip = memoryview(data), 0, data[:2] == b"\x1f\x8b"
        self.inflater = zlib.decompressobj(31) if self.zip else None
        self.buffer, self.start = bytearray(), 0

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        if self.start > 1 << 20:
            del self.buffer[: self.start]
            self.start = 0
        chunk = self.data[self.at : self.at + (1 << 16)]
        if not self.zip:
            self.buffer += chunk
            self.at += len(chunk)
            return True
        self.buffer += self.inflater.decompress(chunk)
        self.at += len(chunk) - len(self.inflater.unused_data)
        if self.inflater.eof:
            self.inflater = zlib.decompressobj(31)
        return True

    def line(self) -> bytes | None:
        """The next line without its end, or None at the end of the file."""
        seen = self.start
        while (end := self.buffer.find(b"\n", seen)) < 0:
            kept = len(self.buffer) - self.start
            if not self._more():
                rest = bytes(self.buffer[self.start :])
                self.start = len(self.buffer)
                return rest or None
            seen = self.start + kept
        out = bytes(self.buffer[self.start : end])
        self.start = end + 1
        return out[:-1] if out.endswith(b"\r") else out

    def take(self, count: int) -> bytes:
        while len(self.buffer) - self.start < count and self._more():
            pass
        out = bytes(self.buffer[self.start : self.start + count])
        if len(out) < count:
            raise ValueError(f"a record declares {count} bytes, {len(out)} are left")
        self.start += count
        return out


# ---- pages to ARC


def http_block(key, payload: bytes) -> bytes:
    own = f"{KEY_FIELD}: {key}\r\n" if key is not None else ""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def arc_head(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 ratewell\n{ARC_TITLES[version]}\n".encode()
    fields = [f"filedesc://{name}", BLANK_IP, date, "text/plain"]
    fields += ["200", "-", "-", "0", name] if version == 2 else []
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, name: str, url: str, date: str, block: bytes) -> bytes:
    fields = [safe(url), BLANK_IP, date, "text/html"]
    fields += ["200", sha1(block), "-", "0", name] if version == 2 else []
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block + b"\n"


def to_arc(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = "20240101000000", version: int = 1) -> str:
    """Write ARC archives of all pages; the folder's path."""

    def run(batches):
        name = f"{uuid.uuid4().hex}.arc"

        def records():
            for batch in batches:
                for i in range(batch.num_rows):
                    own, link, text = (batch.column(c)[i].as_py() for c in range(3))
                    yield arc_record(version, name, link if link is not None else f"urn:page:{own}", date, http_block(own, (text or "").encode()))

        return _packed(records(), lambda n: arc_head(version, f"{n}-{name}", date))

    chosen = pages.select(*[pages[f"`{c}`"].alias(n) for c, n in ((key, "key"), (url, "url"), (html, "html"))])
    return store(chosen.mapInArrow(run, "archive binary"), "arc")


# ---- ARC to WARC


def arc_records(data: bytes) -> Iterator[dict]:
    """Fields and block of the records of an ARC file, in its version's layout."""
    reader, fields = Reader(data), None
    while (line := reader.line()) is not None:
        if not line:
            continue
        if line.startswith(b"filedesc:"):
            body = reader.take(int(line.rsplit(b" ", 1)[1]))
            version = int(body.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            fields = ARC_FIELDS[version]
            continue
        if fields is None:
            raise ValueError("an ARC file begins with a version block")
        values = line.decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
        if len(values) != len(fields):
            raise ValueError(f"a header line has {len(values)} fields instead of {len(fields)}")
        record = dict(zip(fields, values, strict=True))
        record["block"] = reader.take(int(record["length"]))
        yield record


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head with its blank line, and payload, of an HTTP answer; all is payload where there is no head."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block[: end + 4], block[end + 4 :]) if end >= 0 else (block, b"")


def field_of(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n"):
        title, colon, value = line.partition(b":")
        if colon and title.strip().lower() == name.lower().encode():
            return value.strip().decode()
    return None


def iso_date(date: str) -> str:
    """An ARC timestamp (4 to 14 digits) as a WARC one."""
    full = date[:14] + "00000101000000"[len(date[:14]) :] if len(date) < 14 else date[:14]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(url: str, date: str, key: str | None, digest: str) -> str:
    """The same identifier for the same record, however often it is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {key} {digest}')}>"


CAPTURE = "key string, url string, ip string, date string, digest string, length bigint, record_id string"


def captures(spark: SparkSession, arc_path: str, blocks: bool) -> DataFrame:
    """One row per ARC record: key, address, times, digests and identifier; with its HTTP head and payload if asked for."""

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for content in batch.column(1):
                for record in arc_records(content.as_py()):
                    head, payload = split_http(record["block"])
                    key, digest, date = field_of(head, KEY_FIELD), sha1(payload), iso_date(record["date"])
                    row = (key, record["url"], record["ip"], date, digest, len(payload), record_id(record["url"], date, key, digest))
                    rows.append(row + (head, payload) if blocks else row)
                    size += len(payload) * blocks + 200
                    if size >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    kinds = [pa.string()] * 5 + [pa.int64(), pa.string()] + [pa.binary()] * (2 * blocks)
    schema = CAPTURE + (", head binary, payload binary" if blocks else "")
    names = [f.split()[0] for f in schema.split(", ")]
    return load(spark, arc_path).mapInArrow(run, schema)


def warc_head(name: str, date: str) -> bytes:
    body = b"software: ratewell\r\nformat: WARC File Format 1.1\r\n"
    return warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], body)


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def converted(row: dict) -> bytes:
    """The WARC record of a capture; `first_id` names the response that a revisit refers to."""
    fields = [("WARC-Type", "response" if row["first_id"] is None else "revisit"), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]), ("WARC-Target-URI", row["url"]), ("WARC-IP-Address", row["ip"])]
    if row["key"] is not None:
        fields.append(("X-Page-Key", row["key"]))
    fields.append(("WARC-Payload-Digest", f"sha1:{row['digest']}"))
    block = row["head"] + row["payload"]
    if row["first_id"] is not None:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", row["first_id"]), ("WARC-Refers-To-Target-URI", row["first_url"]), ("WARC-Refers-To-Date", row["first_date"]), ("X-Refers-To-Page-Key", row["first_key"])]
        block = row["head"]
    fields += [("X-Payload-Length", str(row["length"])), ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Type", "application/http; msgtype=response")]
    return warc_record(fields, block)


def first_captures(rows: DataFrame, least_bytes: int) -> DataFrame:
    """Per digest with several keys: the capture with the smallest key that the others refer to."""
    order = F.struct(F.expr("try_cast(key as bigint)").alias("number"), F.col("key").alias("key"), F.col("record_id").alias("id"), F.col("url").alias("url"), F.col("date").alias("date"))
    firsts = rows.where((F.col("length") >= least_bytes) & F.col("key").isNotNull()).groupBy("digest", "length").agg(F.min(order).alias("o"), F.count("*").alias("n"))
    return firsts.where("n > 1").select(
        F.col("digest").alias("same_digest"), F.col("length").alias("same_length"), F.col("o.key").alias("first_key"), F.col("o.id").alias("first_id"), F.col("o.url").alias("first_url"), F.col("o.date").alias("first_date")
    )


def convert(spark: SparkSession, arc_path: str, least_bytes: int = 0) -> str:
    """WARC archives of all ARC archives in a folder; the new folder's path.

    Records with equal payloads of at least `least_bytes` bytes are stored once.
    """
    firsts = written(first_captures(captures(spark, arc_path, False), least_bytes), "first-captures")
    rows = captures(spark, arc_path, True)
    same = (rows["digest"] == firsts["same_digest"]) & (rows["length"] == firsts["same_length"]) & (rows["key"] != firsts["first_key"])
    rows = rows.join(firsts, same, "left").drop("same_digest", "same_length")

    def run(batches):
        name = f"{uuid.uuid4().hex}.warc"

        def records():
            for batch in batches:
                columns = [(n, batch.column(k)) for k, n in enumerate(batch.schema.names)]
                for i in range(batch.num_rows):
                    yield converted({n: c[i].as_py() for n, c in columns})

        return _packed(records(), lambda n: warc_head(f"{n}-{name}", "2024-01-01T00:00:00Z"))

    return store(rows.mapInArrow(run, "archive binary"), "warc")


# ---- WARC to rows


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (lower-cased names) and block of the records of a WARC file."""
    reader = Reader(data)
    while (line := reader.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record begins with its version")
        fields = {}
        while line := reader.line():
            title, _, value = line.decode("utf-8", "replace").partition(":")
            fields[title.strip().lower()] = value.strip()
        yield fields, reader.take(int(fields["content-length"]))


RECORDS = "key string, url string, date string, record_id string, record_type string, payload_bytes bigint, payload_digest string, refers_to string, refers_to_key string"


def read(spark: SparkSession, warc_path: str, payloads: bool = False) -> DataFrame:
    """One row per response or revisit of the WARC archives in a folder.

    Lengths and digests of responses are those of the payload as read; a declared digest that differs
    raises.  Revisits hold no payload and carry what they declare.
    """

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for content in batch.column(1):
                for fields, block in warc_records(content.as_py()):
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    payload = split_http(block)[1]
                    digest, length = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
                    if fields["warc-type"] == "response" and (sha1(payload), len(payload)) != (digest, length):
                        raise ValueError(f"the payload of {fields['warc-record-id']} does not have its digest")
                    row = (fields.get("x-page-key"), fields["warc-target-uri"], fields["warc-date"], fields["warc-record-id"], fields["warc-type"], length, digest, fields.get("warc-refers-to"), fields.get("x-refers-to-page-key"))
                    rows.append(row + (payload if fields["warc-type"] == "response" else None,) if payloads else row)
                    size += len(payload) * payloads + 300
                    if size >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    kinds = [pa.string()] * 5 + [pa.int64()] + [pa.string()] * 3 + [pa.binary()] * payloads
    schema = RECORDS + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in schema.split(", ")]
    return load(spark, warc_path).mapInArrow(run, schema)
