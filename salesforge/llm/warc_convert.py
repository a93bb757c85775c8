"""Legacy ARC archives to WARC, and reading both.

ARC: a file begins with a ``filedesc`` record whose body names the version and the fields of the header lines; each
record is a header line with those fields, the last of them its declared length, and as many bytes.
WARC records get a synthesised id, date, type and digests; of records with equal payloads the one with the
smallest page id is a response, the others are revisits of it.

The converter reads each archive twice: once for the digests, of which only (file, offset, page, digest) are shuffled,
then to write.  Payloads are never shuffled; what is joined by file are the compressed archives.
Files are written by Spark's text writer, one row a file of about ``TARGET_BYTES`` (or one record, if that is longer),
so memory is bounded by a file and a lost task leaves nothing behind.

Defined results
* null html: the empty payload.  Records with null or repeated page ids are records of their own; of records with the
  same id and payload the first in the archive counts as the smallest; a null id is the largest.
* an empty table gives no file and an empty result.  Extra columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

TARGET_BYTES = 16 * 2**20
MIN_PAYLOAD = 0  # smaller payloads are never revisits

# The header fields of the two ARC versions, as their specification lists them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_DATE = "20000101000000"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------------------------------------- ARC

def arc_head(name: str, version: int) -> bytes:
    body = f"{version} 0 salesforge\n{ARC_FIELDS[version]}\n".encode()
    extra = "" if version == 1 else " 200 - - 0 " + name
    return f"filedesc://{name} 0.0.0.0 {ARC_DATE} text/plain{extra} {len(body)}\n".encode() + body + b"\n"


def http_response(page_id: int | None, payload: bytes) -> bytes:
    page = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{page}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def arc_record(url: str, body: bytes, version: int, offset: int, name: str) -> bytes:
    url = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) or "-"
    extra = "" if version == 1 else f" 200 {hashlib.md5(body).hexdigest()} - {offset} {name}"
    return f"{url} 0.0.0.0 {ARC_DATE} text/html{extra} {len(body)}\n".encode("utf-8", "surrogatepass") + body + b"\n"


def read_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, body) of the records; the first is the file's description."""
    at, names = 0, None
    while at < len(data):
        end = data.index(b"\n", at)
        values = data[at:end].decode("utf-8", "surrogatepass").split(" ")
        length = int(values[-1])
        body = data[end + 1: end + 1 + length]
        if len(body) < length:
            raise ValueError(f"record at {at} is cut off")
        if names is None:
            version, fields = body.decode().split("\n")[:2]
            names = fields.split(" ")
            if int(version.split(" ")[0]) not in ARC_FIELDS or names != ARC_FIELDS[int(version.split(" ")[0])].split(" "):
                raise ValueError(f"unknown version: {version}")
        if len(values) != len(names):
            raise ValueError(f"{len(values)} fields at {at}, {len(names)} declared")
        yield at, dict(zip(names, values, strict=True)), body
        at = end + 1 + length
        while data[at: at + 1] == b"\n":  # records are parted by a line end
            at += 1


# ---------------------------------------------------------------------------------------------- WARC

def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(repr(parts).encode()).digest()[:16], version=5)}>"


def warc_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in {**headers, "Content-Length": str(len(block))}.items()]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        block = data[end + 4: (at := end + 4 + int(headers["Content-Length"]))]
        if data[at: at + 4] != b"\r\n\r\n":
            raise ValueError(f"record is not closed at {at}")
        at += 4
        yield headers, block


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(head, its fields, entity body) of a stored HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    return head + b"\r\n\r\n", dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:]), body


def _page_id(fields: dict[str, str]) -> int | None:
    return int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None


def _digest_of(fields: dict[str, str], body: bytes, offset: int, archive: str) -> dict:
    _, http, payload = http_parts(body)
    page, digest = _page_id(http), payload_digest(payload)
    return {"page_id": page, "offset": offset, "payload_bytes": len(payload), "digest": digest,
            "record_id": record_id(archive, fields["URL"], fields["Archive-date"], page, digest, offset), "url": fields["URL"]}


def iso_date(arc_date: str) -> str:
    d = arc_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def convert_archive(name: str, data: bytes, revisits: dict[int, dict]) -> bytes:
    """One ARC file as WARC.  revisits: by offset, what the record refers to.

    Record ids are made from the archive's name and the place in it, so a page that is stored twice has two.
    """
    out, archive = [], ""
    for offset, fields, body in read_arc(data):
        date = iso_date(fields["Archive-date"])
        if fields["URL"].startswith("filedesc://"):
            archive = fields["URL"]
            out.append(warc_record({"WARC-Type": "warcinfo", "WARC-Record-ID": record_id(name, "info"), "WARC-Date": date,
                                    "WARC-Filename": name, "Content-Type": "application/warc-fields"},
                                   b"format: WARC File Format 1.1\r\nsource: " + fields["URL"].encode() + b"\r\n"))
            continue
        x = _digest_of(fields, body, offset, archive)
        head = http_parts(body)[0]
        to = revisits.get(offset)
        block = body if to is None else head
        headers = {"WARC-Type": "response" if to is None else "revisit", "WARC-Record-ID": x["record_id"],
                   "WARC-Date": date, "WARC-Target-URI": fields["URL"], "WARC-IP-Address": fields["IP-address"],
                   "Content-Type": "application/http;msgtype=response",
                   "WARC-Payload-Digest": f"sha1:{x['digest']}", "WARC-Block-Digest": f"sha1:{payload_digest(block)}"}
        if to is not None:
            headers |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                        "WARC-Refers-To": to["record_id"], "WARC-Refers-To-Target-URI": to["url"],
                        "WARC-Refers-To-Date": date, "X-Refers-To-Page-Id": str(to["page_id"])}
        out.append(warc_record(headers, block))
    return b"".join(out)


# ---------------------------------------------------------------------------------------------- Spark

def _write_files(files: DataFrame, folder: str) -> None:
    """One text file of each row of column ``value``; the writer ends it with the last line end of the record."""
    files.select("value").write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(folder)


def _as_row(data: bytes) -> str:
    return data[:-1].decode("utf-8", "surrogatepass")  # without the line end that the writer adds


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")


def _plain(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else bytes(content)


def write_arc(pages: DataFrame, folder: str, target_bytes: int = TARGET_BYTES) -> None:
    """The pages as legacy archives; the versions alternate from file to file."""
    def files(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, held, size, name = 0, [], 0, ""
        task = TaskContext.get().partitionId()

        def begin() -> bytes:
            nonlocal name
            name = f"pages-{task}-{n}.arc"
            return arc_head(name, 1 + n % 2)

        for part in parts:
            for page, url, html in zip(part["page_id"], part["url"], part["html"], strict=True):
                held = held or [begin()]
                size = size or len(held[0])
                body = http_response(None if pd.isna(page) else int(page), html.encode("utf-8", "surrogatepass"))
                held.append(arc_record(url, body, 1 + n % 2, size, name))
                size += len(held[-1])
                if size >= target_bytes:
                    yield pd.DataFrame({"value": [_as_row(b"".join(held))]})
                    n, held, size = n + 1, [], 0
        if held:
            yield pd.DataFrame({"value": [_as_row(b"".join(held))]})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), text_or_empty("url").alias("url"),
                        text_or_empty("html").alias("html"))
    _write_files(rows.mapInPandas(files, "value string"), folder)


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, min_payload: int = MIN_PAYLOAD) -> None:
    """Every ARC file of a folder as a WARC file of another."""
    def digests(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content in zip(part["path"], part["content"], strict=True):
                rows, archive = [], ""
                for at, f, b in read_arc(_plain(content)):
                    if f["URL"].startswith("filedesc://"):
                        archive = f["URL"]
                    else:
                        rows.append(_digest_of(f, b, at, archive))
                yield pd.DataFrame(rows, columns=["page_id", "offset", "payload_bytes", "digest", "record_id", "url"]) \
                    .astype({"page_id": "Int64"}).assign(path=path)

    archives = read_files(spark, arc_folder)
    records = materialize(archives.mapInPandas(
        digests, "page_id long, offset long, payload_bytes long, digest string, record_id string, url string, path string"))
    order = [F.coalesce("page_id", F.lit(2**63 - 1)).alias("p"), "path", "offset"]
    first = records.where(F.col("payload_bytes") >= min_payload).groupBy("digest").agg(
        F.min(F.struct(*order, "page_id", "record_id", "url")).alias("to"), F.count("*").alias("n")).where("n > 1")
    revisits = (records.where(F.col("payload_bytes") >= min_payload).join(first, "digest")
                .where((F.col("path") != F.col("to.path")) | (F.col("offset") != F.col("to.offset")))
                .groupBy("path").agg(F.collect_list(F.struct(
                    "offset", "to.page_id", "to.record_id", "to.url")).alias("revisits")))  # at most a file's records

    def files(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content, found in zip(part["path"], part["content"], part["revisits"], strict=True):
                to = {x["offset"]: x for x in (found if found is not None else [])}
                name = path.rsplit("/", 1)[-1].split(".")[0] + ".warc"
                if data := convert_archive(name, _plain(content), to):
                    yield pd.DataFrame({"value": [_as_row(data)]})

    # about one archive a partition, however many there are
    n = max(1, records.select("path").distinct().count())
    _write_files(archives.repartition(n, "path").join(revisits.repartition(n, "path"), "path", "left")
                 .mapInPandas(files, "value string"), warc_folder)


def read_records(spark: SparkSession, warc_folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every response and revisit."""
    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for content in part["content"]:
                out = []
                for headers, block in read_warc(_plain(content)):
                    kind = headers["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    _, http, payload = http_parts(block)
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and (payload_digest(payload), len(payload)) != (
                            digest, int(http["Content-Length"])):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
                    to = headers.get("X-Refers-To-Page-Id", "None")
                    out.append((_page_id(http), int(http["Content-Length"]), digest, kind,
                                None if to == "None" else int(to)))
                yield pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]) \
                    .astype({"page_id": "Int64", "refers_to": "Int64"})

    return read_files(spark, warc_folder).mapInPandas(
        rows, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
