"""WARC records in ZIP-packaged archives: written by Spark tasks, read back by ranges without extraction.

An archive is a ZIP file with stored members: ``data/records.warc`` and its index
``index/records.tsv`` (identifier, type, offset, length of every record). The reader looks for
the end of the central directory (ZIP64 or not) in the file's last bytes, parses the
directory, finds the data of stored members behind their local headers, reads the index, and
fetches ranges of consecutive records. Ranges are rows that Spark deals out again, so one large
archive is read by many tasks.

Of records with equal payloads of at least ``min_payload`` bytes, the one with the smallest
identifier is a response and the others revisit it (no payload, the response's identifier and
the payload's digest and length).

Archives are files of the shared folder, opened through pyarrow's file systems (file, hdfs,
s3, gs, abfs); only archives of finished tasks are listed, so a lost task's leftovers are not read.

Defined results: a NULL page is an empty payload; a NULL identifier is smaller than all others; a NULL url
leaves out its header. Of repeated rows with one identifier, one is the response. An empty
table makes no archive and gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_narrow, saved, shared_folder, with_place

MIN_PAYLOAD = 100
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 4 << 20
#: Names of the members, and of the WARC header fields and values that are written.
DATA, INDEX = "data/records.warc", "index/records.tsv"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def open_store(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


# --- ZIP ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    stored: bool
    header: int  # where its local header starts
    size: int  # bytes as packed


def read_directory(read: Callable[[int, int], bytes], size: int) -> list[Member]:
    """The members of a ZIP file of ``size`` bytes; ``read(start, length)`` fetches a range."""
    tail_size = min(size, 65_535 + 22 + 20)
    tail = read(size - tail_size, tail_size)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != tail_size:  # these bytes in a comment
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of a central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":  # the locator of the ZIP64 end record
        end64 = read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record at its place")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, out, p = read(start, length), [], 0
    for _ in range(count):
        if directory[p : p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, p + 10)[0]
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, p + 20)
        header = struct.unpack_from("<I", directory, p + 42)[0]
        name = directory[p + 46 : p + 46 + n_name].decode()
        extra = directory[p + 46 + n_name : p + 46 + n_name + n_extra]
        p += 46 + n_name + n_extra + n_comment
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: only the fields that are full in the entry, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + n :]
        out.append(Member(name, method == 0, header, packed))
    return out


def data_start(read: Callable[[int, int], bytes], m: Member) -> int:
    """Where the bytes of a stored member start."""
    if not m.stored:
        raise ValueError(f"{m.name} is compressed; only stored members can be read by ranges")
    head = read(m.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header at its place")
    return m.header + 30 + sum(struct.unpack_from("<HH", head, 26))


# --- WARC --------------------------------------------------------------------------------------


def _coded(key: str | None) -> str:
    """An identifier without blanks or brackets; NULL is nothing, an empty one a lone percent sign."""
    return "" if key is None else quote(key, safe="") or "%"


def _plain(coded: str) -> str | None:
    return None if not coded else "" if coded == "%" else unquote(coded)


def _id(key: str | None) -> str:
    return f"<urn:page:{_coded(key)}>"


def record_bytes(key: str | None, url: str | None, payload: bytes, digest: str, revisits: bool, refers_to: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisits else http + payload
    fields = [("WARC-Type", "revisit" if revisits else "response"), ("WARC-Record-ID", _id(key)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisits:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _id(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + body + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)


def parse_record(raw: bytes) -> dict:
    """Header fields (``warc``, ``http``) and the ``payload`` of one record."""
    if not raw.startswith(VERSION):
        raise ValueError("no record starts here")
    end = raw.index(b"\r\n\r\n")
    warc = _fields(raw[:end])
    body = raw[end + 4 : end + 4 + int(warc["Content-Length"])]
    http_end = body.index(b"\r\n\r\n")
    return {"warc": warc, "http": _fields(body[:http_end]), "payload": body[http_end + 4 :]}


# --- Spark jobs --------------------------------------------------------------------------------


def mark_revisits(pages: DataFrame, page_id: str, url: str, html: str, min_payload: int) -> DataFrame:
    """Rows to write: ``page_id``, ``url``, ``html``, ``revisits``, ``refers_to``."""
    own = with_place(pages).select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"), "file", "pos"
    )
    narrow = own.where(F.octet_length("html") >= min_payload).select(
        "page_id", "file", "pos", F.sha2(F.col("html").cast("binary"), 256).alias("digest")
    )
    narrow = saved(narrow, "warc-digests")
    first = F.min(F.struct("page_id", "file", "pos")).alias("first")
    firsts = narrow.groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = narrow.join(firsts, "digest").where((F.col("file") != F.col("first.file")) | (F.col("pos") != F.col("first.pos")))
    later = saved(later.select("file", "pos", F.col("first.page_id").alias("refers_to"), F.lit(True).alias("revisits")), "warc-revisits")
    return join_narrow(own, later, ["file", "pos"], "left").select(
        "page_id", "url", "html", F.coalesce("revisits", F.lit(False)).alias("revisits"), "refers_to"
    )


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """One archive or more for each task; returns the written list ``path``, ``size``, ``records``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        columns = ["page_id", "url", "html", "revisits", "refers_to"]
        rows = ([None if x is None or x is pd.NA or x != x else x for x in r] for b in batches for r in zip(*(b[c] for c in columns)))
        row = next(rows, None)
        while row is not None:
            name, index, at = f"{uuid.uuid4().hex}.zip", [], 0
            with store.open_output_stream(f"{root}/{name}") as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED) as z:
                with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as data:
                    while row is not None and at < archive_bytes:
                        key, url, html, revisits, refers_to = row
                        payload = html.encode()
                        raw = record_bytes(key, url, payload, hashlib.sha256(payload).hexdigest(), bool(revisits), refers_to)
                        data.write(raw)
                        index.append(f"{_coded(key)}\t{'revisit' if revisits else 'response'}\t{at}\t{len(raw)}\n")
                        at += len(raw)
                        row = next(rows, None)
                z.writestr(zipfile.ZipInfo(INDEX), "".join(index))
            size = store.get_file_info(f"{root}/{name}").size
            yield pd.DataFrame({"path": [f"{folder}/{name}"], "size": [size], "records": [len(index)]}).astype({"path": object})

    texts = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return saved(texts.mapInPandas(run, "path string, size long, records long"), "warc-list")


def record_ranges(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Ranges of consecutive records: ``path``, ``start`` in the file, and the ``lengths`` of the records."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                store, place = open_store(path)
                with store.open_input_file(place) as f:
                    read = lambda start, n: f.read_at(n, start)
                    members = {m.name: m for m in read_directory(read, f.size())}
                    first = data_start(read, members[DATA])
                    lines = read(data_start(read, members[INDEX]), members[INDEX].size).decode().splitlines()
                out, held, start = [], [], None
                for line in lines:
                    at, n = map(int, line.rsplit("\t", 2)[1:])
                    start = first + at if start is None else start
                    held.append(n)
                    if sum(held) >= range_bytes or len(held) >= 1000:
                        out.append((path, start, held))
                        held, start = [], None
                if held:
                    out.append((path, start, held))
                yield pd.DataFrame(out, columns=["path", "start", "lengths"]).astype({"path": object})

    return archives.select("path").mapInPandas(run, "path string, start long, lengths array<int>")


def read_records(archives: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives: ``page_id`` (as text), ``url``, ``record_type``, ``refers_to`` (as text),
    ``payload_bytes`` and ``payload_digest`` of the full payload, and the ``payload`` itself if asked for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = lambda x: _plain(x[len("<urn:page:") : -1])
        for b in batches:
            for path, start, lengths in zip(b["path"], b["start"], b["lengths"]):
                store, place = open_store(path)
                with store.open_input_file(place) as f:
                    raw = f.read_at(int(sum(lengths)), int(start))
                out, at = [], 0
                for n in lengths:
                    r = parse_record(raw[at : at + n])
                    at += int(n)
                    warc, said = r["warc"], r["warc"]["WARC-Payload-Digest"].removeprefix("sha256:")
                    if warc["WARC-Type"] == "response" and hashlib.sha256(r["payload"]).hexdigest() != said:
                        raise ValueError(f"{warc['WARC-Record-ID']} in {path}: the payload is not the one that was written")
                    out.append((
                        plain(warc["WARC-Record-ID"]), warc.get("WARC-Target-URI"), warc["WARC-Type"],
                        plain(warc.get("WARC-Refers-To", "<urn:page:>")), int(r["http"]["Content-Length"]), said, r["payload"],
                    ))
                frame = pd.DataFrame(out, columns=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"], dtype=object)
                yield frame if with_payload else frame.drop(columns="payload")

    ranges = record_ranges(archives, range_bytes)
    n = max(archives.sparkSession.sparkContext.defaultParallelism, archives.rdd.getNumPartitions())
    schema = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string"
    return saved(ranges, "warc-ranges").repartition(n).mapInPandas(run, schema + (", payload binary" if with_payload else ""))


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write a record per page, read all archives back; identifiers have the input's type again."""
    kind = pages.schema[page_id].dataType
    rows = mark_revisits(pages, page_id, url, html, min_payload)
    archives = write_archives(rows, shared_folder(pages.sparkSession, "archives"))
    return read_records(archives).select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind)
    )
