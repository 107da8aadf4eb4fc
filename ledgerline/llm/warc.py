"""WARC archives as a Spark data source, read and written.

    spark.dataSource.register(WarcDataSource)
    df.write.format("warc").mode("append").save(path)
    spark.read.format("warc").load(path).filter("record_type = 'response'")

Writing: one gzip member per record, with the ``sl`` extra field that holds the member's
length, so that a reader can pass over a member without inflating it.  A task writes files
under names of its own attempt and rolls them at FILE_BYTES; the commit lists the files of
the committed attempts in a manifest, and only listed files are read.

Reading: the plan deals the files out by size.  In a record the headers are parsed first;
records that fail a pushed-down filter are left there, and so are payloads when the option
``payload`` is "false".  Plain ``.warc`` files, and members without the extra field, are
read as well.  A payload that is decoded is checked against its digest.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from ledgerline.llm.common import lookup, open_folder, stage, work_dir
from ledgerline.sources.tables import Tables

FILE_BYTES = 256 << 20  # a file is closed after the record that passes this
SPLIT_BYTES = 64 << 20  # files are dealt out to tasks up to this
HEAD = 4096  # bytes read to begin with
UNKNOWN_LENGTH = 0xFFFFFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SCHEMA = (
    "record_id string, record_type string, page_id long, target_uri string, date string, "
    "payload_digest string, payload_bytes long, refers_to long, payload binary"
)
HEADER_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")][:-1]
ARROW = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()),
     ("date", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
     ("payload", pa.binary())]
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------------------- writing
def gzip_member(data: bytes) -> bytes:
    """One gzip member whose ``sl`` field has its own length and the length of ``data``."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    total = 10 + 2 + 12 + len(body) + 8
    sizes = (min(total, UNKNOWN_LENGTH), min(len(data), UNKNOWN_LENGTH))
    extra = b"sl" + struct.pack("<HII", 8, *sizes)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(headers: dict, block: bytes) -> bytes:
    lines = [b"WARC/1.1"] + [f"{k}: {v}".encode() for k, v in headers.items() if v is not None]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", b""]) + block + b"\r\n\r\n"


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def page_record(page_id, uri, record_type, refers_to, payload: bytes, date: str) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = record_type == "revisit"
    headers = {
        "WARC-Type": record_type,
        "WARC-Record-ID": page_urn(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": None if uri is None else quote(uri, safe="".join(map(chr, range(0x21, 0x7F)))),
        "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}",
        "WARC-Payload-Length": len(payload),
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Refers-To": page_urn(refers_to) if revisit and refers_to is not None else None,
        "Content-Type": "application/http; msgtype=response",
    }
    return record(headers, http if revisit else http + payload)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options["path"]
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = open_folder(self.path)
        store.create_dir(base, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "target_uri", "record_type", "refers_to", "payload")]
            for row in zip(*columns):
                page_id, uri, kind, refers_to, payload = (x.as_py() for x in row)
                if out is None:
                    files.append([f"pages-{uuid.uuid4().hex}.warc.gz", 0])
                    out = store.open_output_stream(f"{base}/{files[-1][0]}", compression=None)
                    info = {"WARC-Type": "warcinfo", "WARC-Record-ID": page_urn(None), "WARC-Date": self.date, "Content-Type": "application/warc-fields"}
                    size = out.write(gzip_member(record(info, b"format: WARC File Format 1.1\r\n")))
                payload = payload.encode() if isinstance(payload, str) else payload or b""
                size += out.write(gzip_member(page_record(page_id, uri, kind or "response", refers_to, payload, self.date)))
                files[-1][1] = size
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        store, base = open_folder(self.path)
        store.create_dir(base, recursive=True)
        before = _manifests(store, base) if self.overwrite else []
        listed = dict(f for m in messages if m is not None for f in m.files)
        with store.open_output_stream(f"{base}/_files-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps(listed).encode())
        for manifest in before:
            for name in _listed(store, manifest):
                store.delete_file(f"{base}/{name}")
            store.delete_file(manifest)

    def abort(self, messages) -> None:
        store, base = open_folder(self.path)
        for name, _ in (f for m in messages if m is not None for f in m.files):
            store.delete_file(f"{base}/{name}")


def _manifests(store: fs.FileSystem, base: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return [f.path for f in found if re.fullmatch(r"_files-.*\.json", f.base_name)]


def _listed(store: fs.FileSystem, manifest: str) -> dict[str, int]:
    with store.open_input_stream(manifest) as f:
        return json.loads(f.read())


# ---------------------------------------------------------------------------- reading
def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _more(f, data: bytearray, inflate) -> bool:
    """Read and append the next bytes of a record; False at its or the file's end."""
    if inflate is not None and inflate.eof:
        return False
    chunk = f.read(1 << 16)
    data += inflate.decompress(chunk) if inflate is not None and chunk else chunk
    return bool(chunk)


def records(f, size: int, wanted) -> Iterator[tuple[dict, bytes | None]]:
    """Headers and block of each record of an open file.  ``wanted(headers)`` says "skip",
    "headers" or "all"; blocks are read, or inflated, for "all" alone."""
    at = 0
    while at < size:
        f.seek(at)
        first = f.read(HEAD)
        inflate = length = None
        if first[:2] == b"\x1f\x8b":
            if first[3] & 4 and first[12:14] == b"sl":
                length = struct.unpack_from("<I", first, 16)[0]
                length = None if length == UNKNOWN_LENGTH else length
            inflate = zlib.decompressobj(31)
            data = bytearray(inflate.decompress(first))
        else:
            data = bytearray(first)
        while (end := data.find(b"\r\n\r\n")) < 0 and _more(f, data, inflate):
            pass
        if end < 0:
            if data.strip():
                raise ValueError(f"no WARC record at byte {at}")
            return
        headers = _headers(bytes(data[:end]))
        stop = end + 4 + int(headers.get("content-length", 0))
        say = wanted(headers)
        next_at = at + length if length else None if inflate else at + stop + 4
        if say == "all" or next_at is None:
            while (len(data) < stop or next_at is None) and _more(f, data, inflate):
                pass
            if len(data) < stop:
                raise ValueError(f"the WARC record at byte {at} is cut short")
        if next_at is None:
            next_at = f.tell() - len(inflate.unused_data)
        if say != "skip":
            yield headers, bytes(data[end + 4 : stop]) if say == "all" else None
        at = next_at


def _page_id(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def header_row(headers: dict[str, str]) -> dict:
    digest, length = headers.get("warc-payload-digest"), headers.get("warc-payload-length")
    return {
        "record_id": headers.get("warc-record-id"),
        "record_type": headers.get("warc-type"),
        "page_id": _page_id(headers.get("warc-record-id")),
        "target_uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        "payload_digest": digest.removeprefix("sha1:") if digest else None,
        "payload_bytes": int(length) if length else None,
        "refers_to": _page_id(headers.get("warc-refers-to")),
    }


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.tests: list[tuple[str, list | None]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADER_COLUMNS and isinstance(f, IsNotNull):
                self.tests.append((name, None))
            elif name in HEADER_COLUMNS and isinstance(f, (EqualTo, In)):
                self.tests.append((name, [f.value] if isinstance(f, EqualTo) else list(f.value)))
            else:
                yield f

    def partitions(self):
        store, base = open_folder(self.path)
        files = {}
        for manifest in _manifests(store, base):
            files |= _listed(store, manifest)
        if not files:  # archives of another writer
            found = store.get_file_info(fs.FileSelector(base, recursive=True))
            files = {f.path[len(base) + 1 :]: f.size for f in found if f.path.endswith((".warc", ".warc.gz"))}
        dealt, size = [[]], 0
        for name, length in sorted(files.items()):
            if size and size + length > SPLIT_BYTES:
                dealt.append([])
                size = 0
            dealt[-1].append((name, length))
            size += length
        return [InputPartition(x) for x in dealt]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(self.path)

        def wanted(headers: dict) -> str:
            row = header_row(headers)
            for name, values in self.tests:
                if row[name] is None or values is not None and row[name] not in values:
                    return "skip"
            return "all" if self.payload and row["record_type"] == "response" else "headers"

        rows, held = [], 0
        for name, size in partition.value:
            with store.open_input_file(f"{base}/{name}") as f:
                for headers, block in records(f, size, wanted):
                    row = header_row(headers)
                    if block is not None:
                        http = headers.get("content-type", "").startswith("application/http")
                        row["payload"] = block.partition(b"\r\n\r\n")[2] if http else block
                        if row["payload_digest"] not in (None, sha1_base32(row["payload"])):
                            raise ValueError(f"{name}: the payload of {row['record_id']} doesn't fit its digest")
                    rows.append(row)
                    held += len(row.get("payload") or b"") + 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let filters reach it."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# -------------------------------------------------------------------------- operator
def classify(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows for the writer: page_id, target_uri, record_type, refers_to, payload.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest
    page_id is the response and the others revisit it; smaller payloads are all responses.
    A null html is the empty payload.  Null page ids come last; rows repeating the largest
    id of a group are responses each.  Other columns are ignored.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"), payload.alias("payload"),
        F.unhex(F.sha2(F.encode(payload, "UTF-8"), 256)).alias("digest"),
    )
    keys = stage(rows.select("page_id", "digest"), "page-digests")
    groups = stage(keys.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")), "page-groups")
    other = (F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("last"))
    return lookup(rows, groups, "digest", "n").select(
        "page_id", "target_uri", F.when(other, "revisit").otherwise("response").alias("record_type"),
        F.when(other, F.col("last")).alias("refers_to"), "payload",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    path = work_dir(spark, "warc")
    classify(Tables(spark, sf_dir)["pages"]).write.format("warc").mode("append").save(path)
    read = spark.read.format("warc")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    whole = read.load(path).filter("record_type = 'response'").withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    heads = read.option("payload", "false").load(path).filter("record_type = 'revisit'")
    return whole.select(columns).unionByName(heads.select(columns))
