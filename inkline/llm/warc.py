"""WARC archives, compressed record by record with a shared dictionary.

A file starts with a skippable frame that holds the Zstandard dictionary; every
record after it is a frame of its own, so a reader can start at any record
once it has the dictionary. The dictionary is trained on at most
``SAMPLE_RECORDS`` records of at most ``SAMPLE_BYTES`` each, the first in md5 order of
their page; where they are too few to train on, files have no dictionary.

Of pages with equal payloads the one of the smallest id is written as a
response, the others as revisits that refer to it. Tasks write files under
names of their own through a file system client that takes the URI of the shared folder; the manifest,
a table, lists the files of the attempts that counted, and only those are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut
from .sample import first_by_hash

DICTIONARY_FRAME = 0x184D2A5D
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 32_768, 65_536
FILE_BYTES, LEVEL, CHUNK = 64 << 20, 3, 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header(kind: str, name: str, fields: dict[str, str], length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *[f"{k}: {v}" for k, v in fields.items()], f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def name_of(page_id: int | None) -> str:
    return f"urn:x-page:{'none' if page_id is None else page_id}"


def clean_uri(url: str | None) -> str:
    """The address with controls and blanks escaped, so that it stays one header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    fields = {"WARC-Date": date, "WARC-Target-URI": clean_uri(url), "Content-Type": "application/http; msgtype=response",
              "WARC-Payload-Digest": "sha1:" + digest_of(payload)}
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{name_of(refers_to)}>"}
    return header("response" if refers_to is None else "revisit", name_of(page_id), fields, len(body)) + body + b"\r\n\r\n"


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """A file system client for any URI it knows (file, s3, gs, hdfs) and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else f"file://{uri}")


def train(samples: list[bytes]) -> bytes | None:
    if len(samples) < 16:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return None


class Writer:
    """One archive file."""

    def __init__(self, folder: str, dictionary: bytes | None):
        store, root = open_store(folder)
        name = f"pages-{uuid.uuid4().hex}.warc.zst"
        self.uri, self.file = f"{folder}/{name}", store.open_output_stream(f"{root}/{name}", compression=None)
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
        self.records = self.bytes = 0
        if dictionary:
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        info = b"software: inkline\r\nformat: WARC file version 1.1\r\n"
        self._put(self.compressor.compress(header("warcinfo", f"urn:uuid:{uuid.uuid4()}", {"WARC-Date": DATE, "Content-Type": "application/warc-fields"}, len(info)) + info + b"\r\n\r\n"))

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.bytes += len(data)

    def add(self, data: bytes) -> None:
        self._put(self.compressor.compress(data))
        self.records += 1

    def close(self) -> dict:
        self.file.close()
        return {"path": self.uri, "n_records": self.records, "n_bytes": self.bytes}


def write_task(folder: str, dictionary: bytes | None, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Archives (page_id, url, html, refers_to) rows; one manifest row per file."""
        writer, done = None, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                writer = writer or Writer(folder, dictionary)
                writer.add(record(page_id, url, (html or "").encode(), refers_to))
                if writer.bytes >= file_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    return run


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives and returns the manifest."""
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = rows.withColumns({"_sha1": F.sha1(payload), "_size": F.octet_length(payload)})
    groups = cut(rows.filter((F.col("_size") >= min_revisit_bytes) & F.col("page_id").isNotNull()).groupBy("_sha1")
                 .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"))
    again = (F.col("_size") >= min_revisit_bytes) & (F.col("_first") < F.col("page_id"))
    told = rows.join(groups, "_sha1", "left").select("page_id", "url", "html", F.when(again, F.col("_first")).alias("refers_to"))
    # a longer page gives its beginning to the dictionary's sample
    filled = rows.filter("_size > 0").select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html"))
    sample = first_by_hash(filled, F.col("page_id"), SAMPLE_RECORDS, filled.count()).collect()
    dictionary = train([record(r["page_id"], r["url"], r["html"].encode()[:SAMPLE_BYTES], None) for r in sample])
    return cut(told.mapInArrow(write_task(folder, dictionary, file_bytes), MANIFEST))


def frames(stream, dictionary: zstandard.ZstdCompressionDict | None) -> Iterator[bytes]:
    """Decompressed frames of a file, after its dictionary; memory for one record and a chunk."""
    held = b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while held or (held := stream.read(CHUNK)):
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not held and not (held := stream.read(CHUNK)):
                raise ValueError("an archive ends inside a record")
            parts.append(frame.decompress(held))
            held = b""
        held = frame.unused_data
        yield b"".join(parts)


def parse(data: bytes) -> dict | None:
    """A record's figures and payload; None for other kinds of record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = body.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and digest_of(payload) != digest:
        raise ValueError(f"{fields['WARC-Record-ID']}: payload and digest differ")
    number = lambda name: None if name.endswith(":none>") else int(name[1:-1].rpartition(":")[2])
    size = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
    return {"page_id": number(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": number(fields["WARC-Refers-To"]) if kind == "revisit" else None, "url": fields["WARC-Target-URI"],
            "payload": payload if kind == "response" else None}


def read_file(uri: str) -> Iterator[dict]:
    store, path = open_store(uri)
    with store.open_input_file(path) as file:
        start = file.read(8)
        magic, size = struct.unpack("<II", start)
        dictionary = zstandard.ZstdCompressionDict(file.read(size)) if magic == DICTIONARY_FRAME else None
        if dictionary is None:
            file.seek(0)
        for data in frames(file, dictionary):
            if (found := parse(data)) is not None:
                yield found


def read_task(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                for found in read_file(uri):
                    if not with_payload:
                        found["payload"] = None
                    held.append(found)
                    size += 200 + len(found["payload"] or b"")
                    if size > 8 * CHUNK:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    return run


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the listed archives. A revisit has no payload; its size is the one its HTTP header states."""
    files = max(1, manifest.count())
    return manifest.select("path").repartition(files).mapInArrow(read_task(with_payload), RECORDS)


def archive(pages: DataFrame, folder: str | None = None, with_payload: bool = True, **settings) -> DataFrame:
    """Writes all pages and reads the archives back, one row per page.

    Null and empty pages have an empty payload and are archived like others.
    Rows that repeat the id and payload of a response are responses too. A page
    without id is always a response. A null address is written as about:blank.
    """
    folder = folder or f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(pages, folder, **settings), with_payload)
