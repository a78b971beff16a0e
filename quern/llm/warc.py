"""WARC writing, gzip normalising and reading.

Each task writes its records as one gzip stream for the whole file, then the normaliser inflates that stream once, in pieces, writes every
record as a gzip member of its own and writes a sidecar index of offsets beside it. Readers seek by the index. Files are written under a
name of their own and moved when whole, and only files that a finished task has told are read, so a task can be run again anywhere.

Records with equal payloads: the one with the largest page_id is a response, the others are revisits that name it. Cases: a null html is
an empty payload; a null url is written as empty and read as null, any other is read back as it was; rows with a null page_id are responses,
nothing refers to them; of repeated rows of the last page_id with equal payloads each is a response, and these share a record id; an empty
table writes no file; a very long html is one record, which is held whole once; other columns are not read, whatever their names.
"""

from __future__ import annotations

import atexit
import base64
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _remove, cut, join_stats, shared_dir, tune

STREAM_LEVEL, MEMBER_LEVEL = 1, 4
#: Bytes read from a stream at a time.
PIECE = 1 << 18
MIN_BYTES = 0
#: Characters that stand for themselves in a target URI, letters and digits aside.
URI = ":/?#[]@!$&'()*+,;=%-._~"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str, kind: str) -> str:
    """The URN of a record; that of a response can be told from its page and digest, so that its revisits can name it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{kind}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head alone, with the length of the payload it stands for."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    digest = digest_of(payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest, f'revisit/{url}' if revisit else 'response')}",
        "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {quote(url or '', safe=URI)}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Has-Url: {int(url is not None)}",
    ]
    if url is not None and quote(url, safe=URI) != url:
        head.append(f"X-Url: {json.dumps(url)}")  # what no header may hold as it is
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest, 'response')}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join([*head, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"


def url_of(headers: dict) -> str | None:
    if headers["X-Has-Url"] != "1":
        return None
    return json.loads(headers["X-Url"]) if "X-Url" in headers else headers["WARC-Target-URI"]


def parse(data: bytes) -> dict:
    """The headers of a record, and its block as 'block'."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out: dict = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(out["Content-Length"])
    if len(rest) < n + 4 or rest[n : n + 4] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    out["block"] = rest[:n]
    return out


def inflate(source: io.RawIOBase, piece: int = PIECE) -> Iterator[bytes]:
    """The content of a gzip file of one member or many, piece by piece."""
    d = zlib.decompressobj(31)
    while data := source.read(piece):
        while data:
            if d.eof:
                d = zlib.decompressobj(31)
            out = d.decompress(data, 4 * piece)
            if out:
                yield out
            data = d.unused_data if d.eof else d.unconsumed_tail
    if not d.eof:
        yield d.flush()
        if not d.eof:
            raise ValueError("a gzip stream is cut short")


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records out of pieces of a stream; no more than a record and a piece is held."""
    held = bytearray()
    need = 0
    for x in pieces:
        held += x
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                m = re.search(rb"\r\nContent-Length: (\d+)$", bytes(held[:end])) or re.search(rb"(?i)\r\nContent-Length: *(\d+)", bytes(held[:end]))
                if not m:
                    raise ValueError("a record has no length")
                need = end + 4 + int(m[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("a record is cut short")


def normalise(source: io.RawIOBase, sink: io.RawIOBase) -> list[dict]:
    """Rewrites a gzip stream with a member a record; returns the sidecar's lines."""
    lines, at = [], 0
    for r in records(inflate(source)):
        z = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, 31)
        member = z.compress(r) + z.flush()
        sink.write(member)
        lines.append({"offset": at, "length": len(member)})
        at += len(member)
    return lines


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes the archives; returns path and n, a row a file."""
    tune(pages.sparkSession)
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= min_bytes
    groups = own.where(large & F.col("page_id").isNotNull()).groupBy("sha").agg(F.max("page_id").alias("last"), F.count("*").alias("m")).where("m > 1")
    marked = join_stats(own, cut(groups), ["sha"], "m")
    # of repeated rows of the last page_id, each is written as a response
    marked = marked.withColumn("refers_to", F.when(large & (F.col("page_id") < F.col("last")), F.col("last")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        name = uuid.uuid4().hex
        raw, final = f"{base}/{name}.stream", f"{base}/{name}.warc.gz"
        n, z = 0, zlib.compressobj(STREAM_LEVEL, zlib.DEFLATED, 31)
        with store.open_output_stream(raw, compression=None) as out:
            for b in batches:
                for page_id, url, html, refers in zip(b["page_id"].to_pylist(), b["url"].to_pylist(), b["html"], b["refers_to"].to_pylist(), strict=True):
                    payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                    out.write(z.compress(record(page_id, url, payload, refers is not None, refers)))
                    n += 1
            out.write(z.flush())
        if n:
            with store.open_input_stream(raw, compression=None) as source, store.open_output_stream(f"{final}.part", compression=None) as sink:
                lines = normalise(source, sink)
            with store.open_output_stream(f"{base}/{name}.idx", compression=None) as out:
                out.write("".join(json.dumps(x) + "\n" for x in lines).encode())
            store.move(f"{final}.part", final)
        store.delete_file(raw)
        yield pa.RecordBatch.from_arrays([pa.array([name] if n else [], pa.string()), pa.array([n] if n else [], pa.int64())], ["path", "n"])

    return marked.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, n long")


def read(files: DataFrame, folder: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to: every record of the files, by their indexes. A response's
    digest is taken from its payload anew and held against its header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for b in batches:
            for name in b["path"].to_pylist():
                rows = []
                with store.open_input_stream(f"{base}/{name}.idx", compression=None) as f:
                    index = [json.loads(x) for x in f.read().decode().splitlines()]
                with store.open_input_file(f"{base}/{name}.warc.gz") as f:
                    for x in index:
                        f.seek(x["offset"])
                        r = parse(zlib.decompress(f.read(x["length"]), 31))
                        http, _, payload = r["block"].partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        said = r["WARC-Payload-Digest"].removeprefix("sha1:")
                        response = r["WARC-Type"] == "response"
                        if response and (len(payload) != size or digest_of(payload) != said):
                            raise ValueError(f"{name}: a payload differs from its digest")
                        page = r["X-Page-Id"]
                        rows.append((int(page) if page else None, url_of(r), size, said, r["WARC-Type"], None if response else int(r["X-Refers-To-Page"])))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names)

    return files.select("path").mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages to archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    files = cut(write(pages, folder))
    atexit.register(_remove, spark, folder)
    return read(files, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
