"""WARC archives: write, normalise whole-file gzip to one member per record, read by offset.

Archives live in a folder of the shared store. Every task writes files of its
own under fresh names and reports them as rows; a table of those rows is
written once, so files of failed or repeated tasks are never looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, scratch_path, stage
from .batches import map_rows

# A task starts another archive when one holds this much before compression.
ARCHIVE_BYTES = 64 << 20
COPY_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page/{page}')}>"


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1"]
    for name, value in fields:
        if value is not None:
            clean = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value))
            lines.append(f"{name}: {clean}")
    return "\r\n".join(lines).encode() + END


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit carries the HTTP header of its response, length included, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    block = http if revisit else http + payload
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    head = _header(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(page)),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
            ("WARC-Profile", profile if revisit else None),
            ("WARC-Refers-To", record_id(refers_to) if revisit else None),
            ("Page-Id", page),
            ("Refers-To-Page-Id", refers_to if revisit else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block)),
        ]
    )
    return head + block + END


def read_header(stream: BinaryIO) -> tuple[bytes, dict[str, str]] | None:
    """The raw header of the next record and its fields by lower-case name; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    raw, fields, name = [line], {}, ""
    while True:
        line = stream.readline()
        if not line:
            raise EOFError("the archive ends inside a header")
        raw.append(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            return b"".join(raw), fields
        if text[0] in " \t" and name:
            fields[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()


def normalise(source: BinaryIO, target: BinaryIO) -> tuple[list[dict], bool]:
    """Inflate ``source`` once and write each record to ``target`` as a gzip member.

    Returns the index (offset, length and main fields of each member) and
    whether the source ended too early; what came whole before that is kept.
    Blocks are copied in pieces, so no record is held whole.
    """
    index: list[dict] = []
    stream = io.BufferedReader(gzip.GzipFile(fileobj=source), COPY_BYTES)
    offset = 0
    try:
        while (head := read_header(stream)) is not None:
            raw, fields = head
            left = int(fields.get("content-length", 0))
            member = zlib.compressobj(6, zlib.DEFLATED, 31)
            parts = [member.compress(raw)]
            while left:
                piece = stream.read(min(left, COPY_BYTES))
                if not piece:
                    raise EOFError("the archive ends inside a block")
                left -= len(piece)
                parts.append(member.compress(piece))
            parts += [member.compress(END), member.flush()]
            data = b"".join(parts)
            target.write(data)
            index.append(
                {
                    "offset": offset,
                    "length": len(data),
                    "type": fields.get("warc-type"),
                    "id": fields.get("warc-record-id"),
                    "uri": fields.get("warc-target-uri"),
                    "digest": fields.get("warc-payload-digest"),
                }
            )
            offset += len(data)
    except (EOFError, zlib.error, gzip.BadGzipFile):
        return index, True
    return index, False


def read_member(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of one member."""
    stream = io.BytesIO(gzip.decompress(data))
    _, fields = read_header(stream)
    return fields, stream.read(int(fields.get("content-length", 0)))


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds ``payload_sha1, revisit, refers_to`` to pages ``(page_id, url, html)``.

    Of payloads equal and at least ``min_bytes`` long, that with the smallest
    page_id is the response. Repeated rows of that page are responses too; a
    null page_id is the response only if no other page has the payload.
    Only ids and digests are grouped and joined; the frequent ones by a partial
    count and a join that Spark may split.
    """
    pages = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("payload_sha1")
    )
    long = pages.where(F.octet_length("html") >= min_bytes).select("page_id", "payload_sha1")
    firsts = long.groupBy("payload_sha1").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where(F.col("n") > 1).drop("n")
    revisits = (
        long.join(firsts, "payload_sha1")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("_id"), F.col("payload_sha1").alias("_sha1"), "refers_to", F.lit(True).alias("revisit"))
        .distinct()
    )
    # Measured small, the revisits go to the pages; else pages are shuffled by id and digest.
    revisits = broadcast_if_small(stage(revisits, "warc-revisits"))
    same = pages["page_id"].eqNullSafe(revisits["_id"]) & (pages["payload_sha1"] == revisits["_sha1"])
    return pages.join(revisits, same, "left").drop("_id", "_sha1").withColumn("revisit", F.coalesce("revisit", F.lit(False)))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write whole-file gzip archives; one row ``(archive, records)`` for each."""
    columns = ["page_id", "url", "html", "refers_to", "revisit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        out, written, n, name = None, 0, 0, ""

        def finished() -> pa.RecordBatch:
            out.close()
            sink.close()
            return pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [n]})

        for batch in batches:
            cols = [batch.column(c) for c in columns]
            for i in range(batch.num_rows):
                page, url, html, refers, revisit = (c[i].as_py() for c in cols)
                if out is None:
                    name, written, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = store.open_output_stream(f"{path}/{name}", compression=None)
                    out = gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=1, mtime=0)
                data = record(page, url, (html or "").encode(), refers, revisit)
                out.write(data)
                written, n = written + len(data), n + 1
                if written >= ARCHIVE_BYTES:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return records.select(columns).mapInArrow(run, "archive string, records bigint")


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Normalise each file named in ``archive``: ``(archive, warc, index, records, truncated)``.

    The index is a file of JSON lines beside the new archive.
    """

    def make():
        store, path = _store(folder)
        store.create_dir(path, recursive=True)

        def run(batch: pa.RecordBatch) -> Iterator[tuple]:
            for uri in batch.column(0).to_pylist():
                source, at = _store(uri)
                name = f"{path}/{uuid.uuid4().hex}"
                with source.open_input_file(at) as src, store.open_output_stream(f"{name}.warc.gz", compression=None) as dst:
                    index, truncated = normalise(src, dst)
                with store.open_output_stream(f"{name}.index.jsonl", compression=None) as dst:
                    dst.write("".join(json.dumps(x) + "\n" for x in index).encode())
                base = f"{folder}/{name.rpartition('/')[2]}"
                yield uri, f"{base}.warc.gz", f"{base}.index.jsonl", len(index), truncated

        return run

    schema = "archive string, warc string, index string, records bigint, truncated boolean"
    spread = max(archives.sparkSession.sparkContext.defaultParallelism, 1) * 2
    return map_rows(archives.select("archive").repartition(spread, "archive"), schema, make)


READ = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, html string, intact boolean"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Read normalised archives record by record through their indexes.

    ``html`` is the payload of a response (null without ``payloads``, and for
    revisits); ``intact`` says whether it has the length and digest noted.
    """

    def make():
        def run(batch: pa.RecordBatch) -> Iterator[tuple]:
            for warc, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, at = _store(warc)
                with store.open_input_stream(_store(index)[1], compression=None) as src:
                    entries = [json.loads(line) for line in src.read().decode().splitlines()]
                with store.open_input_file(at) as src:
                    for e in entries:
                        src.seek(e["offset"])
                        fields, block = read_member(src.read(e["length"]))
                        http, _, payload = block.partition(END)
                        size = next(
                            int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")
                        )
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        revisit = fields["warc-type"] == "revisit"
                        intact = revisit or (len(payload) == size and payload_digest(payload) == digest)
                        page, refers = fields.get("page-id"), fields.get("refers-to-page-id")
                        yield (
                            int(page) if page else None,
                            fields.get("warc-target-uri"),
                            fields["warc-type"],
                            int(refers) if refers else None,
                            size,
                            digest,
                            payload.decode("utf-8", "replace") if payloads and not revisit else None,
                            intact,
                        )

        return run

    spread = max(archives.sparkSession.sparkContext.defaultParallelism, 1) * 2
    return map_rows(archives.select("warc", "index").repartition(spread, "warc"), READ, make)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages to normalised archives in the shared folder: the table of
    :func:`normalise_archives`, written once. An empty table gives no archive."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    raw = stage(write_archives(plan_records(pages, min_bytes), f"{folder}/raw"), "warc-raw")
    return stage(normalise_archives(raw, f"{folder}/members"), "warc-members")
