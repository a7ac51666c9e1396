"""WARC archives: written as one gzip stream each, then normalised to a member per record.

A monolithic stream can only be read from its start. The normaliser inflates it once, in
pieces of bounded size, writes every record again as a gzip member of its own and notes the
member's place in a sidecar index, so that readers go straight to any record. Files are
written below the shared folder through the file system of its address; each is written
under a name of its attempt and moved into place, so a repeated task leaves the same files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.work import Scratch, arrow_schema, utf8

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


@dataclass(frozen=True)
class Settings:
    """`least_bytes`: smaller payloads are never revisits; `archive_bytes`: content after which
    the next archive begins; `level`: of compression; `piece`: bytes inflated at a time."""

    least_bytes: int = 0
    archive_bytes: int = 256 << 20
    level: int = 1
    piece: int = 1 << 20


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, record_id: str, uri: bytes, digest: str, block: bytes, refers_to: str | None = None) -> bytes:
    lines = [
        b"WARC/1.1",
        b"WARC-Type: " + kind.encode(),
        b"WARC-Record-ID: <" + record_id.encode() + b">",
        b"WARC-Date: 2024-01-01T00:00:00Z",
        b"WARC-Target-URI: " + uri,
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
    ]
    if refers_to is not None:
        lines += [
            b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            b"WARC-Refers-To: <" + refers_to.encode() + b">",
        ]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _uri(url: str | None) -> bytes:
    """The address without bytes that could end a header line."""
    return re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m.group()[0], (url or "about:blank").encode())


class Placed:
    """A file written under a name of its attempt, and moved into place when it is whole."""

    def __init__(self, folder: str, name: str):
        self.system, base = arrow_fs.FileSystem.from_uri(folder)
        self.system.create_dir(base, recursive=True)
        self.path, self.draft = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"
        self.file = self.system.open_output_stream(self.draft, compression=None)

    def done(self) -> None:
        self.file.close()
        if self.system.get_file_info(self.path).type != arrow_fs.FileType.NotFound:
            self.system.delete_file(self.path)
        self.system.move(self.draft, self.path)


def opened(folder: str, name: str) -> BinaryIO:
    system, base = arrow_fs.FileSystem.from_uri(folder)
    return system.open_input_file(f"{base}/{name}")


def records(file: BinaryIO, piece: int) -> Iterator[tuple[bytes, dict[str, str], bytes]]:
    """(header bytes, header fields in lower case, block) of every record of a gzip stream, in one or more members."""
    inflater, held = zlib.decompressobj(31), bytearray()

    def more() -> bool:
        nonlocal inflater
        data = inflater.unconsumed_tail
        if not data:
            if inflater.eof:
                data = inflater.unused_data or file.read(piece)
                if not data:
                    return False
                inflater = zlib.decompressobj(31)
            else:
                data = file.read(piece)
                if not data:
                    return False
        held.extend(inflater.decompress(data, piece))
        return True

    def upto(size: int) -> None:
        while len(held) < size:
            if not more():
                raise ValueError("the archive ends inside a record")

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the archive ends inside a header")
                return
        head = bytes(held[: end + 4])
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
        fields = {k.lower(): v for k, v in fields.items()}
        size = int(fields["content-length"])
        upto(end + 4 + size + 4)
        block = bytes(held[end + 4 : end + 4 + size])
        del held[: end + 4 + size + 4]
        yield head, fields, block


def payload_of(block: bytes) -> tuple[int, bytes]:
    """The length that the HTTP header states, and the body that is there."""
    head, _, body = block.partition(b"\r\n\r\n")
    return int(re.search(rb"(?i)content-length: (\d+)", head)[1]), body


def _listing(id_field: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("archive", T.StringType()),
            T.StructField("place", T.LongType()),
            id_field,
            T.StructField("payload_bytes", T.LongType()),
            T.StructField("payload_digest", T.StringType()),
        ]
    )


def write_monolithic(pages: DataFrame, folder: str, settings: Settings) -> DataFrame:
    """Archives of whole-file gzip streams, a response record per row; rows (archive, place, page_id,
    payload_bytes, payload_digest), place being the record's number in its archive."""
    schema = _listing(pages.schema["page_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            rows = []
            payloads = utf8(batch.column("html"))
            for page_id, url, payload in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), payloads, strict=True):
                if out is None:
                    name, place, written = f"{part:06d}-{number:04d}.warc.gz", 0, 0
                    out, deflater = Placed(folder, name), zlib.compressobj(settings.level, zlib.DEFLATED, 31)
                digest = digest_of(payload)
                record_id = f"urn:x-page:{page_id}:{part}-{number}-{place}"
                content = record("response", record_id, _uri(url), digest, HTTP % len(payload) + payload)
                out.file.write(deflater.compress(content))
                rows.append((name, place, page_id, len(payload), digest))
                place, written = place + 1, written + len(content)
                if written >= settings.archive_bytes:
                    out.file.write(deflater.flush())
                    out.done()
                    out, number = None, number + 1
            arrays = [pa.array(list(x), kind) for x, kind in zip(zip(*rows, strict=True), arrow_schema(schema).types, strict=True)] if rows else [pa.array([], k) for k in arrow_schema(schema).types]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        if out is not None:
            out.file.write(deflater.flush())
            out.done()

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)


def revisits(listing: DataFrame, settings: Settings) -> DataFrame:
    """(archive, place, refers_to) of the records whose payload an earlier one has: that with the
    smallest page_id (null last), then the first written."""
    large = listing.filter(F.col("payload_bytes") >= settings.least_bytes)
    rank = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "archive", "place")
    firsts = large.groupBy("payload_digest", "payload_bytes").agg(F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1")
    same = large.join(firsts, ["payload_digest", "payload_bytes"])
    later = (F.col("archive") != F.col("first.archive")) | (F.col("place") != F.col("first.place"))
    number = F.regexp_replace(F.col("first.archive"), r"^0*(\d+)-0*(\d+)\.warc\.gz$", "$1-$2")
    target = F.concat_ws(":", F.lit("urn:x-page"), F.coalesce(F.col("first.page_id").cast("string"), F.lit("None")), F.concat_ws("-", number, F.col("first.place").cast("string")))
    return same.filter(later).select("archive", "place", target.alias("refers_to"))


def normalise(archives: DataFrame, source: str, target: str, settings: Settings) -> DataFrame:
    """Every record of the archives (archive, places, targets) as a gzip member of its own.

    Returns rows (archive, offset, length) and writes them beside each archive as its sidecar
    index. The records at `places` become revisits of `targets`: their block keeps the HTTP
    header, which states the payload's length, and loses the payload.
    """
    schema = T.StructType(
        [T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                again = dict(zip(row["places"] or [], row["targets"] or [], strict=True))
                out, index, at = Placed(target, row["archive"]), [], 0
                with opened(source, row["archive"]) as file:
                    for place, (head, fields, block) in enumerate(records(file, settings.piece)):
                        content = head + block + b"\r\n\r\n"
                        if place in again:
                            kept = block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
                            content = record(
                                "revisit",
                                fields["warc-record-id"].strip("<>"),
                                fields["warc-target-uri"].encode(),
                                fields["warc-payload-digest"].removeprefix("sha1:"),
                                kept,
                                again[place],
                            )
                        deflater = zlib.compressobj(settings.level, zlib.DEFLATED, 31)
                        member = deflater.compress(content) + deflater.flush()
                        out.file.write(member)
                        index.append((at, len(member)))
                        at += len(member)
                out.done()
                sidecar = Placed(target, row["archive"] + ".index.jsonl")
                sidecar.file.write("".join(json.dumps({"offset": a, "length": n}) + "\n" for a, n in index).encode())
                sidecar.done()
                for lo in range(0, len(index), 10_000):
                    some = index[lo : lo + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["archive"]] * len(some)), pa.array([a for a, _ in some], pa.int64()), pa.array([n for _, n in some], pa.int64())],
                        names=schema.names,
                    )

    return archives.select("archive", "places", "targets").mapInArrow(run, schema)


def read_records(index: DataFrame, folder: str, id_field: T.StructField) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of the records at the
    places of the index (archive, offset, length). A response's digest is taken anew and must be
    the one noted."""
    schema = T.StructType(
        [
            T.StructField("page_id", T.StringType()),
            T.StructField("payload_bytes", T.LongType()),
            T.StructField("payload_digest", T.StringType()),
            T.StructField("record_type", T.StringType()),
            T.StructField("refers_to", T.StringType()),
        ]
    )

    def page_of(record_id: str) -> str | None:
        found = record_id.strip("<>").removeprefix("urn:x-page:").rpartition(":")[0]
        return None if found == "None" else found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["archive"] != name:
                    if file:
                        file.close()
                    name, file = row["archive"], opened(folder, row["archive"])
                file.seek(row["offset"])
                content = zlib.decompress(file.read(row["length"]), 31)
                head, _, rest = content.partition(b"\r\n\r\n")
                fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
                stated, body = payload_of(rest[: int(fields["Content-Length"])])
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                refers_to = fields.get("WARC-Refers-To")
                if fields["WARC-Type"] == "response" and (len(body) != stated or digest_of(body) != digest):
                    raise ValueError(f"{name}: the payload at {row['offset']} is not the one written")
                rows.append((page_of(fields["WARC-Record-ID"]), stated, digest, fields["WARC-Type"], refers_to and page_of(refers_to)))
            arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(arrow_schema(schema).types)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        if file:
            file.close()

    read = index.sortWithinPartitions("archive", "offset").mapInArrow(run, schema)
    kind = id_field.dataType
    return read.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


def archived(pages: DataFrame, settings: Settings | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, read back
    from normalised archives.

    A null html is an empty payload, a null url the target about:blank; other columns are not
    read. Of records of equal payload (of at least `least_bytes`) that with the smallest
    page_id, null last, is the response, of rows of equal page_id the first written; the others
    are revisits and refer to it. No pages give no rows. The archives are removed once they
    are read; `write_monolithic` and `normalise` keep theirs.
    """
    settings = settings or Settings()
    scratch = Scratch(pages.sparkSession, "warc")
    raw, members = scratch.path("monolithic"), scratch.path("members")
    listing = scratch.settle(write_monolithic(pages, raw, settings), "listing")
    again = revisits(listing, settings).groupBy("archive").agg(F.array_sort(F.collect_list(F.struct("place", "refers_to"))).alias("r"))
    names = listing.select("archive").distinct().join(again, "archive", "left")
    work = names.select("archive", F.col("r.place").alias("places"), F.col("r.refers_to").alias("targets"))
    # The rows are few and small, the archives behind them are not: each gets a task.
    n_tasks = max(1, names.count())
    index = scratch.settle(normalise(work.repartition(n_tasks, "archive"), raw, members, settings), "index")
    scratch.drop(raw)
    read = scratch.settle(read_records(index.repartition(n_tasks, "archive"), members, pages.schema["page_id"]), "read")
    scratch.drop_all_but(read)
    return read
