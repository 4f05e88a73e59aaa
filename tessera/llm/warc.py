"""WARC archives through a chunked record table (operator 12).

A payload never travels whole: it is cut into rows (record, chunk number, bytes) of ``CHUNK``
bytes.  The rows of a record pass one after the other, and each carries the size and the
SHA-256 of the payload up to its own end, so the last row of a record holds those of the whole
payload.  Records, their duplicates and their headers are settled on these last rows
alone, without payloads.

For writing, a header row joins the chunk rows of its record and a task streams them into gzip
members, one per record, holding one chunk at a time.  Reading streams the members in the
same way and gives the chunk rows again, with the digest carried along and compared with the
header at the end of each record.  Files are named after the task attempt that wrote
them, and only finished attempts reach the manifest, so a repeated task does no harm.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import shared_path, written

#: Bytes of a chunk; bytes of an archive after which the next record opens a new one; bytes that a
#: reader gathers before it hands them on.
CHUNK, ARCHIVE, GATHER = 1 << 13, 1 << 30, 4 << 20
#: Payloads from this size on are stored once.
LEAST = 100
#: Parts into which the rows of one payload are dealt when duplicates meet their first record.
SALTS = 16
# Names and values of the WARC 1.1 format.
VERSION, PROFILE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TYPES = {"response": "application/http; msgtype=response", "revisit": "application/http; msgtype=response"}

_CHUNKS = "record long, id long, uri string, chunk int, last boolean, size long, digest string, data binary"


def chunk_rows(pages: DataFrame, page_id: str = "page_id", payload: str = "html", uri: str | None = "url", chunk: int = CHUNK) -> DataFrame:
    """record, id, uri, chunk, last, data: the payloads in pieces, in the order of their records.

    Null payloads are empty; an empty payload is one empty chunk.
    """
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("id"),
                        (F.col(f"`{uri}`").cast("string") if uri else F.lit(None).cast("string")).alias("uri"),
                        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("b"))
    cut = rows.select(F.monotonically_increasing_id().alias("record"), "id", "uri",
                      F.expr(f"transform(sequence(0, greatest(0, (octet_length(b) - 1) div {chunk})), i -> substring(b, cast(i * {chunk} + 1 as int), {chunk}))").alias("pieces"))
    return (cut.select("record", "id", "uri", F.size("pieces").alias("n"), F.posexplode("pieces").alias("chunk", "data"))
            .select("record", "id", "uri", "chunk", (F.col("chunk") == F.col("n") - 1).alias("last"), "data"))


def carry_digests(rows: DataFrame) -> DataFrame:
    """``chunk_rows`` with ``size`` and ``digest`` (hex SHA-256) of the payload up to each chunk's end.

    The rows of a record must follow each other in the order of their chunks; anything else is an error.
    """
    def run(batches):
        record, chunk, size, state = None, 0, 0, None
        for batch in batches:
            sizes, digests = [], []
            for own, number, data in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(5), strict=True):
                if number == 0:
                    record, chunk, size, state = own, 0, 0, hashlib.sha256()
                elif own != record or number != chunk + 1:
                    raise ValueError(f"chunk {number} of record {own} is out of order")
                piece = data.as_buffer()
                state.update(piece)
                chunk, size = number, size + len(piece)
                sizes.append(size)
                digests.append(state.copy().hexdigest())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(5)], pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), batch.column(5)],
                                             names=["record", "id", "uri", "chunk", "last", "size", "digest", "data"])
    return rows.select("record", "id", "uri", "chunk", "last", "data").mapInArrow(run, _CHUNKS)


def headers(chunks: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per record: record, id, uri, size, digest, refers (record, id) or null for responses.

    Of records with equal payloads of ``least`` bytes or more the one with the smallest (id, record)
    is a response and the others revisit it; null ids come last.  Groups are counted before a shuffle, and a
    payload's rows are dealt into ``SALTS`` parts to meet their first record.
    """
    records = chunks.where("last").select("record", "id", "uri", "size", "digest")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "record")
    firsts = (records.where(F.col("size") >= least).groupBy(F.col("digest").alias("_digest"), F.col("size").alias("_size"))
              .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
              .select("_digest", "_size", "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    met = records.join(firsts, (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size"))
                       & (F.pmod(F.xxhash64("record"), F.lit(SALTS)).cast("int") == F.col("_salt")), "left")
    other = F.col("_first.record") != F.col("record")
    return met.select("record", "id", "uri", "size", "digest",
                      F.when(other, F.struct(F.col("_first.record").alias("record"), F.col("_first.id").alias("id"))).alias("refers"))


def _name(record: int, own: int | None) -> str:
    return f"<urn:record:{record}:{'-' if own is None else own}>"


def _heads(row: dict, date: str) -> bytes:
    """The WARC header and the HTTP header of a record."""
    kind = "revisit" if row["refers"] else "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _name(row["record"], row["id"])), ("WARC-Date", date)]
    if row["uri"] is not None:
        # Only what would end the header line or the field; all else stays as it is.
        fields.append(("WARC-Target-URI", "".join(quote(c, safe="") if ord(c) <= 32 or ord(c) == 127 else c for c in row["uri"])))
    fields.append(("WARC-Payload-Digest", f"sha256:{row['digest']}"))
    if row["refers"]:
        fields += [("WARC-Refers-To", _name(row["refers"]["record"], row["refers"]["id"])), ("WARC-Profile", PROFILE)]
    length = len(http) + (0 if row["refers"] else row["size"])
    fields += [("Content-Type", TYPES[kind]), ("Content-Length", str(length))]
    return VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n" + http


class _Archive:
    """An archive that is being written: one gzip member per record."""

    def __init__(self, store, path: str, date: str):
        self.file, self.records, self.size, self.member = store.open_output_stream(path), 0, 0, None
        info = b"software: tessera\r\nformat: WARC File Format 1.1\r\n"
        self.begin(VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
            ("Content-Type", "application/warc-fields"), ("Content-Length", len(info))]).encode() + b"\r\n" + info)
        self.end()
        self.records = 0

    def put(self, data: bytes):
        self.size += len(data)
        self.file.write(data)

    def begin(self, head: bytes):
        self.member = zlib.compressobj(4, zlib.DEFLATED, 31)
        self.put(self.member.compress(head))

    def add(self, data):
        self.put(self.member.compress(data))

    def end(self):
        self.put(self.member.compress(b"\r\n\r\n") + self.member.flush())
        self.member, self.records = None, self.records + 1

    def close(self):
        self.file.close()


MANIFEST = "path string, n_records long, n_bytes long"


def write_archives(chunks: DataFrame, folder: str | None = None, archive: int = ARCHIVE, date: str | None = None) -> DataFrame:
    """Write a written table of digested chunks as gzipped WARC files; returns path, n_records, n_bytes of each.

    A record is a response with its payload, or a revisit (see ``headers``) without.  Records are dealt
    out by hash, chunks of a record go to one file in order.  A URI's white space and control characters are
    percent-encoded.  ``date`` (default: now) is that of all records.  An empty table writes no file.
    """
    spark = chunks.sparkSession
    folder = folder or shared_path(spark, "warc")
    uri = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    head = headers(chunks).select("record", F.lit(-1).alias("chunk"), F.lit(None).cast("binary").alias("data"),
                                  F.struct("record", "id", "uri", "size", "digest", "refers").alias("head"))
    kind = head.schema["head"].dataType.simpleString()
    rows = (head.unionByName(chunks.select("record", "chunk", "data", F.lit(None).cast(kind).alias("head")))
            .repartition("record").sortWithinPartitions("record", "chunk"))

    def write(batches):
        task = TaskContext.get()
        tag, store, root = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}", *fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        out, number, revisit, done = None, 0, False, []

        def finished():
            out.close()
            return [f"{uri}/{name}", out.records, out.size]
        for batch in batches:
            given = batch.column(3)
            for i, (chunk, data) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2), strict=True)):
                if chunk >= 0:
                    if not revisit:
                        out.add(data.as_buffer())
                    continue
                if out is not None:
                    out.end()
                    if out.size >= archive:
                        done.append(finished())
                        out = None
                if out is None:
                    name = f"part-{tag}-{number:04d}.warc.gz"
                    out, number = _Archive(store, f"{root}/{name}", date), number + 1
                row = given[i].as_py()
                revisit = bool(row["refers"])
                out.begin(_heads(row, date))
        if out is not None:
            out.end()
            done.append(finished())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*done, strict=True)) or [[], [], []], [pa.string(), pa.int64(), pa.int64()], strict=True)],
                                         names=["path", "n_records", "n_bytes"])

    return written(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def _exactly(stream, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError("archive ends inside a record")
    return data


def parsed(stream, chunk: int = CHUNK) -> Iterator[tuple]:
    """(record, id, type, refers, uri, chunk, last, size, digest, bytes) of each chunk in an unpacked archive.

    At most ``chunk`` bytes of a payload are held.  The digest is carried from chunk to chunk and compared with the header's.  A
    revisit gives one row without bytes, with the size and digest of the payload it stands for.
    """
    def fields(first: bytes) -> dict:
        out, line = {}, first
        while line not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().partition(":")
            out[name.strip().lower()] = value.strip()
            line = stream.readline()
        return out

    def names(text: str):
        record, _, own = text.removeprefix("<urn:record:").removesuffix(">").partition(":")
        return int(record), None if own == "-" else int(own)

    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        head = fields(stream.readline())
        left, kind = int(head["content-length"]), head["warc-type"]
        if kind not in TYPES:
            while left:
                left -= len(_exactly(stream, min(left, chunk)))
            continue
        status = stream.readline()
        lines = [status]
        while lines[-1] not in (b"\r\n", b""):
            lines.append(stream.readline())
        left -= sum(map(len, lines))
        http = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}
        digest, (record, own) = head["warc-payload-digest"].removeprefix("sha256:"), names(head["warc-record-id"])
        refers = names(head["warc-refers-to"])[1] if "warc-refers-to" in head else None
        row = (record, own, kind, refers, head.get("warc-target-uri"))
        if kind == "revisit":
            yield (*row, 0, True, int(http["content-length"]), digest, None)
            continue
        state, number, size, total = hashlib.sha256(), 0, 0, left
        while left or not number:
            data = _exactly(stream, min(left, chunk))
            left, size = left - len(data), size + len(data)
            state.update(data)
            yield (*row, number, not left, size, state.copy().hexdigest(), data)
            number += 1
        if state.hexdigest() != digest or total != int(http["content-length"]):
            raise ValueError(f"record {record}: payload and header differ")


_READ = [("record", "long", pa.int64()), ("id", "long", pa.int64()), ("record_type", "string", pa.string()), ("refers_to", "long", pa.int64()),
         ("uri", "string", pa.string()), ("chunk", "int", pa.int32()), ("last", "boolean", pa.bool_()), ("size", "long", pa.int64()),
         ("digest", "string", pa.string()), ("data", "binary", pa.binary())]


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The chunked record table of the archives: record, id, record_type, refers_to, uri, chunk, last, size, digest, data.

    Without ``payloads`` only the last chunk of each record, without its bytes: payloads are read and
    checked, but leave no task.
    """
    columns = _READ if payloads else _READ[:-1]

    def read(batches):
        held, size = [], 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, _, t) in enumerate(columns)], names=[c for c, _, _ in columns])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for row in parsed(stream):
                        if payloads:
                            held.append(row)
                            size += len(row[9] or b"")
                        elif row[6]:
                            held.append(row[:9])
                        if size >= GATHER or len(held) >= 10_000:
                            yield batch_of(held)
                            held, size = [], 0
        yield batch_of(held)

    # A task per archive: the manifest's rows are tiny, so the planner would put all of them into one task.
    spread = manifest.select("path").repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, ", ".join(f"{c} {t}" for c, t, _ in columns))


def round_trip(pages: DataFrame, page_id: str = "page_id", payload: str = "html", uri: str | None = "url") -> DataFrame:
    """Write an archive record per row, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null payloads are empty.  Repeated rows are records of their own: the first of equal ones is the response.  Null
    ids are kept and never come before an id.  Other columns, of any name, are left out.  An empty table gives an empty one.
    """
    chunks = written(carry_digests(chunk_rows(pages, page_id, payload, uri)), "warc-chunks", "zstd")
    read = read_archives(write_archives(chunks), payloads=False)
    return read.select(F.col("id").alias(page_id), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
