"""WARC archives written from and read into chunked record tables.

A payload never exists in one piece beyond the row it comes from: it is split into rows
(record, chunk number, bytes), written chunk by chunk, and read back as such rows. Each
chunk row carries the SHA-1 of the payload up to and including that chunk, so the last one
has the payload's digest, and the reader compares it with the record's header.

Records with equal payloads are stored once: the one with the largest id is a response, the
others are revisits of it. Only payloads that a Bloom filter calls possibly repeated are
shuffled for that. Archives lie in the shared scratch folder; every writing task puts its
own id into the file names, and readers follow the written list of archives, so files of
lost or repeated tasks are never read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import attach_groups, stored
from regweave.llm.exact_dedup import flag_repeats
from regweave.sources.archives import storage_of
from regweave.storage import scratch_directory

CHUNK_BYTES = 256 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ_ROWS = (
    "archive string, record string, url string, record_type string, refers string,"
    " chunk_no int, is_last boolean, n_bytes long, digest string, chunk binary"
)


def decide(
    pages: DataFrame, page_id: str = "page_id", html: str = "html", least_bytes: int = 1000
) -> DataFrame:
    """``pages`` with digest, n_bytes and refers_to (NULL for a response).

    Of equal payloads of at least ``least_bytes`` the largest id is the response; rows that
    share that id are all responses. A NULL id never is one unless all are NULL. NULL html
    is an empty payload. Columns of the new names are replaced.
    """
    names = [c for c in pages.columns if c not in ("digest", "n_bytes", "refers_to")]
    payload = F.coalesce(F.col(html), F.lit(""))
    keyed = pages.select(
        *names, F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes")
    )
    keyed = keyed.withColumn("__rw_key", F.xxhash64("digest"))
    keys = stored(
        keyed.where(F.col("n_bytes") >= least_bytes)
        .select(F.col(page_id).alias("__rw_id"), "digest", "__rw_key"),
        "payloads",
    )
    none = F.lit(None).cast(pages.schema[page_id].dataType)
    groups = (
        flag_repeats(keys, "__rw_key", "__rw_maybe").where("__rw_maybe").groupBy("digest")
        .agg(F.max("__rw_id").alias("__rw_best"), F.count(F.lit(1)).alias("__rw_size"))
    )
    large = F.col("n_bytes") >= least_bytes
    flagged = flag_repeats(keyed.where(large), "__rw_key", "__rw_maybe", keys)
    joined = attach_groups(flagged.where("__rw_maybe"), groups, ["digest"], "__rw_size", keys.count())
    other = ~F.col(page_id).eqNullSafe(F.col("__rw_best"))
    columns = [*names, "digest", "n_bytes", "refers_to"]
    return (
        keyed.where(~large).withColumn("refers_to", none).select(*columns)
        .unionByName(flagged.where("not __rw_maybe").withColumn("refers_to", none).select(*columns))
        .unionByName(joined.withColumn("refers_to", F.when(other, F.col("__rw_best"))).select(*columns))
    )


def chunk_table(decided: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """One row per chunk of each payload; a revisit and an empty payload have one empty row."""
    body = F.when(F.col("refers_to").isNull(), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8"))
    body = F.coalesce(body, F.lit(b""))
    last = F.floor(F.greatest(F.octet_length("_body") - 1, F.lit(0)) / CHUNK_BYTES).cast("int")
    records = decided.select(
        F.col(page_id).cast("string").alias("record"), F.col(url).alias("url"), "digest",
        F.col("refers_to").cast("string").alias("refers"),
        F.col("refers_to").isNotNull().alias("is_revisit"), "n_bytes", body.alias("_body"),
    )
    # Each row cuts its own chunk; the chunks of a payload are never together.
    numbered = records.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("chunk_no") * CHUNK_BYTES + 1
    return numbered.withColumn(
        "chunk", F.substring("_body", start, F.lit(CHUNK_BYTES))
    ).select("record", "url", "digest", "refers", "is_revisit", "n_bytes", "chunk_no", "chunk")


def _uri(record: str | None) -> str:
    return f"<urn:page:{quote(record, safe='')}>" if record is not None else "<urn:none>"


def _record(uri: str | None) -> str | None:
    found = re.fullmatch(r"<urn:page:(.*)>", uri or "")
    return unquote(found[1]) if found else None


def _head(row: dict) -> bytes:
    """Record header, and the HTTP header with which the block begins."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['n_bytes']}\r\n\r\n"
    )
    length = len(http) + (0 if row["is_revisit"] else row["n_bytes"])
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if row['is_revisit'] else 'response'}",
        f"WARC-Record-ID: {_uri(row['record'])}",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {length}",
    ]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + quote(row["url"], safe="%/:?#[]@!$&'()*+,;=~-._"))
    if row["is_revisit"]:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_uri(row['refers'])}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        system, path = storage_of(folder)
        system.create_dir(path, recursive=True)
        names: list[str] = []
        counts: list[int] = []
        sink = member = stated = None
        running = hashlib.sha1()

        def finish(file, zipped):
            if zipped is not None:
                if stated is not None and running.hexdigest() != stated:
                    raise ValueError(f"{names[-1]}: a payload is not what its digest says")
                zipped.write(b"\r\n\r\n")
                zipped.close()
            if file is not None and zipped is None:
                file.close()

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    finish(None, member)
                    if sink is None or sink.tell() >= archive_bytes:
                        finish(sink, None)
                        names.append(f"{task}-{len(names):04d}.warc.gz")
                        counts.append(0)
                        sink = system.open_output_stream(f"{path}/{names[-1]}", compression=None)
                    member = gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=3, mtime=0)
                    member.write(_head(row))
                    counts[-1] += 1
                    running, stated = hashlib.sha1(), None if row["is_revisit"] else row["digest"]
                running.update(row["chunk"] or b"")
                member.write(row["chunk"] or b"")
        finish(None, member)
        finish(sink, None)
        if names:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{n}" for n in names]), pa.array(counts, pa.int64())],
                names=["archive", "records"],
            )

    return run


def write(
    decided: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    folder: str | None = None,
    archive_bytes: int = 1 << 30,
) -> DataFrame:
    """Writes one record per row; returns the list of archives (archive, records).

    The SHA-1 of a payload is carried along its chunks, and must come out as the digest in the
    record's header.

    Each task writes its own archives, a new one after ``archive_bytes``. Every record is a
    gzip member of its own. An empty table writes nothing.
    """
    spark = decided.sparkSession
    folder = folder or scratch_directory(spark, "warc")
    chunks = chunk_table(decided, page_id, url, html)
    rows = chunks.mapInArrow(_writer(folder, archive_bytes), "archive string, records long")
    return stored(rows, "archives")


def _headers(stream: io.BufferedReader) -> dict[str, str]:
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().rstrip("\r\n").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _reader(with_data: bool):
    def rows(archive: str) -> Iterator[tuple]:
        system, path = storage_of(archive)
        with (
            system.open_input_stream(path, compression=None) as raw,
            gzip.GzipFile(fileobj=raw) as zipped,
            io.BufferedReader(zipped, CHUNK_BYTES) as stream,
        ):
            while version := stream.readline():
                if not version.startswith(b"WARC/"):
                    raise ValueError(f"{archive}: no record where one should begin")
                head = _headers(stream)
                left = int(head["content-length"])
                http = stream.readline()
                left -= len(http)
                fields = {}
                while (line := stream.readline()) != b"\r\n":
                    if not line:
                        raise ValueError(f"{archive}: a record ends in its header")
                    left -= len(line)
                    name, _, value = line.decode().partition(":")
                    fields[name.lower()] = value.strip()
                left -= 2
                record, kind = _record(head["warc-record-id"]), head["warc-type"]
                own = (archive, record, head.get("warc-target-uri"), kind,
                       _record(head.get("warc-refers-to")))
                stated = head["warc-payload-digest"].removeprefix("sha1:")
                if kind == "revisit":
                    yield (*own, 0, True, int(fields["content-length"]), stated, None)
                else:
                    sha, size, number = hashlib.sha1(), 0, 0
                    while True:
                        data = stream.read(min(CHUNK_BYTES, left))
                        if left and not data:
                            raise ValueError(f"{archive}: a record ends in its payload")
                        left -= len(data)
                        size += len(data)
                        sha.update(data)
                        if not left and sha.hexdigest() != stated:
                            raise ValueError(f"{archive}: damaged payload of {record}")
                        yield (*own, number, not left, size, sha.hexdigest(),
                               data if with_data else None)
                        number += 1
                        if not left:
                            break
                if stream.read(4) != b"\r\n\r\n":
                    raise ValueError(f"{archive}: a record does not end where it should")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                held: list[tuple] = []
                for row in rows(archive):
                    held.append(row)
                    if len(held) == (32 if with_data else 4096):
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)

    return run


_ARROW = pa.schema([
    ("archive", pa.string()), ("record", pa.string()), ("url", pa.string()),
    ("record_type", pa.string()), ("refers", pa.string()), ("chunk_no", pa.int32()),
    ("is_last", pa.bool_()), ("n_bytes", pa.int64()), ("digest", pa.string()),
    ("chunk", pa.binary()),
])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), _ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def read(archives: DataFrame, with_data: bool = True, archive: str = "archive") -> DataFrame:
    """The chunked record table of ``archives``.

    One row per chunk: record, url, record_type, refers, chunk_no, is_last, and n_bytes and
    digest of the payload up to this chunk. A revisit has one row, without data, with the
    size and digest of the payload that it stands for. Damage raises an error. An archive is
    read by one task in bounded memory; archives spread over tasks.
    """
    paths = archives.select(archive)
    spread = paths.repartitionByRange(max(1, paths.count()), archive)
    return spread.mapInArrow(_reader(with_data), _READ_ROWS)


def report(records: DataFrame, id_type: str = "long") -> DataFrame:
    """One row per record from its last chunk."""
    return records.where("is_last").select(
        F.col("record").cast(id_type).alias("page_id"),
        F.col("n_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers").cast(id_type).alias("refers_to"),
    )
