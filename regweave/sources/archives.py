"""Zip archives: listing, line scan and audit.

Spark has no zip reader, so tasks open the archives with ``zipfile`` over a seekable
storage handle and hand Arrow batches back. Scan and audit are both divided by archive
entry, and the CSV parsing stays in the JVM.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regweave.sources.delimited import csv_options
from regweave.storage import files, qualified

_CHUNK_CHARS = 4 << 20
# What zipfile raises on damaged content. Storage errors are not among them.
_UNREADABLE = (zipfile.BadZipFile, zlib.error, EOFError, ValueError, RuntimeError)
_ENTRIES = "archive string, number int, entry string, size long"


def list_archives(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """Rows (archive, name) of the archives under ``root``; fails if there is none.

    Only names pass through the driver. (Spark's own file scans leave out empty files,
    which an audit has to see.)
    """
    paths = files(spark, qualified(spark, root), pattern)
    if not paths:
        raise FileNotFoundError(f"no archive {pattern} in {root}")
    names = [path.rsplit("/", 1)[1] for path in paths]
    columns = {"archive": pa.array(paths, pa.string()), "name": pa.array(names, pa.string())}
    return spark.createDataFrame(pa.table(columns))


def storage_uri(location: str) -> str:
    """A Hadoop URI as Arrow reads it: the path escaped, the authority left as it is."""
    scheme, _, rest = location.partition(":")
    authority, slash, path = rest.removeprefix("//").partition("/")
    if not rest.startswith("//"):
        authority, slash, path = "", "", rest
    return f"{re.sub('^s3[an]$', 's3', scheme)}://{authority}{slash}{quote(path)}"


def storage_of(location: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a path or URI as Spark prints it, and the path in it."""
    scheme, colon, rest = location.partition(":")
    if not colon:
        return fs.LocalFileSystem(), location
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(storage_uri(location))


def _open(location: str):
    system, path = storage_of(location)
    return system.open_input_file(path)


def _entry_lister(strict: bool):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with _open(archive) as handle:
                    try:
                        with zipfile.ZipFile(handle) as opened:
                            found = [i for i in opened.infolist() if not i.is_dir() or not strict]
                            rows = [(n, i.filename, i.file_size) for n, i in enumerate(found)]
                        if not opened.infolist():
                            raise zipfile.BadZipFile("no entries")
                    except _UNREADABLE as error:
                        if strict:
                            raise zipfile.BadZipFile(f"damaged archive {archive}") from error
                        rows = [(None, None, None)]
                numbers, names, sizes = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([archive] * len(rows), pa.string()), pa.array(numbers, pa.int32()),
                        pa.array(names, pa.string()), pa.array(sizes, pa.int64()),
                    ],
                    names=["archive", "number", "entry", "size"],
                )

    return entries


def list_entries(archives: DataFrame, archive: str = "archive", strict: bool = True) -> DataFrame:
    """Rows (archive, number, entry, size) from the archives' directories, without decoding.

    An archive that can't be opened, or has no entry, is an error if ``strict``, else one
    row with NULL in the other columns.
    """
    paths = archives.select(archive)
    spread = paths.repartitionByRange(max(1, paths.count()), archive)
    return spread.mapInArrow(_entry_lister(strict), _ENTRIES)


def _line_reader(encoding: str, header: bool):
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, entry in zip(*[batch.column(n).to_pylist() for n in ("archive", "entry")]):
                with _open(archive) as handle, zipfile.ZipFile(handle) as opened:
                    with opened.open(entry) as raw:
                        text = io.TextIOWrapper(raw, encoding, errors="replace", newline=None)
                        if header:
                            text.readline()
                        rest = ""
                        while chunk := text.read(_CHUNK_CHARS):
                            *whole, rest = (rest + chunk).split("\n")
                            if whole:
                                yield pa.RecordBatch.from_pydict({"line": whole})
                        if rest:
                            yield pa.RecordBatch.from_pydict({"line": [rest]})

    return lines


def read_zipped(
    archives: DataFrame,
    schema: T.StructType,
    delimiter: str = ";",
    encoding: str = "ISO-8859-1",
    header: bool = False,
    archive: str = "archive",
) -> DataFrame:
    """One table from all entries of ``archives``, parsed like ``read_delimited``.

    Damage of an archive or of an entry fails the read; ``audit_archives`` reports it. A
    compressed entry can only be decoded from its start, so each one is streamed by one
    task in bounded memory. Lines are parsed, and filtered by whoever reads the result, in
    that task too. Only where entries are too few or too unequal to keep all cores busy
    are the lines spread over all tasks first.
    """
    entries = list_entries(archives, archive)
    counted = entries.agg(F.count("entry"), F.sum("size"), F.max("size")).first()
    count, total, largest = counted[0], counted[1] or 0, counted[2] or 0
    cores = archives.sparkSession.sparkContext.defaultParallelism
    lines = (
        entries.repartitionByRange(max(1, count), "archive", "number")
        .mapInArrow(_line_reader(encoding, header), "line string")
        .filter(F.col("line").rlike(r"[^\x00-\x20]"))
    )
    if count < cores or largest * cores > 2 * total:
        lines = lines.hint("rebalance")
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    row = F.from_csv("line", ddl, csv_options(delimiter, encoding, header=False))
    return lines.select(row.alias("row")).select("row.*")


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        checked = []
        for archive, entry in zip(*[batch.column(n).to_pylist() for n in ("archive", "entry")]):
            ok = False
            if entry is not None:
                with _open(archive) as handle:
                    try:
                        with zipfile.ZipFile(handle) as opened, opened.open(entry) as raw:
                            while raw.read(1 << 20):
                                pass
                        ok = True
                    except _UNREADABLE:
                        pass
            checked.append(ok)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(checked, pa.bool_())],
            names=[*batch.schema.names, "ok"],
        )


def audit_archives(archives: DataFrame, archive: str = "archive") -> DataFrame:
    """Rows (archive, n_entries, n_bytes, bad_entry, ok): full decode with CRC check.

    Entries are decoded independently of each other. ``bad_entry`` is the first damaged
    one; an archive that can't be opened, or has no entry, has NULL for all but ``ok``.
    """
    entries = list_entries(archives, archive, strict=False)
    tasks = max(1, entries.count())
    checked = entries.repartitionByRange(tasks, "archive", "number").mapInArrow(
        _check, f"{_ENTRIES}, ok boolean"
    )
    readable = F.count("entry") > 0
    return checked.groupBy("archive").agg(
        F.when(readable, F.count("entry")).alias("n_entries"),
        F.sum("size").alias("n_bytes"),
        F.min_by("entry", F.when(~F.col("ok"), F.col("number"))).alias("bad_entry"),
        F.bool_and("ok").alias("ok"),
    )
