"""Table and CSV outputs."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regweave.storage import file_system, is_complete, remove

# Written so that quotes are doubled and edge spaces are kept: any CSV reader gets the
# same text back.
_CSV_OPTIONS = {
    "sep": ",",
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# One task copies about so many bytes of a file that is put together, in blocks of these.
_PIECE_BYTES = 64 << 20
_BLOCK_BYTES = 4 << 20


def write_table(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """Write ``df`` as parquet in place of whatever is at ``path``.

    ``rebalance`` is for results much smaller than their input: it evens out the files,
    which would otherwise be one small file for every input split.
    """
    (df.hint("rebalance") if rebalance else df).write.mode("overwrite").parquet(path)


def write_ordered(df: DataFrame, path: str, order: list[str], keys: list[str]) -> None:
    """Write ``df`` as parquet in the order of the columns ``order``, over all files.

    Files and row groups then hold narrow ranges of them, which scans skip by their statistics;
    ``keys`` get Bloom filters besides. A value that fills several files is divided by the
    columns after it.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    blooms = {f"parquet.bloom.filter.enabled#{key}": "true" for key in keys}
    ordered.write.mode("overwrite").options(**blooms).parquet(path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, name: str) -> None:
    """Write ``df`` as the parquet table ``name`` at ``path``, in buckets by ``key``.

    Tables in equally many buckets by the same key join without a shuffle. Each bucket is one
    file in the order of the key. Whatever is at ``path`` is replaced.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove(spark, path)
    (
        df.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key)
        .saveAsTable(name)
    )


def write_table_once(
    spark: SparkSession, build: Callable[[], DataFrame], path: str, rebalance: bool = False
) -> bool:
    """Write the table unless it is complete already; ``build`` runs only if needed."""
    if is_complete(spark, path):
        return False
    write_table(build(), path, rebalance)
    return True


def export_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Write ``df`` as a directory of CSV files, each with a header if wanted, from all tasks."""
    options = _CSV_OPTIONS | {"header": str(header).lower()}
    df.write.mode("overwrite").options(**options).csv(path)


def export_single_csv(df: DataFrame, target: str) -> None:
    """Write ``df`` as the one CSV file ``target``, in the order of its partitions.

    All tasks write files without a header, and tasks copy pieces of those to their places in
    the one file. That takes a file system with writes at any place, which of Hadoop's only
    the local one (or a shared mount) is. Elsewhere the file has one writer, which reads all
    rows and streams them: for large results use ``export_csv`` or ``write_table`` there.
    """
    spark = df.sparkSession
    fs, final = file_system(spark, target)
    staging = f"{target}.{uuid.uuid4().hex}.tmp"
    if fs.getUri().getScheme() == "file":
        export_csv(spark.createDataFrame([], df.schema), f"{staging}/header")
        export_csv(df, f"{staging}/rows", header=False)
        parts = _csv_files(spark, f"{staging}/header") + _csv_files(spark, f"{staging}/rows")
        _, whole = file_system(spark, f"{staging}/whole.csv")
        _put_together(spark, parts, whole.toUri().getPath())
        found, wanted = fs.getFileStatus(whole).getLen(), sum(part.getLen() for part in parts)
        if found != wanted:
            raise RuntimeError(f"{whole.toString()} has {found} bytes instead of {wanted}")
    else:
        export_csv(df.repartition(1), staging)
        parts = _csv_files(spark, staging)
        if len(parts) != 1:
            raise RuntimeError(f"expected one CSV file in {staging}, found {len(parts)}")
        whole = parts[0].getPath()
    # A rename does not replace an existing file, it fails and leaves the old one.
    fs.delete(final, False)
    if not fs.rename(whole, final):
        raise RuntimeError(f"could not move the CSV file to {target}")
    fs.delete(file_system(spark, staging)[1], True)


def _csv_files(spark: SparkSession, path: str) -> list:
    """The CSV files that the tasks of a write left in a directory, in the order of the tasks."""
    fs, pattern = file_system(spark, f"{path}/part-*.csv")
    return sorted(fs.globStatus(pattern), key=lambda part: part.getPath().getName())


def _put_together(spark: SparkSession, parts: list, target: str) -> None:
    """Copy local files, one after another, into the new local file ``target``. The tasks copy
    about equal shares; only names and lengths pass through the driver."""
    tasks, place, room = [], 0, 0
    for part in parts:
        path, start, end = part.getPath().toUri().getPath(), 0, part.getLen()
        while start < end:
            if not room:
                tasks.append([])
                room = _PIECE_BYTES
            length = min(room, end - start)
            tasks[-1].append((path, start, length, place))
            start, place, room = start + length, place + length, room - length

    def copy(pieces: list[tuple[str, int, int, int]]) -> None:
        # Not truncated, as others write to it too. A piece that is copied again is the same.
        out = os.open(target, os.O_WRONLY | os.O_CREAT, 0o666)
        try:
            for path, start, length, place in pieces:
                with open(path, "rb") as source:
                    source.seek(start)
                    while length:
                        block = source.read(min(length, _BLOCK_BYTES))
                        if not block:
                            raise EOFError(f"{path} is shorter than it was")
                        written = 0
                        while written < len(block):
                            written += os.pwrite(out, block[written:], place + written)
                        length, place = length - len(block), place + len(block)
        finally:
            os.close(out)

    spark.sparkContext.parallelize(tasks, len(tasks)).foreach(copy)
