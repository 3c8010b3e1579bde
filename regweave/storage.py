"""Small file-system helpers over the Hadoop FileSystem API (names only, no data)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and ``path`` as a Hadoop Path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a full URI, so that every process resolves it on the same file system."""
    fs, target = file_system(spark, path)
    return fs.makeQualified(target).toString()


def remove(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what is below it, if it exists."""
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def make_directory(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.mkdirs(target)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Put a small file at ``path``, in place of one that may be there."""
    fs, target = file_system(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(content))
    stream.close()


def put_file(spark: SparkSession, path: str, content: bytes) -> None:
    """Put a small file at ``path``, whole or not at all: written beside it and renamed."""
    fs, target = file_system(spark, path)
    attempt = f"{path}.{uuid.uuid4().hex}.tmp"
    write_bytes(spark, attempt, content)
    fs.delete(target, False)
    if not fs.rename(file_system(spark, attempt)[1], target):
        raise RuntimeError(f"could not move a file to {path}")


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """The content of a small file."""
    fs, target = file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed. A half-written directory is not."""
    return exists(spark, f"{path}/_SUCCESS")


def _glob(spark: SparkSession, root: str, pattern: str) -> list:
    fs, path = file_system(spark, f"{root}/{pattern}")
    return list(fs.globStatus(path) or [])


def directories(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Directories under ``root`` whose name starts with ``prefix``, in text order."""
    found = _glob(spark, root, f"{prefix}*")
    return sorted(entry.getPath().toString() for entry in found if entry.isDirectory())


def directory_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the directories in ``root``, in text order."""
    found = _glob(spark, root, "*")
    return sorted(entry.getPath().getName() for entry in found if entry.isDirectory())


def files(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Files under ``root`` whose name matches ``pattern``, in text order."""
    found = _glob(spark, root, pattern)
    return sorted(entry.getPath().toString() for entry in found if entry.isFile())


def described_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of the file at ``path``, or of the files in that folder
    that a read of it would see, in text order."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    found = [entry for entry in fs.listStatus(target) if entry.isFile()]
    shown = [entry for entry in found if entry.getPath().getName()[0] not in "._"]
    return sorted(
        (entry.getPath().toString(), entry.getLen(), entry.getModificationTime()) for entry in shown
    )


def scratch_directory(spark: SparkSession, purpose: str) -> str:
    """A new directory for intermediate tables, in the folder all executors share.

    That folder is ``spark.checkpoint.dir``. Only a local session, whose executors live
    on this machine, may do without it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="regweave-")
    return qualified(spark, f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
