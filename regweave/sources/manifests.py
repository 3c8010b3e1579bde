"""What a staged table was made of, committed beside it when it is complete."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from regweave.operators.profiles import Profile
from regweave.storage import exists, put_file, read_bytes


@dataclass(frozen=True)
class RawFiles:
    """The raw files of a dataset: names below ``root``, lengths and times of change."""

    root: str
    files: tuple[tuple[str, int, int], ...] = ()

    def same_as(self, other: RawFiles) -> bool:
        """Whether the files are the same ones. A release that was copied to another place has
        other times there, so these count in one place only."""
        if self.root == other.root:
            return self.files == other.files
        return [file[:2] for file in self.files] == [file[:2] for file in other.files]


@dataclass(frozen=True)
class Manifest:
    """Raw files, columns and layout of a staged table, and its profile."""

    raw: RawFiles
    columns: tuple[str, ...]
    buckets: int
    profile: Profile

    def made_of(self, raw: RawFiles, columns: tuple[str, ...], buckets: int) -> bool:
        """Whether staging these files would give this table. Raw files that are gone say
        nothing, as the staged table is then all there is."""
        unchanged = not raw.files or self.raw.same_as(raw)
        return unchanged and (self.columns, self.buckets) == (columns, buckets)

    def commit(self, spark: SparkSession, path: str) -> None:
        stored = {
            "raw": {"root": self.raw.root, "files": self.raw.files}, "columns": self.columns,
            "buckets": self.buckets, "profile": self.profile.as_json(),
        }
        put_file(spark, path, json.dumps(stored).encode())

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Manifest | None:
        """The manifest at ``path``, None if there is none."""
        if not exists(spark, path):
            return None
        stored = json.loads(read_bytes(spark, path))
        raw = RawFiles(stored["raw"]["root"], tuple(tuple(file) for file in stored["raw"]["files"]))
        profile = Profile.from_json(stored["profile"])
        return cls(raw, tuple(stored["columns"]), stored["buckets"], profile)
