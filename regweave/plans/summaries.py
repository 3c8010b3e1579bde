"""Partner summaries kept for each raw file, so that a replaced file costs its own rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from regweave.operators.profiles import Profile
from regweave.operators.relational import merge_summaries
from regweave.plans.enrich import partner_summary
from regweave.schemas import COMPANY, PARTNER_SUMMARY
from regweave.sinks.tables import write_table
from regweave.sources.datasets import RawRelease
from regweave.sources.manifests import Manifest
from regweave.storage import directory_names, exists, is_complete, remove

_SCHEMA = T.StructType([T.StructField(COMPANY, T.StringType()), *PARTNER_SUMMARY])
_COLUMNS = tuple(_SCHEMA.names)


def stage_summaries(spark: SparkSession, raw: RawRelease, root: str) -> list[str]:
    """Summarise the partner files of ``raw`` that are new or replaced, each into a folder of
    ``root``, and drop the summaries of files that are gone. Returns the names of the files
    that were read.

    A summary is complete with its manifest, which is committed after it and removed before.
    """
    parts = raw.parts(spark, "socios")
    known = directory_names(spark, root) if exists(spark, root) else []
    for name in known:
        if name not in parts:
            _drop(spark, root, name)
    read = []
    for name, files in parts.items():
        path = f"{root.rstrip('/')}/{name}"
        manifest = Manifest.read(spark, f"{path}.manifest")
        current = manifest is not None and is_complete(spark, path)
        if current and manifest.made_of(files, _COLUMNS, 0):
            continue
        _drop(spark, root, name)
        write_table(partner_summary(raw.read_part(spark, "socios", name)), path)
        Manifest(files, _COLUMNS, 0, Profile(0)).commit(spark, f"{path}.manifest")
        read.append(name)
    return read


def _drop(spark: SparkSession, root: str, name: str) -> None:
    path = f"{root.rstrip('/')}/{name}"
    remove(spark, f"{path}.manifest")
    remove(spark, path)


def merged_summary(spark: SparkSession, root: str) -> DataFrame:
    """One row for each company over the summaries of all files, as ``partner_summary`` of all
    partners gives. A company's partial counts meet, not its partners."""
    paths = [f"{root.rstrip('/')}/{name}" for name in directory_names(spark, root)]
    partial = (
        spark.read.schema(_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], _SCHEMA)
    )
    dates = [field.name for field in PARTNER_SUMMARY if isinstance(field.dataType, T.StringType)]
    counts = [field.name for field in PARTNER_SUMMARY if field.name not in dates]
    return merge_summaries(partial, COMPANY, counts, *dates).select(*_COLUMNS)
