"""Where the tables of one release live, and how to read each of them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.operators.selection import (
    first_of_split_families,
    latest_release,
    select_files,
)
from regweave.schemas import COMPANY, DATASETS, DEFAULT_STATE
from regweave.sources.archives import list_archives, read_zipped
from regweave.sources.delimited import (
    REGISTRY_FORMAT, read_delimited, read_family, read_state_registry,
)
from regweave.sources.manifests import Manifest, RawFiles
from regweave.storage import (
    described_files, directories, directory_names, files, is_complete, qualified, remove,
)


@dataclass(frozen=True)
class RawRelease:
    """Raw files of one release: ``root`` holds its archives or extracted directories.

    ``test_profile`` reads the first file of each split family only.
    """

    root: str
    state_registry: str
    zipped: bool = False
    test_profile: bool = False

    @property
    def profile(self) -> str:
        return "test" if self.test_profile else "full"

    def archives(self, spark: SparkSession, partners: bool = True) -> DataFrame:
        """Rows (archive, name, family) of the archives this release is read from."""
        listed = list_archives(spark, self.root)
        chosen = select_files(listed, "name", partners)
        if self.test_profile:
            chosen = first_of_split_families(chosen, "name").join(listed, "name", "left")
        return chosen.select("archive", "name", "family")

    def inputs(self, spark: SparkSession) -> dict[str, RawFiles]:
        """The raw files of each dataset. Only names pass through the driver."""
        found = {}
        for name, places in self._places(spark).items():
            root = self.state_registry if DATASETS[name].prefix is None else self.root
            found[name] = _described(spark, root, places)
        return found

    def _places(self, spark: SparkSession) -> dict[str, list[str]]:
        """The archives or directories, by dataset and in text order."""
        places: dict[str, list[str]] = {name: [] for name in DATASETS}
        if self.zipped and files(spark, qualified(spark, self.root), "*.zip"):
            for row in self.archives(spark).collect():
                places[row["family"]].append(row["archive"])
        for name, dataset in DATASETS.items():
            if dataset.prefix is None:
                places[name] = [self.state_registry] if self.state_registry else []
            elif not self.zipped:
                own = directories(spark, self.root, dataset.prefix)
                places[name] = own[:1] if self.test_profile and dataset.split else own
        return {name: sorted(own) for name, own in places.items()}

    def parts(self, spark: SparkSession, name: str) -> dict[str, RawFiles]:
        """The raw files of each archive or directory of a dataset, by its name."""
        places = self._places(spark)[name]
        return {place.rsplit("/", 1)[1]: _described(spark, self.root, [place]) for place in places}

    def read_part(self, spark: SparkSession, name: str, part: str) -> DataFrame:
        """The rows of one archive or directory of a dataset."""
        schema = DATASETS[name].schema
        if self.zipped:
            chosen = self.archives(spark).filter(F.col("name") == part)
            return read_zipped(chosen, schema, **REGISTRY_FORMAT)
        return read_delimited(spark, f"{self.root.rstrip('/')}/{part}/*", schema, **REGISTRY_FORMAT)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        dataset = DATASETS[name]
        if dataset.prefix is None:
            return read_state_registry(spark, self.state_registry)
        if self.zipped:
            chosen = self.archives(spark).filter(F.col("family") == name)
            if chosen.isEmpty():
                raise FileNotFoundError(f"no archive of {dataset.prefix} in {self.root}")
            return read_zipped(chosen, dataset.schema, **REGISTRY_FORMAT)
        first_only = self.test_profile and dataset.split
        return read_family(spark, self.root, dataset.prefix, dataset.schema, first_only)


def _described(spark: SparkSession, root: str, places: list[str]) -> RawFiles:
    base = qualified(spark, root).rstrip("/") if root else ""
    return RawFiles(base, tuple(
        (path.removeprefix(base).lstrip("/"), length, time)
        for place in places for path, length, time in described_files(spark, place)
    ))


class _Committed:
    """Tables that are complete with a manifest beside them; ``path`` says where they are."""

    def has(self, spark: SparkSession, name: str) -> bool:
        return is_complete(spark, self.path(name))

    def buckets_of(self, name: str) -> int:
        return 0

    def manifest_path(self, name: str) -> str:
        return f"{self.path(name)}.manifest"

    def manifest(self, spark: SparkSession, name: str) -> Manifest | None:
        return Manifest.read(spark, self.manifest_path(name))

    def current(self, spark: SparkSession, name: str, raw: RawFiles) -> bool:
        """Whether the table is complete and was made of these raw files, in this layout."""
        if not self.has(spark, name):
            return False
        manifest = self.manifest(spark, name)
        if manifest is None:
            return not raw.files and not self.buckets_of(name)
        return manifest.made_of(raw, tuple(DATASETS[name].columns), self.buckets_of(name))

    def remove(self, spark: SparkSession, name: str) -> None:
        """Delete the table, its manifest first."""
        remove(spark, self.manifest_path(name))
        remove(spark, self.path(name))

    def require_profile_of(self, raw: RawRelease | NationalRelease) -> None:
        """Fail if ``raw`` reads another share of the files than these tables hold."""
        if raw.profile != self.profile:
            raise ValueError(
                f"raw files are read with profile {raw.profile!r}, tables are staged as"
                f" {self.profile!r}"
            )


@dataclass(frozen=True)
class NationalRelease(_Committed):
    """Whole tables of one release as parquet, laid out for cutting states from them.

    Establishments are in the order of state and company, and each file holds a narrow range
    of both, so a state is read from its own row groups; the other tables with a company key
    are in its order, with Bloom filters of it. ``plans.jobs.stage_national`` writes them. Takes the
    place of a ``RawRelease``.
    """

    root: str
    release: str
    profile: str = "full"
    zipped = False

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.profile}/{self.release}/national/{name}"

    def inputs(self, spark: SparkSession) -> dict[str, RawFiles]:
        return {name: _described(spark, self.path(name), [self.path(name)]) for name in DATASETS}

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.schema(DATASETS[name].schema).parquet(self.path(name))


@dataclass(frozen=True)
class StagedRelease(_Committed):
    """Location of the staged parquet tables of one release and state.

    The state is part of it, so that runs for two states do not see each other's tables.
    With ``buckets`` the tables that have a company key are laid out in so many buckets by
    it, and joins by company need no shuffle; about 100 MB of the largest table for each is
    a good number. Such tables are known to the session's catalog as external tables.
    """

    root: str
    release: str
    state: str = DEFAULT_STATE
    profile: str = "full"
    buckets: int = 0

    def __post_init__(self) -> None:
        object.__setattr__(self, "state", self.state.upper())

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.profile}/{self.release}/{self.state}/{name}"

    def buckets_of(self, name: str) -> int:
        return self.buckets if COMPANY in DATASETS[name].columns else 0

    def table_name(self, name: str) -> str:
        """The name of a bucketed table in the catalog."""
        return f"regweave_{name}_{hashlib.md5(self.path(name).encode()).hexdigest()}"

    def missing(self, spark: SparkSession, names: list[str]) -> list[str]:
        return [name for name in names if not self.has(spark, name)]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        buckets = self.buckets_of(name)
        if not buckets:
            return spark.read.schema(DATASETS[name].schema).parquet(self.path(name))
        table = self.table_name(name)
        if not spark.catalog.tableExists(table):
            columns = ", ".join(f"`{column}` string" for column in DATASETS[name].columns)
            place = qualified(spark, self.path(name)).replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({COMPANY})"
                f" SORTED BY ({COMPANY}) INTO {buckets} BUCKETS LOCATION '{place}'"
            )
        spark.catalog.refreshTable(table)
        return spark.table(table)


def discover_release(spark: SparkSession, root: str) -> str:
    """The greatest release label among the directories in ``root``; others are ignored."""
    names = [(name,) for name in directory_names(spark, root)]
    listed = spark.createDataFrame(names, "label string")
    return latest_release(listed, "label").first()["label"]


def read_dataset(
    spark: SparkSession, name: str, staged: StagedRelease, raw: RawRelease | None = None
) -> DataFrame:
    """The staged table if it was completely written, else the raw files (unreduced)."""
    if raw is not None:
        staged.require_profile_of(raw)
    if raw is None or staged.has(spark, name):
        return staged.read(spark, name)
    return raw.read(spark, name)
