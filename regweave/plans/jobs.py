"""Staging, building and validating one release for one state.

Call these from your own Spark application. They use the session they are given, change
none of its settings and never stop it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.functions import digits_only
from regweave.operators.joins import Right, measure, semi_join
from regweave.operators.profiles import Observed, Profile
from regweave.operators.quality import PROBE_ROWS, EmptySliceError, duplicate_keys
from regweave.operators.relational import distinct_keys, probe_count, slice_equal
from regweave.plans.enrich import (
    build_enriched, build_partners, join_keys, required_datasets,
)
from regweave.schemas import COMPANY, DATASETS, DEFAULT_STATE
from regweave.sinks.tables import (
    export_single_csv, write_bucketed, write_ordered, write_table,
)
from regweave.sources.archives import audit_archives
from regweave.sources.manifests import Manifest, RawFiles
from regweave.sources.datasets import (
    NationalRelease,
    RawRelease,
    StagedRelease,
    discover_release,
    read_dataset,
)
from regweave.storage import is_complete

#: Tables that hold only what belongs to the staged establishments.
SLICED = ("keys_cnpj_basico", "keys_municipio", "empresas", "simples", "socios", "municipios")


@contextmanager
def cached(*frames: DataFrame) -> Iterator[None]:
    """Keep ``frames`` for the length of a block and always release them."""
    for frame in frames:
        frame.persist()
    try:
        yield
    finally:
        for frame in frames:
            frame.unpersist()


def run_together(spark: SparkSession, job: Callable[[str], None], names: list[str]) -> None:
    """Submit one independent Spark job per name, so that the tail of one table's job
    leaves no cores idle. The first failure is raised once all of them have ended."""
    with ThreadPoolExecutor(len(names)) as pool:
        submit = inheritable_thread_target(spark)
        for future in [pool.submit(submit(job), name) for name in names]:
            future.result()


def stage(
    spark: SparkSession,
    raw: RawRelease | NationalRelease,
    staged: StagedRelease,
    partners: bool = True,
) -> list[str]:
    """Write the staged tables that are missing or out of date, and return their names.

    A table is up to date if its manifest names the raw files that are there now. Raw files
    that were replaced under the same label are staged again, those that are gone are not
    missed. The manifest is committed after the table and holds the profile that later joins
    are planned with (``regweave.operators.profiles``).

    Establishments are cut to the state and written first, then the two key tables that
    reduce the other datasets. Those are read from finished parquet tables, so a lost
    executor costs a re-read of narrow columns, and no wide rows have to be cached.

    Key tables and reduced tables belong to one slice. Where the slice has to be cut, those
    of an older one are removed first, so at no time, not after a crash either, is a table
    complete that does not belong to the complete slice beside it.
    """
    staged.require_profile_of(raw)
    inputs = raw.inputs(spark)
    if not staged.current(spark, "estabelecimentos", inputs["estabelecimentos"]):
        for name in ("estabelecimentos", *SLICED):
            staged.remove(spark, name)
    missing = [
        name for name in required_datasets(partners)
        if not staged.current(spark, name, inputs[name])
    ]
    for name in missing:
        staged.remove(spark, name)
    if "estabelecimentos" in missing:
        cut = slice_equal(raw.read(spark, "estabelecimentos"), "uf", staged.state)
        # In whole tables a state's rows lie together, in few files and not in every split.
        even = isinstance(raw, NationalRelease)
        _write_staged(spark, cut, staged, "estabelecimentos", inputs["estabelecimentos"], even)
    others = [name for name in missing if name != "estabelecimentos"]
    if others:
        _stage_reduced(spark, raw, staged, others, inputs)
    return missing


def stage_national(
    spark: SparkSession, raw: RawRelease, national: NationalRelease, partners: bool = True
) -> list[str]:
    """Write the whole tables of a release that are missing or out of date, and return their
    names. States are then staged from ``national`` in place of the raw release, each by a
    scan of its own row groups instead of all raw text."""
    national.require_profile_of(raw)
    inputs = raw.inputs(spark)
    missing = [
        name for name in required_datasets(partners)
        if not national.current(spark, name, inputs[name])
    ]

    def write(name: str) -> None:
        national.remove(spark, name)
        columns = DATASETS[name].columns
        order = [column for column in ("uf", COMPANY, "cnpj_ordem") if column in columns]
        path, keys = national.path(name), [COMPANY] if COMPANY in columns else []
        if order:
            write_ordered(raw.read(spark, name), path, order, keys)
        else:
            write_table(raw.read(spark, name), path)
        manifest = Manifest(inputs[name], tuple(columns), 0, Profile(0))
        manifest.commit(spark, national.manifest_path(name))

    if missing:
        run_together(spark, write, missing)
    return missing


def _write_staged(
    spark: SparkSession, df: DataFrame, staged: StagedRelease, name: str, files: RawFiles,
    even: bool = False,
) -> None:
    """The table, profiled as it is written, and then its manifest. ``even`` says that its
    partitions make no small files; otherwise all rows are moved once to even them out."""
    path, buckets = staged.path(name), staged.buckets_of(name)
    if buckets:
        df = df.repartition(buckets, COMPANY)
    elif not even:
        df = df.hint("rebalance")
    observed = Observed(df, join_keys(name))
    if buckets:
        write_bucketed(observed.df, path, COMPANY, buckets, staged.table_name(name))
    else:
        write_table(observed.df, path)
    manifest = Manifest(files, tuple(DATASETS[name].columns), buckets, observed.profile())
    manifest.commit(spark, staged.manifest_path(name))


def _stage_reduced(
    spark: SparkSession, raw: RawRelease, staged: StagedRelease, names: list[str],
    inputs: dict[str, RawFiles],
) -> None:
    sliced = spark.read.parquet(staged.path("estabelecimentos"))

    def keys(column: str) -> Right:
        path = staged.path(f"keys_{column}")
        if not is_complete(spark, path):
            write_table(distinct_keys(sliced, column), path)
        return Right(spark.read.schema(sliced.select(column).schema).parquet(path), unique=True)

    companies, towns = keys(COMPANY), keys("municipio")

    def reduced(name: str) -> DataFrame:
        table = raw.read(spark, name)
        # Finding hot keys first would parse the raw text once more. A lone join between
        # two plain scans is one that adaptive execution splits by itself.
        if COMPANY in table.columns:
            return semi_join(table, COMPANY, companies, spread=False, prefilter=True)
        if name == "municipios":
            return semi_join(table, "codigo", towns, "municipio", spread=False)
        return table

    def write(name: str) -> None:
        # A whole table that is parquet already is copied as it lies.
        even = isinstance(raw, NationalRelease) and name not in SLICED
        _write_staged(spark, reduced(name), staged, name, inputs[name], even)

    with cached(companies.df, towns.df):
        measure([companies, towns])
        run_together(spark, write, names)


def tables(
    spark: SparkSession,
    staged: StagedRelease,
    raw: RawRelease | None = None,
    partners: bool = True,
) -> dict[str, DataFrame]:
    """The datasets of a release, staged where possible."""
    return {name: read_dataset(spark, name, staged, raw) for name in required_datasets(partners)}


def profiles(
    spark: SparkSession, staged: StagedRelease, partners: bool = True
) -> dict[str, Profile]:
    """The profiles of the staged tables that have a manifest."""
    found = {name: staged.manifest(spark, name) for name in required_datasets(partners)}
    return {name: manifest.profile for name, manifest in found.items() if manifest is not None}


def build(
    spark: SparkSession,
    staged: StagedRelease,
    output: str,
    raw: RawRelease | None = None,
    partners: bool = True,
    single_csv: bool = False,
) -> list[str]:
    """Stage what is missing (given ``raw``), then write the enriched and partners tables.

    ``single_csv`` adds one CSV file per table, read from the finished table so that
    nothing is computed twice. Returns the paths written.
    """
    if raw is not None:
        stage(spark, raw, staged, partners)
    inputs = tables(spark, staged, partners=partners)
    # Staged partners are already those of the slice.
    enriched = build_enriched(
        inputs, staged.state, partners, reduced=True, profiles=profiles(spark, staged, partners),
        colocated=staged.buckets > 0,
    )
    results = {"enriched": enriched}
    if partners:
        results["partners"] = build_partners(inputs, staged.state, reduced=True)

    def write(name: str) -> None:
        df, path = results[name], f"{output.rstrip('/')}/{name}"
        write_table(df, path)
        if single_csv:
            export_single_csv(spark.read.schema(df.schema).parquet(path), f"{path}.csv")

    run_together(spark, write, list(results))
    suffixes = ["", ".csv"] if single_csv else [""]
    return [f"{output.rstrip('/')}/{name}{suffix}" for name in results for suffix in suffixes]


def audit(spark: SparkSession, raw: RawRelease) -> None:
    """Fail if an archive of a zipped release is damaged."""
    if raw.zipped:
        damaged = audit_archives(raw.archives(spark)).filter(~F.col("ok"))
        first = damaged.orderBy("archive").first()
        if first is not None:
            raise RuntimeError(f"damaged archive {first.archive}, entry {first.bad_entry}")


def validate(
    spark: SparkSession,
    staged: StagedRelease,
    raw: RawRelease | None = None,
    bound: int = PROBE_ROWS,
) -> DataFrame:
    """One-row report of a release; fails on damaged archives and on an empty slice.

    ``slice_rows`` and ``company_rows`` are counted up to ``bound``. ``repeated_keys`` is the
    number of right-hand keys that multiply rows; ``duplicate_report`` lists them.
    """
    if raw is not None:
        audit(spark, raw)
    found = tables(spark, staged, raw, partners=False)
    sliced = slice_equal(found["estabelecimentos"], "uf", staged.state)
    rows = probe_count(sliced, bound)
    if rows == 0:
        raise EmptySliceError(f"no establishments for state {staged.state}")
    counts = (
        rows, probe_count(found["empresas"], bound), found["cnaes"].count(),
        duplicate_report(found).count(),
    )
    return spark.createDataFrame(
        [counts], "slice_rows long, company_rows long, activity_rows long, repeated_keys long"
    )


def duplicate_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows (dataset, key, copies): right-hand keys that multiply establishment rows."""
    right_hand = ("empresas", "simples", "cnaes", "naturezas", "municipios", "jucees")
    reports = []
    for name in right_hand:
        (key,) = DATASETS[name].key
        # A registry number without a digit matches nothing.
        value = F.nullif(digits_only(key), F.lit("")) if name == "jucees" else F.col(key)
        repeated = duplicate_keys(tables[name].select(value.alias("key")), "key")
        reports.append(repeated.select(F.lit(name).alias("dataset"), "key", "copies"))
    return reduce(DataFrame.unionByName, reports)


def run_all(
    spark: SparkSession,
    raw: RawRelease,
    staged: StagedRelease,
    output: str,
    single_csv: bool = False,
) -> list[str]:
    """Audit, stage, validate and build, partners included."""
    staged.require_profile_of(raw)
    audit(spark, raw)
    stage(spark, raw, staged)
    validate(spark, staged)
    return build(spark, staged, output, single_csv=single_csv)


def run_latest(
    spark: SparkSession,
    releases: str,
    state_registry: str,
    staged_root: str,
    output: str,
    state: str = DEFAULT_STATE,
    zipped: bool = True,
    test_profile: bool = False,
    single_csv: bool = False,
) -> list[str]:
    """``run_all`` for the newest release folder in ``releases``; results in its subfolder."""
    label = discover_release(spark, releases)
    raw = RawRelease(f"{releases.rstrip('/')}/{label}", state_registry, zipped, test_profile)
    staged = StagedRelease(staged_root, label, state, raw.profile)
    return run_all(spark, raw, staged, f"{output.rstrip('/')}/{label}", single_csv)
