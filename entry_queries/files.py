"""Sources, sinks and staging: each query writes its tables out and reads them back.

Everything is derived from the whole driver tables and written to the scratch folder the
session names (see ``regweave.storage.scratch_directory``).
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entry_queries.enriched import STATE, enriched_sql
from entry_queries.tables import registry_ctes, registry_tables, table
from regweave.plans.jobs import build, run_together, stage, stage_national
from regweave.plans.summaries import merged_summary, stage_summaries
from regweave.schemas import DATASETS, ENRICHED_SCHEMA, text_schema
from regweave.sinks.tables import export_csv, export_single_csv, write_table, write_table_once
from regweave.sources.archives import audit_archives, list_archives, read_zipped, storage_of
from regweave.sources.datasets import (
    NationalRelease, RawRelease, StagedRelease, discover_release, read_dataset,
)
from regweave.sources.delimited import read_delimited, read_family, read_state_registry
from regweave.storage import (
    directory_names,
    make_directory,
    remove,
    scratch_directory,
    write_bytes,
)

_RAW_OPTIONS = {
    "sep": ";", "encoding": "ISO-8859-1", "quoteAll": "true", "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
# Published releases are compressed. A compressed file is read by one task, so it is kept short.
_RELEASE_FILES = {"compression": "gzip", "maxRecordsPerFile": "250000"}
_LINE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "note"]


def csv_roundtrip(spark, sf_dir):
    source = table(spark, sf_dir, "lineitem")
    path = scratch_directory(spark, "csv")
    export_csv(source, path)
    return read_delimited(spark, path, source.schema, ",", "UTF-8", header=True)


def csv_text_roundtrip(spark, sf_dir):
    source = table(spark, sf_dir, "documents")
    path = scratch_directory(spark, "csv-text")
    export_csv(source, path)
    return read_delimited(spark, path, source.schema, ",", "UTF-8", header=True, multi_line=True)


def parquet_roundtrip(spark, sf_dir):
    source = table(spark, sf_dir, "orders")
    path = scratch_directory(spark, "parquet")
    write_table_once(spark, lambda: source, path)
    return spark.read.schema(source.schema).parquet(path)


def single_csv_export(spark, sf_dir):
    summary = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderpriority").alias("last_priority"))
    )
    target = f"{scratch_directory(spark, 'single-csv')}/summary.csv"
    export_single_csv(summary, target)
    return read_delimited(spark, target, summary.schema, ",", "UTF-8", header=True)


def _write_raw_release(spark: SparkSession, sf_dir: str, root: str) -> RawRelease:
    """Raw files shaped like the publisher's: families cut into numbered directories."""
    found = registry_tables(spark, sf_dir)
    options = _RAW_OPTIONS | _RELEASE_FILES

    def write(name: str) -> None:
        df, dataset = found[name], DATASETS[name]
        if dataset.prefix is None:
            files = df.write.option("header", "true").option("escape", '"')
            files.options(**_RELEASE_FILES).csv(f"{root}/{name}")
        elif dataset.split:
            lower = F.xxhash64("cnpj_basico") < 0
            for number, share in enumerate((df.filter(lower), df.filter(~lower))):
                share.write.options(**options).csv(f"{root}/{dataset.prefix}{number}")
        else:
            df.write.options(**options).csv(f"{root}/{dataset.prefix}")

    run_together(spark, write, list(found))
    return RawRelease(root=root, state_registry=f"{root}/jucees")


def family_scan(spark, sf_dir):
    root = scratch_directory(spark, "family")
    partners = registry_tables(spark, sf_dir)["socios"]
    odd = F.coalesce(F.col("identificador_socio") == "1", F.lit(False))
    for number, share in enumerate((partners.filter(odd), partners.filter(~odd))):
        share.write.options(**_RAW_OPTIONS).csv(f"{root}/Socios{number}")
    return read_family(spark, root, "Socios", DATASETS["socios"].schema)


def state_registry_scan(spark, sf_dir):
    path = scratch_directory(spark, "state-registry")
    registry = registry_tables(spark, sf_dir)["jucees"]
    # The header in the file says something else; names are taken by position.
    other_names = registry.toDF(*[f"coluna_{i}" for i in range(len(registry.columns))])
    other_names.write.option("header", "true").option("escape", '"').csv(path)
    return read_state_registry(spark, path)


def parquet_first_scan(spark, sf_dir):
    """One dataset is staged, the other is only there as raw text."""
    root = scratch_directory(spark, "parquet-first")
    staged = StagedRelease(f"{root}/staged", "2026-01", STATE)
    raw = RawRelease(root=f"{root}/raw", state_registry="")
    found = registry_tables(spark, sf_dir)
    write_table(found["simples"], staged.path("simples"))
    found["empresas"].write.options(**_RAW_OPTIONS).csv(f"{root}/raw/Empresas0")
    return read_dataset(spark, "simples", staged, raw).join(
        read_dataset(spark, "empresas", staged, raw), "cnpj_basico"
    )


def _stage(
    spark: SparkSession, sf_dir: str, purpose: str, buckets: int = 0
) -> tuple[StagedRelease, str]:
    root = scratch_directory(spark, purpose)
    raw = _write_raw_release(spark, sf_dir, f"{root}/raw")
    staged = StagedRelease(f"{root}/staged", "2026-01", STATE, buckets=buckets)
    stage(spark, raw, staged)
    return staged, root


def _count_tables(spark: SparkSession, staged: StagedRelease) -> DataFrame:
    counts = [
        staged.read(spark, name).agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n_rows"))
        for name in DATASETS
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def staged_slice(spark, sf_dir):
    return _count_tables(spark, _stage(spark, sf_dir, "stage")[0])


def restaged_slice(spark, sf_dir):
    """A slice staged from a part of the establishments, then cut again from all of them."""
    root = scratch_directory(spark, "restage")
    raw = _write_raw_release(spark, sf_dir, f"{root}/raw")
    part = RawRelease(f"{root}/part", raw.state_registry)
    for name, dataset in DATASETS.items():
        if dataset.prefix is not None:
            rows = raw.read(spark, name)
            few = rows.filter("cnpj_ordem like '%7'") if name == "estabelecimentos" else rows
            few.write.options(**_RAW_OPTIONS, **_RELEASE_FILES).csv(f"{root}/part/{dataset.prefix}")
    staged = StagedRelease(f"{root}/staged", "2026-01", STATE)
    stage(spark, part, staged)
    remove(spark, staged.path("estabelecimentos"))
    stage(spark, raw, staged)
    return _count_tables(spark, staged)


def replaced_release(spark, sf_dir):
    """Files of one family replaced under the same release label: that family is staged again."""
    root = scratch_directory(spark, "replace")
    raw = _write_raw_release(spark, sf_dir, f"{root}/raw")
    companies = registry_tables(spark, sf_dir)["empresas"].filter(F.xxhash64("cnpj_basico") < 0)
    staged = StagedRelease(f"{root}/staged", "2026-01", STATE)

    def publish(df: DataFrame) -> list[str]:
        df.write.mode("overwrite").options(**_RAW_OPTIONS).csv(f"{root}/raw/Empresas0")
        return stage(spark, raw, staged)

    publish(companies.filter("cnpj_basico like '%7'"))
    again = publish(companies)
    if again != ["empresas"]:
        raise RuntimeError(f"staged again: {again}")
    return _count_tables(spark, staged)


def colocated_enriched_base(spark, sf_dir):
    """Staged in buckets by company, so that the joins by company move nothing."""
    staged, root = _stage(spark, sf_dir, "colocated", buckets=8)
    build(spark, staged, f"{root}/output")
    return spark.read.schema(ENRICHED_SCHEMA).parquet(f"{root}/output/enriched")


def national_slice(spark, sf_dir):
    """One state after another, cut from whole tables in the order of the states."""
    root = scratch_directory(spark, "national")
    raw = _write_raw_release(spark, sf_dir, f"{root}/raw")
    national = NationalRelease(f"{root}/national", "2026-01")
    stage_national(spark, raw, national)
    for state in ("SP", STATE):
        staged = StagedRelease(f"{root}/staged", "2026-01", state)
        stage(spark, national, staged)
    return _count_tables(spark, staged)


def summaries_by_file(spark, sf_dir):
    """Partner summaries of raw files, one of which is replaced, merged."""
    root = scratch_directory(spark, "summaries")
    raw = RawRelease(f"{root}/raw", "")
    partners = registry_tables(spark, sf_dir)["socios"]
    lower = F.xxhash64("cpf_cnpj_socio") < 0

    def publish(number: int, df: DataFrame) -> None:
        df.write.mode("overwrite").options(**_RAW_OPTIONS).csv(f"{root}/raw/Socios{number}")

    publish(0, partners.filter(lower))
    publish(1, partners.filter(~lower).filter("faixa_etaria = '1'"))
    stage_summaries(spark, raw, f"{root}/summaries")
    publish(1, partners.filter(~lower))
    again = stage_summaries(spark, raw, f"{root}/summaries")
    if again != ["Socios1"]:
        raise RuntimeError(f"summarised again: {again}")
    return merged_summary(spark, f"{root}/summaries")


def staged_enriched_base(spark, sf_dir):
    staged, root = _stage(spark, sf_dir, "build")
    build(spark, staged, f"{root}/output")
    return spark.read.schema(ENRICHED_SCHEMA).parquet(f"{root}/output/enriched")


def enriched_csv_of_build(spark, sf_dir):
    """The single CSV file that a build adds on request, as a reader gets it."""
    staged, root = _stage(spark, sf_dir, "csv-build")
    build(spark, staged, f"{root}/output", single_csv=True)
    path = f"{root}/output/enriched.csv"
    return read_delimited(spark, path, ENRICHED_SCHEMA, ",", "UTF-8", header=True)


def latest_folder(spark, sf_dir):
    """The newest of one release folder per month with orders, and of other folders."""
    root = scratch_directory(spark, "releases")
    month = F.date_format("o_orderdate", "yyyy-MM")
    label = F.when(F.col("o_orderstatus") == "P", F.lit("tmp")).otherwise(month).alias("label")
    orders = table(spark, sf_dir, "orders").select(label, "o_orderkey")
    orders.repartition("label").write.partitionBy("label").csv(f"{root}/by")
    names = [name.removeprefix("label=") for name in directory_names(spark, f"{root}/by")]
    for name in names:
        make_directory(spark, f"{root}/releases/{name}")
    newest = discover_release(spark, f"{root}/releases")
    return spark.createDataFrame([(newest,)], "label string")


def _zip_writer(directory: str):
    """Writes archives from lines sorted by archive and entry, each line as it comes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for number, lines in groupby(_rows(batches), key=itemgetter(0)):
            name, written = f"Pedidos{number}", 0
            system, target = storage_of(f"{directory}/{name}.zip")
            system.create_dir(target.rsplit("/", 1)[0], recursive=True)
            with (
                system.open_output_stream(f"{target}.{attempt}") as sink,
                zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive,
            ):
                for entry, own in groupby(lines, key=itemgetter(1)):
                    with archive.open(f"{name}-{entry}.csv", "w", force_zip64=True) as out:
                        for _, _, line in own:
                            out.write(f"{line}\n".encode("ISO-8859-1"))
                            written += 1
            # A task that runs twice replaces its archive with the same content.
            system.move(f"{target}.{attempt}", target)
            yield pa.RecordBatch.from_pydict({"archive": [f"{name}.zip"], "n_rows": [written]})

    return write


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(name).to_pylist() for name in ("archive", "entry", "line")])


_LEAST_ARCHIVES, _ARCHIVE_ROWS, _ENTRIES = 16, 20_000, 4
_ORDER_LINE = "concat(o_orderkey, ';', o_custkey, ';', o_orderstatus, ';\"', o_orderpriority, ' \"\"é\"\"; ã\"')"


def _write_archives(spark: SparkSession, sf_dir: str) -> str:
    """The orders as zipped text: by order number in archives of about ``_ARCHIVE_ROWS`` rows,
    by customer in entries."""
    root = scratch_directory(spark, "archives")
    orders = table(spark, sf_dir, "orders")
    archives = max(_LEAST_ARCHIVES, -(-orders.count() // _ARCHIVE_ROWS))
    lines = orders.selectExpr(
        f"o_orderkey % {archives} as archive", f"o_custkey % {_ENTRIES} as entry",
        f"{_ORDER_LINE} as line",
    )
    written = lines.repartition("archive").sortWithinPartitions("archive", "entry").mapInArrow(
        _zip_writer(root), "archive string, n_rows long"
    )
    written.write.format("noop").mode("overwrite").save()
    return root


def zip_scan(spark, sf_dir):
    archives = list_archives(spark, _write_archives(spark, sf_dir))
    return read_zipped(archives, text_schema(_LINE_COLUMNS))


def zip_audit(spark, sf_dir):
    """One row per archive; the first ones are made unreadable before the audit."""
    root = _write_archives(spark, sf_dir)
    for name in ("Pedidos0.zip", "Pedidos1.zip"):
        write_bytes(spark, f"{root}/{name}", b"cut off")
    archives = list_archives(spark, root)
    report = audit_archives(archives).join(archives, "archive")
    return report.select("name", "n_entries", "n_bytes", "bad_entry", "ok")


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "csv_text_roundtrip": csv_text_roundtrip,
    "csv_family_scan": family_scan,
    "csv_state_registry_scan": state_registry_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "parquet_first_scan": parquet_first_scan,
    "single_csv_export": single_csv_export,
    "zip_scan": zip_scan,
    "zip_audit": zip_audit,
    "staged_slice": staged_slice,
    "restaged_slice": restaged_slice,
    "replaced_release": replaced_release,
    "colocated_enriched_base": colocated_enriched_base,
    "national_slice": national_slice,
    "summaries_by_file": summaries_by_file,
    "staged_enriched_base": staged_enriched_base,
    "enriched_csv_of_build": enriched_csv_of_build,
    "latest_folder": latest_folder,
}

_KEPT = "(select cnpj_basico from estabelecimentos where uf = 'ES')"
_STAGED = {
    "estabelecimentos": "where uf = 'ES'",
    "empresas": f"where cnpj_basico in {_KEPT}",
    "simples": f"where cnpj_basico in {_KEPT}",
    "socios": f"where cnpj_basico in {_KEPT}",
    "municipios": "where codigo in (select municipio from estabelecimentos where uf = 'ES')",
    "cnaes": "",
    "naturezas": "",
    "jucees": "",
}

ORACLES = {
    "csv_roundtrip": "select * from lineitem",
    "csv_text_roundtrip": "select * from documents",
    "csv_family_scan": f"with {registry_ctes()} select * from socios",
    "csv_state_registry_scan": f"with {registry_ctes()} select * from jucees",
    "parquet_roundtrip": "select * from orders",
    "parquet_first_scan": f"""
        with {registry_ctes()}
        select s.*, e.* exclude (cnpj_basico) from simples s join empresas e on s.cnpj_basico = e.cnpj_basico""",
    "single_csv_export": """
        select o_custkey, count(*) as n_orders, max(o_orderpriority) as last_priority
        from orders group by o_custkey""",
    "zip_scan": """
        select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
               o_orderstatus, o_orderpriority || ' "é"; ã' as note from orders""",
    "zip_audit": f"""
        select 'Pedidos' || cast(number as varchar) || '.zip' as name,
               case when number > 1 then count(distinct o_custkey % {_ENTRIES}) end as n_entries,
               case when number > 1
                 then cast(sum(length(cast(o_orderkey as varchar)) + length(cast(o_custkey as varchar))
                   + length(o_orderstatus) + length(o_orderpriority) + 15) as bigint) end as n_bytes,
               cast(null as varchar) as bad_entry, number > 1 as ok
        from (select *, o_orderkey % (select greatest({_LEAST_ARCHIVES},
            (count(*) + {_ARCHIVE_ROWS - 1}) // {_ARCHIVE_ROWS}) from orders) as number from orders)
        group by number""",
    "staged_slice": f"with {registry_ctes()}\n" + "\nunion all\n".join(
        f"select '{name}' as dataset, count(*) as n_rows from {name} {condition}"
        for name, condition in _STAGED.items()
    ),
    "summaries_by_file": f"""
        with {registry_ctes()}
        select cnpj_basico, count(*) as qtd_socios,
            count(*) filter (where identificador_socio = '1') as qtd_socios_pessoa_juridica,
            count(*) filter (where identificador_socio = '2') as qtd_socios_pessoa_fisica,
            count(*) filter (where identificador_socio = '3') as qtd_socios_estrangeiro,
            min(data_entrada_sociedade) as primeira_data_entrada_sociedade,
            max(data_entrada_sociedade) as ultima_data_entrada_sociedade
        from socios group by cnpj_basico""",
    "staged_enriched_base": enriched_sql(),
    "colocated_enriched_base": enriched_sql(),
    # An empty text comes back from a CSV file as NULL; the tables hold none.
    "enriched_csv_of_build": enriched_sql(),
    "latest_folder": """
        select max(strftime(o_orderdate, '%Y-%m')) as label from orders where o_orderstatus <> 'P'""",
}
for _name in ("restaged_slice", "replaced_release", "national_slice"):
    ORACLES[_name] = ORACLES["staged_slice"]
