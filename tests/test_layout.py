"""Whole tables laid out for slices, and partner summaries kept by raw file."""

import gzip
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import registry
from entry_queries import files as entry_files
from regweave.plans import jobs
from regweave.plans.enrich import build_enriched, partner_summary
from regweave.plans.summaries import merged_summary, stage_summaries
from regweave.schemas import COMPANY, DATASETS
from regweave.sinks.tables import write_ordered, write_table
from regweave.sources.datasets import NationalRelease, RawRelease, StagedRelease


@pytest.fixture(params=["extracted", "zipped"])
def raw(request, tmp_path):
    zipped = request.param == "zipped"
    (registry.write_zipped if zipped else registry.write_extracted)(tmp_path / "raw")
    registry.write_state_registry(tmp_path / "registry.csv")
    return RawRelease(str(tmp_path / "raw"), str(tmp_path / "registry.csv"), zipped=zipped)


def scanned_rows(df):
    """Rows that the scan of a plan gives out, after it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(
        leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
    )


@pytest.fixture
def many_files(spark):
    """As many files as shuffle partitions, as with data of more than a few MB."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_a_state_reads_only_its_row_groups(spark, plan, tmp_path, many_files):
    path = str(tmp_path / "t")
    states = F.element_at(F.array(*map(F.lit, ["AC", "BA", "ES", "RJ", "SP", "SP", "SP", "SP"])),
                          (F.col("id") % 8 + 1).cast("int"))
    rows = spark.range(0, 40_000, 1, 8).select(states.alias("uf"), F.hex("id").alias("k"))
    write_ordered(rows.union(spark.createDataFrame([(None, "x")], "uf string, k string")),
                  path, ["uf", "k"], ["k"])
    one = spark.read.parquet(path).filter("uf = 'ES'")
    assert one.count() == 5000 and "EqualTo(uf,ES)" in plan(one)
    assert scanned_rows(one) < 15_000
    # A large state is divided by the next column.
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    sizes = [pq.ParquetFile(f"{path}/{f}").metadata.num_rows for f in files]
    assert len(sizes) >= 6 and max(sizes) < 12_000 and sum(sizes) == 40_001
    key = spark.read.parquet(path).filter("k = '1F4'")
    assert key.count() == 1 and scanned_rows(key) < 40_001  # by statistics or Bloom filter


def test_states_are_staged_from_the_whole_tables(spark, bag, tmp_path, raw):
    national = NationalRelease(str(tmp_path / "national"), "2026-01")
    assert sorted(jobs.stage_national(spark, raw, national)) == sorted(DATASETS)
    assert jobs.stage_national(spark, raw, national) == []
    counts = {name: national.read(spark, name).count() for name in DATASETS}
    assert counts == {name: len(rows) for name, rows in registry.ROWS.items()}
    for state in ("ES", "SP"):
        direct = StagedRelease(str(tmp_path / "direct"), "2026-01", state)
        staged = StagedRelease(str(tmp_path / "staged"), "2026-01", state)
        jobs.stage(spark, raw, direct)
        assert sorted(jobs.stage(spark, national, staged)) == sorted(DATASETS)
        assert jobs.stage(spark, national, staged) == []
        for name in DATASETS:
            assert bag(staged.read(spark, name)) == bag(direct.read(spark, name))
    written = jobs.build(spark, staged, str(tmp_path / "out"), national)
    assert bag(spark.read.parquet(written[0])) == bag(build_enriched(registry.frames(spark), "SP"))


def test_states_cut_from_the_whole_tables_move_no_whole_rows(spark, plan, tmp_path, monkeypatch):
    registry.write_extracted(tmp_path / "raw")
    registry.write_state_registry(tmp_path / "registry.csv")
    raw = RawRelease(str(tmp_path / "raw"), str(tmp_path / "registry.csv"))
    national = NationalRelease(str(tmp_path / "national"), "2026-01")
    jobs.stage_national(spark, raw, national)
    plans = {}

    def spy(df, path):
        plans[os.path.basename(path)] = plan(df)
        write_table(df, path)

    monkeypatch.setattr(jobs, "write_table", spy)
    jobs.stage(spark, national, StagedRelease(str(tmp_path / "staged"), "2026-01", "ES"))
    whole = ("estabelecimentos", "jucees", "cnaes", "naturezas")
    assert [name for name in whole if "Exchange" in plans[name]] == []
    # Splits of raw text hold a few rows of the state each: those are still brought together.
    jobs.stage(spark, raw, StagedRelease(str(tmp_path / "direct"), "2026-01", "ES"))
    assert "Exchange" in plans["estabelecimentos"]


def test_raw_releases_are_short_compressed_files(spark, bag, tmp_path, monkeypatch):
    monkeypatch.setattr(entry_files, "registry_tables", lambda *_: registry.frames(spark))
    monkeypatch.setitem(entry_files._RELEASE_FILES, "maxRecordsPerFile", "2")
    raw = entry_files._write_raw_release(spark, "", str(tmp_path / "raw"))
    parts = [path for path in (tmp_path / "raw").rglob("part-*") if path.is_file()]
    assert {path.suffix for path in parts} == {".gz"}
    sizes = {path: gzip.open(path).read().count(b"\n") for path in parts}
    assert max(sizes.values()) <= 3  # two records and, in the state registry, a header
    for name, frame in registry.frames(spark).items():
        assert bag(raw.read(spark, name)) == bag(frame)


def test_replaced_raw_files_reach_the_states(spark, tmp_path):
    registry.write_extracted(tmp_path / "raw")
    registry.write_state_registry(tmp_path / "registry.csv")
    raw = RawRelease(str(tmp_path / "raw"), str(tmp_path / "registry.csv"))
    national = NationalRelease(str(tmp_path / "national"), "2026-01")
    staged = StagedRelease(str(tmp_path / "staged"), "2026-01", "ES")
    jobs.stage_national(spark, raw, national)
    jobs.stage(spark, national, staged)
    path = tmp_path / "raw" / "Simples" / "DATA.CSV"
    path.write_bytes(path.read_bytes() + b'"12345678";"N"\n')
    assert jobs.stage_national(spark, raw, national) == ["simples"]
    assert jobs.stage(spark, national, staged) == ["simples"]
    assert staged.read(spark, "simples").count() == 5
    with pytest.raises(ValueError, match="profile"):
        jobs.stage_national(spark, raw, NationalRelease(str(tmp_path), "2026-01", "test"))


def test_summaries_of_files_add_up(spark, bag, tmp_path, raw):
    root = str(tmp_path / "summaries")
    want = bag(partner_summary(registry.frames(spark)["socios"]))
    names = ["Socios0.zip", "Socios1.zip"] if raw.zipped else ["Socios0", "Socios1"]
    assert stage_summaries(spark, raw, root) == names
    merged = merged_summary(spark, root)
    assert merged.columns[0] == COMPANY and bag(merged) == want
    assert stage_summaries(spark, raw, root) == []


def test_a_replaced_partner_file_is_the_only_one_read(spark, bag, tmp_path, monkeypatch):
    registry.write_extracted(tmp_path / "raw")
    raw = RawRelease(str(tmp_path / "raw"), "")
    for number in range(2, 10):
        (tmp_path / "raw" / f"Socios{number}").mkdir()
        text = f'"{number:08d}";"1";;;;"2020010{number}"\n"12345678";"2";;;;"19990101"\n'
        (tmp_path / "raw" / f"Socios{number}" / "DATA.CSV").write_text(text)
    root = str(tmp_path / "summaries")
    assert len(stage_summaries(spark, raw, root)) == 10
    (tmp_path / "raw" / "Socios4" / "DATA.CSV").write_text('"12345678";"3";;;;"18880101"\n')
    assert stage_summaries(spark, raw, root) == ["Socios4"]
    assert bag(merged_summary(spark, root)) == bag(partner_summary(raw.read(spark, "socios")))
    # A summary without its manifest was not finished; that of a file that is gone goes.
    os.remove(f"{root}/Socios5.manifest")
    (tmp_path / "raw" / "Socios6" / "DATA.CSV").unlink()
    (tmp_path / "raw" / "Socios6").rmdir()
    assert stage_summaries(spark, raw, root) == ["Socios5"]
    assert not os.path.exists(f"{root}/Socios6") and not os.path.exists(f"{root}/Socios6.manifest")
    assert bag(merged_summary(spark, root)) == bag(partner_summary(raw.read(spark, "socios")))


def test_no_partner_files(spark, tmp_path):
    raw = RawRelease(str(tmp_path), "")
    assert stage_summaries(spark, raw, str(tmp_path / "none")) == []
    os.makedirs(tmp_path / "none", exist_ok=True)
    assert merged_summary(spark, str(tmp_path / "none")).collect() == []
