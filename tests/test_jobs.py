import os

import pytest

import registry
from regweave.operators.quality import EmptySliceError
from regweave.plans import jobs
from regweave.plans.enrich import build_enriched
from regweave.schemas import DATASETS
from regweave.sources.datasets import RawRelease, StagedRelease, read_dataset
from regweave.sources.delimited import read_delimited

STAGED_ROWS = {
    "estabelecimentos": 4, "empresas": 2, "simples": 4, "socios": 5, "municipios": 1, "cnaes": 1,
    "naturezas": 1, "jucees": 3,
}


@pytest.fixture(params=["extracted", "zipped"])
def raw(request, tmp_path):
    root = tmp_path / "raw"
    zipped = request.param == "zipped"
    (registry.write_zipped if zipped else registry.write_extracted)(root)
    registry.write_state_registry(tmp_path / "registry.csv")
    return RawRelease(str(root), str(tmp_path / "registry.csv"), zipped=zipped)


@pytest.fixture
def extracted(tmp_path):
    registry.write_extracted(tmp_path / "raw")
    registry.write_state_registry(tmp_path / "registry.csv")
    return RawRelease(str(tmp_path / "raw"), str(tmp_path / "registry.csv"))


def staged_at(tmp_path, state="ES", profile="full"):
    return StagedRelease(str(tmp_path / "staged"), "2026-01", state, profile)


def times(staged):
    return {
        name: os.stat(f"{staged.path(name)}/_SUCCESS").st_mtime_ns
        for name in DATASETS if os.path.exists(f"{staged.path(name)}/_SUCCESS")
    }


def test_stage_then_build_equals_building_from_the_tables(spark, bag, tmp_path, raw):
    staged = staged_at(tmp_path)
    assert sorted(jobs.stage(spark, raw, staged)) == sorted(DATASETS)
    counts = {name: staged.read(spark, name).count() for name in DATASETS}
    assert counts == STAGED_ROWS

    before = times(staged)
    assert jobs.stage(spark, raw, staged) == []
    assert times(staged) == before

    written = jobs.build(spark, staged, str(tmp_path / "out"), single_csv=True)
    assert [os.path.basename(path) for path in written] == [
        "enriched", "enriched.csv", "partners", "partners.csv"
    ]
    want = bag(build_enriched(registry.frames(spark), "ES"))
    assert bag(spark.read.parquet(written[0])) == want
    schema = spark.read.parquet(written[0]).schema
    assert bag(read_delimited(spark, written[1], schema, ",", "UTF-8", header=True)) == want
    assert spark.read.parquet(written[2]).count() == 5


def test_shuffled_staging_gives_the_same(spark, tmp_path, extracted, no_broadcast):
    staged = staged_at(tmp_path)
    jobs.stage(spark, extracted, staged)
    assert {name: staged.read(spark, name).count() for name in DATASETS} == STAGED_ROWS


def test_states_do_not_mix_and_half_written_tables_are_rebuilt(spark, tmp_path, extracted):
    es, sp = staged_at(tmp_path, "ES"), staged_at(tmp_path, "SP")
    jobs.stage(spark, extracted, es, partners=False)
    assert not es.has(spark, "socios")
    jobs.stage(spark, extracted, sp)
    assert es.read(spark, "estabelecimentos").count() == 4
    assert sp.read(spark, "estabelecimentos").count() == 1
    assert sp.read(spark, "socios").count() == 1

    kept = times(es)
    os.remove(f"{es.path('empresas')}/_SUCCESS")
    assert sorted(jobs.stage(spark, extracted, es)) == ["empresas", "socios"]
    after = times(es)
    assert {name for name in kept if kept[name] != after[name]} == {"empresas"}


def test_only_missing_datasets_need_their_raw_files(spark, tmp_path, extracted):
    staged = staged_at(tmp_path)
    jobs.stage(spark, extracted, staged)
    os.remove(f"{staged.path('cnaes')}/_SUCCESS")
    os.remove(tmp_path / "raw" / "Simples" / "DATA.CSV")
    assert jobs.stage(spark, extracted, staged) == ["cnaes"]


def test_test_profile_reads_the_first_file_of_split_families(spark, tmp_path, raw):
    short = RawRelease(raw.root, raw.state_registry, raw.zipped, test_profile=True)
    assert short.read(spark, "estabelecimentos").count() == 3
    assert short.read(spark, "socios").count() == 3
    assert short.read(spark, "simples").count() == 5
    staged = staged_at(tmp_path, profile=short.profile)
    assert "/test/2026-01/ES/" in staged.path("cnaes")


def test_parquet_first(spark, tmp_path, extracted):
    staged = staged_at(tmp_path)
    assert read_dataset(spark, "empresas", staged, extracted).count() == 3
    jobs.stage(spark, extracted, staged)
    assert read_dataset(spark, "empresas", staged, extracted).count() == 2


def test_validate(spark, tmp_path, raw):
    staged = staged_at(tmp_path)
    jobs.stage(spark, raw, staged)
    report = jobs.validate(spark, staged, raw)
    assert tuple(report.first()) == (4, 2, 1, 1)
    assert tuple(jobs.validate(spark, staged, bound=3).first()) == (3, 2, 1, 1)
    with pytest.raises(EmptySliceError):
        jobs.validate(spark, staged_at(tmp_path, "RJ"), raw)
    if raw.zipped:
        path = tmp_path / "raw" / "Cnaes.zip"
        path.write_bytes(path.read_bytes()[:40])
        with pytest.raises(RuntimeError, match="Cnaes.zip"):
            jobs.validate(spark, staged, raw)


def test_duplicate_report(spark, bag):
    got = jobs.duplicate_report(registry.frames(spark))
    assert bag(got) == {("simples", "22222222", 2): 1}


def test_run_all(spark, tmp_path, extracted):
    written = jobs.run_all(spark, extracted, staged_at(tmp_path), str(tmp_path / "out"))
    assert len(written) == 2


def test_run_latest_takes_the_newest_release_folder(spark, tmp_path):
    for name in ("2025-12", "tmp", "2026-1"):
        (tmp_path / "releases" / name).mkdir(parents=True)
    registry.write_zipped(tmp_path / "releases" / "2026-01")
    registry.write_state_registry(tmp_path / "registry.csv")
    written = jobs.run_latest(
        spark, str(tmp_path / "releases"), str(tmp_path / "registry.csv"),
        str(tmp_path / "staged"), str(tmp_path / "out"), "es",
    )
    assert written == [f"{tmp_path}/out/2026-01/enriched", f"{tmp_path}/out/2026-01/partners"]
    assert spark.read.parquet(written[0]).count() == 5


def test_a_new_slice_removes_what_belongs_to_the_old_one(spark, tmp_path, extracted):
    staged = staged_at(tmp_path)
    part = tmp_path / "part"
    registry.write_extracted(part)
    for number in (0, 1):
        path = part / f"Estabelecimentos{number}" / "DATA.CSV"
        kept = [line for line in path.read_bytes().splitlines(True) if b"22222222" in line]
        path.write_bytes(b"".join(kept))
    jobs.stage(spark, RawRelease(str(part), extracted.state_registry), staged)
    assert staged.read(spark, "empresas").count() == 1
    # Staged again one table at a time, as after a crash between two writes.
    os.remove(f"{staged.path('estabelecimentos')}/_SUCCESS")
    redone = jobs.stage(spark, extracted, staged)
    assert {"estabelecimentos", "empresas", "simples", "socios", "municipios"} == set(redone)
    assert {name: staged.read(spark, name).count() for name in DATASETS} == STAGED_ROWS


def test_a_crash_after_the_cut_leaves_nothing_of_the_old_slice(
    spark, tmp_path, extracted, monkeypatch
):
    staged = staged_at(tmp_path)
    jobs.stage(spark, extracted, staged)
    os.remove(f"{staged.path('estabelecimentos')}/_SUCCESS")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "_stage_reduced", crash)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.stage(spark, extracted, staged)
    assert staged.has(spark, "estabelecimentos") and not staged.has(spark, "empresas")
    assert not os.path.exists(staged.path("keys_cnpj_basico"))


def test_profiles_do_not_mix(spark, tmp_path, extracted):
    short = RawRelease(extracted.root, extracted.state_registry, test_profile=True)
    staged = staged_at(tmp_path)
    for call in (
        lambda: jobs.stage(spark, short, staged),
        lambda: jobs.build(spark, staged, str(tmp_path / "out"), short),
        lambda: jobs.run_all(spark, short, staged, str(tmp_path / "out")),
        lambda: read_dataset(spark, "cnaes", staged, short),
    ):
        with pytest.raises(ValueError, match="profile"):
            call()
    assert not os.path.exists(staged.path("cnaes"))


@pytest.mark.parametrize("zipped", [True, False])
def test_a_missing_family_is_an_error(spark, tmp_path, zipped):
    root = tmp_path / "raw"
    (registry.write_zipped if zipped else registry.write_extracted)(root)
    if zipped:
        os.remove(root / "Simples.zip")
    else:
        os.rename(root / "Simples", root / "Other")
    raw = RawRelease(str(root), "", zipped=zipped)
    with pytest.raises((FileNotFoundError, ValueError)):
        raw.read(spark, "simples")


def test_cached_frames_are_released_after_a_failure(spark):
    frame = spark.range(3)
    with pytest.raises(KeyError), jobs.cached(frame):
        assert frame.is_cached
        raise KeyError
    assert not frame.is_cached
