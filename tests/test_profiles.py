"""Profiles taken while staging, joins planned with them, manifests and co-located tables."""

import os
import shutil

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import registry
from regweave.operators import joins
from regweave.operators.joins import Join, Right, left_join, prepare
from regweave.operators.profiles import REPORTED, Frequent, Observed, Profile
from regweave.plans import jobs
from regweave.plans.enrich import build_enriched, join_keys
from regweave.schemas import COMPANY, DATASETS
from regweave.sources.datasets import RawRelease, StagedRelease
from regweave.sources.manifests import Manifest, RawFiles


def written(spark, df, keys, path):
    observed = Observed(df.hint("rebalance"), keys)
    observed.df.write.mode("overwrite").parquet(str(path))
    return observed.profile()


@pytest.fixture
def release(tmp_path):
    registry.write_extracted(tmp_path / "raw")
    registry.write_state_registry(tmp_path / "registry.csv")
    return RawRelease(str(tmp_path / "raw"), str(tmp_path / "registry.csv"))


def staged_at(tmp_path, buckets=0):
    return StagedRelease(str(tmp_path / "staged"), "2026-01", "ES", buckets=buckets)


@pytest.fixture
def no_counting(monkeypatch):
    """Any measuring or counting before a join fails."""
    def fail(*_):
        raise AssertionError("a table was read to plan a join")

    monkeypatch.setattr(joins, "_row_bytes", fail)
    for name in ("hot_keys", "worth_counting"):
        monkeypatch.setattr(joins, name, lambda sides: [] if not sides else fail())


def test_a_profile_is_exact_for_few_keys(spark, tmp_path):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(
        F.concat(F.lit("k"), F.col("id") % 50)
    )
    df = spark.range(0, 9000, 1, 6).select(key.alias("k"), F.col("id").cast("string").alias("t"), "id")
    profile = written(spark, df, {"k": F.col("k"), "both": F.concat("k", "t")}, tmp_path / "t")
    counts = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    assert profile.rows == 9000 and dict(profile.keys["k"].counts) == counts
    sizes = df.agg(F.sum(F.octet_length("k")), F.sum(F.octet_length("t"))).first()
    assert profile.bytes == {"k": sizes[0], "t": sizes[1]}
    assert profile.size(["k"], fixed=1) == sizes[0] + 16 * 9000
    assert Profile.from_json(profile.as_json()) == profile


def test_sketches_of_many_keys_miss_no_frequent_one(spark, tmp_path):
    key = F.when(F.col("id") % 7 == 0, F.concat(F.lit("h"), F.col("id") % 4)).otherwise(
        F.col("id").cast("string")
    )
    df = spark.range(0, 300_000, 1, 8).select(key.alias("k"))
    found = written(spark, df, {"k": F.col("k")}, tmp_path / "t").keys["k"]
    assert len(found.counts) <= REPORTED and found.others < 300
    hot = found.above(200, 4)
    assert set(hot) == {"h0", "h1", "h2", "h3"}
    assert found.above(1_000_000, 4) is None  # keys of a few rows are not known


def test_empty_tables_have_a_profile(spark, tmp_path):
    df = spark.createDataFrame([], "k string, t string")
    profile = written(spark, df, {"k": F.col("k")}, tmp_path / "t")
    assert profile.rows == 0 and profile.keys["k"].above(8, 4) == {}
    nothing = df.join(spark.range(0).selectExpr("cast(id as string) as k"), "k")
    assert written(spark, nothing, {"k": F.col("k")}, tmp_path / "u").rows == 0


def test_hot_null_keys_count_on_the_left_only():
    found = Frequent(100, {None: 60, "a": 30, "b": 10}, 0)
    assert found.above(10, 2) == {None: 6, "a": 3}
    assert found.above(10, 2, nulls=False) == {"a": 8, "b": 3}


def test_hot_key_of_a_small_encoded_file_is_split(spark, bag, plan, tmp_path, no_broadcast, monkeypatch):
    """The file has a few KB, Spark's estimate is far below what is counted by size."""
    monkeypatch.setattr(joins, "SPREAD_ROWS", 100_000)
    path = str(tmp_path / "left")
    key = F.when(F.col("id") % 4 > 0, "hot").otherwise((F.col("id") % 200).cast("string"))
    spark.range(0, 200_000, 1, 4).select(key.alias("k")).write.parquet(path)
    left = spark.read.parquet(path)
    assert joins._estimate(left) < 1 << 20
    right = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    right = right.unionByName(spark.createDataFrame([("hot", 2)], "k string, v int"))
    join = Join("k", [Right(right)], left)
    prepare([join])
    assert set(join.hot[0]) == {"hot"}
    joined = left_join(left, "k", [Right(right)])
    assert "_hot_key" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.groupBy("v").count().collect() == left.join(right, "k", "left").groupBy("v").count().collect()


def test_hot_keys_come_from_profiles(spark, bag, no_broadcast, no_counting, monkeypatch):
    monkeypatch.setattr(joins, "SPREAD_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_PARTITIONS", 1)
    rows = [("hot", f"a{i}") for i in range(60)] + [(f"k{i % 20}", f"b{i}") for i in range(60)]
    rows += [(None, "n")] * 30
    left = spark.createDataFrame(pa.table({"k": [r[0] for r in rows], "x": [r[1] for r in rows]}))
    right = spark.createDataFrame(pa.table({"k": ["hot", "k1", None] * 9, "v": list(range(27))}))
    known = Frequent(150, {"hot": 60, None: 30}, 3)
    other = Frequent(27, {"hot": 9, "k1": 9, None: 9}, 0)
    join = Join("k", [Right(right, size=1 << 40, frequent=other)], left, known)
    prepare([join])
    assert set(join.hot[0]) == {"hot", None} and set(join.hot[1]) == {"hot", "k1"}
    assert bag(joins.apply(left, join)) == bag(left.join(right, "k", "left").select("k", "x", "v"))


def test_profiled_sizes_decide_broadcasts(spark, no_counting):
    table = spark.range(5).select(F.col("id").alias("k"))
    small, large = Right(table, size=100), Right(table, size=1 << 40)
    joins.measure([small, large])
    assert small.small and not large.small and large.misjudged


@pytest.mark.parametrize("broadcast", [True, False])
def test_staged_tables_are_joined_without_counting(
    spark, bag, tmp_path, release, request, broadcast, monkeypatch
):
    staged = staged_at(tmp_path)
    jobs.stage(spark, release, staged)
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    request.getfixturevalue("no_counting")
    found = jobs.profiles(spark, staged)
    assert set(found) == set(DATASETS) and found["estabelecimentos"].rows == 4
    assert set(found["estabelecimentos"].keys) == {
        COMPANY, "cnae_fiscal_principal", "municipio", "cnpj"}
    assert found["jucees"].keys["cnpj"].counts == {
        "12345678000190": 1, "1111111000111": 1, None: 1}
    got = build_enriched(jobs.tables(spark, staged), "ES", reduced=True, profiles=found)
    monkeypatch.undo()
    assert bag(got) == bag(build_enriched(registry.frames(spark), "ES"))


def test_colocated_tables_join_by_company_without_a_shuffle(
    spark, bag, plan, tmp_path, release, no_broadcast
):
    staged = staged_at(tmp_path, buckets=4)
    assert sorted(jobs.stage(spark, release, staged)) == sorted(DATASETS)
    assert jobs.stage(spark, release, staged) == []

    def enriched():
        found = jobs.tables(spark, staged)
        return build_enriched(
            found, "ES", reduced=True, profiles=jobs.profiles(spark, staged), colocated=True
        )

    got, want = enriched(), build_enriched(registry.frames(spark), "ES")
    text = plan(got)
    assert text.count(f"SortMergeJoin [{COMPANY}") == 3
    assert f"Exchange hashpartitioning({COMPANY}" not in text
    assert bag(got) == bag(want)
    # Another application does not know the tables yet.
    for name in DATASETS:
        spark.sql(f"DROP TABLE IF EXISTS {staged.table_name(name)}")
    again = enriched()
    assert f"Exchange hashpartitioning({COMPANY}" not in plan(again) and bag(again) == bag(want)
    out = jobs.build(spark, staged, str(tmp_path / "out"))
    assert bag(spark.read.parquet(out[0])) == bag(want)
    # Another layout of the same place is staged anew.
    plain = staged_at(tmp_path)
    assert set(jobs.stage(spark, release, plain)) >= {"estabelecimentos", "empresas", "simples", "socios"}
    assert plain.read(spark, "empresas").count() == 2


def test_a_replaced_raw_file_is_staged_again(spark, tmp_path, release):
    staged = staged_at(tmp_path)
    jobs.stage(spark, release, staged)
    path = tmp_path / "raw" / "Empresas0" / "DATA.CSV"
    path.write_bytes(path.read_bytes().replace(b"PADARIA LTDA", b"PADARIA S.A."))  # same length
    stat = os.stat(path)
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns + 10**9))
    assert jobs.stage(spark, release, staged) == ["empresas"]
    assert staged.read(spark, "empresas").where("razao_social = 'PADARIA S.A.'").count() == 1
    assert jobs.stage(spark, release, staged) == []

    path = tmp_path / "raw" / "Estabelecimentos1" / "DATA.CSV"
    kept = path.read_bytes().splitlines(True)
    path.write_bytes(b"".join(line for line in kept if b"22222222" not in line))
    redone = jobs.stage(spark, release, staged)
    assert set(redone) == {"estabelecimentos", "empresas", "simples", "socios", "municipios"}
    assert staged.read(spark, "empresas").count() == 1

    (tmp_path / "raw" / "Simples" / "MORE.CSV").write_bytes(b'"12345678";"N"\n')
    assert jobs.stage(spark, release, staged) == ["simples"]


def test_a_copied_release_is_the_same_one(spark, tmp_path, release):
    staged = staged_at(tmp_path)
    jobs.stage(spark, release, staged)
    shutil.copytree(tmp_path / "raw", tmp_path / "copy")
    assert jobs.stage(spark, RawRelease(str(tmp_path / "copy"), release.state_registry), staged) == []
    path = tmp_path / "copy" / "Simples" / "DATA.CSV"
    path.write_bytes(path.read_bytes() + b'"12345678";"N"\n')
    assert jobs.stage(spark, RawRelease(str(tmp_path / "copy"), release.state_registry), staged) == [
        "simples"]


def test_a_table_without_its_manifest_is_not_complete(spark, tmp_path, release):
    staged = staged_at(tmp_path)
    jobs.stage(spark, release, staged)
    os.remove(staged.manifest_path("cnaes"))
    assert jobs.stage(spark, release, staged) == ["cnaes"]
    other = Manifest.read(spark, staged.manifest_path("cnaes"))
    Manifest(other.raw, ("codigo",), 0, other.profile).commit(spark, staged.manifest_path("cnaes"))
    assert jobs.stage(spark, release, staged) == ["cnaes"]


def test_raw_files_compare_times_in_one_place_only():
    one = RawFiles("file:/a", (("x", 5, 1),))
    assert not one.same_as(RawFiles("file:/a", (("x", 5, 2),)))
    assert one.same_as(RawFiles("file:/b", (("x", 5, 2),)))
    assert not one.same_as(RawFiles("file:/b", (("x", 6, 2),)))


def test_zipped_releases_have_manifests(spark, tmp_path):
    registry.write_zipped(tmp_path / "raw")
    registry.write_state_registry(tmp_path / "registry.csv")
    raw = RawRelease(str(tmp_path / "raw"), str(tmp_path / "registry.csv"), zipped=True)
    found = raw.inputs(spark)
    assert [file[0] for file in found["empresas"].files] == ["Empresas0.zip", "Empresas1.zip"]
    assert len(found["jucees"].files) == 1 and set(found) == set(DATASETS)
    short = RawRelease(raw.root, raw.state_registry, True, test_profile=True).inputs(spark)
    assert [file[0] for file in short["empresas"].files] == ["Empresas0.zip"]
    staged = staged_at(tmp_path)
    jobs.stage(spark, raw, staged)
    os.utime(tmp_path / "raw" / "Cnaes.zip", ns=(0, 10**18))
    assert jobs.stage(spark, raw, staged) == ["cnaes"]


def test_join_keys_are_columns_of_their_tables(spark):
    frames = registry.frames(spark)
    for name, frame in frames.items():
        assert frame.select(*[key.alias(n) for n, key in join_keys(name).items()]).columns
