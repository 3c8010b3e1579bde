import pytest

from regweave.operators.selection import (
    first_of_split_families,
    latest_release,
    select_files,
    sorted_names,
)


def names(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "name string")


def test_latest_release_ignores_malformed_labels(spark, bag):
    labels = names(spark, "2026-01", "2025-12", "2026-1", "tmp", "2026-01", "2027-01\n", None)
    assert bag(latest_release(labels, "name")) == {("2026-01",): 2}


def test_latest_release_fails_without_a_label(spark):
    with pytest.raises(Exception, match="no release label"):
        latest_release(names(spark, "tmp", "2026-1"), "name").collect()


FILES = [
    "Empresas1.zip", "Empresas0.zip", "Empresas10.zip", "Simples.zip", "Motivos.zip", "Socios0.zip",
    "Socios1.zip", "Estabelecimentos3.zip", "Empresas.zip", "xEmpresas0.zip", "Empresas0.zip.tmp",
    "Cnaes.zip", "Simples0.zip",
]


def test_select_files(spark, bag):
    got = select_files(names(spark, *FILES), "name", partners=False)
    assert bag(got) == {
        ("Empresas1.zip", "empresas"): 1, ("Empresas0.zip", "empresas"): 1,
        ("Empresas10.zip", "empresas"): 1, ("Simples.zip", "simples"): 1,
        ("Estabelecimentos3.zip", "estabelecimentos"): 1, ("Cnaes.zip", "cnaes"): 1,
    }
    with_partners = select_files(names(spark, *FILES), "name", partners=True)
    assert with_partners.count() == got.count() + 2


def test_first_of_split_families(spark, bag):
    chosen = select_files(names(spark, *FILES), "name", partners=True)
    assert bag(first_of_split_families(chosen, "name")) == {
        ("Empresas0.zip", "empresas"): 1, ("Socios0.zip", "socios"): 1,
        ("Estabelecimentos3.zip", "estabelecimentos"): 1,
        ("Simples.zip", "simples"): 1, ("Cnaes.zip", "cnaes"): 1,
    }


def test_sorted_names(spark):
    listing = sorted_names(names(spark, "b", "a", "b"), "name")
    assert [row.name for row in listing.collect()] == ["a", "b"]
