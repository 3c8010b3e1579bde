import pytest

import registry
from regweave.plans.enrich import build_enriched, build_partners
from regweave.schemas import DATASETS, ENRICHED, ENRICHED_SCHEMA

SUMMARY = [name for name in ENRICHED if name.startswith(("qtd_", "primeira_", "ultima_"))]


def nullable(schema):
    return [(field.name, field.dataType) for field in schema]


@pytest.fixture(params=["broadcast", "shuffled"])
def enriched(request, spark):
    if request.param == "shuffled":
        request.getfixturevalue("no_broadcast")
    return build_enriched(registry.frames(spark), "ES")


def test_enriched_rows(enriched):
    assert enriched.columns == ENRICHED and len(ENRICHED) == 63
    assert nullable(enriched.schema) == nullable(ENRICHED_SCHEMA)
    rows = [row.asDict() for row in enriched.collect()]
    assert len(rows) == 5  # four establishments, one of them with two tax regime rows
    by_key = {row["cnpj"]: row for row in rows}

    full = by_key["12345678000190"]
    assert full["razao_social"] == "PADARIA LTDA"
    assert full["natureza_juridica_descricao"] == "Sociedade Limitada"
    assert full["cnae_descricao"] == "Comércio varejista"
    assert full["municipio_descricao"] == "VITORIA"
    assert full["telefone_1_completo"] == "(27) 33334444"
    assert (full["email"], full["correio_eletronico"]) == ("a@b.c", " a@b.c ")
    assert (full["jucees_nire"], full["jucees_nome_empresa"]) == ("321", "PADARIA, LTDA")
    assert [full[name] for name in SUMMARY] == [5, 1, 1, 1, "00000000", "20200101"]

    branch = by_key["1234567871"]
    assert branch["cnpj_ordem"] is None and branch["jucees_nire"] is None
    assert branch["telefone_1_completo"] == "999" and branch["telefone_2_completo"] is None
    assert branch["email"] is None and branch["correio_eletronico"] == "   "
    assert branch["cnae_descricao"] is None and branch["qtd_socios"] == 5

    orphan = by_key["01111111000111"]
    assert orphan["razao_social"] is None and orphan["natureza_juridica_descricao"] is None
    assert orphan["opcao_mei"] == "S" and orphan["jucees_nire"] is None
    assert orphan["municipio_descricao"] is None
    assert [orphan[name] for name in SUMMARY] == [None] * 6

    twice = [row for row in rows if row["cnpj_basico"] == "22222222"]
    assert sorted(row["opcao_simples"] for row in twice) == ["N", "S"]
    assert twice[0]["natureza_juridica"] == "8888"
    assert twice[0]["natureza_juridica_descricao"] is None
    assert twice[0]["qtd_socios"] is None and twice[0]["fax_completo"] == "(28) 1"


def test_schema_is_the_same_without_partners(spark):
    tables = registry.frames(spark)
    del tables["socios"]
    off = build_enriched(tables, "ES", partners=False)
    assert nullable(off.schema) == nullable(ENRICHED_SCHEMA)
    assert {row[name] for row in off.collect() for name in SUMMARY} == {None}


def test_row_count_is_the_slice_with_unique_keys(spark):
    tables = registry.frames(spark)
    tables["simples"] = tables["simples"].dropDuplicates(["cnpj_basico"])
    assert build_enriched(tables, "ES").count() == 4
    assert build_enriched(tables, "sp").count() == 1  # state codes are upper-cased
    assert build_enriched(tables, "RJ").count() == 0


def test_partners_of_the_state(spark):
    got = build_partners(registry.frames(spark), "ES")
    assert got.columns == DATASETS["socios"].columns
    assert {row.cnpj_basico for row in got.collect()} == {"12345678"} and got.count() == 5


def test_company_joins_share_one_distribution(spark, plan, no_broadcast):
    text = plan(build_enriched(registry.frames(spark), "ES"))
    # Wide rows move for the registry key, the company key and three code lists; each of
    # the seven right sides moves once.
    assert text.count("Exchange hashpartitioning") == 12
