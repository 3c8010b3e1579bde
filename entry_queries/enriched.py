"""The enriched table and the partners table over registry-shaped driver tables."""

from __future__ import annotations

from entry_queries.tables import registry_ctes, registry_tables
from regweave.plans.enrich import build_enriched, build_partners
from regweave.plans.jobs import duplicate_report

STATE = "ES"


def enriched_base(spark, sf_dir):
    return build_enriched(registry_tables(spark, sf_dir), STATE)


def enriched_base_no_many(spark, sf_dir):
    return build_enriched(registry_tables(spark, sf_dir), STATE, partners=False)


def enriched_lower_case_state(spark, sf_dir):
    """The state may be given in any case; the column is compared as it is."""
    return build_enriched(registry_tables(spark, sf_dir), STATE.lower())


def partners_of_state(spark, sf_dir):
    return build_partners(registry_tables(spark, sf_dir), STATE)


def registry_duplicates(spark, sf_dir):
    # The partners, many per company, give the tax-regime table repeated keys.
    found = registry_tables(spark, sf_dir)
    both = found["simples"].select("cnpj_basico").unionAll(found["socios"].select("cnpj_basico"))
    return duplicate_report(found | {"simples": both})


QUERIES = {
    "enriched_base": enriched_base,
    "enriched_base_no_many": enriched_base_no_many,
    "enriched_lower_case_state": enriched_lower_case_state,
    "partners_of_state": partners_of_state,
    "registry_duplicates": registry_duplicates,
}


def _phone(area: str, number: str) -> str:
    area, number = [f"nullif(trim({column}, ' '), '')" for column in (area, number)]
    return (
        f"case when {number} is null then null when {area} is null then {number}"
        f" else '(' || {area} || ') ' || {number} end"
    )


_NO_PARTNERS = """cast(null as bigint) as qtd_socios,
    cast(null as bigint) as qtd_socios_pessoa_juridica,
    cast(null as bigint) as qtd_socios_pessoa_fisica,
    cast(null as bigint) as qtd_socios_estrangeiro,
    cast(null as varchar) as primeira_data_entrada_sociedade,
    cast(null as varchar) as ultima_data_entrada_sociedade"""


def enriched_sql(partners: bool = True) -> str:
    summary = "s.* exclude (cnpj_basico)" if partners else _NO_PARTNERS
    join = "left join summary s on e.cnpj_basico = s.cnpj_basico" if partners else ""
    return f"""
with {registry_ctes()},
summary as (
    select cnpj_basico, count(*) as qtd_socios,
        count(*) filter (where identificador_socio = '1') as qtd_socios_pessoa_juridica,
        count(*) filter (where identificador_socio = '2') as qtd_socios_pessoa_fisica,
        count(*) filter (where identificador_socio = '3') as qtd_socios_estrangeiro,
        min(data_entrada_sociedade) as primeira_data_entrada_sociedade,
        max(data_entrada_sociedade) as ultima_data_entrada_sociedade
    from socios group by cnpj_basico),
e as (
    select *, coalesce(cnpj_basico, '') || coalesce(cnpj_ordem, '') || coalesce(cnpj_dv, '') as cnpj,
        {_phone('ddd_1', 'telefone_1')} as telefone_1_completo,
        {_phone('ddd_2', 'telefone_2')} as telefone_2_completo,
        {_phone('ddd_fax', 'fax')} as fax_completo,
        nullif(trim(correio_eletronico, ' '), '') as email
    from estabelecimentos where uf = '{STATE}')
select e.*,
    c.* exclude (cnpj_basico), t.* exclude (cnpj_basico),
    a.descricao as cnae_descricao, n.descricao as natureza_juridica_descricao,
    m.descricao as municipio_descricao,
    j.nire as jucees_nire, j.constituicao as jucees_constituicao,
    j.nome_empresa as jucees_nome_empresa, j.nome_fantasia as jucees_nome_fantasia,
    j.municipio as jucees_municipio, j.natureza_juridica as jucees_natureza_juridica,
    j.atividade_principal as jucees_atividade_principal,
    {summary}
from e
left join empresas c on e.cnpj_basico = c.cnpj_basico
left join simples t on e.cnpj_basico = t.cnpj_basico
left join cnaes a on e.cnae_fiscal_principal = a.codigo
left join naturezas n on c.natureza_juridica = n.codigo
left join municipios m on e.municipio = m.codigo
left join jucees j on e.cnpj = nullif(regexp_replace(j.cnpj, '[^0-9]', '', 'g'), '')
{join}"""


def _repeated(name: str, key: str, source: str | None = None) -> str:
    return (
        f"select '{name}' as dataset, {key} as key, count(*) as copies from {source or name}"
        f" where {key} is not null group by {key} having count(*) > 1"
    )


_BOTH = "(select cnpj_basico from simples union all select cnpj_basico from socios)"

ORACLES = {
    "enriched_base": enriched_sql(),
    "enriched_base_no_many": enriched_sql(partners=False),
    "enriched_lower_case_state": enriched_sql(),
    "partners_of_state": f"""
with {registry_ctes()}
select * from socios where cnpj_basico in (select cnpj_basico from estabelecimentos where uf = '{STATE}')""",
    "registry_duplicates": f"with {registry_ctes()}\n" + "\nunion all\n".join(
        [_repeated("empresas", "cnpj_basico"), _repeated("simples", "cnpj_basico", _BOTH)]
        + [_repeated(name, "codigo") for name in ("cnaes", "naturezas", "municipios")]
        + [_repeated("jucees", "nullif(regexp_replace(cnpj, '[^0-9]', '', 'g'), '')")]
    ),
}
