"""Declared schemas of the registry tables and of the enriched table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def text_schema(names: list[str]) -> T.StructType:
    """All-string, all-nullable struct; keys keep their leading zeros this way."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Fixed value: the state a run is for unless it says otherwise.
DEFAULT_STATE = "ES"

#: The key that all tables about companies share.
COMPANY = "cnpj_basico"

# Column names and their order in the published registry files.
EMPRESAS = [
    "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
    "capital_social", "porte_empresa", "ente_federativo_responsavel",
]
ESTABELECIMENTOS = [
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial",
    "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral",
    "motivo_situacao_cadastral", "nome_cidade_exterior", "pais",
    "data_inicio_atividade", "cnae_fiscal_principal", "cnae_fiscal_secundaria",
    "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "uf",
    "municipio", "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax",
    "correio_eletronico", "situacao_especial", "data_situacao_especial",
]
SIMPLES = [
    "cnpj_basico", "opcao_simples", "data_opcao_simples", "data_exclusao_simples",
    "opcao_mei", "data_opcao_mei", "data_exclusao_mei",
]
SOCIOS = [
    "cnpj_basico", "identificador_socio", "nome_socio_razao_social", "cpf_cnpj_socio",
    "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal",
    "nome_representante", "qualificacao_representante_legal", "faixa_etaria",
]
CODE_LIST = ["codigo", "descricao"]
JUCEES = [
    "nome_empresa", "nome_fantasia", "cnpj", "nire", "constituicao", "logradouro",
    "numero", "complemento", "bairro", "municipio", "cep", "cod_natureza_juridica",
    "natureza_juridica", "atividade_principal",
]

# Column names and their order in the enriched output table.
ENRICHED = [
    "cnpj", "cnpj_basico", "cnpj_ordem", "cnpj_dv", "razao_social", "nome_fantasia",
    "identificador_matriz_filial", "qualificacao_responsavel", "situacao_cadastral",
    "data_situacao_cadastral", "motivo_situacao_cadastral", "situacao_especial",
    "data_situacao_especial", "data_inicio_atividade", "cnae_fiscal_principal",
    "cnae_descricao", "cnae_fiscal_secundaria", "natureza_juridica",
    "natureza_juridica_descricao", "porte_empresa", "capital_social",
    "ente_federativo_responsavel", "pais", "nome_cidade_exterior", "tipo_logradouro",
    "logradouro", "numero", "complemento", "bairro", "cep", "uf", "municipio",
    "municipio_descricao", "ddd_1", "telefone_1", "telefone_1_completo", "ddd_2",
    "telefone_2", "telefone_2_completo", "ddd_fax", "fax", "fax_completo",
    "correio_eletronico", "email", "opcao_simples", "data_opcao_simples",
    "data_exclusao_simples", "opcao_mei", "data_opcao_mei", "data_exclusao_mei",
    "qtd_socios", "qtd_socios_pessoa_juridica", "qtd_socios_pessoa_fisica",
    "qtd_socios_estrangeiro", "primeira_data_entrada_sociedade",
    "ultima_data_entrada_sociedade", "jucees_nire", "jucees_constituicao",
    "jucees_nome_empresa", "jucees_nome_fantasia", "jucees_municipio",
    "jucees_natureza_juridica", "jucees_atividade_principal",
]

# Types of the partner summary; also used for its NULL stand-ins when partners are off.
PARTNER_SUMMARY = T.StructType([
    T.StructField("qtd_socios", T.LongType()),
    T.StructField("qtd_socios_pessoa_juridica", T.LongType()),
    T.StructField("qtd_socios_pessoa_fisica", T.LongType()),
    T.StructField("qtd_socios_estrangeiro", T.LongType()),
    T.StructField("primeira_data_entrada_sociedade", T.StringType()),
    T.StructField("ultima_data_entrada_sociedade", T.StringType()),
])

_SUMMARY_TYPES = {field.name: field.dataType for field in PARTNER_SUMMARY}
ENRICHED_SCHEMA = T.StructType(
    [T.StructField(name, _SUMMARY_TYPES.get(name, T.StringType())) for name in ENRICHED]
)


@dataclass(frozen=True)
class Dataset:
    """One registry table.

    ``prefix`` is the name its raw files start with (None for the state registry,
    which is one CSV of its own), ``split`` says whether the publisher cuts it into
    numbered files, and ``key`` names the columns that should identify a row.
    """

    name: str
    columns: list[str]
    prefix: str | None
    split: bool = False
    key: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return text_schema(self.columns)


DATASETS = {
    dataset.name: dataset
    for dataset in (
        Dataset("estabelecimentos", ESTABELECIMENTOS, "Estabelecimentos", True,
                ("cnpj_basico", "cnpj_ordem", "cnpj_dv")),
        Dataset("empresas", EMPRESAS, "Empresas", True, ("cnpj_basico",)),
        Dataset("simples", SIMPLES, "Simples", False, ("cnpj_basico",)),
        Dataset("cnaes", CODE_LIST, "Cnaes", False, ("codigo",)),
        Dataset("naturezas", CODE_LIST, "Naturezas", False, ("codigo",)),
        Dataset("municipios", CODE_LIST, "Municipios", False, ("codigo",)),
        Dataset("jucees", JUCEES, None, False, ("cnpj",)),
        Dataset("socios", SOCIOS, "Socios", True),
    )
}
