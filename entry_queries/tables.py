"""The driver tables, and registry-shaped views derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regweave.schemas import DATASETS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(column: str) -> str:
    return f"lpad(cast({column} as string), 12, '0')"


def _ymd(column: str) -> str:
    return f"cast(year({column}) * 10000 + month({column}) * 100 + day({column}) as string)"


_CHECK_DIGIT = (
    "case when o_orderpriority = '4-NOT SPECIFIED' then null else substr(o_orderpriority, 1, 1) end"
)
_AREA = (
    "case o_orderpriority when '1-URGENT' then '27' when '2-HIGH' then ' 28 '"
    " when '3-MEDIUM' then '  ' end"
)
_NUMBER = (
    "case when o_totalprice < 100000 then null when o_totalprice < 200000 then '   '"
    " else concat(' ', cast(o_orderkey as string), ' ') end"
)


def _key_if(column: str, condition: str) -> str:
    """The key, or one that matches nothing where the condition fails."""
    return f"case when {condition} then {_key(column)} else concat('x', {_key(column)}) end"


# View -> (driver table, expression per column). Every row of the table is kept. A column
# that is not listed is NULL. The expressions are valid in Spark SQL and in DuckDB; text is
# planted over all rows, so blanks, edge spaces, quotes and delimiters occur everywhere.
_VIEWS = {
    "estabelecimentos": ("orders", {
        "cnpj_basico": _key("o_custkey"),
        "cnpj_ordem": _key("o_orderkey"),
        "cnpj_dv": _CHECK_DIGIT,
        "identificador_matriz_filial": "case when o_totalprice > 250000 then '1' else '2' end",
        "nome_fantasia": "o_orderpriority",
        "situacao_cadastral": "o_orderstatus",
        "data_situacao_cadastral": _ymd("o_orderdate"),
        "data_inicio_atividade": _ymd("o_orderdate"),
        "cnae_fiscal_principal": "cast(cast(floor(o_totalprice / 1000) as bigint) as string)",
        "cnae_fiscal_secundaria": "concat(o_orderstatus, ',', o_orderpriority)",
        "logradouro": "concat('RUA \"', o_orderpriority, '\"; LOJA')",
        "numero": "cast(o_custkey as string)",
        "bairro": "concat('  ', o_orderstatus, ' ')",
        "uf": "case o_orderstatus when 'F' then 'ES' when 'O' then 'SP' when 'P' then 'es' end",
        "municipio": "cast(dayofyear(o_orderdate) as string)",
        "ddd_1": _AREA,
        "telefone_1": _NUMBER,
        "ddd_2": _AREA,
        "telefone_2": "cast(o_custkey as string)",
        "ddd_fax": "'27'",
        "fax": _NUMBER,
        "correio_eletronico": (
            "case o_orderpriority when '1-URGENT' then ' a@b.c ' when '2-HIGH' then '   '"
            " when '3-MEDIUM' then chr(9) when '5-LOW' then 'd@e.f' end"
        ),
    }),
    "empresas": ("customer", {
        "cnpj_basico": _key_if("c_custkey", "c_acctbal >= 0"),
        "razao_social": "c_name",
        "natureza_juridica": "cast(c_nationkey as string)",
        "capital_social": "cast(c_acctbal as string)",
        "porte_empresa": "c_mktsegment",
    }),
    "simples": ("customer", {
        "cnpj_basico": _key_if("c_custkey", "c_mktsegment <> 'HOUSEHOLD'"),
        "opcao_simples": "case when c_acctbal > 5000 then 'S' else 'N' end",
        "opcao_mei": "case when c_acctbal < 1000 then 'S' else 'N' end",
    }),
    "cnaes": ("part", {
        "codigo": "cast(p_partkey as string)", "descricao": "p_name",
    }),
    "naturezas": ("region", {
        "codigo": "cast(r_regionkey as string)", "descricao": "r_name",
    }),
    "municipios": ("supplier", {
        "codigo": "cast(s_suppkey as string)", "descricao": "s_name",
    }),
    "jucees": ("orders", {
        "nome_empresa": "concat('EMPRESA ', cast(o_custkey as string))",
        "nome_fantasia": "concat('LOJA, ', o_orderpriority)",
        # One digit more where there is to be no match, and some numbers without a digit.
        "cnpj": (
            f"case when o_orderkey % 100 = 7 then './-'"
            f" else concat({_key('o_custkey')}, '.', {_key('o_orderkey')}, '/-',"
            f" coalesce({_CHECK_DIGIT}, ''),"
            " case when o_orderpriority = '1-URGENT' then '0' else '' end) end"
        ),
        "nire": "cast(o_orderkey as string)",
        "constituicao": _ymd("o_orderdate"),
        "municipio": "o_orderstatus",
        "natureza_juridica": "o_orderpriority",
        "atividade_principal": "concat('\"', o_orderstatus, '\"')",
    }),
    "socios": ("lineitem", {
        "cnpj_basico": _key("l_orderkey"),
        "identificador_socio": (
            "case when l_linenumber = 7 then '9' when l_linenumber = 6 then null"
            " when l_returnflag = 'R' then '1' when l_returnflag = 'A' then '2' else '3' end"
        ),
        "nome_socio_razao_social": "concat('SOCIO ', cast(l_partkey as string))",
        "cpf_cnpj_socio": "cast(l_suppkey as string)",
        "data_entrada_sociedade": (
            f"case when l_quantity < 3 then '00000000' when l_quantity < 5 then null"
            f" else {_ymd('l_shipdate')} end"
        ),
        "faixa_etaria": "cast(l_linenumber as string)",
    }),
}


def registry_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight registry tables over the whole driver tables."""
    found = {}
    for name, (source, expressions) in _VIEWS.items():
        columns = [
            f"cast({expressions.get(column, 'null')} as string) as {column}"
            for column in DATASETS[name].columns
        ]
        found[name] = table(spark, sf_dir, source).selectExpr(*columns)
    return found


def registry_ctes() -> str:
    """The same eight tables as a SQL ``WITH`` list."""
    parts = []
    for name, (source, expressions) in _VIEWS.items():
        columns = ", ".join(
            f"cast({expressions.get(column, 'null')} as varchar) as {column}"
            for column in DATASETS[name].columns
        )
        parts.append(f"{name} as (select {columns} from {source})")
    return ",\n".join(parts)
