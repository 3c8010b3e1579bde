"""The enriched establishment table and the partners table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regweave.functions import blank_to_null, composite_key, digits_only, phone_number
from regweave.operators.joins import Join, Right, apply, code_list, prepare, semi_join
from regweave.operators.profiles import Profile
from regweave.operators.relational import distinct_keys, prefixed, slice_equal, summarise_many
from regweave.schemas import COMPANY, DATASETS, DEFAULT_STATE, ENRICHED, PARTNER_SUMMARY

# Partner type codes and the summary columns that count them.
PARTNER_KINDS = {
    "qtd_socios_pessoa_juridica": "1",
    "qtd_socios_pessoa_fisica": "2",
    "qtd_socios_estrangeiro": "3",
}

# Coded column -> code list and the name of its description.
CODE_LISTS = {
    "cnae_fiscal_principal": ("cnaes", "cnae_descricao"),
    "natureza_juridica": ("naturezas", "natureza_juridica_descricao"),
    "municipio": ("municipios", "municipio_descricao"),
}

_REGISTRY_PREFIX = "jucees_"


def required_datasets(partners: bool) -> list[str]:
    """Datasets the enriched table is built from."""
    return [name for name in DATASETS if partners or name != "socios"]


def _establishment() -> Column:
    return composite_key(*DATASETS["estabelecimentos"].key)


def _registry_digits() -> Column:
    # Rows without a digit in their number match nothing.
    return F.nullif(digits_only("cnpj"), F.lit(""))


def join_keys(name: str) -> dict[str, Column]:
    """The keys by which the table ``name`` takes part in the joins here."""
    keys = {
        column: F.col(column) for column in (COMPANY, *CODE_LISTS) if column in DATASETS[name].columns
    }
    if name == "estabelecimentos":
        keys["cnpj"] = _establishment()
    elif name == "jucees":
        # The registry's other columns of these names are no keys.
        keys = {"cnpj": _registry_digits()}
    elif name in {table for table, _ in CODE_LISTS.values()}:
        keys = {"codigo": F.col("codigo")}
    return keys


def partner_summary(partners: DataFrame) -> DataFrame:
    """Six measures of the partners of each company."""
    return summarise_many(
        partners,
        key=COMPANY,
        kind="identificador_socio",
        kinds=PARTNER_KINDS,
        date="data_entrada_sociedade",
        count_as="qtd_socios",
        first_as="primeira_data_entrada_sociedade",
        last_as="ultima_data_entrada_sociedade",
    )


def build_enriched(
    tables: Mapping[str, DataFrame],
    state: str = DEFAULT_STATE,
    partners: bool = True,
    reduced: bool = False,
    profiles: Mapping[str, Profile] | None = None,
    colocated: bool = False,
) -> DataFrame:
    """The state's establishments with everything known about them, 63 columns.

    Left-join semantics throughout. Without ``partners`` the six summary columns are NULL
    of the same types, so the schema is always the same; with them, ``tables`` needs
    ``socios``. ``reduced`` says that ``socios`` holds the slice's partners only, as staged
    tables do.

    The order of the joins is chosen for the width of what is shuffled: the state
    registry, which needs the establishments distributed by their own key, comes while
    rows are narrow; the joins by company share one distribution; the code lists, which
    are small and normally broadcast, come last, as do the columns computed from the row
    itself. Legal forms are looked up on the companies, which are fewer and narrower. The
    sizes and hot keys of all tables are found by one job each, before the plan is made.

    ``profiles`` of the tables, as staging takes them (``join_keys``), replace those jobs; the
    table of establishments must then hold this state only. ``colocated`` says that the tables
    by company lie in equal buckets by it: their joins come first then, where they need no
    shuffle, and the legal forms after them.
    """
    known = profiles or {}

    def frequent(table: str, name: str):
        return known[table].keys.get(name) if table in known else None

    def size(table: str, columns: list[str], fixed: int = 0) -> int | None:
        return known[table].size(columns, fixed) if table in known else None

    sliced = slice_equal(tables["estabelecimentos"], "uf", state.upper())
    sliced = sliced.withColumn("cnpj", _establishment())

    published = [
        name.removeprefix(_REGISTRY_PREFIX) for name in ENRICHED if name.startswith(_REGISTRY_PREFIX)
    ]
    # Left out here, rows without a number have no digits computed.
    numbered = tables["jucees"].filter(F.col("cnpj").isNotNull())
    numbered = prefixed(numbered, _REGISTRY_PREFIX, published, keep=["cnpj"])
    listed = Right(
        numbered.withColumn("cnpj", _registry_digits()), bound=numbered,
        size=size("jucees", ["cnpj", *published]), frequent=frequent("jucees", "cnpj"),
    )
    registry = Join("cnpj", [listed], sliced, frequent("estabelecimentos", "cnpj"))
    firms, regimes = (
        Right(
            tables[name], size=size(name, DATASETS[name].columns), frequent=frequent(name, COMPANY)
        )
        for name in ("empresas", "simples")
    )
    companies = Join(COMPANY, [firms, regimes], sliced, frequent("estabelecimentos", COMPANY))
    wanted = []
    if partners:
        if not reduced:
            keys = distinct_keys(sliced, COMPANY)
            wanted.append(Right(keys, unique=True, bound=sliced.select(COMPANY)))
        # No larger summary is possible than one row of this for every partner.
        date = F.col("data_entrada_sociedade")
        widest = {
            field.name: date if isinstance(field.dataType, T.StringType) else F.lit(0)
            for field in PARTNER_SUMMARY
        }
        bound = tables["socios"].select(COMPANY, *[c.alias(name) for name, c in widest.items()])
        dates = ["data_entrada_sociedade"] * 2
        summary = Right(
            partner_summary(tables["socios"]), unique=True, bound=bound,
            size=size("socios", [COMPANY, *dates], len(PARTNER_SUMMARY) - len(dates)),
        )
        companies.rights.append(summary)
    codes = {}
    for column, (table, output) in CODE_LISTS.items():
        codes[column] = code_list(column, tables[table], "codigo", "descricao", output)
        codes[column].size = size(table, ["codigo", "descricao"])
        codes[column].frequent = frequent(table, "codigo")
        owner = "estabelecimentos" if column in sliced.columns else "empresas"
        coded = sliced if column in sliced.columns else tables["empresas"]
        codes[column] = Join(column, [codes[column]], coded, frequent(owner, column))
    prepare([registry, companies, *codes.values()], wanted)
    if wanted and wanted[0].small:
        # A broadcast of the slice's companies keeps all other partners out of the
        # aggregation. Without one, the partial aggregation is the cheaper reduction.
        summary.df = partner_summary(semi_join(tables["socios"], COMPANY, wanted[0]))
    if not colocated:
        firms.df = apply(tables["empresas"], codes.pop("natureza_juridica"))

    result = sliced
    for join in (companies, registry) if colocated else (registry, companies):
        result = apply(result, join)
    for code in codes.values():
        result = apply(result, code)

    derived = {
        "telefone_1_completo": phone_number("ddd_1", "telefone_1"),
        "telefone_2_completo": phone_number("ddd_2", "telefone_2"),
        "fax_completo": phone_number("ddd_fax", "fax"),
        "email": blank_to_null("correio_eletronico"),
    }
    if not partners:
        derived |= {field.name: F.lit(None).cast(field.dataType) for field in PARTNER_SUMMARY}
    return result.withColumns(derived).select(*ENRICHED)


def build_partners(
    tables: Mapping[str, DataFrame], state: str = DEFAULT_STATE, reduced: bool = False
) -> DataFrame:
    """All partners of companies with an establishment in the state.

    ``reduced`` says that ``socios`` holds no others, as staged tables do.
    """
    if reduced:
        return tables["socios"].select(*DATASETS["socios"].columns)
    sliced = slice_equal(tables["estabelecimentos"], "uf", state.upper())
    kept = semi_join(tables["socios"], COMPANY, sliced)
    return kept.select(*DATASETS["socios"].columns)
