"""A small hand-made registry with the awkward cases, and its raw files."""

import zipfile

import pyarrow as pa

from regweave.schemas import DATASETS

ROWS = {
    "estabelecimentos": [
        # matrix with everything known
        {"cnpj_basico": "12345678", "cnpj_ordem": "0001", "cnpj_dv": "90", "uf": "ES",
         "nome_fantasia": 'BAR "DO" ZÉ; FILIAL', "municipio": "5705", "ddd_1": "27",
         "telefone_1": "33334444", "cnae_fiscal_principal": "4711302",
         "correio_eletronico": " a@b.c "},
        # branch without its order number, phone without area code, blank e-mail
        {"cnpj_basico": "12345678", "cnpj_dv": "71", "uf": "ES", "telefone_1": "999",
         "ddd_2": "27", "correio_eletronico": "   ", "cnae_fiscal_principal": "0000000",
         "municipio": "5705"},
        # no company row, registry key that lost its leading zero
        {"cnpj_basico": "01111111", "cnpj_ordem": "0001", "cnpj_dv": "11", "uf": "ES",
         "municipio": "9999"},
        # company with a doubled tax regime row and no partners
        {"cnpj_basico": "22222222", "cnpj_ordem": "0001", "cnpj_dv": "22", "uf": "ES",
         "municipio": "5705", "ddd_fax": "28", "fax": "1"},
        {"cnpj_basico": "33333333", "cnpj_ordem": "0001", "cnpj_dv": "33", "uf": "SP",
         "municipio": "7107"},
        {"cnpj_basico": "44444444", "cnpj_ordem": "0001", "cnpj_dv": "44", "municipio": "7107"},
        {"cnpj_basico": "55555555", "cnpj_ordem": "0001", "cnpj_dv": "55", "uf": "es"},
    ],
    "empresas": [
        {"cnpj_basico": "12345678", "razao_social": "PADARIA LTDA", "natureza_juridica": "2062",
         "capital_social": "1000,00"},
        {"cnpj_basico": "22222222", "razao_social": "LOJA", "natureza_juridica": "8888"},
        {"cnpj_basico": "33333333", "razao_social": "PAULISTA", "natureza_juridica": "2062"},
    ],
    "simples": [
        {"cnpj_basico": "12345678", "opcao_simples": "S"},
        {"cnpj_basico": "22222222", "opcao_simples": "S"},
        {"cnpj_basico": "22222222", "opcao_simples": "N"},
        {"cnpj_basico": "01111111", "opcao_mei": "S"},
        {"cnpj_basico": "33333333", "opcao_simples": "N"},
    ],
    "cnaes": [{"codigo": "4711302", "descricao": "Comércio varejista"}],
    "naturezas": [{"codigo": "2062", "descricao": "Sociedade Limitada"}],
    "municipios": [
        {"codigo": "5705", "descricao": "VITORIA"}, {"codigo": "7107", "descricao": "SAO PAULO"},
    ],
    "jucees": [
        {"cnpj": "12.345.678/0001-90", "nire": "321", "nome_empresa": "PADARIA, LTDA"},
        {"cnpj": "1.111.111/0001-11", "nire": "322"},
        {"cnpj": None, "nire": "323"},
    ],
    "socios": [
        {"cnpj_basico": "12345678", "identificador_socio": kind, "data_entrada_sociedade": date}
        for kind, date in [
            ("1", "20200101"), ("2", "00000000"), ("3", None), ("9", "20190101"), (None, None),
        ]
    ] + [{"cnpj_basico": "33333333", "identificador_socio": "2"}],
}


def rows(name):
    return [tuple(row.get(column) for column in DATASETS[name].columns) for row in ROWS[name]]


def frames(spark):
    """The tables, by way of Arrow, which makes them plain JVM relations."""
    found = {}
    for name in ROWS:
        columns = DATASETS[name].columns
        values = [pa.array(column, pa.string()) for column in zip(*rows(name))]
        found[name] = spark.createDataFrame(pa.Table.from_arrays(values, names=columns))
    return found


def _line(row, delimiter):
    quoted = ['"' + (value or "").replace('"', '""') + '"' for value in row]
    return delimiter.join(quoted) + "\n"


def _shares(name):
    """File name (without number for the single files) -> rows."""
    dataset, found = DATASETS[name], rows(name)
    if not dataset.split:
        return {dataset.prefix: found}
    return {f"{dataset.prefix}0": found[:3], f"{dataset.prefix}1": found[3:]}


def write_state_registry(path):
    header = ",".join(f"col{i}" for i in range(14)) + "\n"
    text = header + "".join(_line(row, ",") for row in rows("jucees"))
    path.write_text(text, encoding="utf-8")


def write_extracted(root):
    for name in ROWS:
        if name != "jucees":
            for directory, share in _shares(name).items():
                (root / directory).mkdir(parents=True)
                text = "".join(_line(row, ";") for row in share)
                (root / directory / "DATA.CSV").write_bytes(text.encode("ISO-8859-1"))


def write_zipped(root):
    root.mkdir(parents=True)
    for name in ROWS:
        if name != "jucees":
            for stem, share in _shares(name).items():
                text = "".join(_line(row, ";") for row in share)
                with zipfile.ZipFile(root / f"{stem}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("DATA.CSV", text.encode("ISO-8859-1"))
    (root / "Motivos.zip").write_bytes(b"not needed, and not an archive")
