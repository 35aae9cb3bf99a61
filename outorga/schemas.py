"""Stage columns, mart schemas and the data contract of every mart table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG, TEXT, DATE, DOUBLE = T.LongType(), T.StringType(), T.DateType(), T.DoubleType()
MONEY = T.DecimalType(18, 2)

# --------------------------------------------------------------------------
# Columns kept from each raw extract. Stage tables are all text.
# --------------------------------------------------------------------------
STAGE_COLUMNS: dict[str, list[str]] = {
    "estados": ["codigo_uf", "uf", "nome", "regiao"],
    "municipios": ["codigo_ibge", "nome", "latitude", "longitude", "capital", "codigo_uf"],
    "proponentes": ["IDENTIF_PROPONENTE", "NM_PROPONENTE"],
    "propostas": [
        "ID_PROPOSTA", "COD_MUNIC_IBGE", "COD_ORGAO_SUP", "DESC_ORGAO_SUP", "NATUREZA_JURIDICA",
        "COD_ORGAO", "DESC_ORGAO", "MODALIDADE", "IDENTIF_PROPONENTE", "OBJETO_PROPOSTA",
        "ANO_PROP", "UF_PROPONENTE", "MUNIC_PROPONENTE",
    ],
    "convenios": [
        "NR_CONVENIO", "ID_PROPOSTA", "DIA_ASSIN_CONV", "SIT_CONVENIO", "INSTRUMENTO_ATIVO",
        "DIA_PUBL_CONV", "DIA_INIC_VIGENC_CONV", "DIA_FIM_VIGENC_CONV", "DIA_LIMITE_PREST_CONTAS",
        "VL_GLOBAL_CONV", "VL_REPASSE_CONV", "VL_CONTRAPARTIDA_CONV",
    ],
    "emendas": [
        "ID_PROPOSTA", "NR_EMENDA", "NOME_PARLAMENTAR", "TIPO_PARLAMENTAR", "VALOR_REPASSE_EMENDA",
    ],
    "desembolsos": ["ID_DESEMBOLSO", "NR_CONVENIO", "DATA_DESEMBOLSO", "VL_DESEMBOLSADO"],
    "contrapartidas": ["NR_CONVENIO", "DT_INGRESSO_CONTRAPARTIDA", "VL_INGRESSO_CONTRAPARTIDA"],
    "tributos": ["NR_CONVENIO", "DATA_TRIBUTO", "VL_PAG_TRIBUTOS"],
    "pagamentos": [
        "NR_MOV_FIN", "NR_CONVENIO", "IDENTIF_FORNECEDOR", "NOME_FORNECEDOR", "DATA_PAG", "VL_PAGO",
    ],
    "obtv": [
        "NR_MOV_FIN", "IDENTIF_FAVORECIDO_OBTV_CONV", "NM_FAVORECIDO_OBTV_CONV", "TP_AQUISICAO",
        "VL_PAGO_OBTV_CONV",
    ],
    "licitacoes": [
        "ID_LICITACAO", "NR_CONVENIO", "MODALIDADE_LICITACAO", "TP_PROCESSO_COMPRA",
        "TIPO_LICITACAO", "STATUS_LICITACAO", "VALOR_LICITACAO",
    ],
}

# Stage rules: rows with a null here are dropped; tables outside DISTINCT keep duplicates.
STAGE_REQUIRED = {
    "convenios": ["DIA_ASSIN_CONV", "DIA_PUBL_CONV"],
    "obtv": ["IDENTIF_FAVORECIDO_OBTV_CONV"],
}
STAGE_NOT_DISTINCT = {"licitacoes"}
COMMA_SEPARATED = {"estados", "municipios"}


def stage_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, TEXT) for c in STAGE_COLUMNS[table]])


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


MART_SCHEMAS: dict[str, T.StructType] = {
    "estados": _struct(("SIGLA", TEXT), ("NOME", TEXT), ("REGIAO", TEXT), ("REGIAO_ABREVIADA", TEXT)),
    "municipios": _struct(
        ("CODIGO_IBGE", LONG), ("NOME_MUNICIPIO", TEXT), ("UF", TEXT), ("REGIAO", TEXT),
        ("REGIAO_ABREVIADA", TEXT), ("NOME_ESTADO", TEXT), ("LATITUDE", DOUBLE),
        ("LONGITUDE", DOUBLE), ("CAPITAL", TEXT),
    ),
    "proponentes": _struct(("IDENTIF_PROPONENTE", TEXT), ("NM_PROPONENTE", TEXT), ("CODIGO_IBGE", LONG)),
    "emendas": _struct(
        ("NR_EMENDA", LONG), ("NOME_PARLAMENTAR", TEXT), ("TIPO_PARLAMENTAR", TEXT), ("VALOR_EMENDA", MONEY),
    ),
    "emendas_convenios": _struct(("NR_EMENDA", LONG), ("NR_CONVENIO", LONG), ("VALOR_REPASSE_EMENDA", MONEY)),
    "convenios": _struct(
        ("NR_CONVENIO", LONG), ("DIA_ASSIN_CONV", DATE), ("SIT_CONVENIO", TEXT),
        ("INSTRUMENTO_ATIVO", TEXT), ("DIA_PUBL_CONV", DATE), ("DIA_INIC_VIGENC_CONV", DATE),
        ("DIA_FIM_VIGENC_CONV", DATE), ("DIA_LIMITE_PREST_CONTAS", DATE), ("VL_GLOBAL_CONV", MONEY),
        ("VL_REPASSE_CONV", MONEY), ("VL_CONTRAPARTIDA_CONV", MONEY), ("COD_ORGAO_SUP", LONG),
        ("DESC_ORGAO_SUP", TEXT), ("NATUREZA_JURIDICA", TEXT), ("COD_ORGAO", LONG),
        ("DESC_ORGAO", TEXT), ("MODALIDADE", TEXT), ("IDENTIF_PROPONENTE", TEXT),
        ("OBJETO_PROPOSTA", TEXT), ("VALOR_EMENDA_CONVENIO", MONEY), ("COM_EMENDAS", TEXT),
        ("INSUCESSO", DOUBLE),
    ),
    "licitacoes": _struct(
        ("ID_LICITACAO", LONG), ("NR_CONVENIO", LONG), ("MODALIDADE_COMPRA", TEXT),
        ("TIPO_LICITACAO", TEXT), ("FORMA_LICITACAO", TEXT), ("REGISTRO_PRECOS", TEXT),
        ("LICITACAO_INTERNACIONAL", TEXT), ("STATUS_LICITACAO", TEXT), ("VALOR_LICITACAO", MONEY),
    ),
    "fornecedores": _struct(("FORNECEDOR_ID", LONG), ("IDENTIF_FORNECEDOR", TEXT), ("NOME_FORNECEDOR", TEXT)),
    "movimento": _struct(
        ("MOV_ID", LONG), ("NR_CONVENIO", LONG), ("DATA_MOV", DATE), ("VALOR_MOV", MONEY),
        ("TIPO_MOV", TEXT), ("FORNECEDOR_ID", LONG),
    ),
    "calendario": _struct(
        ("DATA", DATE), ("ANO", LONG), ("MES_NUMERO", LONG), ("MES_NOME", TEXT),
        ("ANO_MES_NUMERO", LONG), ("MES_ANO", TEXT), ("MES_NOME_ANO", TEXT),
        ("TRIMESTRE_NUMERO", LONG), ("TRIMESTRE_NOME", TEXT), ("ANO_TRIMESTRE_NUMERO", LONG),
        ("TRIMESTRE_ANO", TEXT), ("TRIMESTRE_NOME_ANO", TEXT), ("SEMANA_NUMERO", LONG),
        ("SEMANA_NOME", TEXT), ("ANO_SEMANA_NUMERO", LONG), ("SEMANA_ANO", TEXT),
        ("SEMANA_NOME_ANO", TEXT), ("DIA_DA_SEMANA", TEXT),
    ),
    "atributos": _struct(("ATRIBUTO", TEXT), ("VALOR", TEXT)),
    "data_atual": _struct(("DATA_ATUAL", DATE)),
}

# Order in which targets are loaded.
LOAD_ORDER = [
    "estados", "municipios", "proponentes", "emendas", "emendas_convenios", "licitacoes",
    "calendario", "convenios", "fornecedores", "movimento", "atributos", "data_atual",
]


@dataclass(frozen=True)
class Contract:
    """What the relational target demands of one mart table."""

    key: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()

    def not_null(self, table: str) -> list[str]:
        return [c for c in MART_SCHEMAS[table].names if c not in self.nullable]


# --------------------------------------------------------------------------
# Keys, nullable columns and text lengths of the target.
# --------------------------------------------------------------------------
CONTRACTS: dict[str, Contract] = {
    "estados": Contract(
        ("SIGLA",), (), (("SIGLA", 2), ("NOME", 30), ("REGIAO", 12), ("REGIAO_ABREVIADA", 2))),
    "municipios": Contract(
        ("CODIGO_IBGE",), ("LATITUDE", "LONGITUDE"),
        (("NOME_MUNICIPIO", 60), ("UF", 2), ("REGIAO", 12), ("REGIAO_ABREVIADA", 2),
         ("NOME_ESTADO", 30), ("CAPITAL", 3))),
    "proponentes": Contract(
        ("IDENTIF_PROPONENTE",), (), (("IDENTIF_PROPONENTE", 14), ("NM_PROPONENTE", 150))),
    "emendas": Contract(("NR_EMENDA",), (), (("NOME_PARLAMENTAR", 60), ("TIPO_PARLAMENTAR", 20))),
    "emendas_convenios": Contract(),
    "convenios": Contract(
        ("NR_CONVENIO",),
        ("DIA_PUBL_CONV", "DIA_LIMITE_PREST_CONTAS", "DESC_ORGAO_SUP", "OBJETO_PROPOSTA"),
        (("SIT_CONVENIO", 80), ("INSTRUMENTO_ATIVO", 3), ("DESC_ORGAO_SUP", 80),
         ("NATUREZA_JURIDICA", 60), ("DESC_ORGAO", 80), ("MODALIDADE", 20),
         ("IDENTIF_PROPONENTE", 14), ("COM_EMENDAS", 3))),
    "licitacoes": Contract(
        ("ID_LICITACAO",), (),
        (("MODALIDADE_COMPRA", 50), ("TIPO_LICITACAO", 20), ("FORMA_LICITACAO", 20),
         ("REGISTRO_PRECOS", 3), ("LICITACAO_INTERNACIONAL", 3), ("STATUS_LICITACAO", 15))),
    "fornecedores": Contract(
        ("FORNECEDOR_ID",), (), (("IDENTIF_FORNECEDOR", 40), ("NOME_FORNECEDOR", 150))),
    "movimento": Contract(("MOV_ID", "DATA_MOV"), (), (("TIPO_MOV", 1),)),
    "calendario": Contract(
        ("DATA",), (),
        (("MES_NOME", 10), ("MES_ANO", 7), ("MES_NOME_ANO", 15), ("TRIMESTRE_NOME", 12),
         ("TRIMESTRE_ANO", 7), ("TRIMESTRE_NOME_ANO", 17), ("SEMANA_NOME", 10), ("SEMANA_ANO", 7),
         ("SEMANA_NOME_ANO", 15), ("DIA_DA_SEMANA", 13))),
    "atributos": Contract((), (), (("ATRIBUTO", 30), ("VALOR", 100))),
    "data_atual": Contract(),
}

# (table, column) values that must exist in (table, column).
REFERENCES = [
    (("convenios", "IDENTIF_PROPONENTE"), ("proponentes", "IDENTIF_PROPONENTE")),
    (("licitacoes", "NR_CONVENIO"), ("convenios", "NR_CONVENIO")),
    (("movimento", "NR_CONVENIO"), ("convenios", "NR_CONVENIO")),
    (("movimento", "FORNECEDOR_ID"), ("fornecedores", "FORNECEDOR_ID")),
    (("movimento", "DATA_MOV"), ("calendario", "DATA")),
    (("emendas_convenios", "NR_EMENDA"), ("emendas", "NR_EMENDA")),
    (("emendas_convenios", "NR_CONVENIO"), ("convenios", "NR_CONVENIO")),
    (("proponentes", "CODIGO_IBGE"), ("municipios", "CODIGO_IBGE")),
    (("municipios", "UF"), ("estados", "SIGLA")),
]
