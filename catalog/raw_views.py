"""Raw register extracts derived from the driver's typed tables: all text, day-first dates,
decimal commas, and the nulls, orphans and odd codes the cleaning rules are there for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outorga.schemas import STAGE_COLUMNS

STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]
REGIONS = ["norte", "nordeste", "centro_oeste", "sudeste", "sul"]


def day_text(c: Column | str, plus: int = 0) -> Column:
    day = (F.col(c) if isinstance(c, str) else c).cast("date")
    return F.date_format(F.date_add(day, plus), "dd/MM/yyyy")


def money_text(c: Column | str) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return F.replace(value.cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


def every(c: str, n: int, remainder: int = 0) -> Column:
    return F.col(c) % n == remainder


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")"), (index + 1).cast("int"))


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _estados(t) -> DataFrame:
    return t("nation").select(
        text("n_nationkey").alias("codigo_uf"), pick(STATES, F.col("n_nationkey")).alias("uf"),
        F.col("n_name").alias("nome"),
        F.when(F.col("n_nationkey") == 24, "litoral").otherwise(pick(REGIONS, F.col("n_regionkey"))).alias("regiao"))


def _municipios(t) -> DataFrame:
    return t("supplier").select(
        text("s_suppkey").alias("codigo_ibge"), F.col("s_name").alias("nome"),
        F.when(~every("s_suppkey", 7), money_text("s_acctbal")).alias("latitude"),
        money_text(-F.col("s_acctbal")).alias("longitude"),
        F.when(every("s_suppkey", 10), "1").otherwise("0").alias("capital"),
        F.when(every("s_suppkey", 37), "99").otherwise(text("s_nationkey")).alias("codigo_uf"))


def _proponentes(t) -> DataFrame:
    names = F.array(
        F.col("c_name"),
        F.when(every("c_custkey", 50), F.concat(F.upper("c_name"), F.lit(" II"))),
        F.when(every("c_custkey", 40), F.concat(F.lit("\t  "), F.col("c_name"), F.lit(" "))))
    return t("customer").select(
        text("c_custkey").alias("IDENTIF_PROPONENTE"), F.explode(F.array_compact(names)).alias("NM_PROPONENTE"))


def _propostas(t) -> DataFrame:
    town = F.col("o_custkey") % 1500
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        text("o_orderkey").alias("ID_PROPOSTA"),
        F.when(~every("o_orderkey", 149), text(town)).alias("COD_MUNIC_IBGE"),
        text(1000 + F.col("o_custkey") % 20).alias("COD_ORGAO_SUP"),
        F.concat(F.lit("Ministry "), text(F.col("o_custkey") % 20)).alias("DESC_ORGAO_SUP"),
        F.lower("c_mktsegment").alias("NATUREZA_JURIDICA"),
        text(2000 + F.col("o_custkey") % 40).alias("COD_ORGAO"),
        F.concat(F.lit("Agency "), text(F.col("o_custkey") % 40)).alias("DESC_ORGAO"),
        F.col("o_orderpriority").alias("MODALIDADE"),
        F.when(every("o_custkey", 101), F.concat(F.lit("X"), text("o_custkey"))).otherwise(
            text("o_custkey")).alias("IDENTIF_PROPONENTE"),
        F.concat_ws(" ", "o_orderpriority", "c_mktsegment").alias("OBJETO_PROPOSTA"),
        text(F.year(F.col("o_orderdate").cast("date"))).alias("ANO_PROP"),
        pick(STATES, (F.col("c_nationkey") + F.col("o_custkey") % 3) % 27).alias("UF_PROPONENTE"),
        F.concat(F.lit("Town "), text(town)).alias("MUNIC_PROPONENTE"))


def _convenios(t) -> DataFrame:
    key = "o_orderkey"
    status = (
        F.when(every(key, 11), None).when(F.col("o_orderstatus") == "O", "Em execução")
        .when(every(key, 5), "Prestação de Contas Rejeitada").when(every(key, 5, 1), "Inadimplente")
        .when(every(key, 5, 2), "Convênio Rescindido").otherwise("Prestação de Contas Aprovada"))
    total = F.col("o_totalprice").cast("decimal(18,2)")
    return t("orders").select(
        text(key).alias("NR_CONVENIO"), text(key).alias("ID_PROPOSTA"),
        F.when(~every(key, 17), day_text("o_orderdate")).alias("DIA_ASSIN_CONV"),
        status.alias("SIT_CONVENIO"),
        F.when(every(key, 2), "Sim").when(every(key, 3), "Não").otherwise("NÃO").alias("INSTRUMENTO_ATIVO"),
        F.when(~every(key, 13), day_text("o_orderdate", 1)).alias("DIA_PUBL_CONV"),
        day_text("o_orderdate", 10).alias("DIA_INIC_VIGENC_CONV"),
        day_text("o_orderdate", 400).alias("DIA_FIM_VIGENC_CONV"),
        F.when(~every(key, 19), day_text("o_orderdate", 460)).alias("DIA_LIMITE_PREST_CONTAS"),
        money_text(total).alias("VL_GLOBAL_CONV"), money_text(total - 10).alias("VL_REPASSE_CONV"),
        F.lit("10,00").alias("VL_CONTRAPARTIDA_CONV"))


def _emendas(t) -> DataFrame:
    part = F.col("l_partkey")
    return t("lineitem").where(F.col("l_returnflag") == "R").select(
        text("l_orderkey").alias("ID_PROPOSTA"),
        F.when(~every("l_partkey", 23), text(part)).alias("NR_EMENDA"),
        F.when(~every("l_partkey", 17), F.concat(F.lit("P"), text(part % 50))).alias("NOME_PARLAMENTAR"),
        F.when(every("l_partkey", 3), "INDIVIDUAL").when(every("l_partkey", 3, 1), "BANCADA").alias("TIPO_PARLAMENTAR"),
        F.when(F.col("l_linenumber") != 7, money_text("l_extendedprice")).alias("VALOR_REPASSE_EMENDA"))


def _movement_number() -> Column:
    return text(F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def _desembolsos(t) -> DataFrame:
    return t("lineitem").where(F.col("l_linestatus") == "O").select(
        _movement_number().alias("ID_DESEMBOLSO"), text("l_orderkey").alias("NR_CONVENIO"),
        F.when(~every("l_partkey", 41), day_text("l_shipdate")).alias("DATA_DESEMBOLSO"),
        F.when(F.col("l_quantity") == 1, "0,00").when(
            ~every("l_partkey", 43), money_text("l_extendedprice")).alias("VL_DESEMBOLSADO"))


def _contrapartidas(t) -> DataFrame:
    return t("lineitem").where(F.col("l_linestatus") == "F").select(
        text("l_orderkey").alias("NR_CONVENIO"),
        F.when(~every("l_partkey", 41), day_text("l_shipdate")).alias("DT_INGRESSO_CONTRAPARTIDA"),
        F.when(F.col("l_quantity") == 1, "0,00").when(
            ~every("l_partkey", 43), money_text("l_extendedprice")).alias("VL_INGRESSO_CONTRAPARTIDA"))


def _tributos(t) -> DataFrame:
    bad = F.concat(F.date_format(F.col("l_shipdate").cast("date"), "dd/MM"), F.lit("/0209"))
    amount = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)")
    return t("lineitem").where(F.col("l_tax") > 0).select(
        text("l_orderkey").alias("NR_CONVENIO"),
        F.when(every("l_linenumber", 3), None).when(every("l_partkey", 10), bad).otherwise(
            day_text("l_shipdate")).alias("DATA_TRIBUTO"),
        money_text(amount).alias("VL_PAG_TRIBUTOS"))


def _pagamentos(t) -> DataFrame:
    supplier = text("l_suppkey")
    return t("lineitem").select(
        F.when(~every("l_partkey", 97), _movement_number()).alias("NR_MOV_FIN"),
        text("l_orderkey").alias("NR_CONVENIO"),
        F.when(~every("l_suppkey", 31), supplier).alias("IDENTIF_FORNECEDOR"),
        F.when(every("l_suppkey", 5), F.concat(F.lit("Supplier "), supplier)).otherwise(
            F.concat(F.lit("SUPPLIER "), supplier)).alias("NOME_FORNECEDOR"),
        F.when((F.col("l_linenumber") != 6) | every("l_partkey", 2), day_text("l_shipdate")).alias("DATA_PAG"),
        F.when(F.col("l_quantity") == 1, "0,00").otherwise(money_text("l_extendedprice")).alias("VL_PAGO"))


def _obtv(t) -> DataFrame:
    rows = t("lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
    rows = rows.groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("part"), F.min("l_extendedprice").alias("price"))
    return rows.select(
        F.when(~every("l_orderkey", 211), text(F.col("l_orderkey") * 10 + 1)).alias("NR_MOV_FIN"),
        F.when(~every("part", 29), F.concat(F.lit("B"), text("part"))).alias("IDENTIF_FAVORECIDO_OBTV_CONV"),
        F.when(~every("part", 19), F.concat(F.lit("Benef "), text("part"))).alias("NM_FAVORECIDO_OBTV_CONV"),
        F.lit("Material").alias("TP_AQUISICAO"), money_text("price").alias("VL_PAGO_OBTV_CONV"))


def _licitacoes(t) -> DataFrame:
    key = "p_partkey"
    kinds = [
        F.concat(F.lit("Presencial - "), F.col("p_name")), F.lit("Eletrônico - Registro de Preço"),
        F.lit("ELETRONICO Menor Preço"), F.lit("Melhor técnica"), F.lit("Técnica e Preço"), F.lit("123"),
        F.lit(None).cast("string"), F.lit("menor preço e melhor tecnica"), F.lit("Tecnica e preco registro de preco")]
    status = F.when(~every(key, 8), F.col("p_brand"))
    # Every 50th row comes twice, with a status that differs in case only.
    statuses = F.when(every(key, 50), F.array(status, F.lower(status))).otherwise(F.array(status))
    return t("part").select(
        text(key).alias("ID_LICITACAO"), text(F.col(key) * 9).alias("NR_CONVENIO"),
        F.when(every(key, 7), "12").when(every(key, 7, 2), "34").when(
            ~every(key, 7, 1), F.col("p_type")).alias("MODALIDADE_LICITACAO"),
        F.when(every(key, 3, 1), "Eletrônica").when(every(key, 3, 2), "5").alias("TP_PROCESSO_COMPRA"),
        F.element_at(F.array(*kinds), (F.col(key) % 9 + 1).cast("int")).alias("TIPO_LICITACAO"),
        F.explode(statuses).alias("STATUS_LICITACAO"),
        F.when(~every(key, 6), money_text("p_retailprice")).alias("VALOR_LICITACAO"))


VIEWS = {
    "estados": _estados, "municipios": _municipios, "proponentes": _proponentes, "propostas": _propostas,
    "convenios": _convenios, "emendas": _emendas, "desembolsos": _desembolsos,
    "contrapartidas": _contrapartidas, "tributos": _tributos, "pagamentos": _pagamentos, "obtv": _obtv,
    "licitacoes": _licitacoes,
}


def raw(table: Callable[[str], DataFrame], name: str) -> DataFrame:
    """A raw view over the typed tables that ``table`` reads by name."""
    return VIEWS[name](table).select(*STAGE_COLUMNS[name])
