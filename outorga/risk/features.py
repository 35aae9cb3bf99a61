"""Feature frame of the risk model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outorga import fixed
from outorga.operators.joins import keep_known
from outorga.operators.ranking import principal, top_with_ties

GRANT_COLUMNS = [
    "NR_CONVENIO", "VL_REPASSE_CONV", "VL_CONTRAPARTIDA_CONV", "VALOR_EMENDA_CONVENIO", "OBJETO_PROPOSTA",
    "COD_ORGAO", "COD_ORGAO_SUP", "NATUREZA_JURIDICA", "MODALIDADE", "IDENTIF_PROPONENTE", "COM_EMENDAS",
]
NUMBERS = ["VL_REPASSE_CONV", "VL_CONTRAPARTIDA_CONV", "VALOR_EMENDA_CONVENIO"]
CODES = ["COD_ORGAO", "COD_ORGAO_SUP", "CODIGO_IBGE"]
TEXTS = [
    "OBJETO_PROPOSTA", "NATUREZA_JURIDICA", "MODALIDADE", "IDENTIF_PROPONENTE", "COM_EMENDAS",
    "PRINCIPAL_PARLAMENTAR", "PRINCIPAL_FORNECEDOR",
]


def live(grants: DataFrame) -> DataFrame:
    return grants.where(F.lower("SIT_CONVENIO") == fixed.LIVE_STATUS)


def finished(grants: DataFrame) -> DataFrame:
    """Grants whose outcome is known: those to learn from."""
    return grants.where(F.coalesce(F.lower("SIT_CONVENIO") != fixed.LIVE_STATUS, F.lit(True)))


def failure_label(status: Column) -> Column:
    failed = [s.upper() for s in fixed.FAILED_STATUSES]
    return F.when(F.upper(status).isin(failed), 1).otherwise(0)


def principal_politician(bridge: DataFrame, amendments: DataFrame) -> DataFrame:
    """Politician of the largest transfer of each grant, the last name among ties. A transfer of an
    unknown amendment can still be the largest, and then names nobody."""
    names = amendments.select("NR_EMENDA", "NOME_PARLAMENTAR")
    return principal(
        bridge.join(names, "NR_EMENDA", "left"), "NR_CONVENIO", "VALOR_REPASSE_EMENDA", "NOME_PARLAMENTAR",
        "PRINCIPAL_PARLAMENTAR")


def principal_supplier(ledger: DataFrame, suppliers: DataFrame, gathered: bool = False) -> DataFrame:
    """Supplier paid most by each grant, the last identification among ties. Only the winners meet
    the supplier dimension. ``gathered`` says that the ledger comes from a join on the grant."""
    paid = ledger.where(F.col("TIPO_MOV") == "P").groupBy("NR_CONVENIO", "FORNECEDOR_ID").agg(
        F.coalesce(F.sum("VALOR_MOV"), F.lit(0)).alias("paid"))
    # not an inner join: its "id is not null" would go down to one of the two reads of the payments that the winners take,
    # and two reads that differ are shuffled twice
    named = suppliers.select("FORNECEDOR_ID", "IDENTIF_FORNECEDOR", F.lit(True).alias("_found"))
    best = top_with_ties(paid, "NR_CONVENIO", "paid", gathered).join(named, "FORNECEDOR_ID", "left")
    return best.groupBy("NR_CONVENIO").agg(
        F.max("IDENTIF_FORNECEDOR").alias("PRINCIPAL_FORNECEDOR"), F.max("_found").alias("_found")).where("_found").drop("_found")


def principals(mart: dict[str, DataFrame], keys: DataFrame, gathered: bool = False) -> dict[str, DataFrame]:
    """Principal politician and supplier of the grants in ``keys`` (NR_CONVENIO). ``gathered`` leaves the payments where
    their join with the keys has brought them."""
    bridge = keep_known(mart["emendas_convenios"], "NR_CONVENIO", keys)
    ledger = keep_known(mart["movimento"], "NR_CONVENIO", keys)
    return {
        "politicians": principal_politician(bridge, mart["emendas"]),
        "paid_most": principal_supplier(ledger, mart["fornecedores"], gathered)}


def feature_frame(grants: DataFrame, mart: dict[str, DataFrame], label: bool = False) -> DataFrame:
    """Ten grant columns, municipality, principal politician and supplier; text nulls filled. A
    proponent with several municipalities gives several rows. A mart that has the ``principals`` of all its grants is
    not asked for its transfers and payments again."""
    chosen = grants.select(*GRANT_COLUMNS, *([failure_label(F.col("SIT_CONVENIO")).alias("LABEL")] if label else []))
    keys = chosen.select("NR_CONVENIO").distinct()
    best = mart if "paid_most" in mart else principals(mart, keys)
    frame = (
        chosen.join(mart["proponentes"].select("IDENTIF_PROPONENTE", "CODIGO_IBGE"), "IDENTIF_PROPONENTE")
        .join(best["politicians"], "NR_CONVENIO", "left")
        .join(best["paid_most"], "NR_CONVENIO", "left"))
    return frame.select(
        "NR_CONVENIO", *[F.col(c).cast("double").alias(c) for c in NUMBERS], *CODES,
        *[F.coalesce(c, F.lit(fixed.NO_MEMBER)).alias(c) for c in TEXTS], *(["LABEL"] if label else []))


def filled(frame: DataFrame) -> DataFrame:
    """Add what a model takes, under names of its own: numbers with 0 for null, a flag of each that was null, and
    codes with a category for null. No row is lost."""
    return frame.withColumns({
        **{f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMBERS},
        **{f"_{c}_FALTA": F.col(c).isNull().cast("double") for c in NUMBERS},
        **{f"_{c}": F.coalesce(F.col(c).cast("string"), F.lit(fixed.NO_MEMBER)) for c in CODES}})
