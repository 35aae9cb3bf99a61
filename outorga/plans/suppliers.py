"""fornecedores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outorga import fixed
from outorga.functions.values import conform, decimal_comma, non_zero
from outorga.operators.joins import keep_known, null_safe_join
from outorga.operators.keys import dense_ids
from outorga.operators.tables import append_member
from outorga.schemas import MART_SCHEMAS

NAMES = ["IDENTIF_FORNECEDOR", "NOME_FORNECEDOR"]


def paid_suppliers(stage: dict[str, DataFrame], grants: DataFrame) -> DataFrame:
    """Distinct supplier names of non-zero payments of known grants. Where a bank transfer names
    the beneficiary of a movement, the beneficiary and its amount stand instead of the payment's.

    Only distinct names are wanted, so the two sides never need to be paired row by row: transfers
    that belong to a payment, plus payments that have no transfer. Many transfers or payments of
    one movement (a null movement included) multiply nothing.
    """
    payments = stage["pagamentos"].where(F.col("DATA_PAG").isNotNull()).select(
        F.col("NR_CONVENIO").try_cast("long").alias("NR_CONVENIO"), "NR_MOV_FIN", *NAMES, "VL_PAGO")
    payments = keep_known(payments, "NR_CONVENIO", grants)
    transfers = stage["obtv"].where(F.col("IDENTIF_FAVORECIDO_OBTV_CONV").isNotNull()).select(
        "NR_MOV_FIN", F.col("IDENTIF_FAVORECIDO_OBTV_CONV").alias(NAMES[0]),
        F.col("NM_FAVORECIDO_OBTV_CONV").alias(NAMES[1]), F.col("VL_PAGO_OBTV_CONV").alias("VL_PAGO"))
    by_transfer = null_safe_join(transfers, payments.select("NR_MOV_FIN").distinct(), "NR_MOV_FIN", "left_semi")
    by_payment = null_safe_join(payments, transfers.select("NR_MOV_FIN").distinct(), "NR_MOV_FIN", "left_anti")

    def names(df: DataFrame) -> DataFrame:
        return df.where(non_zero(decimal_comma(F.col("VL_PAGO")))).select(
            F.upper(F.coalesce(NAMES[0], F.lit(fixed.UNSPECIFIED_F))).alias(NAMES[0]),
            F.upper(F.coalesce(NAMES[1], F.lit(fixed.UNSPECIFIED_M))).alias(NAMES[1]))

    return names(by_transfer).unionByName(names(by_payment)).distinct()


def fornecedores(stage: dict[str, DataFrame], grants: DataFrame) -> DataFrame:
    numbered = dense_ids(paid_suppliers(stage, grants), "FORNECEDOR_ID", NAMES, unique=True)
    return append_member(
        conform(numbered, MART_SCHEMAS["fornecedores"]),
        FORNECEDOR_ID=fixed.NO_MEMBER_ID, IDENTIF_FORNECEDOR=fixed.NO_MEMBER, NOME_FORNECEDOR=fixed.NO_MEMBER)
