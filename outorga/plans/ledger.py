"""movimento: seven kinds of money movement in one table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outorga import fixed
from outorga.functions.values import conform, day_first_date, decimal_comma, non_zero
from outorga.operators.joins import bad_suffix_date, correct_dates, date_corrections, keep_known
from outorga.operators.keys import dense_ids
from outorga.operators.tables import union_all
from outorga.schemas import MART_SCHEMAS
from outorga.session import cut_lineage

LEG = ["NR_CONVENIO", "DATA_MOV", "VALOR_MOV", "TIPO_MOV", "FORNECEDOR_ID"]


def _leg(df: DataFrame, kind: str, date, amount, supplier=None) -> DataFrame:
    return df.select(
        F.col("NR_CONVENIO").try_cast("long").alias("NR_CONVENIO"), date.alias("DATA_MOV"),
        amount.alias("VALOR_MOV"), F.lit(kind).alias("TIPO_MOV"),
        (F.lit(fixed.NO_MEMBER_ID) if supplier is None else F.col(supplier)).cast("long").alias("FORNECEDOR_ID"))


def milestone_legs(grants: DataFrame) -> DataFrame:
    """Signature, start and end of every grant at its global value: one scan, three rows each."""
    kinds = {"A": "DIA_ASSIN_CONV", "I": "DIA_INIC_VIGENC_CONV", "F": "DIA_FIM_VIGENC_CONV"}
    moments = F.array(*[F.struct(F.col(c).alias("day"), F.lit(k).alias("kind")) for k, c in kinds.items()])
    rows = grants.select("NR_CONVENIO", "VL_GLOBAL_CONV", F.explode(moments).alias("m"))
    return rows.select(
        "NR_CONVENIO", F.col("m.day").alias("DATA_MOV"), F.col("VL_GLOBAL_CONV").alias("VALOR_MOV"),
        F.col("m.kind").alias("TIPO_MOV"), F.lit(fixed.NO_MEMBER_ID).cast("long").alias("FORNECEDOR_ID"))


def deposit_leg(raw: DataFrame, kind: str, date: str, amount: str, grants: DataFrame) -> DataFrame:
    """Disbursements (D) or counterpart deposits (C): dated, non-zero, of known grants."""
    rows = raw.where(F.col(date).isNotNull() & F.col(amount).isNotNull())
    leg = _leg(rows, kind, day_first_date(F.col(date)), decimal_comma(F.col(amount)))
    leg = keep_known(leg.where(non_zero(F.col("VALOR_MOV"))), "NR_CONVENIO", grants)
    return correct_dates(leg, "NR_CONVENIO", "DATA_MOV", date_corrections(raw.sparkSession, kind))


def payment_leg(payments: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Payments (P) whose raw supplier is found in the dimension under exactly that spelling."""
    rows = payments.where(F.col("DATA_PAG").isNotNull() & non_zero(decimal_comma(F.col("VL_PAGO"))))
    rows = rows.join(suppliers, ["IDENTIF_FORNECEDOR", "NOME_FORNECEDOR"])
    leg = _leg(rows, "P", day_first_date(F.col("DATA_PAG")), decimal_comma(F.col("VL_PAGO")), "FORNECEDOR_ID")
    return correct_dates(leg, "NR_CONVENIO", "DATA_MOV", date_corrections(payments.sparkSession, "P"))


def tax_leg(taxes: DataFrame, payments: DataFrame, grants: DataFrame) -> DataFrame:
    """Taxes (T). The date is the year of a known bad suffix; else the day given, or the grant's
    first payment where none is given, corrected; else the start of the grant."""
    first_paid = payments.groupBy("NR_CONVENIO").agg(F.min("DATA_MOV").alias("_paid"))
    starts = grants.select("NR_CONVENIO", F.col("DIA_INIC_VIGENC_CONV").alias("_start"))
    text = F.col("DATA_TRIBUTO")
    rows = taxes.select(
        F.col("NR_CONVENIO").try_cast("long").alias("NR_CONVENIO"), "DATA_TRIBUTO", "VL_PAG_TRIBUTOS")
    rows = rows.join(first_paid, "NR_CONVENIO", "left").join(starts, "NR_CONVENIO", "left").withColumns({
        "_suffix": bad_suffix_date(text),
        "_day": F.when(text.isNull(), F.col("_paid")).otherwise(day_first_date(text)),
    })
    rows = correct_dates(rows, "NR_CONVENIO", "_day", date_corrections(taxes.sparkSession, "T"))
    day = F.coalesce("_suffix", "_day", F.when(text.isNull(), F.col("_start")))
    return _leg(rows, "T", day, decimal_comma(F.col("VL_PAG_TRIBUTOS")))


Keep = Callable[[DataFrame], DataFrame]


def movements(
    stage: dict[str, DataFrame], grants: DataFrame, suppliers: DataFrame, keep: Keep = cut_lineage, keep_legs: Keep | None = None,
) -> DataFrame:
    """All legs, without ids. The payment leg is used twice, for itself and for the tax dates, and
    it is the widest join of the mart: ``keep`` writes it down and reads it back; ``keep_legs`` the others."""
    payments = keep(payment_leg(stage["pagamentos"], suppliers))
    others = union_all([
        milestone_legs(grants),
        deposit_leg(stage["desembolsos"], "D", "DATA_DESEMBOLSO", "VL_DESEMBOLSADO", grants),
        deposit_leg(stage["contrapartidas"], "C", "DT_INGRESSO_CONTRAPARTIDA", "VL_INGRESSO_CONTRAPARTIDA", grants),
        tax_leg(stage["tributos"], payments, grants),
    ])
    return union_all([others if keep_legs is None else keep_legs(others), payments])


def movimento(
    stage: dict[str, DataFrame], grants: DataFrame, suppliers: DataFrame, keep: Keep = cut_lineage, keep_legs: Keep | None = None,
) -> DataFrame:
    """The ledger. Where ``keep_legs`` writes the legs down, they are shuffled once for their ids."""
    keys = ["DATA_MOV", "TIPO_MOV", "NR_CONVENIO", "FORNECEDOR_ID", "VALOR_MOV"]
    legs = movements(stage, grants, suppliers, keep, keep_legs)
    kept = None if keep_legs is None else lambda rows: rows  # they are written down already
    return conform(dense_ids(legs, "MOV_ID", keys, keep=kept), MART_SCHEMAS["movimento"])
