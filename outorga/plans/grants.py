"""proponentes, the amendment tables and the central grants fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outorga import fixed
from outorga.functions.text import yes_no
from outorga.functions.values import conform, decimal_comma, year_and_number
from outorga.operators.joins import keep_known
from outorga.operators.tables import group_sum
from outorga.schemas import MART_SCHEMAS


def shared_grants(stage: dict[str, DataFrame]) -> DataFrame:
    """Granted proposals with the columns that the fact and the amendments need, for a run to write down once."""
    return shared_rows(stage).distinct()


def shared_rows(stage: dict[str, DataFrame]) -> DataFrame:
    """Those of ``shared_grants`` with their copies, for users who take each different one of what they choose anyway."""
    return granted_rows(stage, list(dict.fromkeys(["ID_PROPOSTA", *FACT_COLUMNS])))


def known_grants(stage: dict[str, DataFrame]) -> DataFrame:
    """NR_CONVENIO of every grant of the fact, for those who only ask whether a grant is known."""
    return granted_proposals(stage, ["NR_CONVENIO"]).select(F.col("NR_CONVENIO").try_cast("long").alias("NR_CONVENIO")).distinct()


def proponentes(stage: dict[str, DataFrame]) -> DataFrame:
    """Proponents that hold a grant, with the municipality of each proposal. Only whether a
    proposal has a grant matters, so grants come in as a semi-join."""
    proposals = stage["propostas"].select("ID_PROPOSTA", "IDENTIF_PROPONENTE", F.col("COD_MUNIC_IBGE").alias("CODIGO_IBGE"))
    granted = keep_known(proposals, "ID_PROPOSTA", stage["convenios"]).drop("ID_PROPOSTA").distinct()
    rows = granted.join(stage["proponentes"], "IDENTIF_PROPONENTE").select(*MART_SCHEMAS["proponentes"].names)
    return conform(rows.distinct(), MART_SCHEMAS["proponentes"])


def granted_rows(stage: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Grants with their proposal, for known proponents. The proponent's name is not used, so the
    proponents only filter: several names of one proponent multiply nothing."""
    proposals = keep_known(stage["propostas"], "IDENTIF_PROPONENTE", stage["proponentes"])
    return stage["convenios"].join(proposals, "ID_PROPOSTA").select(*columns)


def granted_proposals(stage: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Each different one of the granted rows."""
    return granted_rows(stage, columns).distinct()


def amendment_transfers(stage: dict[str, DataFrame], granted: DataFrame | None = None) -> DataFrame:
    """One row per amendment line and grant; amounts stay text because lines are told apart by
    their text. ``granted`` are granted proposals that are written down already."""
    lines = stage["emendas"].where(F.col("NR_EMENDA").isNotNull())
    years = stage["propostas"].select("ID_PROPOSTA", "ANO_PROP").distinct()
    lines = lines.join(years, "ID_PROPOSTA").distinct()
    wanted = ["ID_PROPOSTA", "NR_CONVENIO"]
    grants = granted_proposals(stage, wanted) if granted is None else granted.select(*wanted).distinct()
    return lines.join(grants, "ID_PROPOSTA").select(
        year_and_number(F.col("ANO_PROP"), F.col("NR_EMENDA")).alias("NR_EMENDA"), "NR_CONVENIO",
        "NOME_PARLAMENTAR", "TIPO_PARLAMENTAR", "VALOR_REPASSE_EMENDA")


def emendas_convenios(transfers: DataFrame) -> DataFrame:
    bridge = transfers.select("NR_EMENDA", "NR_CONVENIO", "VALOR_REPASSE_EMENDA").distinct()
    return conform(
        bridge.withColumn("VALOR_REPASSE_EMENDA", decimal_comma(F.col("VALOR_REPASSE_EMENDA"))),
        MART_SCHEMAS["emendas_convenios"])


def emendas(transfers: DataFrame) -> DataFrame:
    lines = transfers.select("NR_EMENDA", "NOME_PARLAMENTAR", "TIPO_PARLAMENTAR", "VALOR_REPASSE_EMENDA").distinct()
    lines = lines.withColumn("VALOR_EMENDA", decimal_comma(F.col("VALOR_REPASSE_EMENDA"))).fillna(
        {"NOME_PARLAMENTAR": fixed.UNSPECIFIED_M, "TIPO_PARLAMENTAR": fixed.UNSPECIFIED_M})
    return conform(
        group_sum(lines, ["NR_EMENDA", "NOME_PARLAMENTAR", "TIPO_PARLAMENTAR"], "VALOR_EMENDA"),
        MART_SCHEMAS["emendas"])


FACT_COLUMNS = [c for c in MART_SCHEMAS["convenios"].names
                if c not in ("COM_EMENDAS", "VALOR_EMENDA_CONVENIO", "INSUCESSO")]


def convenios(
    stage: dict[str, DataFrame], bridge: DataFrame, granted: DataFrame | None = None,
    different: Callable[[DataFrame], DataFrame] = DataFrame.distinct,
) -> DataFrame:
    """Every grant with its amendment total and flag: both from one grouped side, in one join. ``granted`` are granted
    rows that are written down already, of which ``different`` drops the copies; their dates and amounts are typed
    before the join, as they move as 8 bytes then."""
    if granted is None:
        grants = granted_proposals(stage, FACT_COLUMNS).withColumn("NR_CONVENIO", F.col("NR_CONVENIO").try_cast("long"))
    else:
        typed = T.StructType([f for f in MART_SCHEMAS["convenios"].fields if f.name in FACT_COLUMNS])
        grants = conform(_cleaned(different(granted.select(*FACT_COLUMNS))), typed)
    totals = group_sum(bridge, ["NR_CONVENIO"], "VALOR_REPASSE_EMENDA", "VALOR_EMENDA_CONVENIO")
    zero = F.lit(0).cast("decimal(18,2)")
    fact = grants.join(totals, "NR_CONVENIO", "left").withColumns({
        "COM_EMENDAS": yes_no(F.col("VALOR_EMENDA_CONVENIO").isNotNull()),
        "VALOR_EMENDA_CONVENIO": F.coalesce("VALOR_EMENDA_CONVENIO", zero),
        "INSUCESSO": F.lit(0.0),
    })
    return conform(_cleaned(fact) if granted is None else fact, MART_SCHEMAS["convenios"])


def _cleaned(grants: DataFrame) -> DataFrame:
    return grants.withColumns({
        "SIT_CONVENIO": F.upper(F.coalesce("SIT_CONVENIO", F.lit(fixed.UNDEFINED_F))),
        "INSTRUMENTO_ATIVO": F.upper("INSTRUMENTO_ATIVO"),
        "NATUREZA_JURIDICA": F.upper("NATUREZA_JURIDICA"),
        **{c: decimal_comma(F.col(c)) for c in ("VL_GLOBAL_CONV", "VL_REPASSE_CONV", "VL_CONTRAPARTIDA_CONV")},
    })


def dated_grants(stage: dict[str, DataFrame]) -> DataFrame:
    """The fact as far as the ledger needs it: without amendments, which the ledger never looks at."""
    spark = stage["convenios"].sparkSession
    return convenios(stage, spark.createDataFrame([], MART_SCHEMAS["emendas_convenios"]))
