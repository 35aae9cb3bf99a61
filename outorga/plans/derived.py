"""calendario, atributos and data_atual."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outorga.functions.labels import calendar_columns
from outorga.functions.values import conform
from outorga.operators.tables import attribute_values, union_all
from outorga.schemas import MART_SCHEMAS


def calendario(first_days: DataFrame, date: str, last_day: Column) -> DataFrame:
    """One row per day from the earliest ``date`` to ``last_day`` (a literal or a scalar), both
    included."""
    span = first_days.agg(F.min(date).alias("first")).select("first", last_day.alias("last"))
    # First after last leaves no day, where a bare sequence would count downwards.
    span = span.where(F.col("first") <= F.col("last"))
    days = span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("DATA"))
    return conform(days.withColumns(calendar_columns(F.col("DATA"))), MART_SCHEMAS["calendario"])


def atributos(grants: DataFrame, amendments: DataFrame, procurements: DataFrame) -> DataFrame:
    return union_all([
        attribute_values(grants, {
            "SIT_CONVENIO": "SIT_CONVENIO", "NATUREZA_JURIDICA": "NATUREZA_JURIDICA",
            "MODALIDADE": "MODALIDADE_TRANSFERENCIA"}),
        attribute_values(amendments, {"TIPO_PARLAMENTAR": "TIPO_PARLAMENTAR"}),
        attribute_values(procurements, {
            c: c for c in ("MODALIDADE_COMPRA", "TIPO_LICITACAO", "FORMA_LICITACAO", "STATUS_LICITACAO")}),
    ])


def data_atual(spark: SparkSession, day: dt.date) -> DataFrame:
    return spark.range(1).select(F.lit(day).alias("DATA_ATUAL"))
