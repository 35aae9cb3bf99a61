"""Classification of procurement texts. Each rule is one ordered CASE over its input columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outorga import fixed
from outorga.functions.text import contains_any, is_number_text, starts_with_any, yes_no


def _missing(c: Column) -> Column:
    return c.isNull() | is_number_text(c)


def modality(raw: Column, process: Column) -> Column:
    """Code 12 is the reverse auction; a missing or numeric modality falls back to the process
    type, and that to the sentinel."""
    return (
        F.when(raw == "12", F.lit("PREGÃO"))
        .when(~_missing(raw), raw)
        .when(~_missing(process), process)
        .otherwise(F.lit(fixed.UNSPECIFIED_F))
    )


def type_text(raw: Column) -> Column:
    return F.when(~is_number_text(raw), raw)


def form(kind: Column) -> Column:
    return (
        F.when(starts_with_any(kind, "presencial"), F.lit("PRESENCIAL"))
        .when(starts_with_any(kind, "eletrônico", "eletronico"), F.lit("ELETRÔNICO"))
        .otherwise(F.lit(fixed.NOT_APPLICABLE))
    )


def price_registration(kind: Column) -> Column:
    return yes_no(contains_any(kind, "registro de preço", "registro de preco"))


def international(kind: Column) -> Column:
    """The published rule tests lower-cased text for an upper-case prefix, so it never holds."""
    return yes_no(starts_with_any(kind, "LICITACAO_INTERNACIONAL"))


def type_class(kind: Column) -> Column:
    return (
        F.when(contains_any(kind, "menor preço", "menor preco", "menor valor"), F.lit("MENOR PREÇO"))
        .when(contains_any(kind, "melhor técnica", "melhor tecnica"), F.lit("MELHOR TÉCNICA"))
        .when(
            contains_any(kind, "técnica e preço", "técnica e preco", "tecnica e preço", "tecnica e preco"),
            F.lit("TÉCNICA E PREÇO"))
        .otherwise(F.lit(fixed.NOT_APPLICABLE))
    )
