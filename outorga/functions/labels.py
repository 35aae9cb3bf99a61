"""Code-to-label lookups over fixed tables, and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from outorga import fixed
from outorga.functions.text import padded_label


def literal_map(table: dict) -> Column:
    """A fixed table as one map literal (values are texts or whole numbers)."""
    entries = [str(x) if isinstance(x, int) else f"'{x}'" for pair in table.items() for x in pair]
    return F.expr(f"map({', '.join(entries)})")


def lookup(table: dict, c: Column) -> Column:
    """Look ``c`` up in a small fixed table held as a map literal; missing -> null."""
    return F.try_element_at(literal_map(table), c)


def region_code(region: Column) -> Column:
    return lookup(fixed.REGION_CODES, region)


def state_region(state: Column) -> Column:
    return lookup({uf: region for region, ufs in fixed.REGION_STATES.items() for uf in ufs}, state)


def _literal_array(texts: list[str]) -> Column:
    return F.expr("array(" + ", ".join(f"'{t}'" for t in texts) + ")")


def month_name(day: Column) -> Column:
    return F.element_at(_literal_array(fixed.MONTHS), F.month(day))


def weekday_name(day: Column) -> Column:
    return F.element_at(_literal_array(fixed.WEEKDAYS), F.weekday(day) + 1)


def calendar_columns(day: Column) -> dict[str, Column]:
    """All attributes of a day. The quarter text reads 'semestre' and the ISO week is paired with
    the calendar year, as in the published mart."""
    year, month, quarter, week = (f(day).cast("long") for f in (F.year, F.month, F.quarter, F.weekofyear))

    def named(number: Column, suffix: str) -> Column:
        return F.concat(number.cast("string"), F.lit(suffix))

    def with_year(name: Column) -> Column:
        return F.concat_ws(" ", name, year.cast("string"))

    quarter_name, week_name = named(quarter, "o semestre"), named(week, "a semana")
    return {
        "ANO": year,
        "MES_NUMERO": month,
        "MES_NOME": month_name(day),
        "ANO_MES_NUMERO": year * 100 + month,
        "MES_ANO": padded_label(month, year),
        "MES_NOME_ANO": with_year(month_name(day)),
        "TRIMESTRE_NUMERO": quarter,
        "TRIMESTRE_NOME": quarter_name,
        "ANO_TRIMESTRE_NUMERO": year * 100 + quarter,
        "TRIMESTRE_ANO": padded_label(quarter, year),
        "TRIMESTRE_NOME_ANO": with_year(quarter_name),
        "SEMANA_NUMERO": week,
        "SEMANA_NOME": week_name,
        "ANO_SEMANA_NUMERO": year * 100 + week,
        "SEMANA_ANO": padded_label(week, year),
        "SEMANA_NOME_ANO": with_year(week_name),
        "DIA_DA_SEMANA": weekday_name(day),
    }
