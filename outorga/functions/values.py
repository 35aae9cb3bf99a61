"""Typed values out of raw text. Every parse is a ``try_`` form: bad text becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outorga.schemas import MONEY


def decimal_comma(c: Column, kind: T.DataType | str = MONEY) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast(kind)


def day_first_date(c: Column) -> Column:
    """``d/M/yyyy``, else month first, else ISO; a time of day after the date is ignored."""
    day = F.substring_index(c, " ", 1)
    return F.coalesce(
        F.try_to_date(day, "d/M/yyyy"), F.try_to_date(day, "M/d/yyyy"), F.try_to_date(day, "yyyy-M-d"))


def non_zero(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def year_and_number(year: Column, number: Column) -> Column:
    """Composite key: year followed by number, as text."""
    return F.concat(year, number)


def typed(c: Column, current: T.DataType, wanted: T.DataType) -> Column:
    if current == wanted:
        return c
    if isinstance(wanted, T.DateType):
        return day_first_date(c) if isinstance(current, T.StringType) else c.cast(wanted)
    return c.try_cast(wanted)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: its columns, its order, its types, in one select."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[typed(F.col(f.name), have[f.name], f.dataType).alias(f.name) for f in schema.fields])
