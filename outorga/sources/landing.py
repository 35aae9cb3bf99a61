"""Scans of raw delimited extracts. Everything is read as text; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outorga.functions.text import null_tokens
from outorga.functions.values import day_first_date


def read_raw(
    spark: SparkSession, path: str | list[str], columns: list[str], sep: str = ";",
    encoding: str = "UTF-8", multi_line: bool = True,
) -> DataFrame:
    """Named columns of plain or gzip CSV files, null tokens made null.

    ``multi_line`` allows line breaks in quoted fields but reads each file in one task, which a compressed file
    calls for anyway; ``delimited.read_ranges`` splits plain files with such fields.
    """
    reader = spark.read.options(
        header=True, sep=sep, quote='"', escape='"', encoding=encoding, multiLine=multi_line,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return null_tokens(reader.csv(path).select(*columns))


def load_date(df: DataFrame, column: str) -> DataFrame:
    """One row DATA_ATUAL: the day-first date in the first row of the load-date extract."""
    return df.limit(1).select(day_first_date(F.trim(column)).alias("DATA_ATUAL"))
