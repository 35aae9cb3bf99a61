"""Expressions shared by the corpus operators: ASCII lower case, words, spans, scratch tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outorga.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What lies between words of letters, digits and everything beyond ASCII, before lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def cased_words(text: Column) -> Column:
    """Words of a text in their own case; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def covered(spans: Column) -> Column:
    """Number of positions that lie in at least one of the (start, length) spans."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, s: Column) -> Column:
        first = F.greatest(acc["end"], s["start"].cast("long"))
        end = F.greatest(acc["end"], (s["start"] + s["length"]).cast("long"))
        return F.struct(end.alias("end"), (acc["n"] + end - F.least(first, end)).alias("n"))

    return F.aggregate(F.sort_array(spans), start, add, lambda acc: acc["n"])


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once per row, however often it is used further on. (The
    optimizer may copy a projected expression into each of its uses, but not a generated one.)"""
    return df.select("*", F.explode(F.array(value)).alias(name))


def packed(df: DataFrame, *columns: Column) -> DataFrame:
    """The row as one struct ``_row`` beside computed columns, so that no name of the input can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *columns)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: computed once, survives lost executors, and the
    planner knows its size."""
    return cut_lineage(df, codec=None)  # the limits of the corpus operators were measured with the session's codec


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it. (A cluster whose machines don't
    share that folder gets the package by ``--py-files`` or an installation.)"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark
