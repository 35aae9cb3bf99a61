"""Projections, unions, grouped sums and reports over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outorga.session import cut_lineage


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Stack by name; a column missing from a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_member(df: DataFrame, **values) -> DataFrame:
    """Add one fixed row to a dimension."""
    row = df.sparkSession.range(1).select(
        *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(row)


def group_sum(df: DataFrame, by: list[str], amount: str, name: str | None = None) -> DataFrame:
    """Money total per key; a group of nulls only sums to zero."""
    total = F.coalesce(F.sum(amount), F.lit(0)).cast(df.schema[amount].dataType)
    return df.groupBy(*by).agg(total.alias(name or amount))


def distinct_sum(df: DataFrame, by: list[str], amount: str, name: str | None = None) -> DataFrame:
    """Total over the *distinct* (key, amount) rows: equal transfers of one key count once."""
    return group_sum(df.select(*by, amount).distinct(), by, amount, name)


def attribute_values(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """(ATRIBUTO, VALOR) list of the distinct values of several columns, in one scan."""
    wanted = df.select(*[F.col(c).alias(label) for c, label in names.items()])
    return wanted.unpivot([], list(names.values()), "ATRIBUTO", "VALOR").distinct()


#: Digests of repeated rows that every reader of a table may be handed.
FEW = 100_000

#: Lists that a table's digests are dealt to: as many as an aggregate of lists holds without a sort, or one for so many rows.
LISTS, LISTED = 128, 1_000_000


def without_copies(rows: DataFrame, few: int = FEW) -> DataFrame:
    """Each different row once, of rows that are written down and cheap to read again.

    Of each row only a digest is shuffled: 4 bytes, in the list that the rest of the digest names, so that a row costs its
    4 bytes and no more. Rows whose digest no other row has stay where they are; the others are few as a rule, and only
    they are compared as a whole. So rows of one digest that differ all stay. Where any are copies, readers leave out the rows
    that share a digest and take them from a table of their own; where these are many, all is written down once more."""
    whole = F.xxhash64(*rows.columns)
    lists = max(LISTS, rows.count() // LISTED)
    digest = {"_list": F.pmod(whole, F.lit(lists)).cast("int"), "_digest": F.shiftright(whole, 32).cast("int")}
    listed = rows.select(*[c.alias(name) for name, c in digest.items()]).groupBy("_list").agg(F.collect_list("_digest").alias("_all"))
    some = listed.where(F.size(F.array_distinct("_all")) < F.size("_all")).select("_list", F.explode("_all").alias("_digest"))
    again = cut_lineage(some.groupBy("_list", "_digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    found = again.count()
    if not found:
        return rows
    shared = (digest["_list"] == F.col("_list")) & (digest["_digest"] == F.col("_digest"))
    alike = rows.join(again, shared, "left_semi").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    alike = cut_lineage(alike)
    if alike.where("_copies > 1").isEmpty():
        return rows
    once = rows.join(again, shared, "left_anti").unionByName(alike.drop("_copies"))
    return once if found <= few else cut_lineage(once)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table, rows) line per table."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()])


def first_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)
