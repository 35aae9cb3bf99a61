"""Data-contract checks. Each returns rows that break the contract, or counts of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outorga.functions.labels import lookup
from outorga.operators.joins import drop_known
from outorga.operators.tables import union_all
from outorga.schemas import CONTRACTS, REFERENCES, Contract


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values held by more than one row, with the row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def _per_column(df: DataFrame, measures: dict, name: str) -> DataFrame:
    """One aggregate pass, turned into (column_name, measure) rows."""
    one = df.agg(*[m.alias(c) for c, m in measures.items()])
    return one.unpivot([], list(measures), "column_name", name)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return _per_column(df, {c: F.count_if(F.col(c).isNull()) for c in columns}, "nulls")


def longest_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    longest = {c: F.coalesce(F.max(F.length(c)), F.lit(0)).cast("long") for c in columns}
    return _per_column(df, longest, "max_length")


def overlong(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Columns whose longest text exceeds its limit."""
    rows = longest_texts(df, list(limits)).withColumn("length_limit", lookup(limits, F.col("column_name")))
    return rows.where("max_length > length_limit")


def missing_references(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows whose non-null value has no counterpart in the target."""
    return drop_known(df.where(F.col(column).isNotNull()), column, target, target_column)


def _one_pass(table: str, df: DataFrame, contract: Contract) -> DataFrame:
    """All counts of one table from one scan: rows are folded by key, with what breaks a rule counted on the way."""
    rules = [("not null", c, F.col(c).isNull()) for c in contract.not_null(table)]
    rules += [("text length", c, F.length(c) > n) for c, n in contract.max_length]
    counts = [F.count_if(broken).alias(f"_{n}") for n, (_, _, broken) in enumerate(rules)]
    found = [(rule, column, F.col(f"_{n}")) for n, (rule, column, _) in enumerate(rules)]
    if contract.key:
        folded = df.groupBy(*contract.key).agg(F.count(F.lit(1)).alias("_rows"), *counts)
        totals = folded.agg(F.count_if(F.col("_rows") > 1).alias("_key"), *[F.sum(f"_{n}").alias(f"_{n}") for n in range(len(rules))])
        found.insert(0, ("unique key", ", ".join(contract.key), F.col("_key")))
    else:
        totals = df.agg(*counts)  # every table has a column that may not be null
    rows = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("contract"), F.lit(column).alias("column_name"),
                 F.coalesce(n.cast("long"), F.lit(0).cast("long")).alias("violations")) for rule, column, n in found])
    return totals.select(F.inline(rows))


def _references(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows without a counterpart, for all references at once: the values of each table come from one scan, folded
    before the shuffle, and one anti-join tells which of them the targets lack."""
    here = [(n, *r) for n, r in enumerate(REFERENCES) if r[0][0] in tables and r[1][0] in tables]

    def values(table: str, wanted: list[tuple[str, Column]]) -> DataFrame:
        each = F.array(*[F.struct(tag.alias("ref"), F.col(column).cast("string").alias("value")) for column, tag in wanted])
        return tables[table].select(F.explode(each).alias("v")).select("v.*").where("value is not null")

    def by_table(sides: list[tuple[int, str, str]]) -> dict[str, list[tuple[str, Column]]]:
        out: dict[str, list[tuple[str, Column]]] = {}
        for n, table, column in sides:
            out.setdefault(table, []).append((column, F.lit(n)))
        return out

    users = by_table([(n, *user) for n, user, _ in here])
    targets = by_table([(n, *target) for n, _, target in here])
    used = union_all([values(t, w) for t, w in users.items()]).groupBy("ref", "value").agg(F.count(F.lit(1)).alias("rows"))
    known = union_all([values(t, w) for t, w in targets.items()])
    lost = used.join(known, ["ref", "value"], "left_anti").groupBy("ref").agg(F.sum("rows").alias("violations"))
    some = next(iter(tables.values())).sparkSession
    names = some.createDataFrame(
        [(n, user[0], f"reference to {target[0]}", user[1]) for n, user, target in here],
        "ref int, table_name string, contract string, column_name string")
    return names.join(lost, "ref", "left").selectExpr(
        "table_name", "contract", "column_name", "coalesce(violations, 0L) violations")


def check_mart(tables: dict[str, DataFrame]) -> DataFrame:
    """Every contract of every given table: (table_name, contract, column_name, violations)."""
    found = [_one_pass(table, df, CONTRACTS[table]) for table, df in tables.items() if table in CONTRACTS]
    if any(user[0] in tables and target[0] in tables for user, target in REFERENCES):
        found.append(_references(tables))
    return union_all(found)
