"""Membership tests, lookups with fallback, overrides and date corrections.

No join here names a broadcast side that grows with the data: adaptive execution broadcasts a
side it has measured as small and splits hot keys of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outorga import fixed
from outorga.functions.labels import lookup
from outorga.functions.text import yes_no
from outorga.session import cut_lineage


def keep_known(df: DataFrame, key: str, known: DataFrame, known_key: str | None = None) -> DataFrame:
    """Rows whose key exists in ``known``."""
    return df.join(known.select(F.col(known_key or key).alias(key)), key, "left_semi")


def drop_known(df: DataFrame, key: str, known: DataFrame, known_key: str | None = None) -> DataFrame:
    """Rows whose key does not exist in ``known``; null keys stay."""
    return df.join(known.select(F.col(known_key or key).alias(key)), key, "left_anti")


def flag_known(df: DataFrame, key: str, known: DataFrame, known_key: str, flag: str) -> DataFrame:
    """SIM/NAO column: does the key exist in ``known``?"""
    present = known.select(F.col(known_key).alias(key)).distinct().withColumn("_present", F.lit(True))
    return df.join(present, key, "left").withColumn(flag, yes_no(F.col("_present").isNotNull())).drop("_present")


def attach_total(df: DataFrame, key: str, totals: DataFrame, total: str) -> DataFrame:
    """Left join a pre-aggregated total; keys without one get zero."""
    return df.join(totals.select(key, total), key, "left").withColumn(
        total, F.coalesce(F.col(total), F.lit(0).cast(totals.schema[total].dataType)))


def null_safe_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join where a null key matches a null key. For semi and anti joins the right side needs each
    key once, so a hot null never multiplies rows."""
    other = right.withColumnRenamed(key, "_key")
    joined = left.join(other, F.col(key).eqNullSafe(F.col("_key")), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("_key")


#: Rows of one key that one side brings to a cell of an override.
RUN = 1_000


def override(left: DataFrame, right: DataFrame, key: str, when: str, pairs: dict[str, str], run: int = RUN) -> DataFrame:
    """Left join on ``key``, null matching null; where ``when`` came along, the right columns replace the left ones.
    Several right rows per key give several result rows.

    Equal right rows travel once, with their count, and become rows again in the result. A key with more than ``run``
    rows on a side is cut into cells: its left rows are dealt to as many hands as it has runs, its right rows likewise,
    and each hand of one side meets each of the other in a cell of its own. So a key that holds many rows, a null one
    included, is the work of many tasks, and no task has more than a run of each side.
    """
    carried = dict.fromkeys([when, *pairs.values()])
    names = {c: f"_right{n}" for n, c in enumerate(carried)}
    right = right.select(F.col(key).alias("_key"), *[F.col(c).alias(n) for c, n in names.items()])
    runs = right.groupBy(*right.columns).agg(F.count(F.lit(1)).alias("_copies"))
    many = left.groupBy(F.col(key).alias("_hot")).agg(F.ceil(F.count(F.lit(1)) / run).alias("_hands"))
    found = runs.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) / run).alias("_others"))
    hot = many.join(found, F.col("_hot").eqNullSafe(F.col("_key"))).where("_hands > 1 or _others > 1").select("_hot", "_hands", "_others")
    hot = cut_lineage(hot)  # its size is known before the sides meet it: where it is small, they are not shuffled for it

    def hand(of: str, *columns: Column | str) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(*columns), F.col(of)), F.lit(0).cast("long"))

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(of, F.lit(1)) - 1))

    # Equal left rows would share a hand, but for the task they come from.
    dealt = left.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").withColumn(
        "_a", hand("_hands", *left.columns, F.spark_partition_id())).withColumn("_b", every("_others"))
    spread = runs.join(hot.withColumnRenamed("_hot", "_hot2"), F.col("_key").eqNullSafe(F.col("_hot2")), "left").select(
        *right.columns, F.expr("array_repeat(true, cast(_copies as int))").alias("_each"),
        hand("_others", *runs.columns).alias("_b2"), every("_hands").alias("_a2"))
    cell = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_a") == F.col("_a2")) & (F.col("_b") == F.col("_b2"))
    # A hot key has a match in some cell; the cells of it without one say nothing.
    joined = dealt.join(spread, cell, "left").where("_each is not null or _hands is null")
    matched = F.col(names[when]).isNotNull()
    # The array of the copies is made once for a right row, not for each pair.
    return joined.withColumn("_copy", F.explode(F.coalesce("_each", F.array(F.lit(True))))).select(*[
        F.when(matched, F.col(names[pairs[c]])).otherwise(F.col(c)).alias(c) if c in pairs else F.col(c)
        for c in left.columns])


def date_corrections(spark: SparkSession, leg: str) -> DataFrame:
    """(_grant, _wrong, _right) of one ledger leg, as a local relation: the planner knows its size
    (at most a few dozen rows) and broadcasts it, so the leg is not shuffled for it."""
    rows = [(grant, _iso(wrong), _iso(right)) for kind, grant, wrong, right in fixed.date_fixes() if kind == leg]
    values = ", ".join(f"({grant}L, date'{wrong}', date'{right}')" for grant, wrong, right in rows)
    return spark.sql(f"select * from values {values} as fixes(_grant, _wrong, _right)")


def _iso(day_first: str) -> str:
    return "-".join(reversed(day_first.split("/")))


def correct_dates(df: DataFrame, grant: str, date: str, corrections: DataFrame) -> DataFrame:
    """Replace the wrong dates of single grants; (grant, wrong date) is unique in ``corrections``."""
    hit = (F.col(grant) == F.col("_grant")) & (F.col(date) == F.col("_wrong"))
    joined = df.join(corrections, hit, "left")
    return joined.withColumn(date, F.coalesce("_right", date)).select(*df.columns)


def bad_suffix_date(text: Column, suffixes: dict[str, int] | None = None) -> Column:
    """1 January of the year a known bad year suffix stands for; null for any other text."""
    table = fixed.BAD_YEAR_SUFFIXES if suffixes is None else suffixes
    year = lookup(table, F.right(text, F.lit(5)))
    return F.make_date(year, F.lit(1), F.lit(1))
