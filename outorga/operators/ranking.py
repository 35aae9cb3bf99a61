"""Sums over higher values, ranks and top-1 per group that never hold one whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outorga.session import cut_lineage

#: Different (group, value) pairs of one slot.
SLOT = 100_000


def sums_above(pairs: DataFrame, group: list[str], value: str, measures: list[str], slot: int = SLOT) -> DataFrame:
    """For rows with one (group, value) each: ``<measure>_above``, the sums over the higher values of the group.

    The pairs are cut by range, in order of group and falling value, into as many slots as there are times ``slot``
    pairs, so a slot is as big whether the pairs belong to one group or to many, and the slots grow with the data.
    Slots are written down, as a range exchange draws a sample that a second run would not repeat. What lies
    above a row is the rest of its slot and the totals of the slots before, of which there is one for each group
    and slot. ``group`` may be empty: then all rows are one group."""
    pairs = cut_lineage(pairs)
    slots = -(-pairs.count() // slot)
    placed = pairs.withColumn("_slot", F.lit(0))
    if slots > 1:
        ranges = pairs.repartitionByRange(slots, *group, F.desc(value))
        placed = cut_lineage(ranges.withColumn("_slot", F.spark_partition_id()))
    inside = W.partitionBy(*group, "_slot").orderBy(F.desc(value)).rowsBetween(W.unboundedPreceding, -1)
    rows = placed.withColumns({f"_{m}_in": F.sum(m).over(inside) for m in measures})
    if slots > 1:
        before = W.partitionBy(*group).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
        totals = placed.groupBy(*group, "_slot").agg(*[F.sum(m).alias(m) for m in measures])
        totals = totals.select(*group, "_slot", *[F.sum(m).over(before).alias(f"_{m}_before") for m in measures])
        rows = rows.join(totals, [*group, "_slot"])
    else:
        rows = rows.withColumns({f"_{m}_before": F.lit(0).cast("long") for m in measures})

    def above(m: str):
        zero = F.lit(0).cast("long")
        return (F.coalesce(f"_{m}_in", zero) + F.coalesce(f"_{m}_before", zero)).alias(f"{m}_above")

    return rows.select(*pairs.columns, *[above(m) for m in measures])


def rank_in_group(df: DataFrame, group: str, value: str, name: str = "rank", slot: int = SLOT) -> DataFrame:
    """Descending rank within the group, ties sharing the smallest; null values and rows of no group stay unranked.

    The rank of a value is one plus the rows of its group above it. Ties fold into a count before any shuffle."""
    ranked = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    counts = ranked.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    ranks = sums_above(counts, [group], value, ["_n"], slot)
    ranks = ranks.select(group, value, (F.col("_n_above") + 1).cast("long").alias(name))
    return df.join(ranks, [group, value], "left").select(*df.columns, name)


def top_with_ties(df: DataFrame, group: str, value: str, gathered: bool = False) -> DataFrame:
    """All rows that carry the highest value of their group. The maximum is combined before the
    shuffle and the rows meet it on (group, value), so a hot group is spread by value. Rows that a join or a sum has
    ``gathered`` by group already are compared where they are, in runs that spill, and not shuffled again."""
    if gathered:
        known = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        highest = F.max(value).over(W.partitionBy(group))
        return known.withColumn("_highest", highest).where(F.col(value) == F.col("_highest")).select(*df.columns)
    best = df.groupBy(group).agg(F.max(value).alias(value))
    return df.join(best, [group, value], "left_semi").select(*df.columns)


def principal(df: DataFrame, group: str, value: str, member: str, name: str) -> DataFrame:
    """Member with the highest value per group, the greatest member among ties: one shuffle."""
    best = F.max_by(F.col(member), F.struct(F.col(value), F.col(member)))
    return (
        df.where(F.col(value).isNotNull()).groupBy(group).agg(best.alias(name))
        .where(F.col(name).isNotNull()))
