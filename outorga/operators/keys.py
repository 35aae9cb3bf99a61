"""Dense surrogate ids that depend on row content alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outorga.session import cut_lineage


#: Cells for the rows of a run: a cell holds a tenth of a run, unless rows are repeated.
CELL = 10


def _single(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row by itself, as the first run of its copies."""
    return df.select(*keys, F.lit(0).cast("long").alias("_run"), F.lit(1).cast("long").alias("_copies"))


def _folded(df: DataFrame, keys: list[str], run: int) -> DataFrame:
    """Each different row with the number of its copies, in runs."""
    folded = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return (
        folded.select("*", F.explode(F.expr(f"sequence(0L, (_n - 1) div {run})")).alias("_run"))
        .select(*keys, "_run", F.least(F.lit(run).cast("long"), F.col("_n") - F.col("_run") * run).alias("_copies")))


def dense_ids(
    df: DataFrame, name: str, keys: list[str], unique: bool = False, hex_digits: int = 4, run: int = 10_000,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Number the rows 1..n by (bucket, keys), where the bucket is a prefix of the keys' MD5.

    A plain ``row_number() over (order by keys)`` sorts everything in one task, and buckets cut by
    the key's own prefix are as uneven as the data. A digest prefix cuts evenly whatever the keys
    hold and is the same on every run and cluster, so no range sampling has to be frozen first.
    Only the bucket sizes (at most 16 ** ``hex_digits`` rows, so the broadcast is bounded) are
    summed in one window. The rows are shuffled by bucket once and sorted once: the sizes are added up
    from the shuffled rows as they lie.

    Equal rows are folded into (row, count) before the shuffle and cut into runs of ``run`` copies
    that fall into different buckets; so a row repeated without end is spread too. ``unique=True``
    says the keys are already distinct and skips the fold. Only ``keys`` and the id are returned.

    The fold shuffles every row once more. Where ``keep`` writes the rows down and reads them back, only rows that may
    have more than ``run`` copies are folded: those in a cell, by digest, of more than ``run`` rows.
    """
    whole = unique  # no row of ``runs`` stands for several
    if unique:
        runs = _single(df, keys)
    elif keep is None:
        runs = _folded(df, keys, run)
    else:
        rows = keep(df.select(*keys))
        cell = F.pmod(F.xxhash64(*keys), F.lit(max(rows.count() * CELL // run, 1)))
        full = cut_lineage(rows.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > run).select("_cell"))
        whole = full.isEmpty()
        runs = _single(rows if whole else rows.join(full, cell == F.col("_cell"), "left_anti"), keys)
        if not whole:
            runs = runs.unionByName(_folded(rows.join(full, cell == F.col("_cell"), "left_semi"), keys, run))
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.col("_run").cast("string")))
    bucket = F.substring(digest, 1, hex_digits)
    order = [F.col(k).asc_nulls_last() for k in keys] + ([] if whole else [F.col("_run")])
    in_bucket = W.partitionBy("_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    # The bucket is worked out again behind the shuffle: its digits are a quarter of what a row would bring along.
    shuffled = runs.repartition(bucket).withColumn("_bucket", bucket)
    placed = shuffled.withColumn("_upto", F.sum("_copies").over(in_bucket))
    # The digest of whole rows keeps the columns in the plan, without which this would be a shuffle of its own.
    sizes = shuffled.groupBy("_bucket").agg(
        F.sum("_copies").alias("_size"), F.bit_xor(F.xxhash64(*keys, "_run")).alias("_whole")).where("_whole is not null")
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    last = F.col("_offset") + F.col("_upto")
    numbered = placed.join(F.broadcast(offsets), "_bucket")
    if whole:
        return numbered.select(last.alias(name), *keys)
    return numbered.select(F.explode(F.sequence(last - F.col("_copies") + 1, last)).alias(name), *keys)
