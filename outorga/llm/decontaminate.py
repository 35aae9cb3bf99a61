"""Benchmark decontamination.

The windows of the benchmark (13 words each) make a hash set that is broadcast, keyed by the longest
word of each window. Every word of a document probes that set; a probe that hits gives the place where
the window would have to start, and there all its words are compared. Only verified windows count.

Defined results: a null or wordless text has no words and is clean; benchmark rows with a null id, a null
text or no word are no items; repeated benchmark rows count once per id; repeated documents each get
their own, equal, row; an empty benchmark leaves all documents clean. Extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outorga.llm.common import ascii_lower, cased_words, covered, packed, stored, unpacked

WINDOW = 13
#: Most bytes of windows in one broadcast; a larger benchmark is taken in so many blocks of this size.
BROADCAST_BYTES = 64 << 20


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(key, offset, length, window, items): each different window, its longest word, and the items
    that hold it."""
    words = F.col("_words")
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))
    longest = F.array_max(F.transform("_w", lambda w, i: F.struct(F.length(w).alias("n"), w.alias("w"), (-i).alias("i"))))
    cut = (
        benchmark.select(F.col("item_id").cast("string").alias("_item"), cased_words(ascii_lower(F.col("text"))).alias("_words"))
        .filter(F.col("_item").isNotNull() & (F.size(words) > 0))
        .select("_item", F.explode(F.transform(starts, lambda i: F.slice(words, i + 1, size))).alias("_w"))
        .withColumn("_k", longest)
    )
    return cut.groupBy(
        F.lower(F.col("_k.w")).alias("key"), (-F.col("_k.i")).alias("offset"), F.size("_w").alias("length"),
        F.concat_ws(" ", "_w").alias("window"),
    ).agg(F.collect_set("_item").alias("items"))


def hits(documents: DataFrame, grams: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(digest, spans, items) of each different text that holds a window: word spans and item ids."""
    grams = stored(grams)
    size = grams.agg(F.sum(F.length("window") + F.length("key") + F.length(F.concat_ws(",", "items")) + 64)).first()[0] or 0
    blocks = -(-size // limit) or 1
    words, start = F.col("_words"), F.col("_pos") - F.col("offset")
    probes = documents.select(F.unhex(F.md5("text")).alias("digest"), cased_words(F.col("text")).alias("_words")).select(
        "digest", "_words", F.posexplode("_words").alias("_pos", "_word"))

    def found(block: DataFrame) -> DataFrame:
        there = F.concat_ws(" ", F.slice(words, F.greatest(start, F.lit(0)) + 1, F.col("length")))
        return (
            probes.join(F.broadcast(block), F.lower("_word") == F.col("key"))
            .filter((start >= 0) & (start + F.col("length") <= F.size(words)))
            .filter(ascii_lower(there) == F.col("window"))
            .select("digest", F.struct(start.alias("start"), "length").alias("span"), "items")
        )

    parts = [grams] if blocks == 1 else [grams.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k) for k in range(blocks)]
    return reduce(DataFrame.union, map(found, parts)).groupBy("digest").agg(
        F.collect_set("span").alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """The rule: at least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def judged(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents as ``_row`` with n_words, n_hit, items, spans and contaminated."""
    found = hits(documents, windows(benchmark, size)).select(F.col("digest").alias("_digest"), "spans", "items")
    none = F.array().cast("array<string>")
    rows = packed(documents, F.unhex(F.md5("text")).alias("_d"), F.size(cased_words(F.col("text"))).cast("long").alias("n_words"))
    return (
        rows.join(found, F.col("_d") == F.col("_digest"), "left")
        .withColumn("items", F.sort_array(F.coalesce("items", none)))
        .withColumn("n_hit", F.coalesce(covered(F.col("spans")), F.lit(0).cast("long")))
        .withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))
    )


def clean(documents: DataFrame, benchmark: DataFrame, action: str = "document", size: int = WINDOW) -> DataFrame:
    """Documents without benchmark passages, with their own columns.

    action ``document`` leaves out contaminated documents. ``span`` keeps every document and cuts the words of
    each hit span out of it (the rest joined by single spaces; texts without a hit are not touched).
    """
    rows = judged(documents, benchmark, size)
    if action == "document":
        return unpacked(rows.filter(~F.col("contaminated")))
    words = cased_words(F.col("_row.text"))
    kept = F.filter(words, lambda _, i: ~F.exists("spans", lambda s: (i >= s["start"]) & (i < s["start"] + s["length"])))
    text = F.when(F.col("n_hit") > 0, F.array_join(kept, " ")).otherwise(F.col("_row.text"))
    return unpacked(rows.withColumn("_row", F.col("_row").withField("text", text)))
