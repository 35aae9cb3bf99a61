"""Document fingerprints by spot signatures.

A spot is a common word (an anchor) with the chain of the next content words after it, common words
between them left out; in long stretches without an anchor, each word is one. The set of spots of a text, as hashes in order, is its fingerprint. Two fingerprints
are compared by the Jaccard likeness of their sets.

Defined results: null counts as the empty text; the start of a text is an anchor for its first word and its
first two; the one spot of a text without words is that text; the empty text has the empty fingerprint. Two empty fingerprints have likeness 1. Equal texts have equal fingerprints.
In the order of documents, rows with equal id go by the digest of their texts, null ids come last, and
equal rows follow one another. An empty table gives no rows, extra columns are not looked at, and a very long text is
one row of one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outorga.llm.common import BETWEEN, once, stored

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine für im ist mit nicht sich sie und von zu "
    "au avec dans de des du elle en est et il la le les par pas pour que qui sur un une "
    "como con del el es los las no para por se su una y").split()
CHAIN = 2
RUN = 6  # content words in a row from which on each chain among them is a spot too
GROUP = 2000  # documents that are put in order together
MOST_GROUPS = 1 << 18  # bounds the table of groups, the one broadcast here


def _any_of(words: list[str]) -> str:
    """A pattern for a whole word out of a list, branching by letters so that most words fail at once."""
    firsts: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        firsts.setdefault(word[0], []).append(word[1:])
    return "(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in firsts.items()) + ")(?![^ ])"


def with_spots(df: DataFrame, text: str, name: str, anchors: list[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Add the set of spots of a text column as sorted hashes."""
    mark, content = r"\x01[^ ]++", r"[^\x01 ][^ ]*+"
    spot = rf"\x01(?=([^ ]++(?:(?: {mark})*+ {content}){{{chain}}}))"
    run = rf"(?<![^ ]){content}(?: {content}){{{RUN - 1},}}+"
    any_chain = rf"(?<![^ ])(?=([^ ]+(?: [^ ]+){{{chain}}}))"
    chains = lambda part: F.regexp_extract_all(part, F.lit(any_chain), 1)
    # words and single spaces, common words behind a mark
    words = F.trim(F.regexp_replace(F.lower(text), BETWEEN, " "))
    df = once(df, "_w", F.regexp_replace(words, rf"(?<![^ ]){_any_of(anchors)}", "\x01$0"))
    words = F.col("_w")
    at_anchors = F.transform(F.regexp_extract_all(words, F.lit(spot), 1), lambda s: F.regexp_replace(s, f" {mark}", ""))
    between = F.flatten(F.transform(F.regexp_extract_all(words, F.lit(run), 0), chains))
    start = F.translate(words, "\x01", "")
    head = F.filter(F.array(F.regexp_extract(start, "^[^ ]+", 0), F.regexp_extract(start, "^[^ ]+ [^ ]+", 0)), lambda s: s != "")
    bare = F.when(F.length(words) == 0, F.filter(F.array(F.col(text)), lambda s: s != "")).otherwise(F.array().cast("array<string>"))
    chosen = F.concat(at_anchors, between, F.transform(head, lambda s: F.concat(F.lit("^"), s)), bare)
    hashes = F.sort_array(F.array_distinct(F.transform(chosen, lambda s: F.xxhash64(s))))
    return once(df, name, hashes).drop("_w")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets."""
    sizes = F.size(a) + F.size(b)
    both = F.array(F.size(F.array_intersect(a, b)))  # in an array, so that it is worked out once
    return F.when(sizes == 0, F.lit(1.0)).otherwise(F.get(F.transform(both, lambda n: n / (sizes - n)), F.lit(0)))


def written(spots: Column) -> Column:
    """A fingerprint as text: the hashes in hexadecimal."""
    return F.array_join(F.transform(spots, lambda h: F.lower(F.hex(h))), ",")


def _ranges(documents: DataFrame) -> tuple[int, int, DataFrame]:
    """Ranges of doc_id that hold about GROUP documents each, however the ids are spread: equal widths
    first, then each of those cut into equal widths of its own span. (low, width, a row per first width)."""
    ids = documents.select(F.col("doc_id").cast("long").alias("id"))
    low, high, n = ids.agg(F.min("id"), F.max("id"), F.count("id")).first()
    most = MOST_GROUPS // 4
    low, width = low or 0, ((high or 0) - (low or 0)) // min(max(n // GROUP, 1), most) + 1
    span = F.expr(f"(high - low) div least(greatest(n div {GROUP}, 1), {most}) + 1")
    table = ids.filter(F.col("id").isNotNull()).groupBy(F.expr(f"(id - {low}L) div {width}L").alias("a")).agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count("id").alias("n")).select("a", "low", span.alias("width"))
    return low, width, table


def with_next(documents: DataFrame) -> DataFrame:
    """(doc_id, text, spots, next_text, next_spots): each document and the one that follows in falling order
    of doc_id (after the last: the first). A text moves once: each range of ids is put in order on its own,
    with a copy of the document that follows its last."""
    low, width, table = _ranges(documents)
    table = F.broadcast(stored(table))
    at = F.struct(F.coalesce("a", F.lit(-1).cast("long")).alias("a"), F.coalesce(F.expr("(doc_id - low) div width"), F.lit(0).cast("long")).alias("b"))

    def grouped(df: DataFrame) -> DataFrame:
        return df.withColumn("_a", F.expr(f"(doc_id - {low}L) div {width}L")).join(
            table, F.col("_a") == F.col("a"), "left").withColumn("group", at).drop("_a", "a", "low", "width")

    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    tops = grouped(rows.select("doc_id")).groupBy("group").agg(F.max("doc_id").alias("top"))
    fall = W.orderBy(F.col("group").desc())
    whole = fall.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    tops = F.broadcast(stored(tops.select(
        F.col("group").alias("_g"), "top", F.coalesce(F.lag("group").over(fall), F.last("group").over(whole)).alias("before"))))
    own = F.struct(F.lit(0).alias("copy"), F.col("group"))
    copied = F.struct(F.lit(1).alias("copy"), F.col("before").alias("group"))
    to = F.when(F.col("doc_id").eqNullSafe(F.col("top")), F.array(own, copied)).otherwise(F.array(own))
    dealt = grouped(with_spots(rows, "text", "spots")).join(tops, F.col("group") == F.col("_g"))
    dealt = dealt.select("doc_id", "text", "spots", F.md5("text").alias("digest"), F.inline(to))
    order = W.partitionBy("group").orderBy("copy", F.col("doc_id").desc_nulls_last(), "digest")
    return dealt.select(
        "doc_id", "text", "spots", "copy", F.lead("text").over(order).alias("next_text"),
        F.lead("spots").over(order).alias("next_spots")).filter(F.col("copy") == 0).drop("copy")


def edited(documents: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text (its last third replaced by the head of the
    next document), and the likeness of its own to that one and to the next document's."""
    n = F.length("text")
    third = F.expr("length(text) div 3").cast("int")
    text = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    rows = once(with_next(documents), "edited", text)
    rows = with_spots(rows.withColumn("n_chars", n.cast("long")).drop("text", "next_text"), "edited", "edited_spots")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written(F.col("spots")).alias("fingerprint"),
        written(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"))
