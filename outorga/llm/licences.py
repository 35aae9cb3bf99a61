"""Licence scan by a positional index of rare words.

Each template is a key phrase with a label. Document frequencies of the licence words are counted over
all documents; a template is then found through its two rarest words: their places in a file, less their
offsets in the template, give two sets of starts, whose intersection are the candidates. There the
whole phrase is compared. Each occurrence of a phrase holds both words, so none can be missed.

Defined results: a null or empty text has no words, no place and no label (empty strings, score 0, null
first and last word); repeated documents get equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outorga.llm.common import ascii_lower, cased_words, once

#: Key phrase and label, fixed by the contract.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Key phrase and label of licences and versions beyond those.
MORE = {
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "free and unencumbered software released into the public domain": "unlicense",
}


def document_frequencies(documents: DataFrame, phrases: list[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and in how many each licence word is (as many rows as there are such words)."""
    vocabulary = sorted({w for p in phrases for w in p.split()})
    found = F.array_intersect(cased_words(F.lower("text")), F.array(*map(F.lit, vocabulary)))
    counts = documents.select(F.explode(F.array_append(found, "")).alias("word")).groupBy("word").count().collect()
    df = {r["word"]: r["count"] for r in counts}
    return df.pop("", 0), {w: df.get(w, 0) for w in vocabulary}


def rarest(phrase: str, idf: dict[str, float]) -> list[int]:
    """Places of the two words of highest IDF in the phrase (one word of a kind)."""
    words = phrase.split()
    order = sorted(range(len(words)), key=lambda i: (-idf[words[i]], i))
    first = order[0]
    return [first, *[i for i in order if words[i] != words[first]][:1]]


def scan(documents: DataFrame, base: dict[str, str] = BASE, more: dict[str, str] = MORE) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score grows with the words of the distinct phrases found: w / (w + 2).
    """
    templates = list({**base, **more}.items())
    total, df = document_frequencies(documents, [p for p, _ in templates])
    idf = {w: math.log((1 + total) / (1 + n)) for w, n in df.items()}
    keys = {p: rarest(p, idf) for p, _ in templates}
    rare = sorted({p.split()[i] for p, at in keys.items() for i in at})
    words = F.col("_words")

    def starts(phrase: str, at: int) -> Column:
        word = phrase.split()[at]
        return F.transform(F.filter("_rare", lambda r: r["w"] == word), lambda r: r["i"] - at)

    def places(phrase: str) -> Column:
        sets = [starts(phrase, at) for at in keys[phrase]]
        n = len(phrase.split())
        both = F.array_intersect(*sets) if len(sets) > 1 else sets[0]
        there = lambda i: ascii_lower(F.concat_ws(" ", F.slice(words, F.greatest(i, F.lit(0)) + 1, n)))
        return F.filter(both, lambda i: (i >= 0) & (there(i) == phrase))

    rows = once(documents.select("doc_id", "text"), "_words", cased_words(F.col("text"))).drop("text")
    low = lambda i: F.lower(F.get(words, i))
    every = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    hit = F.transform(F.filter(every, lambda i: low(i).isin(rare)), lambda i: F.struct(low(i).alias("w"), i.alias("i")))
    nothing = F.array().cast("array<struct<phrase:int,start:int>>")

    def numbered(k: int, phrase: str) -> Column:
        return F.transform(places(phrase), lambda i: F.struct(F.lit(k).alias("phrase"), i.alias("start")))

    found = F.flatten(F.array(*[numbered(k, p) for k, (p, _) in enumerate(templates)]))
    rows = once(rows, "_rare", hit).withColumn("n_words", F.size("_words").cast("long"))
    rows = once(rows, "_found", F.when(F.size("_rare") > 0, found).otherwise(nothing))
    number = {p: k for k, (p, _) in enumerate(templates)}
    of_base = F.filter("_found", lambda f: f["phrase"].isin([number[p] for p in base]))
    names = F.array(*[F.lit(label) for _, label in templates])
    sizes = F.array(*[F.lit(len(p.split())) for p, _ in templates])
    label = lambda found: F.array_join(F.sort_array(F.array_distinct(F.transform(found, lambda f: F.get(names, f["phrase"])))), ",")
    weight = F.aggregate(
        F.array_distinct(F.transform("_found", lambda f: f["phrase"])), F.lit(0), lambda a, k: a + F.get(sizes, k))
    return rows.select(
        "doc_id", "n_words",
        F.size(of_base).cast("long").alias("n_base"),
        F.array_min(F.transform(of_base, lambda f: f["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(of_base, lambda f: f["start"])).cast("long").alias("last_word"),
        label(of_base).alias("base_labels"), label(F.col("_found")).alias("labels"),
        (weight / (weight + 2)).alias("score"))
