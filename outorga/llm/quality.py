"""Quality of documents by hierarchical empirical Bayes.

A logistic classifier over surface features gives each document a probability of being good. Its sums
per site (host and path) give posteriors: a path's mean is drawn towards its host's, a host's towards the
mean of all, the more the fewer documents it has. How much follows from the variances within and between
groups (their moments over all documents). A document's own log-odds and its path's are then added up.

The classifier is fitted on at most SAMPLE label rows, those of the smallest hashes of doc_id (twice as
many rows where ids repeat); all else
covers every document. Groups are added up before they move, so a host with most rows is no burden.

Defined results: a null text counts as empty; null host and path are sites of their own; label rows without
id or label are not used, repeated ones count each; with no labels, or labels of one kind only, every document
has that share (1 without labels) as its evidence; an empty table gives an empty result. Extra columns pass
through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outorga.llm.common import once, packed, stored

SAMPLE = 20_000
RIDGE = 1e-3
LEAST = 0.5  # quality from which on a document is kept


def _features() -> dict[str, Column]:
    """Features over ``_t`` (text), ``_n`` (characters, one at least), ``_w`` (words between spaces), ``_d``
    (different ones) and ``_r`` (the text without small letters, spaces and common punctuation)."""
    w, n, rest = F.col("_w"), F.col("_n"), F.col("_r")
    size, kinds = F.greatest(F.size(w), F.lit(1)), F.col("_d")
    among = lambda pattern: F.length(F.regexp_replace(rest, pattern, "")) / n
    again = F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1))))
    lines = F.split("_t", "\n")
    return {
        "size": F.log1p(F.size(w)),
        "word": F.least(n / size, F.lit(30.0)),
        "symbols": among(r"[\p{L}\p{N}]+"),
        "upper": among(r"[^\p{Lu}]+"),
        "digits": among("[^0-9]+"),
        "distinct": kinds / size,
        "richness": F.log1p(kinds) / F.log1p(size),
        "repeated": again / size,
        "lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


def with_features(df: DataFrame, text: Column) -> DataFrame:
    """Add ``_x``, the feature values of a text."""
    df = once(df, "_t", F.coalesce(text, F.lit("")))
    df = once(df, "_w", F.array_remove(F.split("_t", r"\s+"), "")).withColumn("_n", F.greatest(F.length("_t"), F.lit(1)))
    df = once(once(df, "_d", F.size(F.array_distinct("_w"))), "_r", F.regexp_replace("_t", r"[\p{Ll}\s.,;:?'()\x22-]+", ""))
    return once(df, "_x", F.array(*[v.cast("double") for v in _features().values()])).drop("_t", "_w", "_n", "_d", "_r")


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with the constant last, means, deviations) of the classifier."""
    some = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_y")).dropna()
    some = stored(some.orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample))  # bounds what is broadcast
    rows = documents.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("text", "_id", "_y")
    got = with_features(rows, F.col("text")).select("_x", "_y").orderBy(F.xxhash64("_x"), "_x", "_y").limit(2 * sample).toPandas()
    if got.empty or got["_y"].nunique() < 2:
        share = float(got["_y"].mean()) if len(got) else 1.0
        share = min(max(share, 1e-3), 1 - 1e-3)
        k = len(_features())
        return np.r_[np.zeros(k), np.log(share / (1 - share))], np.zeros(k), np.ones(k)
    x, y = np.stack(got["_x"].to_numpy()), got["_y"].to_numpy()
    mean, dev = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.clip((x - mean) / dev, -8, 8), np.ones(len(x))]
    w = np.zeros(z.shape[1])
    balance = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(50):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (balance * p * (1 - p) + 1e-9)[:, None]).T @ z + RIDGE * len(x) * np.eye(len(w)),
                               z.T @ (balance * (y - p)) - RIDGE * len(x) * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, dev


def probability(x: Column, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Column:
    """The classifier's probability, within (0.001, 0.999)."""
    w, mean, dev = model
    total = F.lit(float(w[-1]))
    for i in range(len(mean)):
        z = (F.get(x, F.lit(i)) - float(mean[i])) / float(dev[i])
        total = total + float(w[i]) * F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return F.greatest(F.least(1 / (1 + F.exp(-total)), F.lit(0.999)), F.lit(0.001))


def _strength(groups: DataFrame, centre: Column) -> float:
    """Documents that a prior is worth: variance within groups over that between them. ``groups`` has n,
    total and squares per group; ``centre`` is the mean that each group is drawn to."""
    mean = F.col("total") / F.col("n")
    r = groups.agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("nn"),
        F.sum(F.col("squares") - F.col("n") * mean * mean).alias("within"),
        F.sum(F.col("n") * (mean - centre) * (mean - centre)).alias("between")).first()
    if not r["n"] or r["n"] <= r["k"]:
        return 1e6
    within = max(r["within"] / (r["n"] - r["k"]), 1e-9)
    spread = (r["between"] - (r["k"] - 1) * within) / max(r["n"] - r["nn"] / r["n"], 1e-9)
    return float(np.clip(within / max(spread, 1e-12), 1e-3, 1e6))


def posteriors(scored: DataFrame) -> tuple[float, DataFrame]:
    """Mean of all and (host, path, p_host, p_path) per site, from rows with _host, _path and _p."""
    sums = (F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))
    sites = stored(scored.groupBy("_host", "_path").agg(
        F.count("*").alias("n"), F.sum("_p").alias("total"), F.sum(F.col("_p") * F.col("_p")).alias("squares")))
    hosts = sites.groupBy("_host").agg(*sums)
    all_of = hosts.agg(*sums).first()
    mean = all_of["total"] / all_of["n"] if all_of["n"] else 0.5
    k = _strength(hosts, F.lit(mean))
    hosts = stored(hosts.select(F.col("_host").alias("_h"), ((F.col("total") + k * mean) / (F.col("n") + k)).alias("p_host")))
    sites = sites.join(hosts, F.col("_host") == F.col("_h")).drop("_h")
    k = _strength(sites, F.col("p_host"))
    drawn = (F.col("total") + k * F.col("p_host")) / (F.col("n") + k)
    return mean, stored(sites.select(F.col("_host").alias("_h"), F.col("_path").alias("_s"), "p_host", drawn.alias("p_path")))


def judged(documents: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", label: str = "quality") -> DataFrame:
    """The documents as ``_row`` with p_document, p_host, p_path, p_quality and keep."""
    model = fit(documents, labels, label)
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = packed(documents, name(host).alias("_host"), name(path).alias("_path"), F.col("text").alias("_text"))
    scored = with_features(rows, F.col("_text")).select("_row", "_host", "_path", probability(F.col("_x"), model).alias("_p"))
    mean, sites = posteriors(scored)
    odds = lambda p: F.log(p / (1 - p))
    inside = lambda p: F.greatest(F.least(p, F.lit(0.999)), F.lit(0.001))
    total = odds(F.col("_p")) + odds(inside(F.col("p_path"))) - odds(inside(F.lit(mean)))
    out = scored.join(sites, (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_s")))
    out = out.select("_row", F.col("_p").alias("p_document"), "p_host", "p_path", (1 / (1 + F.exp(-total))).alias("p_quality"))
    return out.withColumn("keep", F.col("p_quality") >= LEAST)


def kept(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents of sufficient quality, with their own columns."""
    return judged(documents, labels, **options).filter("keep").select("_row.*")
