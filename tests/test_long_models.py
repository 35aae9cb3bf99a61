"""Term table, k-means, linear scores and components in long form, against NumPy."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import rows
from outorga.risk import components, kmeans, linear
from outorga.risk.model import areas, confusion
from outorga.risk.text import term_counts, term_table, tf_idf
from outorga.session import cut_lineage
from pyspark.sql import functions as F


def test_term_table_stems_each_word_once(spark):
    docs = spark.createDataFrame([(1, "escolas escola rua"), (2, "ruas a"), (3, None), (4, "")], "id long, text string")
    table = term_table(docs, "id", "text")
    named = table.counts.join(table.vocabulary, "number")
    assert rows(named, "id", "term", "tf") == [(1, "escol", 2), (1, "rua", 1), (2, "rua", 1)]
    assert rows(table.vocabulary, "number") == [(1,), (2,)]
    assert tf_idf(docs.where("id > 2"), "id", "text").count() == 0


def test_terms_are_shuffled_once_and_worked_out_once(spark):
    docs = spark.createDataFrame([(1, "escolas escola rua"), (None, "rua")], "id long, text string")
    plan = term_counts(docs, "id", "text")._jdf.queryExecution().sparkPlan().toString()
    exchanges = term_counts(docs, "id", "text")._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert exchanges == 1 and plan.count("regexp_extract_all") == 1


def test_weights_without_a_key_and_repeated_keys(spark):
    docs = spark.createDataFrame([(1, "rua rua"), (None, "rua casa"), (2, "casa"), (2, "rua"), (3, None)], "id long, text string")
    got = rows(tf_idf(docs.repartition(3), "id", "text"), "id", "term", "tf", "df", F.round("weight", 6).alias("weight"))
    casa, rua = math.log(6 / 3) + 1, math.log(6 / 4) + 1  # the row without a key counts for df, with its terms
    length = math.hypot(casa, rua)
    assert [r[:4] for r in got] == [(1, "rua", 2, 3), (2, "cas", 1, 2), (2, "rua", 1, 3)]
    assert [r[4] for r in got] == [1.0, round(casa / length, 6), round(rua / length, 6)]


def test_centres_leave_out_columns_that_round_to_zero(spark):
    cells = [(i, "all", 900) for i in range(5)] + [(0, "rare", 2), (4, "minus", -2)]
    points = spark.createDataFrame(cells, "key long, column string, x long")
    members = spark.createDataFrame([(i, 0) for i in range(5)], "key long, cluster int")
    assert rows(kmeans.centres_of(points, members, 2)) == [("all", [900, 0])]
    given = spark.createDataFrame([("all", [900, 0]), ("rare", [1, 0])], "column string, c array<long>")
    assert rows(kmeans.step(points, given, 2)) == [("all", [900, 0])]


def cloud(n: int = 60, k: int = 3, d: int = 6):
    rng = np.random.default_rng(4)
    middle = rng.integers(1, 50, (k, d)) * (rng.random((k, d)) < 0.6)
    return np.array([middle[i % k] * 1000 + (middle[i % k] > 0) * rng.integers(-40, 40, d) for i in range(n)])


def as_points(spark, x, parts):
    cells = [(i, f"c{j}", int(v)) for i, row in enumerate(x) for j, v in enumerate(row) if v]
    random.Random(parts).shuffle(cells)
    return spark.createDataFrame(cells, "key long, column string, x long").repartition(parts)


def dense(centres, k, d):
    out = np.zeros((k, d), np.int64)
    for r in centres.collect():
        out[:, int(r["column"][1:])] = r["c"]
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_lloyd_step_equals_numpy(spark, parts):
    x, k = cloud(), 4
    points = as_points(spark, x, parts)
    start = np.vstack([x[:3], [10**9] * 6])  # nobody is near the last one
    given = spark.createDataFrame([(f"c{j}", [int(v) for v in start[:, j]]) for j in range(6)], "column string, c array<long>")
    far = {r["key"]: r["distances"] for r in kmeans.squared_distances(points, given, k).collect()}
    want = ((x[:, None].astype(object) - start[None].astype(object)) ** 2).sum(2)
    assert all(far[i] == list(want[i]) for i in far) and len(far) == len(x)
    near = want.argmin(1)
    moved = dense(kmeans.step(points, given, k), k, 6)
    for j in range(3):
        members = x[near == j]
        assert (moved[j] == [math.floor((2 * int(s) + len(members)) / (2 * len(members))) for s in members.sum(0)]).all()
    assert (moved[3] == start[3]).all()


def test_clusters_do_not_depend_on_partitions(spark):
    x, k = cloud(), 3
    results = []
    for parts in (1, 4):
        points = as_points(spark, x, parts)
        found = {r["key"]: r["cluster"] for r in kmeans.assigned(points, kmeans.fit(points, k), k).collect()}
        results.append(found)
    assert results[0] == results[1]
    groups = [{results[0][i] for i in range(g, len(x), k)} for g in range(k)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == k
    same = spark.createDataFrame([(1, "a", 5), (2, "a", 5)], "key long, column string, x long")
    assert kmeans.seeds(same, 3).count() == 1 and kmeans.assigned(same, kmeans.fit(same, 2), 2).count() == 2


def test_steps_leave_the_points_where_they_are(spark, monkeypatch):
    """Members that are too many for a broadcast come to the points; the points are not shuffled for each step."""
    points, plans = cut_lineage(as_points(spark, cloud(), 3)), []
    want = rows(kmeans.fit(points, 3, steps=2), F.sort_array("c").alias("c"), "column")
    keep = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(keep)

    def noted(points_, members, k, whole=kmeans.centres_of):
        plans.append(points_.join(members, "key")._jdf.queryExecution().executedPlan().toString())
        return whole(points_, members, k)

    monkeypatch.setattr(kmeans, "centres_of", noted)
    spark.conf.set(keep, "-1")
    try:
        assert rows(kmeans.fit(points, 3, steps=2), F.sort_array("c").alias("c"), "column") == want != []
    finally:
        spark.conf.set(keep, before)
    held = [p.split("InMemoryRelation")[0] for p in plans]
    assert len(held) > 3 and all("InMemoryTableScan" in p and p.count("Exchange hashpartitioning") <= 1 for p in held)


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(8)
    data = [(i, rng.choice([None, 1.0, 2.5, 9.0]), 4.0, rng.choice(["A", "B", None]), rng.choice(["p", "q", "r", "s"])) for i in range(200)]
    return data, spark.createDataFrame(data, "r long, a double, flat double, kind string, who string")


def cells(frame):
    return linear.long_features(frame, "r", linear.statistics(frame, ["a", "flat"]), ["a", "flat"], ["kind"], ["who"])


def test_long_features_and_scores(spark, frame):
    data, df = frame
    known = [a for _, a, *_ in data if a is not None]
    mean, deviation = np.mean(known), np.std(known, ddof=1)
    want = {(r, "1"): 1.0 for r, *_ in data} | {(r, f"kind={k or ''}"): 1.0 for r, _, _, k, _ in data}
    want |= {(r, "a"): (a - mean) / deviation for r, a, *_ in data if a is not None} | {(r, "a?"): 1.0 for r, a, *_ in data if a is None}
    got = {(r["row"], r["column"]): r["value"] for r in cells(df).collect()}
    hashed = {key: got.pop(key) for key in list(got) if "#" in key[1]}
    assert len(hashed) == 200 and len({c for _, c in hashed}) == 4
    assert got.keys() == want.keys() and all(got[key] == pytest.approx(want[key]) for key in want)
    weights = spark.createDataFrame([("1", -0.5), ("a", 2.0), ("kind=A", 1.0), ("never", 9.0)], "column string, weight double")
    scored = {r["r"]: r["INSUCESSO"] for r in linear.predicted(df, "r", cells(df), weights, proba=True).collect()}
    for r, a, _, k, _ in data:
        score = -0.5 + 2 * (0 if a is None else (a - mean) / deviation) + (k == "A")
        assert scored[r] == pytest.approx(1 / (1 + math.exp(-score)))


def test_linear_model_learns(spark, frame):
    _, df = frame
    labels = df.select(F.col("r").alias("row"), F.when((F.col("who") == "p") | (F.col("a") > 5), 1).otherwise(0).alias("label"))
    weights = linear.fit(cells(df), labels)
    scored = linear.predicted(df, "r", cells(df), weights, proba=True, name="p").join(labels, F.col("r") == F.col("row"))
    value = {r["metric"]: r["value"] for r in areas(scored, "p", "label").collect()}
    assert value["areaUnderROC"] > 0.95


def test_components_equal_numpy(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(120, 8)) * [9, 5, 3, 1, 1, 0.5, 0.2, 0] * (rng.random((120, 8)) < 0.7) + [3, 0, 0, 1, 0, 0, 0, 0], 3)
    table = spark.createDataFrame([(i, f"c{j}", float(v)) for i, row in enumerate(x) for j, v in enumerate(row) if v], "row long, column string, value double")
    directions, variances, total = components.principal_components(table, 3, turns=15)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    assert variances == pytest.approx(list(values[::-1][:3]), rel=1e-5) and total == pytest.approx(values.sum())
    got = np.zeros((8, 3))
    for r in directions.collect():
        got[int(r["column"][1:])] = r["v"]
    for j in range(3):
        assert abs(got[:, j] @ vectors[:, -1 - j]) == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("slot", [100_000, 7, 1])
def test_areas_and_confusion(spark, slot):
    rng = random.Random(9)
    data = [(rng.choice([None, *[k / 10 for k in range(11)]]), rng.choice([0, 0, 1])) for _ in range(300)]
    df = spark.createDataFrame(data, "s double, y int")
    got = {r["metric"]: r["value"] for r in areas(df, "s", "y", slot).collect()}
    known = [(s, y) for s, y in data if s is not None]
    pos, neg = [s for s, y in known if y], [s for s, y in known if not y]
    assert got["areaUnderROC"] == pytest.approx(sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg))
    points = []
    for t in sorted({s for s, _ in known}, reverse=True):
        hits = sum(s >= t for s in pos)
        points.append((hits / len(pos), hits / sum(s >= t for s, _ in known)))
    points.insert(0, (0.0, points[0][1]))
    assert got["areaUnderPR"] == pytest.approx(sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:])))
    one = {r["metric"]: r["value"] for r in areas(df.where("y = 1"), "s", "y", slot).collect()}
    assert one == {"areaUnderROC": None, "areaUnderPR": 1.0}
    none = {r["metric"]: r["value"] for r in confusion(df.where("false"), "s", "y").collect()}
    assert none == {"accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}
