"""Text clusters and the risk model."""

from __future__ import annotations

import math

import pytest
from outorga.risk import features, model
from outorga.risk.text import TextClusterer, tf_idf
from pyspark.sql import functions as F

THEMES = ["pavimentação asfáltica rua", "construção escola municipal", "aquisição ambulância hospital"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, f"{THEMES[n % 3]} lote {'abc'[n % 3] * 3}") for n in range(60)]
    return spark.createDataFrame([*rows, (60, ""), (61, None)], "id long, text string").persist()


def test_tf_idf_against_the_formula(spark):
    df = spark.createDataFrame([(1, "escola rua rua"), (2, "escola"), (3, "")], "id long, text string")
    got = {(r["id"], r["term"]): r["weight"] for r in tf_idf(df, "id", "text").collect()}
    idf = {"escol": math.log(4 / 3) + 1, "rua": math.log(4 / 2) + 1}
    length = math.hypot(idf["escol"], 2 * idf["rua"])
    assert got[1, "rua"] == pytest.approx(2 * idf["rua"] / length)
    assert got[1, "escol"] == pytest.approx(idf["escol"] / length)
    assert got[2, "escol"] == pytest.approx(1.0)
    assert len(got) == 3


def test_clusters(spark, docs):
    fitted = TextClusterer(k=4, width=512).fit(docs, "text")
    labels = {r["id"]: r["cluster"] for r in fitted.predict(docs, "text").collect()}
    groups = [{labels[n] for n in range(theme, 60, 3)} for theme in range(3)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    nearest = {r["id"]: min(range(4), key=lambda j: r["distances"][j])
               for r in fitted.distances(docs, "id", "text").collect()}
    assert nearest == labels
    assert fitted.predict_text(spark, THEMES[1] + " lote bbb") == labels[1]


def test_distances_match_vectors(docs):
    fitted = TextClusterer(k=4, width=512).fit(docs, "text")
    centres = fitted.model.clusterCenters()
    points = {r["id"]: r["_vector"].toArray() for r in fitted.weighted(fitted.counts(docs, "text")).collect()}
    for r in fitted.distances(docs, "id", "text").collect():
        want = [float(math.sqrt(((points[r["id"]] - c) ** 2).sum())) for c in centres]
        assert r["distances"] == pytest.approx(want, abs=1e-6)


@pytest.fixture(scope="module")
def frame(spark):
    n = F.col("id")
    return spark.range(400).select(
        n.alias("NR_CONVENIO"), (n * 10.0).alias("VL_REPASSE_CONV"), (n % 7).cast("double").alias("VL_CONTRAPARTIDA_CONV"),
        F.lit(0.0).alias("VALOR_EMENDA_CONVENIO"), (n % 5).alias("COD_ORGAO"), (n % 3).alias("COD_ORGAO_SUP"),
        (n % 90).alias("CODIGO_IBGE"), F.element_at(F.array(*map(F.lit, THEMES)), (n % 3 + 1).cast("int")).alias("OBJETO_PROPOSTA"),
        F.lit("MUNICIPAL").alias("NATUREZA_JURIDICA"), F.when(n % 4 == 0, "A").otherwise("B").alias("MODALIDADE"),
        (n % 90).cast("string").alias("IDENTIF_PROPONENTE"), F.when(n % 2 == 0, "SIM").otherwise("NAO").alias("COM_EMENDAS"),
        (n % 30).cast("string").alias("PRINCIPAL_PARLAMENTAR"), (n % 60).cast("string").alias("PRINCIPAL_FORNECEDOR"),
        F.when(n % 4 == 0, 1).otherwise(0).alias("LABEL")).persist()


@pytest.fixture(scope="module")
def fitted(frame):
    return model.fit(frame, components=8, hash_width=32, texts=TextClusterer(k=3, width=256))


def test_model_learns_and_scores(frame, fitted):
    metrics = {r["metric"]: r["value"] for r in model.validation_metrics(fitted, frame).collect()}
    assert metrics["areaUnderROC"] > 0.95
    scores = fitted.predict(frame, proba=True, scale=True).agg(F.min("INSUCESSO"), F.max("INSUCESSO")).first()
    assert 1 / (1 + math.e) <= scores[0] < scores[1] <= 1 / (1 + math.exp(-1))


def test_model_round_trip(spark, frame, fitted, tmp_path):
    fitted.save(spark, str(tmp_path / "model"))
    again = model.RiskModel.load(spark, str(tmp_path / "model"))
    pair = fitted.predict(again.predict(frame, proba=True, name="b"), proba=True, name="a")
    assert pair.where("abs(a - b) > 1e-12").count() == 0
    assert again.hyperparameters(spark).where("stage = 'KMeansModel' and parameter = 'k'").first()["value"] == "3"


def test_unseen_categories_are_scored(frame, fitted):
    odd = frame.limit(5).withColumn("MODALIDADE", F.lit("NEVER SEEN")).withColumn("OBJETO_PROPOSTA", F.lit("zzz"))
    assert fitted.predict(odd, proba=True).where("INSUCESSO is not null").count() == 5


def test_label_and_write_back(spark):
    df = spark.createDataFrame([(1, "INADIMPLENTE"), (2, "Convênio Rescindido"), (3, "EM EXECUÇÃO"), (4, None)], "k int, s string")
    assert [r["y"] for r in df.select("k", features.failure_label(F.col("s")).alias("y")).orderBy("k").collect()] == [1, 1, 0, 0]
    base = df.select("k", F.lit(0.0).alias("INSUCESSO"))
    scores = spark.createDataFrame([(2, 0.7)], "k int, v double")
    assert [r[1] for r in model.write_back(base, scores, "k", "INSUCESSO", "v").orderBy("k").collect()] == [0.0, 0.7, 0.0, 0.0]


def test_fitted_model_scores_after_a_snapshot(spark, frame, fitted, tmp_path):
    import datetime as dt

    from outorga.sources.snapshots import Snapshots

    before = fitted.predict(frame, proba=True).agg(F.sum("INSUCESSO")).first()[0]
    Snapshots(spark, str(tmp_path)).write(frame, "mart", "grants", dt.date(2022, 3, 5))
    assert fitted.predict(frame, proba=True).agg(F.sum("INSUCESSO")).first()[0] == pytest.approx(before)


def test_grants_with_gaps_are_scored_and_live_ones_not_learned(spark, frame, fitted):
    gaps = frame.withColumn("VL_REPASSE_CONV", F.lit(None).cast("double")).withColumn("COD_ORGAO", F.lit(None).cast("long"))
    scored = fitted.predict(gaps, proba=True)
    assert scored.columns == [*frame.columns, "INSUCESSO"] and scored.where("INSUCESSO is null or VL_REPASSE_CONV is not null").count() == 0
    grants = spark.createDataFrame([(1, features.fixed.LIVE_STATUS), (2, "INADIMPLENTE"), (3, None)], "k int, SIT_CONVENIO string")
    assert sorted(r["k"] for r in features.finished(grants).collect()) == [2, 3]


def test_catalog_scores_live_grants_and_learns_from_finished_ones(spark, frame, fitted, monkeypatch):
    from catalog import marts
    from catalog.registry import QUERIES

    key, learned = F.col("NR_CONVENIO"), []
    grants = frame.select("NR_CONVENIO", F.when(key % 2 == 0, features.fixed.LIVE_STATUS).otherwise("INADIMPLENTE").alias("SIT_CONVENIO"))
    monkeypatch.setattr(marts, "mart", lambda i: {"convenios": grants})
    monkeypatch.setattr(features, "feature_frame", lambda some, tables, label=False: frame.join(some.select("NR_CONVENIO"), "NR_CONVENIO"))
    monkeypatch.setattr(model, "fit", lambda f, **_: learned.append(f) or fitted)
    for name in ("m7_components", "m8_classify", "m10_appended_predictions"):
        assert QUERIES[name](spark, "/nowhere").count() == 400
    assert 0 < learned[0].count() < 200 and learned[0].where(key % 2 == 0).count() == 0


def test_payments_are_read_once_for_the_principal_supplier(spark, tmp_path):
    ledger = spark.createDataFrame([
        (1, "P", 7, 5), (1, "P", 8, 3), (1, "P", 8, 2), (1, "P", 9, 4), (2, "P", None, 6), (2, "P", 7, 1), (3, "P", 70, 1),
        (3, "T", 7, 9), (4, "P", 6, 1), (4, "P", 70, 1)], "NR_CONVENIO long, TIPO_MOV string, FORNECEDOR_ID long, VALOR_MOV long")
    suppliers = spark.createDataFrame([(7, "a"), (8, "b"), (9, "c"), (6, None)], "FORNECEDOR_ID long, IDENTIF_FORNECEDOR string")
    ledger.repartition(3).write.parquet(f"{tmp_path}/ledger")
    best = features.principal_supplier(spark.read.parquet(f"{tmp_path}/ledger"), suppliers)
    assert best.columns == ["NR_CONVENIO", "PRINCIPAL_FORNECEDOR"]
    assert sorted(map(tuple, best.collect())) == [(1, "b"), (4, None)]
    plan = best._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1


def test_what_is_appended_to_a_prediction_is_worked_out_with_it(fitted, frame):
    """Two columns appended one after the other are those appended alone, and the texts are stemmed once."""
    def key(r):
        return r["NR_CONVENIO"]

    labelled = fitted.predict(frame, name="said")
    both = fitted.predict(labelled, proba=True, name="chance")
    parts = fitted.components(both)
    assert parts.columns == [*frame.columns, "said", "chance", "components"]
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == fitted.components(frame)._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")
    got = {key(r): (r["said"], r["chance"], list(r["components"])) for r in parts.collect()}
    said = {key(r): r["INSUCESSO"] for r in fitted.predict(frame).collect()}
    chance = {key(r): r["INSUCESSO"] for r in fitted.predict(frame, proba=True).collect()}
    alone = {key(r): list(r["components"]) for r in fitted.components(frame).collect()}
    assert got == {k: (said[k], chance[k], alone[k]) for k in said}
    # a column named like one of the pipeline's hides none of them
    named = fitted.predict(frame, proba=True, name="prediction")
    assert fitted._last is None and named.columns == [*frame.columns, "prediction"]
