"""Encoding, classification and scoring with Spark ML."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import (
    PCA, CountVectorizerModel, FeatureHasher, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outorga.operators.ranking import SLOT, sums_above
from outorga.risk.features import CODES, NUMBERS, TEXTS, feature_frame, filled, live
from outorga.risk.text import TextClusterer, TextClusters
from outorga.session import cut_lineage, new_folder

CLUSTER = "OBJETO_GRUPO"
#: Categories whose values the register fixes, and the text groups; all others are open and are hashed.
ONE_HOT = ["COM_EMENDAS", "NATUREZA_JURIDICA", "MODALIDADE", CLUSTER]
HASHED = [c for c in TEXTS if c != "OBJETO_PROPOSTA" and c not in ONE_HOT] + [f"_{c}" for c in CODES]


def rescaled(probability: Column, slope: float = 2.0, middle: float = 0.5) -> Column:
    """Logistic rescale of a probability around ``middle``."""
    return 1 / (1 + F.exp(-slope * (probability - middle)))


def encoder(hash_width: int = 512, one_hot: list[str] = ONE_HOT, hashed: list[str] = HASHED) -> list:
    """Scale the numbers, give the categories of a closed domain a column each, hash the open ones, assemble."""
    return [
        VectorAssembler(inputCols=[f"_{c}" for c in NUMBERS], outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        StringIndexer(inputCols=one_hot, outputCols=[f"{c}_index" for c in one_hot], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_index" for c in one_hot], outputCols=[f"{c}_hot" for c in one_hot]),
        FeatureHasher(inputCols=hashed, outputCol="hashed", numFeatures=hash_width, categoricalCols=hashed),
        VectorAssembler(
            inputCols=["scaled", *[f"_{c}_FALTA" for c in NUMBERS], *[f"{c}_hot" for c in one_hot], "hashed"], outputCol="encoded"),
    ]


@dataclass
class RiskModel:
    """Text clusters of the object of the grant, and the pipeline over all features."""

    texts: TextClusters
    pipeline: PipelineModel
    #: What ``predict`` returned last, and the columns of the pipeline that it comes from.
    _last: tuple[DataFrame, DataFrame] | None = field(default=None, repr=False, compare=False)

    def _prepared(self, frame: DataFrame) -> DataFrame:
        return filled(self.texts.predict(frame, "OBJETO_PROPOSTA").withColumnRenamed("cluster", CLUSTER))

    def _scored(self, frame: DataFrame) -> DataFrame:
        """The frame with all columns of the pipeline. A frame that ``predict`` just returned goes on from the columns it
        was made of: texts are stemmed and rows encoded once for all that is appended to them."""
        if self._last is not None and self._last[0] is frame:
            return self._last[1]
        return self.pipeline.transform(self._prepared(frame))

    def predict(self, frame: DataFrame, proba: bool = False, scale: bool = False, name: str = "INSUCESSO") -> DataFrame:
        """Append the label (as double), the probability of failure, or that probability rescaled."""
        scored = self._scored(frame)
        probability = vector_to_array("probability")[1]
        value = (rescaled(probability) if scale else probability) if proba else F.col("prediction")
        appended = scored.select(*frame.columns, value.alias(name))
        self._last = None if name in scored.columns else (appended, scored.withColumn(name, value))
        return appended

    def components(self, frame: DataFrame) -> DataFrame:
        """Append the principal components the classifier sees."""
        return self._scored(frame).select(*frame.columns, vector_to_array("components").alias("components"))

    def hyperparameters(self, spark: SparkSession) -> DataFrame:
        """(stage, parameter, value) of every fitted stage."""
        rows = [
            (type(stage).__name__, param.name, str(value))
            for stage in [self.texts.model, *self.pipeline.stages]
            for param, value in stage.extractParamMap().items()]
        return spark.createDataFrame(rows, "stage string, parameter string, value string")

    def save(self, spark: SparkSession, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        self.texts.model.write().overwrite().save(f"{path}/clusters")
        self.texts.counter.write().overwrite().save(f"{path}/columns")
        spec = self.texts.spec
        text = json.dumps({
            "k": spec.k, "seed": spec.seed, "width": spec.width, "stop_words": spec.stop_words,
            "accented": spec.accented, "plain": spec.plain, "scale": self.texts.scale})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/texts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "RiskModel":
        spec = json.loads(spark.read.text(f"{path}/texts").first()["value"])
        scale = spec.pop("scale")
        texts = TextClusters(
            TextClusterer(**spec), CountVectorizerModel.load(f"{path}/columns"), scale,
            KMeansModel.load(f"{path}/clusters"))
        return RiskModel(texts, PipelineModel.load(f"{path}/pipeline"))


def fit(
    frame: DataFrame, components: int = 16, hash_width: int = 512, texts: TextClusterer | None = None,
    label: str = "LABEL",
) -> RiskModel:
    """Fit on a labelled feature frame. The PCA solves a square problem of the encoded width on the
    driver: ``hash_width`` and a column per value of a closed domain, independent of the number of rows."""
    clusters = (texts or TextClusterer()).fit(frame, "OBJETO_PROPOSTA")
    model = RiskModel(clusters, None)
    prepared = model._prepared(frame).persist()
    stages = [
        *encoder(hash_width),
        PCA(k=components, inputCol="encoded", outputCol="components"),
        LogisticRegression(featuresCol="components", labelCol=label, maxIter=20, regParam=0.01),
    ]
    # read back from the shared folder, stages carry no training summary (nor the session that it holds)
    folder = new_folder(frame.sparkSession)
    Pipeline(stages=stages).fit(prepared).write().save(folder)
    model.pipeline = PipelineModel.load(folder)
    prepared.unpersist()
    return model


def areas(scored: DataFrame, score: str, label: str, slot: int = SLOT) -> DataFrame:
    """(metric, value): areas under the receiver operating and precision-recall curves, from rank sums.

    Rows of one score are one point of both curves. What lies above a point are sums over higher scores, so the points
    need no order and no task holds them all; each adds its trapezoid. The precision before the first point is
    that of the first point. Without rows of one of the classes an area is null. Null scores and labels don't count."""
    hit = F.col(label).cast("double") == 1
    points = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("_score")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    points = sums_above(points, [], "_score", ["pos", "neg"], slot)
    pos, neg, pos_above, neg_above = (F.col(c) for c in ("pos", "neg", "pos_above", "neg_above"))
    precision = (pos_above + pos) / (pos_above + neg_above + pos + neg)
    before = F.when(pos_above + neg_above > 0, pos_above / (pos_above + neg_above)).otherwise(precision)
    sums = points.agg(
        F.sum(neg.cast("double") * (pos_above + pos / 2)).alias("roc"), F.sum(pos * (precision + before) / 2).alias("pr"),
        F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("n"))
    both = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("roc") / (F.col("p") * F.col("n")))
    return sums.select(
        both.alias("areaUnderROC"), F.when(F.col("p") > 0, F.col("pr") / F.col("p")).alias("areaUnderPR")).unpivot(
        [], ["areaUnderROC", "areaUnderPR"], "metric", "value")


def confusion(scored: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """(metric, value): accuracy, precision, recall and their harmonic mean where scores above the threshold say yes;
    a ratio without anything to divide by is 0."""
    says, is_so = F.col(score) > threshold, F.col(label).cast("double") == 1
    table = scored.agg(
        F.count_if(says & is_so).alias("tp"), F.count_if(says & ~is_so).alias("fp"),
        F.count_if(~says & is_so).alias("fn"), F.count(F.lit(1)).alias("n"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    tp, fp, fn, n = (F.col(c) for c in ("tp", "fp", "fn", "n"))
    return table.select(
        ratio(n - fp - fn, n).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1")).unpivot([], ["accuracy", "precision", "recall", "f1"], "metric", "value")


def validation_metrics(model: RiskModel, frame: DataFrame, label: str = "LABEL") -> DataFrame:
    """(metric, value): areas under the curves and the confusion-table ratios."""
    scored = cut_lineage(model.predict(frame, proba=True, name="score").select(label, "score"))
    return areas(scored, "score", label).unionByName(confusion(scored, "score", label))


def score_live(grants: DataFrame, mart: dict[str, DataFrame], model: RiskModel) -> DataFrame:
    """Grants fact with the rescaled risk of every live grant, joined by key. The highest score
    stands where a grant has several feature rows."""
    frame = feature_frame(live(grants), mart)
    scores = model.predict(frame, proba=True, scale=True, name="_score").groupBy("NR_CONVENIO").agg(
        F.max("_score").alias("_score"))
    return write_back(grants, scores, "NR_CONVENIO", "INSUCESSO", "_score")


def write_back(df: DataFrame, values: DataFrame, key: str, target: str, value: str) -> DataFrame:
    """Left join (key, value) and let the value replace the target where there is one."""
    joined = df.join(values.select(key, value), key, "left")
    return joined.withColumn(target, F.coalesce(value, target)).select(*df.columns)
