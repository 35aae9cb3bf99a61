"""Vocabulary, TF-IDF and k-means over short texts."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outorga.functions.stems import ACCENTED, PLAIN, stems, tokens
from outorga.operators.keys import dense_ids
from outorga.session import cut_lineage


def vocabulary_stems(docs: DataFrame, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """Distinct terms with their stem: terms fold map-side, and each is stemmed once."""
    terms = docs.select(F.explode(tokens(F.col(text), stop_words)).alias("term")).distinct()
    return terms.select("term", stems(F.array("term"))[0].alias("stem"))


class TermTable(NamedTuple):
    """Documents as numbers: ``vocabulary`` (number, term) of stems, ``counts`` (key, number, tf)."""

    vocabulary: DataFrame
    counts: DataFrame


def term_counts(docs: DataFrame, key: str, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """(key, term, tf) over stems of two letters or more. Words are stemmed where they are read: that costs less than
    to bring each (document, word) to the stem of the word, and only (document, term) is shuffled, once."""
    terms = stems(tokens(F.col(text), stop_words))
    # not the inner explode: the optimizer would work out the terms a second time, to ask whether there are any
    rows = docs.select(key, F.explode_outer(terms).alias("term")).where(F.length("term") > 1)
    return rows.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_table(docs: DataFrame, key: str, text: str, stop_words: list[str] | None = None) -> TermTable:
    """Tokenise and stem once, number the stems of two letters or more. Both tables are written to the shared folder,
    where counts, weights and clusters read them; terms repeated in a document fold before anything is shuffled."""
    counts = cut_lineage(term_counts(docs, key, text, stop_words))
    vocabulary = cut_lineage(dense_ids(counts.select("term").distinct(), "number", ["term"], unique=True))
    return TermTable(vocabulary, cut_lineage(counts.join(vocabulary, "term").select(key, "number", "tf")))


def term_weights(counts: DataFrame, key: str, document_total: int, term: str = "number") -> DataFrame:
    """(key, term, tf, df, weight): smoothed idf plus one, each document scaled to unit length. Rows without a key count
    for df, but get no weight.

    A term that is in every document makes its join key hot; the join is a plain equi-join, which adaptive execution
    broadcasts or splits. The rows of a document end up side by side, so sums by document fold where they are read."""
    frequencies = counts.groupBy(term).agg(F.count(F.lit(1)).alias("df"))
    met = counts.join(frequencies, term).where(F.col(key).isNotNull()).repartition(key)  # weights come after the shuffle
    idf = F.ln((F.lit(document_total) + 1) / (F.col("df") + 1)) + 1
    weighted = met.withColumn("w", F.col("tf") * idf)
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(key)))
    return weighted.select(key, term, "tf", "df", (F.col("w") / length).alias("weight"))


def tf_idf(docs: DataFrame, key: str, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """(key, term, tf, df, weight) of each document's stems."""
    return term_weights(cut_lineage(term_counts(docs, key, text, stop_words)), key, docs.count(), "term")


@dataclass
class TextClusterer:
    """TF-IDF and k-means over stems. Terms are hashed into ``width`` columns, so no vocabulary is
    gathered and none is cut; centres and idf take ``width`` numbers each, whatever the corpus."""

    k: int = 5
    seed: int = 0
    width: int = 2**15
    stop_words: list[str] = field(default_factory=list)
    accented: str = ACCENTED
    plain: str = PLAIN

    def columns(self, text: str) -> Column:
        """Hashed column names of the stems of a text."""
        words = stems(tokens(F.col(text), self.stop_words, self.accented, self.plain))
        words = F.filter(words, lambda w: F.length(w) > 1)
        return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(self.width)).cast("string"))

    def _counter(self) -> CountVectorizerModel:
        """Counts terms per column; its vocabulary is the ``width`` column names."""
        return CountVectorizerModel.from_vocabulary([str(k) for k in range(self.width)], inputCol="_terms", outputCol="_tf")

    def fit(self, docs: DataFrame, text: str) -> "TextClusters":
        clusters = TextClusters(self, self._counter(), [], None)
        counts = clusters.counts(docs.select(text), text).select("_tf").persist()  # several passes follow
        idf = IDF(inputCol="_tf", outputCol="_idf").fit(counts)
        clusters.scale = [float(i) + 1.0 if n > 0 else 0.0 for i, n in zip(idf.idf.toArray(), idf.docFreq)]
        points = clusters.weighted(counts).select("_vector")
        clusters.model = KMeans(
            k=self.k, seed=self.seed, featuresCol="_vector", predictionCol="cluster").fit(points)
        counts.unpersist()
        return clusters

    def fit_predict(self, docs: DataFrame, text: str) -> DataFrame:
        return self.fit(docs, text).predict(docs, text)

    def fit_transform(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        return self.fit(docs, text).distances(docs, key, text)


@dataclass
class TextClusters:
    """Fitted clusters. ``scale`` is idf + 1 per column, in the counter's column order."""

    spec: TextClusterer
    counter: CountVectorizerModel
    scale: list[float]
    model: KMeansModel | None

    def counts(self, docs: DataFrame, text: str) -> DataFrame:
        none = F.array().cast("array<string>")
        return self.counter.transform(docs.withColumn("_terms", F.coalesce(self.spec.columns(text), none)))

    def weighted(self, counts: DataFrame) -> DataFrame:
        """Append TF-IDF vectors of unit length."""
        scaled = ElementwiseProduct(
            scalingVec=Vectors.dense(self.scale), inputCol="_tf", outputCol="_scaled").transform(counts)
        return Normalizer(p=2.0, inputCol="_scaled", outputCol="_vector").transform(scaled).drop("_scaled")

    def predict(self, docs: DataFrame, text: str) -> DataFrame:
        """Append the number of the nearest centre."""
        return self.model.transform(self.weighted(self.counts(docs, text))).drop("_terms", "_tf", "_vector")

    def predict_text(self, spark: SparkSession, text: str) -> int:
        """Cluster of one text."""
        return self.predict(spark.createDataFrame([(text,)], "text string"), "text").first()["cluster"]

    def distances(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        """(key, distances): Euclidean distance of each document to every centre.

        In long form: the non-zero weights of a document meet the ``width`` rows of the centre
        table, and |x - c|^2 = |x|^2 - 2 x.c + |c|^2 takes one sum per centre."""
        centres = [c.tolist() for c in self.model.clusterCenters()]
        rows = zip(self.counter.vocabulary, self.scale, map(list, zip(*centres)))
        table = docs.sparkSession.createDataFrame(rows, "column string, scale double, centre array<double>")

        terms = docs.select(key, F.explode_outer(self.spec.columns(text)).alias("column"))
        counts = terms.groupBy(key, "column").agg(F.count("column").alias("tf"))
        # The centre table has exactly ``width`` rows of k numbers.
        weights = counts.join(F.broadcast(table), "column", "left").withColumn(
            "w", F.coalesce(F.col("tf") * F.col("scale"), F.lit(0.0)))
        dots = [F.coalesce(F.sum(F.col("w") * F.col("centre")[j]), F.lit(0.0)).alias(f"d{j}")
                for j in range(len(centres))]
        sums = weights.groupBy(key).agg(F.sum(F.col("w") * F.col("w")).alias("xx"), *dots)
        known = F.col("xx") > 0  # a document without terms is the zero vector

        def distance(j: int) -> Column:
            squared = sum(x * x for x in centres[j])
            gap = F.when(known, 1 - 2 * F.col(f"d{j}") / F.sqrt("xx")).otherwise(0.0)
            return F.sqrt(F.greatest(gap + squared, F.lit(0.0)))

        return sums.select(key, F.array(*[distance(j) for j in range(len(centres))]).alias("distances"))
