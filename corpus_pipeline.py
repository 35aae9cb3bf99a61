"""Documents to packed training sequences: quality, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns the columns of
documents; the last one returns the pieces and their places in the sequences. Stages are written to the shared
folder and read back, so a lost executor costs no more than the stage it worked on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from outorga.llm import decontaminate, jaccard, packing, pii, quality
from outorga.llm.common import importable, stored
from outorga.session import ensure_shared, tune


def _ready(spark: SparkSession) -> SparkSession:
    return importable(tune(ensure_shared(spark)))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the hierarchical quality model keeps."""
    return quality.kept(docs, _table(_ready(spark), sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    _ready(spark)
    return jaccard.distinct(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.clean(docs, _table(_ready(spark), sf_dir, "benchmark"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced by surrogates."""
    _ready(spark)
    return pii.pseudonymised(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 4096 tokens."""
    _ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontamination", decontaminated),
    ("personal_data", pseudonymised),
    ("packing", packed),
]

#: Keyed surrogates, trained models and tokenizers are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents."""
    docs = _table(_ready(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
