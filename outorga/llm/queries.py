"""Queries of the corpus operators: each applies its operator to a whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outorga.llm import (
    collocations, decontaminate, divergence, extract, jaccard, language, licences, lines, packing, pii, quality, spotsigs, warc)
from outorga.llm.common import importable
from outorga.llm.oracles import SQL  # noqa: F401
from outorga.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Callable[[str], DataFrame]], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(tune(spark))
        return fn(lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_decontamination(table) -> DataFrame:
    rows = decontaminate.judged(table("documents").select("doc_id", "text"), table("benchmark"))
    return rows.select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op2_surrogates(table) -> DataFrame:
    rows = pii.replaced(table("documents").select("doc_id", "text"))
    return rows.select(
        F.col("_row.doc_id").alias("doc_id"), "text", F.size("found").cast("long").alias("n_entities"),
        F.size(F.array_distinct("found")).cast("long").alias("n_distinct"),
        F.array_join(F.sort_array(F.array_distinct("found.kind")), ",").alias("kinds"))


@query
def op3_quality(table) -> DataFrame:
    rows = quality.judged(table("documents").select("doc_id", "text", "source", "lang"), table("labels"))
    return rows.select(F.col("_row.doc_id").alias("doc_id"), "p_document", "p_host", "p_path", "p_quality", "keep")


@query
def op4_language(table) -> DataFrame:
    documents = table("documents").select("doc_id", "text", "lang")
    return language.identify(documents, language.fit(documents))


@query
def op5_near_duplicates(table) -> DataFrame:
    return jaccard.near_duplicates(table("documents").select("doc_id", "text"))


@query
def op6_main_text(table) -> DataFrame:
    return extract.extract(table("pages"))


@query
def op7_packing(table) -> DataFrame:
    return packing.pack(table("documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_spot_signatures(table) -> DataFrame:
    return spotsigs.edited(table("documents"))


@query
def op9_warc(table) -> DataFrame:
    return warc.round_trip(table("pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_licences(table) -> DataFrame:
    return licences.scan(table("documents"))


@query
def op11_collocations(table) -> DataFrame:
    return collocations.collocations(table("documents"))


@query
def op12_line_dedup(table) -> DataFrame:
    rows = lines.deduplicated(table("documents").select("doc_id", "text"))
    return rows.select(F.col("_row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_divergence(table) -> DataFrame:
    return divergence.audit(table("documents"))


QUERIES["pipeline"] = corpus_pipeline.run
